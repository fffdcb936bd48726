from __future__ import annotations

import random
from dataclasses import replace
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tradewind.config import Settings
from tradewind.operators.visits import bounces, repair_new_visitor, unique_visits

T0 = datetime(2021, 1, 1, tzinfo=timezone.utc)
COLUMNS = "id int, mid string, flag string, last string, rowtime timestamp"
NAMES = {"mid": "mid", "last_page": "last", "tiebreak": ["id"]}


def at(seconds: float) -> datetime:
    return T0 + timedelta(seconds=seconds)


def pages(spark, rows):
    return spark.createDataFrame(
        [(i, mid, flag, last, None if s is None else at(s)) for i, (mid, s, last, flag) in enumerate(rows)], COLUMNS
    )


def entry(mid, s):
    return (mid, s, None, "0")


def inner(mid, s):
    return (mid, s, "home", "0")


@pytest.mark.parametrize(
    ("rows", "expected"),
    [
        ([entry("a", 0), entry("a", 3)], {0: "matched", 1: "timeout"}),
        ([entry("a", 0), inner("a", 9.999)], {}),
        ([entry("a", 0), inner("a", 10)], {0: "timeout"}),
        ([entry("a", 0)], {0: "timeout"}),
        ([entry("a", 0), entry("a", 1), entry("a", 2)],
         {0: "matched", 1: "matched", 2: "timeout"}),
        ([entry("a", 0), entry("b", 1), inner("a", 2)], {1: "timeout"}),
        ([("a", 0, "", "0"), ("b", 0, "  ", "0"), ("c", 0, None, "0"), ("d", 0, "\t", "0")],
         {0: "timeout", 1: "timeout", 2: "timeout", 3: "timeout"}),
        ([entry(None, 0)], {}),
        # A tile boundary (tiles start at multiples of 600 s) between the two pages.
        ([entry("a", 599), inner("a", 601)], {}),
        ([entry("a", 599), entry("a", 609)], {0: "timeout", 1: "timeout"}),
        ([entry("a", 599), entry("a", 600)], {0: "matched", 1: "timeout"}),
    ],
)
def test_bounces(spark, rows, expected):
    found = bounces(pages(spark, rows), Settings(), **NAMES)
    assert {r.id: r.reason for r in found.collect()} == expected


def brute_bounces(rows, within, times):
    by_mid = {}
    for i, (mid, s, last, _) in enumerate(rows):
        by_mid.setdefault(mid, []).append((s, i, last is None))
    out = {}
    for events in by_mid.values():
        events.sort()
        for n, (s, i, is_entry) in enumerate(events):
            if not is_entry:
                continue
            verdict = "matched"
            for step in range(1, times):
                if n + step >= len(events) or events[n + step][0] - s >= within:
                    verdict = "timeout"
                    break
                if not events[n + step][2]:
                    verdict = None
                    break
            if verdict:
                out[i] = verdict
    return out


@pytest.mark.parametrize("times", [2, 3])
def test_bounces_against_brute_force(spark, times):
    rnd = random.Random(times)
    rows = [
        (
            "hot" if rnd.random() < 0.4 else f"m{rnd.randrange(20)}",
            rnd.randrange(0, 6000) / 2,
            None if rnd.random() < 0.7 else "home",
            "0",
        )
        for _ in range(1500)
    ]
    settings = Settings(bounce_times=times)
    want = brute_bounces(rows, 10, times)
    for tile in (10, 37, 600, 10_000):
        found = bounces(
            pages(spark, rows), settings, tile=timedelta(seconds=tile), **NAMES
        )
        assert {r.id: r.reason for r in found.collect()} == want


def test_streaming_bounces_equal_batch(spark, tmp_path):
    from tradewind.operators.windows import watermarked
    from tradewind.streaming.sinks import run_available

    rnd = random.Random(3)
    rows = sorted(
        (
            ("hot" if rnd.random() < 0.4 else f"m{rnd.randrange(9)}", rnd.randrange(0, 2000) / 2,
             None if rnd.random() < 0.7 else "home", "0")
            for _ in range(600)
        ),
        key=lambda r: r[1],
    )
    rows.append(entry("end", 100_000))
    everything = pages(spark, rows)
    path = str(tmp_path / "in")
    for n in range(5):
        chunk = everything.filter((F.col("id") >= n * 121) & (F.col("id") < (n + 1) * 121))
        chunk.coalesce(1).write.mode("append").parquet(path)
    stream = (
        spark.readStream.schema(everything.schema).option("maxFilesPerTrigger", 1).parquet(path)
    )
    settings = Settings()
    found = run_available(
        bounces(
            watermarked(stream, "rowtime", settings.bounce_delay), settings,
            tile=timedelta(seconds=60), **NAMES,
        ),
        "bounce-test",
    )
    got = sorted((r.id, r.reason) for r in found.collect())
    want = brute_bounces(rows, 10, 2)
    del want[len(rows) - 1]  # still open
    assert got == sorted(want.items())
    assert found.filter("rowtime is null or mid is null").count() == 0

def test_devices_share_buckets_of_streaming_state(spark, tmp_path):
    from tradewind.operators.windows import watermarked
    from tradewind.streaming.sinks import table_writer

    rnd = random.Random(7)
    rows = [(f"m{rnd.randrange(90)}", rnd.randrange(0, 1000) / 2, None if rnd.random() < 0.7 else "home", "0") for _ in range(400)]
    rows.append(entry("end", 100_000))
    everything = pages(spark, rows)
    everything.write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(everything.schema).parquet(f"{tmp_path}/in")
    settings = Settings(state_buckets=5)
    found = bounces(watermarked(stream, "rowtime", settings.bounce_delay), settings, **NAMES)
    query = table_writer(found, f"{tmp_path}/out", f"{tmp_path}/ck").trigger(availableNow=True).start()
    query.awaitTermination()
    want = brute_bounces(rows, 10, 2)
    del want[len(rows) - 1]  # still open
    assert {r.id: r.reason for r in spark.read.parquet(f"{tmp_path}/out").collect()} == want
    # The states of two tiles and of the end are buckets; there are 91 devices.
    assert query.recentProgress[0].stateOperators[0].numRowsTotal <= 2 * 5 + 1


def flags(df):
    return {r.id: r.flag for r in df.collect()}


NEW = {"mid": "mid", "flag": "flag", "tiebreak": ["id"]}


@pytest.mark.parametrize(
    ("given", "expected"),
    [("1101", "1000"), ("01", "01"), ("000", "000"), ("11", "10")],
)
def test_new_visitor(spark, given, expected):
    rows = [("m", 5, None, f) for f in given]
    found = flags(repair_new_visitor(pages(spark, rows), **NEW))
    assert "".join(found[i] for i in sorted(found)) == expected


def test_new_visitor_keeps_records_without_device_and_known_devices_old(spark):
    rows = [(None, 0, None, "1"), (None, 1, None, "1"), ("m", 2, None, "1"), ("k", 3, None, "1")]
    seen = spark.createDataFrame([("k",)], "mid string")
    found = flags(repair_new_visitor(pages(spark, rows), seen=seen, **NEW))
    assert found == {0: "1", 1: "1", 2: "1", 3: "0"}


def test_new_visitor_with_records_without_time(spark):
    rows = [("m", None, None, "1"), ("m", 5, None, "1"), ("m", 3, None, "1"),
            ("n", None, None, "1"), ("n", None, None, "1"), ("m", 9, None, None)]
    found = flags(repair_new_visitor(pages(spark, rows), **NEW))
    assert found == {0: "0", 1: "0", 2: "1", 3: "1", 4: "0", 5: None}


def test_new_visitor_against_brute_force_with_one_hot_device(spark):
    rnd = random.Random(11)
    rows = [
        ("hot" if rnd.random() < 0.4 else f"m{rnd.randrange(40)}", rnd.randrange(200), None,
         rnd.choice("01"))
        for _ in range(1000)
    ]
    want, seen = {}, set()
    for i, (mid, _, _, flag) in sorted(enumerate(rows), key=lambda x: (x[1][1], x[0])):
        want[i] = "1" if flag == "1" and mid not in seen else "0"
        if flag == "1":
            seen.add(mid)
    assert flags(repair_new_visitor(pages(spark, rows), **NEW)) == want


def test_unique_visits(spark):
    rows = [
        entry("a", 3600), entry("a", 7200),
        inner("b", 100), entry("b", 200),
        # 15:59:59 and 16:00:00 UTC lie on two days at +08:00.
        entry("c", 16 * 3600 - 1), entry("c", 16 * 3600),
        entry(None, 5),
    ]
    found = unique_visits(pages(spark, rows), Settings(), **NAMES)
    assert sorted(r.id for r in found.collect()) == [0, 3, 4, 5]
    utc = unique_visits(pages(spark, rows), Settings(business_tz="UTC"), **NAMES)
    assert sorted(r.id for r in utc.collect()) == [0, 3, 4]


def test_hot_device_is_cut_before_the_shuffle(spark):
    plan = unique_visits(
        pages(spark, [entry("a", 0)]), Settings(), **NAMES
    )._jdf.queryExecution().executedPlan().toString()
    before_exchange = plan.split("Exchange hashpartitioning")[1]
    assert "WindowGroupLimit" in before_exchange and "Partial" in before_exchange


def test_settings_are_values():
    assert replace(Settings(), business_tz="UTC").business_tz == "UTC"
