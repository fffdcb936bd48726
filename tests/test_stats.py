from __future__ import annotations

from datetime import datetime, timedelta, timezone
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tradewind import schemas
from tradewind.config import Settings
from tradewind.operators import metrics as M
from tradewind.operators.windows import label_window, tumbling_sum, watermarked
from tradewind.plans import stats
from tradewind.streaming.sinks import RefinedTable, finish, jdbc_columns, run_available

T0 = datetime(2021, 1, 1, tzinfo=timezone.utc)
UTC = Settings(business_tz="UTC")


def at(seconds: float) -> datetime:
    return T0 + timedelta(seconds=seconds)


def test_window_edges(spark):
    df = spark.createDataFrame([(at(0), 1), (at(9.999), 1), (at(10), 1), (None, 1)], "t timestamp, n int")
    rows = label_window(tumbling_sum(df, [], ["n"], "t", timedelta(seconds=10)), "+08:00").collect()
    assert sorted((r.stt, r.edt, r.n) for r in rows) == [
        ("2021-01-01 08:00:00", "2021-01-01 08:00:10", 2),
        ("2021-01-01 08:00:10", "2021-01-01 08:00:20", 1),
    ]


EMPTY = {
    "page": "common struct<mid:string>, page struct<page_id:string,item:string,item_type:string>, "
            "displays array<struct<item:string,item_type:string>>, rowtime timestamp",
    "order_wide": "sku_id bigint, order_id bigint, sku_num bigint, "
                  "split_total_amount decimal(16,2), rowtime timestamp",
    "payment_wide": "sku_id bigint, order_id bigint, split_total_amount decimal(16,2), "
                    "rowtime timestamp",
    "cart": "sku_id bigint, rowtime timestamp",
    "favor": "sku_id bigint, rowtime timestamp",
    "refund": "sku_id bigint, order_id bigint, refund_amount decimal(16,2), rowtime timestamp",
    "comment": "sku_id bigint, appraise string, rowtime timestamp",
}
DIMS = {
    "sku": "ID string, SKU_NAME string, PRICE decimal(16,2), CATEGORY3_ID string, "
           "SPU_ID string, TM_ID string",
    "spu": "ID string, SPU_NAME string",
    "trademark": "ID string, TM_NAME string",
    "category3": "ID string, NAME string",
}


def product(spark, **rows):
    sources = {n: spark.createDataFrame(rows.get(n, []), s) for n, s in EMPTY.items()}
    dims = {
        n: spark.createDataFrame([("1", "one", Decimal(5), None, None, None)] if n == "sku" else [], s)
        for n, s in DIMS.items()
    }
    return {r.sku_id: r for r in stats.product_stats(sources, dims, UTC).collect()}


def test_product_ids_are_counted_once_per_kind(spark):
    d = Decimal("2.50")
    got = product(
        spark,
        order_wide=[(1, 7, 2, d, at(1)), (1, 7, 3, d, at(2)), (1, 8, 1, None, at(3))],
        payment_wide=[(1, 7, d, at(4)), (1, 7, d, at(4))],
        refund=[(1, 7, d, at(5)), (1, 9, d, at(5)), (1, 9, d, at(6))],
        cart=[(1, at(1)), (2, at(1))],
    )
    r = got[1]
    assert (r.order_ct, r.paid_order_ct, r.refund_order_ct) == (2, 1, 2)
    assert (r.order_sku_num, r.order_amount, r.payment_amount, r.refund_amount) == (
        6, Decimal("5.00"), Decimal("5.00"), Decimal("7.50"),
    )
    assert r.sku_name == "one" and got[2].sku_name is None
    assert (got[2].cart_ct, got[2].order_ct, got[2].order_amount) == (1, 0, 0)


def test_product_pages_tolerate_nulls(spark):
    got = product(spark, page=[
        (("m",), (None, "1", "sku_id"), None, at(0)),
        (("m",), ("good_detail", "1", "sku_id"), [("1", None), ("1", "sku_id")], at(1)),
        (("m",), ("good_detail", "1", "promo"), [], at(2)),
        (("m",), ("home", "1", "sku_id"), [("1", "sku_id")], at(3)),
    ])
    assert (got[1].click_ct, got[1].display_ct) == (1, 2)


PAGE = (
    "common struct<vc:string,ch:string,ar:string,is_new:string>, "
    "page struct<last_page_id:string,during_time:bigint>, rowtime timestamp"
)


def test_one_pass_page_metrics_sum_like_the_union(spark):
    pages = spark.createDataFrame(
        [(("v", "c", "a", "1"), (last, stay), at(i))
         for i, (last, stay) in enumerate([(None, 3), ("", None), (" ", 4), ("home", 5)])],
        PAGE,
    )

    def total(df):
        return df.agg(*(F.sum(c).alias(c) for c in M.VISITOR_SUMS)).first()

    union = M.union_metrics([M.page_metrics(pages), M.session_metrics(pages)])
    assert total(M.page_visit_metrics(pages)) == total(union)
    assert total(union).sv_ct == 3 and total(union).dur_sum == 12


def test_province_counts_orders_once_and_amounts_per_row(spark):
    schema = (
        "rowtime timestamp, province_id bigint, province_name string, "
        "province_area_code string, province_iso_code string, province_3166_2_code string, "
        "order_id bigint, total_amount decimal(16,2), split_total_amount decimal(16,2)"
    )
    where = (3, "n", None, "i", "x")
    rows = spark.createDataFrame(
        [(at(1), *where, 7, Decimal("9.60"), Decimal("4.60")),
         (at(2), *where, 7, Decimal("9.60"), Decimal("5.00")),
         (at(3), *where, None, Decimal("1.00"), Decimal("1.00"))],
        schema,
    )
    whole = stats.province_stats(rows, UTC).first()
    assert (whole.order_count, whole.order_amount) == (1, Decimal("20.20"))
    split = stats.province_stats(rows, UTC, measure="split_total_amount").first()
    assert split.order_amount == Decimal("10.60")


def chunks(spark, path, schema, *parts):
    for part in parts:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def test_late_rows_within_and_beyond_the_lateness(spark, tmp_path):
    """Delay 1 s plus lateness 2 s: a row 2.9 s behind still counts, one beyond is dropped."""
    schema = "t timestamp, n int"
    stream = chunks(
        spark, str(tmp_path / "in"), schema,
        [(at(5), 1)], [(at(12.9), 1)], [(at(9.999), 1)],
        [(at(13.1), 1)], [(at(13.2), 1)], [(at(9.5), 1)], [(at(1000), 1)],
    )
    delay = UTC.visitor_delay + UTC.visitor_lateness
    sums = tumbling_sum(watermarked(stream, "t", delay), [], ["n"], "t", UTC.window)
    rows = run_available(label_window(sums, "UTC"), "late").collect()
    # 9.999 arrives with the watermark at 9.9 and counts. A batch drops what is behind the
    # watermark its predecessor started with, so 9.5 comes one batch after 13.1 was taken.
    assert {r.stt: r.n for r in rows}["2021-01-01 00:00:00"] == 2


def test_restart_from_checkpoint_loses_and_repeats_nothing(spark, tmp_path):
    schema = "sku_id bigint, rowtime timestamp"
    src, out, ck = (str(tmp_path / n) for n in ("in", "out", "ck"))

    def run():
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
        timed = watermarked(M.cart_metrics(stream), "rowtime", timedelta(0))
        sums = tumbling_sum(timed, ["sku_id"], ["cart_ct"], "rowtime", UTC.window)
        finish(
            sums.writeStream.format("parquet").option("path", out)
            .option("checkpointLocation", ck).trigger(availableNow=True).start()
        )

    chunks(spark, src, schema, [(1, at(1)), (1, at(2))], [(1, at(3))])
    run()
    chunks(spark, src, schema, [(1, at(9)), (2, at(11))], [(9, at(1000))])
    run()
    run()
    rows = spark.read.parquet(out).select("window.start", "sku_id", "cart_ct").collect()
    assert sorted((r.sku_id, r.cart_ct) for r in rows) == [(1, 4), (2, 1)]


def test_distinct_counts_on_a_stream_equal_batch(spark, tmp_path):
    rows = [(i % 5, i % 7, 1, Decimal(i % 3), at(i % 40)) for i in range(300)]
    rows.sort(key=lambda r: r[-1])
    last = [(99, 99, 1, Decimal(0), at(10_000))]
    schema = EMPTY["order_wide"]
    stream = chunks(spark, str(tmp_path / "in"), schema, rows[:100], rows[100:], last)
    batch = spark.createDataFrame(rows, schema)

    def shaped(df):
        from tradewind.operators.windows import tumbling_distinct

        timed = watermarked(M.order_metrics(df), "rowtime", timedelta(seconds=1))
        return label_window(
            tumbling_distinct(
                timed, ["sku_id"], ["order_sku_num", "order_amount"], ["ref_id"],
                {"order_ct": F.lit(True)}, "rowtime", UTC.window,
            ),
            "UTC",
        )

    got = run_available(shaped(stream), "distinct").collect()
    want = shaped(batch).collect()
    key = lambda r: (r.stt, r.sku_id)
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, want), key=str)
    assert len({key(r) for r in got}) == len(got)


def test_interval_join_on_a_stream_equals_batch(spark, tmp_path):
    from tradewind.operators.joins import interval_join

    schema = "id int, k int, t timestamp"
    a = sorted(((i, i % 6, at(i * 7 % 90)) for i in range(120)), key=lambda r: r[2])
    b = sorted(((i, i % 6, at(i * 11 % 90)) for i in range(120)), key=lambda r: r[2])

    def joined(left, right):
        return interval_join(
            watermarked(left, "t", timedelta(0)), watermarked(right, "t", timedelta(0)),
            {"k": "k"}, "t", "t", timedelta(seconds=-4), timedelta(seconds=6),
            upper_inclusive=False,
        ).select(F.col("l.id").alias("a"), F.col("r.id").alias("b"))

    sides = [
        chunks(spark, str(tmp_path / n), schema, rows[:60], rows[60:])
        for n, rows in (("a", a), ("b", b))
    ]
    got = run_available(joined(*sides), "join").collect()
    want = joined(spark.createDataFrame(a, schema), spark.createDataFrame(b, schema)).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want)) and len(want) > 100


def test_unique_visits_on_a_stream_keep_one_per_device_day(spark, tmp_path):
    from tradewind.operators.visits import unique_visits

    schema = "id int, mid string, last string, rowtime timestamp"
    rows = [(i, f"m{i % 3}", None if i % 2 else "home", at(i * 3000)) for i in range(120)]
    stream = chunks(spark, str(tmp_path / "in"), schema, rows[:50], rows[50:80], rows[80:])
    names = {"mid": "mid", "last_page": "last", "tiebreak": ["id"]}
    got = run_available(unique_visits(stream, UTC, **names), "visits")
    want = unique_visits(spark.createDataFrame(rows, schema), UTC, **names)
    day = F.to_date("rowtime")
    assert sorted(got.select("mid", day).collect()) == sorted(want.select("mid", day).collect())


def test_refined_table_keeps_the_newest_row(spark, tmp_path):
    table = RefinedTable(spark, str(tmp_path / "t"), ["k"])
    table.write(spark.createDataFrame([("a", 1), ("b", 1)], "k string, n int"), 0)
    table.write(spark.createDataFrame([("a", 2)], "k string, n int"), 1)
    table.write(spark.createDataFrame([("a", 3)], "k string, n int"), 1)  # run again
    assert sorted(tuple(r) for r in table.read().collect()) == [("a", 3), ("b", 1)]


def test_sink_columns_are_chosen_by_name(spark):
    wide = spark.range(1).select(
        *(F.lit(0).alias(c) for c in [*reversed(schemas.PRODUCT_STATS_COLUMNS), "order_ids"])
    )
    assert jdbc_columns(wide, schemas.PRODUCT_STATS_COLUMNS).columns == schemas.PRODUCT_STATS_COLUMNS


@pytest.mark.parametrize("name", ["order_wide", "payment_wide"])
def test_record_widths(name):
    assert len(getattr(schemas, name.upper())) == {"order_wide": 35, "payment_wide": 36}[name]


def test_hot_sku_is_spread_over_its_ids(spark):
    """The first shuffle of the distinct count is keyed by id too, not by product alone."""
    rows = spark.createDataFrame([(1, i, 1, Decimal(1), at(1)) for i in range(50)], EMPTY["order_wide"])
    from tradewind.operators.windows import tumbling_distinct

    found = tumbling_distinct(
        M.order_metrics(rows), ["sku_id"], ["order_sku_num"], ["ref_id"],
        {"order_ct": F.lit(True)}, "rowtime", UTC.window,
    )
    plan = found._jdf.queryExecution().executedPlan().toString()
    first = plan.rindex("Exchange hashpartitioning")
    assert "ref_id" in plan[first:plan.index("\n", first)]


def test_failed_query_is_started_again(spark, tmp_path):
    from pyspark.errors import StreamingQueryException

    from tradewind.streaming.sinks import with_restarts

    starts = []

    def start(failures):
        stream = chunks(spark, str(tmp_path / "in"), "n int", [(1,)])
        starts.append(1)

        def each(batch, batch_id):
            if len(starts) <= failures:
                raise RuntimeError("not yet")

        return (
            stream.writeStream.foreachBatch(each)
            .option("checkpointLocation", str(tmp_path / f"ck{failures}"))
            .trigger(availableNow=True).start()
        )

    with_restarts(lambda: start(2), restarts=3, pause=0)
    assert len(starts) == 3
    starts.clear()
    with pytest.raises(StreamingQueryException):
        with_restarts(lambda: start(9), restarts=1, pause=0)
    assert len(starts) == 2


def test_the_product_job_joins_its_orders_once(spark, monkeypatch):
    from tradewind.plans import on_tables, orders

    calls, join = [], orders.order_wide
    monkeypatch.setattr(orders, "order_wide", lambda *a, **k: calls.append(1) or join(*a, **k))
    assert on_tables.product_stats_stream(spark, "/root/testdata/sf0.001").count() > 0
    assert len(calls) == 1
