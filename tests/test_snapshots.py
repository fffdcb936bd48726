"""Snapshots read in chunks while the table changes, and rows that leave without an old image."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F
from test_jobs import Bench

from tradewind.config import TOPICS
from tradewind.operators.changes import current_state, retract_by_key
from tradewind.operators.parse import parse_changes, snapshot_changes
from tradewind.operators.snapshots import MARKS, changes_after, number_chunk, whole_feed
from tradewind.streaming import jobs
from tradewind.streaming.sinks import finish, run_available, table_writer

COLUMNS = {"id": "bigint", "v": "string"}
CHANGE = "database string, table string, type string, before map<string,string>, after map<string,string>, ts bigint"


@pytest.fixture
def bench(spark, tmp_path):
    return Bench(spark, tmp_path)


def applied(table, log, upto):
    """Plain Python: the table after the log's changes up to a place."""
    table = dict(table)
    for kind, key, value, at in log:
        if at <= upto:
            table.pop(key, None) if kind == "delete" else table.update({key: value})
    return table


def row(kind, key, value, at):
    image = {"id": str(key), "v": value}
    gone = kind == "delete"
    return ("shop", "u", kind, {"id": str(key)} if gone else None, None if gone else image, at)


def random_log(rng, start, n):
    log, table = [], dict(start)
    for at in range(1, n + 1):
        key = rng.randrange(40)
        kind = "insert" if key not in table else rng.choice(["update", "delete"])
        log.append((kind, key, f"v{at}", at))
        table = applied(table, log[-1:], at)
    return log


def test_feed_of_chunks_read_at_any_moment(spark):
    rng = random.Random(1)
    for _ in range(3):
        start = {k: "old" for k in range(0, 40, 3)}
        log = random_log(rng, start, 120)
        rows, marks = [], []
        for chunk in range(4):
            low, seen, high = sorted(rng.sample(range(121), 3))
            marks.append((chunk, low, high))
            rows += [(k, v, chunk) for k, v in applied(start, log, seen).items() if k // 10 == chunk]
        snapshot = spark.createDataFrame(rows, "id bigint, v string, chunk bigint")
        read = snapshot_changes(snapshot.select("id", "v"), "shop", "u").withColumn("chunk", number_chunk("id", 10))
        changes = spark.createDataFrame([row(*c) for c in log], CHANGE)
        feed = whole_feed(read, spark.createDataFrame(marks, MARKS), changes, "id", number_chunk("id", 10))
        state = {r.id: r.v for r in current_state(feed, "id", COLUMNS).collect()}
        assert state == applied(start, log, 120)
        # As of its chunk's high mark a key comes once at most, and each later change once.
        high = {c: h for c, _, h in marks}
        got = feed.select(F.coalesce("after", "before")["id"].cast("int"), "ts").collect()
        later = [(k, at) for _, k, _, at in log if at > high[k // 10]]
        opening = [(k, high[k // 10]) for c in range(4) for k in applied(start, log, high[c]) if k // 10 == c]
        assert sorted(map(tuple, got)) == sorted(later + opening)


def test_chunk_of_odd_keys(spark):
    rows = [("1", None), ("-1", None), (None, "12"), ("x", None), (None, None)]
    changes = spark.createDataFrame([({"id": a} if a else None, {"id": b} if b else None) for a, b in rows],
                                    "after map<string,string>, before map<string,string>")
    assert [r[0] for r in changes.select(number_chunk("id", 10)).collect()] == [0, -1, 1, None, None]


def test_seed_job_goes_on_and_the_log_continues_it(bench):
    spark, log, table = bench.spark, [], {k: "old" for k in range(30)}

    def change(kind, key, value):
        log.append((kind, key, value, len(log) + 1))
        table.update(applied(table, log[-1:], len(log)))
        if kind == "delete":
            table.pop(key, None)

    def read(chunk, fails=()):
        if chunk in fails:
            raise OSError("the source went away")
        change("update", 10 * chunk + 1, f"before {chunk}")
        rows = [(k, v) for k, v in table.items() if k // 10 == chunk]
        change("update", 10 * chunk + 2, f"after {chunk}")
        change("delete", 10 * chunk + 3, None)
        change("insert", 10 * chunk + 3, "again")
        change("delete", 10 * chunk + 4, None)
        change("update", 5, f"in {chunk}")
        return spark.createDataFrame(rows, "id bigint, v string")

    chunk = number_chunk("id", 10)
    as_changes = lambda: spark.createDataFrame([row(*c) for c in log], CHANGE)
    seed = lambda r: jobs.seed_in_chunks(bench.w, "shop", "u", "id", chunk, range(3), r, lambda: len(log), as_changes)
    with pytest.raises(OSError):
        seed(lambda c: read(c, fails=(1,)))
    marks = seed(read)
    assert [r.chunk for r in marks.orderBy("chunk").collect()] == [0, 1, 2]
    change("update", 25, "last")

    opened = parse_changes(bench.topics.read(TOPICS["raw_changes"])).withColumns(
        {c: F.transform_values(c, lambda _, v: v.cast("string")) for c in ("before", "after")})
    path = f"{bench.w.root}/log"
    as_changes().write.parquet(path)
    stream = spark.readStream.schema(CHANGE).parquet(path)
    later = run_available(changes_after(stream, marks, chunk), "later")
    both = opened.unionByName(later)
    assert {r.id: r.v for r in current_state(both, "id", COLUMNS).collect()} == table
    keys = [r.id for r in opened.select(F.col("after")["id"].alias("id")).collect()]
    assert len(keys) == len(set(keys))


def test_rows_leave_as_the_last_change_left_them(spark, tmp_path):
    log = [("insert", 1, "a", 1), ("update", 1, "b", 2), ("delete", 1, None, 3), ("delete", 1, None, 4),
           ("insert", 1, "c", 5), ("update", 2, "x", 6), ("update", 2, None, 7), ("update", 2, "z", 8)]
    rows = [row(*c) for c in log] + [("shop", "u", "insert", None, None, 9), ("shop", "u", "insert", None, {"v": "no key"}, 10)]
    want = [(1, True, 1, "a"), (2, False, 1, "a"), (2, True, 1, "b"), (3, False, 1, "b"), (5, True, 1, "c"),
            (6, True, 2, "x"), (7, False, 2, "x"), (7, True, 2, None), (8, False, 2, None), (8, True, 2, "z")]
    changes = spark.createDataFrame(rows, CHANGE)
    got = retract_by_key(changes, "id", COLUMNS)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    path, out = f"{tmp_path}/in", f"{tmp_path}/out"
    for i in range(0, len(rows), 3):  # a load of three changes at a time, in one checkpoint
        changes.filter(F.col("ts").between(i + 1, i + 3)).write.mode("append").parquet(path)
        stream = spark.readStream.schema(CHANGE).parquet(path)
        writer = table_writer(retract_by_key(stream, "id", COLUMNS), out, f"{tmp_path}/checkpoint")
        finish(writer.trigger(availableNow=True).start())
    assert sorted(map(tuple, spark.read.parquet(out).collect()), key=str) == sorted(want, key=str)


def test_keys_share_buckets_of_last_images(spark, tmp_path):
    from tradewind.streaming.stateful import streaming_last_images

    changes = spark.range(300).selectExpr(
        "cast(id % 100 as string) _key", "id ts", "case when id % 7 > 0 then map('v', cast(id as string)) end _new"
    )
    changes.write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(changes.schema).parquet(f"{tmp_path}/in")
    pairs = streaming_last_images(stream, ["ts"], buckets=3)
    query = table_writer(pairs, f"{tmp_path}/out", f"{tmp_path}/ck").trigger(availableNow=True).start()
    finish(query)
    image = lambda i: {"v": str(i)} if i >= 0 and i % 7 else None
    got = spark.read.parquet(f"{tmp_path}/out").orderBy("ts").collect()
    assert [(r.ts, r._old, r._new) for r in got] == [(i, image(i - 100), image(i)) for i in range(300)]
    assert query.recentProgress[0].stateOperators[0].numRowsTotal == 3
