"""Dimension tables folded in place, against a plain dictionary."""

from __future__ import annotations

import os
import random

import pytest

from tradewind.operators.joins import lookup_join
from tradewind.sources.dims import DimTable, StoredDims

FEED = "after map<string,string>, ts bigint"


def files_of(table):
    return {os.path.join(d, f) for d, _, names in os.walk(table.path) for f in names if f.endswith(".parquet")}


def test_batches_of_changes_equal_a_dictionary(spark, tmp_path):
    rng, table, want = random.Random(4), DimTable(spark, str(tmp_path), "d", ["id", "a", "b"], buckets=4).create(), {}
    for batch in range(5):
        feed = []
        for at in range(rng.randint(0, 30)):
            key = str(rng.randrange(12))
            change = {"id": key}
            for c in "ab":
                if rng.random() < 0.6:
                    change[c] = rng.choice([f"{c}{batch}.{at}", None])
            feed.append((change, at))
            want.setdefault(key, {"a": None, "b": None}).update({c: v for c, v in change.items() if c != "id"})
        feed += [({"a": "no key"}, 99), (None, 100)]
        rng.shuffle(feed)
        changes = spark.createDataFrame(feed, FEED)
        for _ in range(2):  # a batch run again changes nothing
            table.upsert(changes, batch, ["ts"])
    got = {r.id: {"a": r.a, "b": r.b} for r in table.read().collect()}
    assert got == want
    table.clean()
    assert {r.id: {"a": r.a, "b": r.b} for r in table.read().collect()} == want
    assert len(table._versions()) == 1
    moved = table.copy(f"{tmp_path}/other", buckets=7)
    assert {r.id: {"a": r.a, "b": r.b} for r in moved.read().collect()} == want


def test_a_batch_writes_and_a_lookup_reads_their_buckets_only(spark, tmp_path):
    table = DimTable(spark, str(tmp_path), "d", ["id", "v"], buckets=16)
    table.upsert(spark.createDataFrame([({"id": str(i), "v": "old"}, i) for i in range(500)], FEED), 0, ["ts"])
    first = files_of(table)
    table.upsert(spark.createDataFrame([({"id": "7", "v": "new"}, 1)], FEED), 1, ["ts"])
    assert len(files_of(table) - first) == 1
    one = table.read(only=spark.createDataFrame([(7,), (7,), (9999,)], "sku_id bigint"))
    assert [(r.id, r.v) for r in one.collect()] == [("7", "new")]
    assert len(one.inputFiles()) <= 2
    assert table.read().filter("v = 'old'").count() == 499
    # Another number of buckets asked for later changes nothing: the table keeps its own.
    again = DimTable(spark, str(tmp_path), "d", ["id", "v"], buckets=3)
    again.upsert(spark.createDataFrame([({"id": "8", "v": "new"}, 1)], FEED), 2, ["ts"])
    assert again.read().filter("v = 'new'").count() == 2


def test_a_batch_that_died_before_its_pointer_counts_for_nothing(spark, tmp_path, monkeypatch):
    table = DimTable(spark, str(tmp_path), "d", ["id", "v"]).create()
    changes = spark.createDataFrame([({"id": "1", "v": "a"}, 1)], FEED)

    def dies(*_):
        raise OSError("the driver died")

    monkeypatch.setattr(table, "_point", dies)
    with pytest.raises(OSError):
        table.upsert(changes, 0, ["ts"])
    monkeypatch.undo()
    assert table.read().count() == 0
    table.upsert(changes, 0, ["ts"])
    assert [tuple(r) for r in table.read().collect()] == [("1", "a")]
    table.clean()
    assert len(files_of(table)) == 1


def test_a_job_reads_the_tables_for_its_batch(spark, tmp_path):
    user = DimTable(spark, str(tmp_path), "user", ["id", "name"], buckets=8)
    user.upsert(spark.createDataFrame([({"id": str(i), "name": f"n{i}"}, i) for i in range(50)], FEED), 0, ["ts"])
    dims = StoredDims({"user": user, "all": user}, {"user": "user_id"})
    batch = spark.createDataFrame([(3, 30), (4, 40), (999, 1)], "user_id bigint, amount int")
    found = dims(batch)
    assert sorted(r.id for r in found["user"].collect()) == ["3", "4"] and found["all"].count() == 50
    rows = lookup_join(batch, found["user"], {"user_id": "id"}, {"user_name": "name"}).collect()
    assert {(r.user_id, r.user_name) for r in rows} == {(3, "n3"), (4, "n4"), (999, None)}
    assert dims()["user"].count() == 50


def test_refined_table_folds_open_rows_only(spark, tmp_path, monkeypatch):
    from pyspark.sql import functions as F

    from tradewind.streaming.sinks import RefinedTable

    table = RefinedTable(spark, str(tmp_path / "t"), ["w", "k"])
    frame = lambda *rows: spark.createDataFrame(rows, "w int, k string, n int")
    rows = lambda **kw: sorted((tuple(r) for r in table.read(**kw).collect()), key=str)
    with pytest.raises(ValueError):
        table.read()
    table.write(frame((1, "a", 1), (2, "a", 1)), 0, F.col("w") < 1)
    table.write(frame((1, "a", 2), (2, None, 7), (3, "a", 1)), 1, F.col("w") < 2)
    assert rows(only_closed=True) == [(1, "a", 2)]
    assert rows() == [(1, "a", 2), (2, "a", 1), (2, None, 7), (3, "a", 1)]
    # Run again with more closed than before, and dying while the closed rows move.
    finish = table._finish
    monkeypatch.setattr(table, "_finish", lambda part, replaced: None if part == table._state()[2] and replaced else finish(part, replaced))
    table.write(frame((1, "a", 3), (2, None, 7)), 1, F.col("w") < 3)
    monkeypatch.undo()
    assert rows(only_closed=True) == [(1, "a", 3), (2, "a", 1), (2, None, 7)]
    table.write(frame((3, "a", 5)), 2, F.col("w") < 3)
    assert rows(only_closed=True) == [(1, "a", 3), (2, "a", 1), (2, None, 7)]
    assert rows()[-1] == (3, "a", 5)
    part = table._state()[2]
    assert [tuple(r) for r in spark.read.parquet(f"{table.path}/_parts/{part}/closed=false").collect()] == [(3, "a", 5)]
    assert len(os.listdir(f"{table.path}/_parts")) <= 2
