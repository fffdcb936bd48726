from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tradewind.config import Settings
from tradewind.operators.joins import (
    flatten_sku,
    interval_join,
    lookup_first,
    lookup_join,
    merge_first_non_null,
)
from tradewind.plans.orders import join_orders, payment_wide

T0 = datetime(2021, 1, 1, 12)


def at(seconds: float) -> datetime:
    return T0 + timedelta(seconds=seconds)


def pairs(left, right, lower, upper, **options):
    joined = interval_join(
        left, right, {"k": "k"}, "t", "t",
        timedelta(seconds=lower), timedelta(seconds=upper), **options,
    )
    return sorted((r[0], r[1]) for r in joined.select("l.id", "r.id").collect())


SIDE = "id int, k int, t timestamp"


@pytest.mark.parametrize(
    ("inclusive", "expected"), [(True, [2, 4]), (False, [])]
)
def test_interval_bounds(spark, inclusive, expected):
    left = spark.createDataFrame([(1, 1, at(0)), (9, None, at(0))], SIDE)
    right = spark.createDataFrame(
        [(1, 1, at(-5.001)), (2, 1, at(-5)), (3, 1, at(5.001)), (4, 1, at(5)),
         (5, None, at(0))],
        SIDE,
    )
    found = pairs(
        left, right, -5, 5, lower_inclusive=inclusive, upper_inclusive=inclusive
    )
    assert [r for _, r in found] == expected


def test_interval_join_against_brute_force_with_one_hot_key(spark):
    rnd = random.Random(7)
    make = lambda n: [
        (i, 0 if rnd.random() < 0.4 else rnd.randrange(1, 30), at(rnd.randrange(0, 4000) / 2))
        for i in range(n)
    ]
    a, b = make(400), make(400)
    left, right = spark.createDataFrame(a, SIDE), spark.createDataFrame(b, SIDE)
    want = sorted(
        (x[0], y[0]) for x in a for y in b
        if x[1] == y[1] and timedelta(seconds=-7) <= y[2] - x[2] < timedelta(seconds=3)
    )
    for tile in (None, 10, 11, 5000):
        width = timedelta(seconds=tile) if tile else None
        assert pairs(left, right, -7, 3, upper_inclusive=False, tile=width) == want


def test_interval_join_rejects_bad_bounds(spark):
    side = spark.createDataFrame([(1, 1, at(0))], SIDE)
    with pytest.raises(ValueError, match="upper bound"):
        pairs(side, side, 1, -1)
    with pytest.raises(ValueError, match="tile"):
        pairs(side, side, -5, 5, tile=timedelta(seconds=1))


def test_facts_are_never_broadcast(spark):
    side = spark.createDataFrame([(1, 1, at(0))], SIDE)
    joined = interval_join(
        side, side, {"k": "k"}, "t", "t", timedelta(0), timedelta(seconds=1)
    )
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_lookup_hits_misses_nulls_and_repeated_keys(spark):
    facts = spark.createDataFrame([(1, 10), (2, 11), (3, None), (4, 12)], "id int, key bigint")
    dim = spark.createDataFrame(
        [("10", "a", 1), ("12", "x", 2), ("12", "b", 3), (None, "n", 4)],
        "ID string, NAME string, N int",
    )
    found = lookup_join(facts, dim, {"key": "ID"}, {"name": "NAME", "n": "N"})
    got = {r.id: (r.name, r.n) for r in found.collect()}
    assert got == {1: ("a", 1), 2: (None, None), 3: (None, None), 4: ("b", 3)}


def test_lookup_by_two_keys_and_without_keys(spark):
    dim = spark.createDataFrame([("a", "x", 1), ("a", "y", 2)], "p string, q string, v int")
    facts = spark.createDataFrame([("a", "y"), ("b", "y")], "p string, q string")
    found = lookup_join(facts, dim, {"p": "p", "q": "q"}, {"v": "v"}, unique=True)
    assert sorted((r.p, r.v) for r in found.collect()) == [("a", 2), ("b", None)]
    with pytest.raises(ValueError, match="at least one key"):
        lookup_join(facts, dim, {}, {"v": "v"})
    with pytest.raises(ValueError, match="at least one key"):
        lookup_first(dim)
    assert lookup_first(dim, p="a", q="y").collect()[0].v == 2
    assert lookup_first(dim, p="zzz").collect() == []


def test_flattened_sku_keeps_every_sku(spark):
    make = spark.createDataFrame
    sku = make(
        [("1", "s", "2", "3", "4"), ("9", "t", "x", None, "4")],
        "ID string, SKU_NAME string, CATEGORY3_ID string, SPU_ID string, TM_ID string",
    )
    flat = flatten_sku(
        sku, make([("3", "spu")], "ID string, SPU_NAME string"),
        make([("4", "tm")], "ID string, TM_NAME string"),
        make([("2", "cat")], "ID string, NAME string"),
    )
    got = {r.ID: (r.SPU_NAME, r.TM_NAME, r.CATEGORY3_NAME) for r in flat.collect()}
    assert got == {"1": ("spu", "tm", "cat"), "9": (None, "tm", None)}


def test_first_non_null_merge(spark):
    left = spark.createDataFrame([(1, None, 5.0), (2, "b", None)], "k int, s string, d double")
    right = spark.createDataFrame([(1, "z", 6.0), (2, "y", 7.0)], "k int, s string, d double")
    merged = merge_first_non_null(left, right, ["k"], keep_left=("d",))
    assert sorted(tuple(r) for r in merged.collect()) == [(1, "z", 5.0), (2, "b", None)]


ORDER = (
    "id bigint, province_id bigint, order_status string, user_id bigint, "
    "total_amount decimal(16,2), activity_reduce_amount decimal(16,2), "
    "coupon_reduce_amount decimal(16,2), original_total_amount decimal(16,2), "
    "feight_fee decimal(16,2), create_time string, create_date string, "
    "create_hour string, rowtime timestamp"
)
DETAIL = (
    "id bigint, order_id bigint, sku_id bigint, order_price decimal(16,2), sku_num bigint, "
    "sku_name string, split_total_amount decimal(16,2), "
    "split_activity_amount decimal(16,2), split_coupon_amount decimal(16,2), "
    "rowtime timestamp"
)
PAYMENT = (
    "id bigint, order_id bigint, user_id bigint, total_amount decimal(16,2), "
    "subject string, payment_type string, create_time string, callback_time string, "
    "rowtime timestamp"
)


def _order(key, seconds):
    return (key, 3, "1001", 8, None, None, None, None, None, "t", "d", "h", at(seconds))


def _detail(key, order, seconds):
    return (key, order, 5, None, 2, "n", None, None, None, at(seconds))


def test_order_join_gives_one_row_per_detail(spark):
    orders = spark.createDataFrame([_order(1, 0), _order(2, 0)], ORDER)
    details = spark.createDataFrame(
        [_detail(10, 1, 5), _detail(11, 1, -5), _detail(12, 2, 6), _detail(13, 7, 0)], DETAIL
    )
    wide = join_orders(orders, details, Settings())
    assert sorted(r.detail_id for r in wide.collect()) == [10, 11]
    assert {"expire_time", "operate_time", "split_feight_fee"} <= set(wide.columns)


def test_payment_bounds_and_whose_value_stands(spark):
    orders = spark.createDataFrame(
        [_order(1, 0), _order(2, -900), _order(3, -900.001), _order(4, 0.001)], ORDER
    )
    details = spark.createDataFrame(
        [_detail(10 + i, i, s) for i, s in ((1, 0), (2, -900), (3, -900.001), (4, 0.001))],
        DETAIL,
    )
    wide = join_orders(orders, details, Settings())
    payments = spark.createDataFrame(
        [(100 + i, i, None, None, "s", "1101", "p", None, at(0)) for i in (1, 2, 3, 4)],
        PAYMENT,
    )
    paid = payment_wide(payments, wide, Settings()).collect()
    assert sorted(r.payment_id for r in paid) == [101, 102]
    # The payment's null user stands over the order's user 8.
    assert {r.user_id for r in paid} == {None}
    assert {(r.payment_create_time, r.order_create_time) for r in paid} == {("p", "t")}


def test_hot_payment_key_is_split_by_time(spark):
    """All rows under one key: the equi-key still has one value per time tile."""
    rows = [(i, 1, at(20 * i)) for i in range(200)]
    side = spark.createDataFrame(rows, SIDE)
    joined = interval_join(
        side, side, {"k": "k"}, "t", "t", timedelta(seconds=-5), timedelta(seconds=5)
    )
    tiles = joined.select(F.col("r._tile")).distinct().count()
    assert joined.count() == 200
    assert tiles > 50


@pytest.fixture
def eager_skew(spark):
    """Adaptive skew handling with thresholds that small test data can reach."""
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in changed}
    for k, v in changed.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_hot_lookup_key_is_split_by_adaptive_execution(spark, eager_skew):
    n = 60_000
    facts = spark.range(0, n, 1, 8).select(
        "id", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("key")
    )
    dim = spark.range(n).select(
        F.col("id").alias("ID"), F.concat(F.lit("name-"), "id").alias("NAME")
    )
    found = lookup_join(facts, dim, {"key": "ID"}, {"name": "NAME"}, unique=True)
    rows = found.collect()
    assert len(rows) == n and all(r.name == f"name-{r.key}" for r in rows)
    assert "skew=true" in found._jdf.queryExecution().executedPlan().toString()


def test_hot_keys_of_a_lookup_are_dealt_out(spark):
    """Half the rows on one key, a tenth on none: same rows as without, and no full task."""
    from statistics import median

    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "8"}
    before = {k: spark.conf.get(k) for k in conf}
    facts = spark.range(20000).select(
        "id", F.when(F.col("id") % 2 == 0, 7).when(F.col("id") % 10 == 1, None).otherwise(F.col("id")).alias("user")
    )
    dim = spark.range(0, 20000, 3).select(F.col("id").cast("string").alias("key"), (-F.col("id")).alias("v"))
    dim = dim.unionByName(spark.createDataFrame([("7", -1), ("7", -2), (None, 0)], "key string, v bigint"))
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        dealt = lookup_join(facts, dim, {"user": "key"}, {"found": "v"}, spread=64)
        assert dealt.columns == ["id", "user", "found"]
        sizes = [r["count"] for r in dealt.groupBy(F.spark_partition_id()).count().collect()]
        plain = lookup_join(facts, dim, {"user": "key"}, {"found": "v"})
        assert sorted(map(tuple, dealt.collect())) == sorted(map(tuple, plain.collect()))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(sizes) == 8 and max(sizes) < 2 * median(sizes)
    assert lookup_join(facts.limit(0), dim, {"user": "key"}, {"found": "v"}, spread=8).count() == 0


def test_a_replay_in_time_order_keeps_the_state_small(spark, tmp_path):
    from tradewind.operators.windows import watermarked
    from tradewind.sources.shop import replayed
    from tradewind.streaming.sinks import finish, table_writer

    # Newest first, many rows of one time, times between two milliseconds, and none.
    time = "CASE WHEN id % 50 > 0 THEN timestamp_micros((5000 - id div 4) * 900) END"
    left = spark.range(2000).selectExpr("id", f"{time} rowtime")
    right = spark.range(2000).selectExpr("id order_id", f"{time} + INTERVAL '0.001' SECOND rowtime", "id v")
    span = timedelta(milliseconds=2)
    pairs = lambda a, b: interval_join(
        a, b, {"id": "order_id"}, "rowtime", "rowtime", -span, span
    ).select("l.id", "r.v")
    want = sorted(map(tuple, pairs(left, right).collect()))
    assert len(want) == 1960
    streams = replayed({"l": (left, F.col("rowtime")), "r": (right, F.col("rowtime"))}, 400)
    a, b = (watermarked(streams[n], "rowtime", timedelta(0)) for n in "lr")
    query = table_writer(pairs(a, b), f"{tmp_path}/out", f"{tmp_path}/ck").trigger(availableNow=True).start()
    finish(query)
    assert sorted(map(tuple, spark.read.parquet(f"{tmp_path}/out").collect())) == want
    states = [p.stateOperators[0] for p in query.recentProgress]
    assert len(states) >= 10 and max(s.numRowsTotal for s in states) < 1500
    assert all(s.numRowsDroppedByWatermark == 0 for s in states)
