"""Shop records derived from the analytic tables (orders, lineitem, events, ...).

Each function gives the record shape that the job of the same name consumes, with
``rowtime`` as event time.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.config import TIME_FORMAT
from tradewind.session import run_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stream_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The same table read as a stream of its files.

    The path is given as a pattern, as the file source takes a plain path for a folder.
    """
    schema = table(spark, sf_dir, name).schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/{name}.parque[t]")


def _slice_of(at: Column, cuts: list[int], low: int, high: int) -> Column:
    """How many of ``cuts`` are at or below ``at``, by halving; a null counts as past them."""
    if low == high:
        return F.lit(low)
    mid = (low + high) // 2
    return F.when(at < cuts[mid], _slice_of(at, cuts, low, mid)).otherwise(_slice_of(at, cuts, mid + 1, high))


def replayed(
    tables: Mapping[str, tuple[DataFrame, Column]], rows: int, most: int = 48
) -> dict[str, DataFrame]:
    """Tables replayed as streams in the order of their event times, a slice of time a batch.

    A stream that gets a whole table as one batch holds all of it in state before its
    watermark first moves. Here each batch brings the next slice of every table, so state
    holds the open part of time and one slice: about ``rows`` rows, all tables taken together.
    It is more where many have one time, and from ``most`` slices on, as each batch reads the
    dimensions of its job anew. Slices are cut at whole milliseconds, the unit of
    watermarks, at the same places in all tables; so no row is late, whatever the order of a
    table is. ``tables`` maps a name to rows and their event time.
    """
    spark = next(iter(tables.values()))[0].sparkSession
    parts = min(most, max(1, -(-sum(df.count() for df, _ in tables.values()) // rows)))
    cuts = []
    if parts > 1:
        each = [df.select(F.unix_millis(time).alias("at")) for df, time in tables.values()]
        shares = [k / parts for k in range(1, parts)]
        every = reduce(DataFrame.unionAll, each)
        found = every.agg(F.percentile_approx("at", shares, 100 * parts)).first()[0]
        cuts = sorted(set(found or []))
    return {name: _replay(spark, name, df, time, cuts) for name, (df, time) in tables.items()}


def _replay(spark: SparkSession, name: str, df: DataFrame, time: Column, cuts: list[int]) -> DataFrame:
    path = run_dir(spark, f"replay-{name}")
    part = _slice_of(F.unix_millis(time), cuts, 0, len(cuts))
    sliced = df.withColumn("slice", part)
    # One file a slice: a batch takes whole files, so it never cuts a slice. Its row groups are
    # small, as tasks read a file by these.
    writer = sliced.repartition(len(cuts) + 1, "slice").write.partitionBy("slice")
    writer.option("maxRecordsPerFile", 0).option("parquet.block.size", 2 << 20).parquet(path)
    # The file source goes by times of change.
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    made = {}
    for status in files.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/slice=*/*.parquet")):
        at = status.getPath()
        made[int(at.getParent().getName().split("=")[1])] = (at, status.getModificationTime())
    last = max((t for _, t in made.values()), default=0)
    for k, (at, _) in made.items():
        files.setTimes(at, last - (len(cuts) - k) * 1000, -1)
    times = [files.getFileStatus(made[k][0]).getModificationTime() for k in sorted(made)]
    if any(a >= b for a, b in zip(times, times[1:], strict=False)):
        raise OSError(f"{path}: this file system does not take the times of a replay")
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1)
    return stream.parquet(f"{path}/slice=*/*.parquet")


def _ts(column: str) -> Column:
    return F.col(column).cast("timestamp")


def _money(column: str) -> Column:
    return F.col(column).cast("decimal(16,2)")


def order_info(orders: DataFrame, customer: DataFrame) -> DataFrame:
    who = customer.select("c_custkey", "c_nationkey")
    none = F.lit(None).cast("decimal(16,2)")
    placed = orders.join(who, orders.o_custkey == who.c_custkey, "left").select(
        F.col("o_orderkey").alias("id"),
        F.col("c_nationkey").cast("bigint").alias("province_id"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("o_custkey").alias("user_id"),
        _money("o_totalprice").alias("total_amount"),
        none.alias("activity_reduce_amount"),
        none.alias("coupon_reduce_amount"),
        none.alias("original_total_amount"),
        none.alias("feight_fee"),
        F.date_format("o_orderdate", TIME_FORMAT).alias("create_time"),
        _ts("o_orderdate").alias("rowtime"),
    )
    return placed.withColumns(
        {
            "create_date": F.substring("create_time", 1, 10),
            "create_hour": F.substring("create_time", 12, 2),
        }
    )


def order_detail(lineitem: DataFrame) -> DataFrame:
    price = _money("l_extendedprice")
    none = F.lit(None).cast("decimal(16,2)")
    return lineitem.select(
        F.col("l_linenumber").cast("bigint").alias("id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("sku_id"),
        F.col("l_quantity").cast("bigint").alias("sku_num"),
        F.lit(None).cast("string").alias("sku_name"),
        price.alias("order_price"),
        (price * (1 - F.col("l_discount").cast("decimal(4,2)"))).alias(
            "split_total_amount"
        ),
        none.alias("split_activity_amount"),
        none.alias("split_coupon_amount"),
        _ts("l_shipdate").alias("rowtime"),
    )


def payment_info(orders: DataFrame) -> DataFrame:
    paid = orders.filter(F.col("o_orderstatus") == "F")
    wait = F.make_dt_interval(mins=(F.col("o_orderkey") % 30).cast("int"))
    moment = F.col("o_orderdate").cast("timestamp") + wait
    kind = F.col("o_orderkey") % 3
    return paid.select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("user_id"),
        _money("o_totalprice").alias("total_amount"),
        F.lit(None).cast("string").alias("subject"),
        F.when(kind == 0, "1101").when(kind == 1, "1102").otherwise("1103").alias(
            "payment_type"
        ),
        F.date_format(moment, TIME_FORMAT).alias("create_time"),
        F.lit(None).cast("string").alias("callback_time"),
        moment.alias("rowtime"),
    )


def page_log(events: DataFrame) -> DataFrame:
    """Page records; an entry page is a ``view``. Keeps ``event_id`` as arrival order."""
    eid, user = F.col("event_id"), F.col("user_id")
    item = (eid % 2000).cast("string")
    shown = F.transform(
        F.slice(F.array(F.lit(0), F.lit(1)), F.lit(1), (eid % 3).cast("int")),
        lambda k: F.struct(
            ((eid + k) % 2000).cast("string").alias("item"),
            F.when((eid + k) % 5 == 0, "promo_id").otherwise("sku_id").alias("item_type"),
        ),
    )
    return events.select(
        F.struct(
            user.cast("string").alias("mid"),
            F.concat(F.lit("v"), (eid % 3).cast("string")).alias("vc"),
            F.concat(F.lit("c"), (eid % 4).cast("string")).alias("ch"),
            (user % 25).cast("string").alias("ar"),
            (eid % 2).cast("string").alias("is_new"),
        ).alias("common"),
        F.struct(
            F.when(F.col("event_type") == "click", "good_detail")
            .otherwise(F.col("event_type"))
            .alias("page_id"),
            F.when(F.col("event_type") != "view", "home").alias("last_page_id"),
            item.alias("item"),
            F.lit("sku_id").alias("item_type"),
            F.floor("value").cast("bigint").alias("during_time"),
        ).alias("page"),
        shown.alias("displays"),
        _ts("ts").alias("rowtime"),
        "event_id",
    )


def _sku_event(events: DataFrame, kind: str, *cols: Column) -> DataFrame:
    return events.filter(F.col("event_type") == kind).select(
        (F.col("event_id") % 2000).alias("sku_id"), *cols, _ts("ts").alias("rowtime")
    )


def favor_info(events: DataFrame) -> DataFrame:
    return _sku_event(events, "signup")


def cart_info(events: DataFrame) -> DataFrame:
    return _sku_event(events, "click")


def refund_info(events: DataFrame) -> DataFrame:
    return _sku_event(
        events,
        "error",
        (F.col("event_id") % 15000).alias("order_id"),
        _money("value").alias("refund_amount"),
    )


def comment_info(events: DataFrame) -> DataFrame:
    grade = (F.lit(1201) + F.col("event_id") % 4).cast("string")
    return _sku_event(events, "purchase", grade.alias("appraise"))


def search_phrases(documents: DataFrame) -> DataFrame:
    start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").cast("timestamp")
    return documents.select(
        F.timestamp_seconds(F.unix_seconds(start) + F.col("doc_id")).alias("rowtime"),
        F.col("text").alias("fullword"),
    )


def order_changes(orders: DataFrame) -> DataFrame:
    """One change per order; keys that are 1 modulo 8 are changed a second time."""
    key = F.col("o_orderkey")
    image = F.create_map(
        F.lit("o_orderkey"), key.cast("string"),
        F.lit("o_custkey"), F.col("o_custkey").cast("string"),
        F.lit("o_orderstatus"), F.col("o_orderstatus"),
    )
    kind = F.when(key % 4 == 0, "delete").when(key % 4 == 1, "update").otherwise("insert")
    gone = kind == "delete"
    nothing = F.lit(None).cast("map<string,string>")
    seq = F.explode(
        F.when(key % 8 == 1, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    )
    base = orders.select("o_orderkey", "o_custkey", "o_orderstatus", seq.alias("_n"))
    later = F.create_map(
        F.lit("o_orderkey"), key.cast("string"), F.lit("o_orderstatus"), F.lit("X")
    )
    again = F.col("_n") == 1
    return base.select(
        F.lit("shop").alias("database"),
        F.lit("order_info").alias("table"),
        kind.alias("type"),
        F.when(kind != "insert", image).otherwise(nothing).alias("before"),
        F.when(again, later).when(~gone, image).otherwise(nothing).alias("after"),
        (key * 2 + F.col("_n")).alias("ts"),
    )


def dim_user(customer: DataFrame) -> DataFrame:
    key = F.col("c_custkey")
    born = F.date_add(F.lit("1960-01-01").cast("date"), (key % 14000).cast("int"))
    return customer.select(
        key.alias("ID"),
        F.when(key % 2 == 0, "M").otherwise("F").alias("GENDER"),
        F.date_format(born, "yyyy-MM-dd").alias("BIRTHDAY"),
    )


def dim_province(nation: DataFrame) -> DataFrame:
    return nation.select(
        F.col("n_nationkey").cast("bigint").alias("ID"),
        F.col("n_name").alias("NAME"),
        F.col("n_regionkey").cast("string").alias("AREA_CODE"),
        F.substring("n_name", 1, 3).alias("ISO_CODE"),
        F.concat(F.lit("X-"), F.substring("n_name", 1, 2)).alias("ISO_3166_2"),
    )


def dim_sku(part: DataFrame) -> DataFrame:
    return part.select(
        F.col("p_partkey").alias("ID"),
        F.col("p_name").alias("SKU_NAME"),
        _money("p_retailprice").alias("PRICE"),
        F.col("p_type").alias("CATEGORY3_ID"),
        F.col("p_size").cast("bigint").alias("SPU_ID"),
        F.col("p_brand").alias("TM_ID"),
    )


def dim_spu(part: DataFrame) -> DataFrame:
    size = F.col("p_size").cast("bigint")
    return part.select(
        size.alias("ID"), F.concat(F.lit("spu-"), size.cast("string")).alias("SPU_NAME")
    ).distinct()


def dim_trademark(part: DataFrame) -> DataFrame:
    return part.select(
        F.col("p_brand").alias("ID"),
        F.concat(F.lit("tm-"), F.col("p_brand")).alias("TM_NAME"),
    ).distinct()


def dim_category3(part: DataFrame) -> DataFrame:
    return part.select(
        F.col("p_type").alias("ID"), F.lower("p_type").alias("NAME")
    ).distinct()


def dims(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    part = table(spark, sf_dir, "part")
    return {
        "user": dim_user(table(spark, sf_dir, "customer")),
        "province": dim_province(table(spark, sf_dir, "nation")),
        "sku": dim_sku(part),
        "spu": dim_spu(part),
        "trademark": dim_trademark(part),
        "category3": dim_category3(part),
    }
