"""Streaming jobs bound to the analytic tables, registered beside those of ``on_tables``."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.config import Settings, span
from tradewind.operators import metrics as M
from tradewind.operators.changes import current_state, retract_by_key
from tradewind.operators.parse import parse_records, snapshot_changes
from tradewind.operators.snapshots import number_chunk, whole_feed
from tradewind.operators.visits import repair_new_visitor
from tradewind.operators.windows import tumbling
from tradewind.plans import logs, orders, stats
from tradewind.plans import on_tables as B
from tradewind.session import run_dir
from tradewind.sources import shop
from tradewind.sources.dims import DimTable
from tradewind.sources.topics import FolderTopics
from tradewind.streaming import jobs
from tradewind.streaming.heartbeats import LateRows, with_heartbeat
from tradewind.streaming.sinks import finish, run_available, table_writer

_query = B._query


# ---- silent sources and late rows ------------------------------------------------


def _silent(df: DataFrame) -> DataFrame:
    """A stream of df's columns on a topic that never has a record."""
    spark, path = df.sparkSession, run_dir(df.sparkSession, "silent")
    spark.createDataFrame([], df.schema).write.parquet(path)
    return spark.readStream.schema(df.schema).parquet(path)


@_query
def product_stats_silent_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Product statistics of a shop without refunds: heartbeats close the windows."""
    events = shop.stream_table(spark, sf, "events")
    sources = {
        "page": shop.page_log(events),
        "order_wide": B._as_stream(B._wide(spark, sf), "order-wide"),
        "payment_wide": B._as_stream(B._paid(spark, sf), "payment-wide"),
        "cart": shop.cart_info(events),
        "favor": shop.favor_info(events),
        "refund": _silent(shop.refund_info(shop.table(spark, sf, "events"))),
        "comment": shop.comment_info(events),
    }
    beat = spark.range(1).select(F.lit(None).cast("string").alias("source"), F.lit("2100-01-01").cast("timestamp").alias("rowtime"))
    beats = B._as_stream(beat, "heartbeat")
    delay = B.MONTHLY.product_delay
    running = stats.product_stats(
        {name: with_heartbeat(df, beats, name, delay) for name, df in sources.items()},
        shop.dims(spark, sf), B.MONTHLY, unique_dims=True,
    )
    return B._doubles(run_available(running, "product-silent"), *B._AMOUNTS, "sku_price")


@_query
def late_rows_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Daily counts per device from two loads, a third of the events in the second: rows in
    days that the first load closed are dropped, and counted as groups of their batch."""
    base = run_dir(spark, "late")
    events = shop.table(spark, sf, "events")
    events.filter("false").write.parquet(f"{base}/in")
    stream = spark.readStream.schema(events.schema).parquet(f"{base}/in")
    pages = shop.page_log(stream).withWatermark("rowtime", span(B.SETTINGS.visitor_delay))
    daily = pages.groupBy(tumbling("rowtime", B.SETTINGS.window), "common.mid").agg(F.count("*").alias("n"))
    rows = daily.select(F.date_format("window.start", "yyyy-MM-dd").alias("day"), "mid", "n")
    late = LateRows(spark, f"{base}/late")
    spark.streams.addListener(late)
    try:
        for condition in ("event_id % 3 <> 0", "event_id % 3 = 0"):
            events.filter(condition).write.mode("append").parquet(f"{base}/in")
            finish(table_writer(rows, f"{base}/out", f"{base}/checkpoint").trigger(availableNow=True).start())
        late.settled()
    finally:
        spark.streams.removeListener(late)
    kept = spark.read.schema(rows.schema).parquet(f"{base}/out")
    dropped = late.read().agg(F.sum("dropped").alias("n"))
    return kept.unionByName(dropped.select(F.lit("late").alias("day"), F.lit(None).cast("string").alias("mid"), "n"))


@_query
def visitor_stats_refined_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Visitor statistics in update mode from three loads in time order, the windows at the
    seams refined by the next load: the closed rows are those of the append mode."""
    base = run_dir(spark, "refined")
    sources = {"page_log": B._pages(spark, sf), "unique_visit": B._visits(spark, sf), "bounce": B._bounced(spark, sf)}
    sources = {name: B._kept(df, f"refined-{name}") for name, df in sources.items()}
    streams = {}
    for name, df in sources.items():
        df.filter("false").write.parquet(f"{base}/{name}")
        streams[name] = spark.readStream.schema(df.schema).parquet(f"{base}/{name}")
    w = jobs.Warehouse(spark, None, base, B.SETTINGS, once=True)
    rows = stats.visitor_stats(*streams.values(), w.settings)
    first = sources["page_log"].select(F.min("rowtime"), F.max("rowtime")).first()
    third = (first[1] - first[0]) / 3
    for part in range(3):
        until = [F.lit(first[0] + third * k) for k in (part, part + 1)]
        here = (F.col("rowtime") >= until[0]) & ((F.col("rowtime") < until[1]) if part < 2 else F.lit(True))
        for name, df in sources.items():
            if part == 2:  # one record far in the future closes all windows but its own
                end = (F.lit("2100-01-01" if f.name == "rowtime" else None).cast(f.dataType).alias(f.name) for f in df.schema)
                df = df.unionByName(spark.range(1).select(*end))
            df.filter(here).write.mode("append").parquet(f"{base}/{name}")
        query, table = jobs.refined_table(w, rows, "refined", M.VISITOR_KEYS, ["stt", "edt", *M.VISITOR_KEYS, *M.VISITOR_SUMS])
        finish(query)
    return table.read(only_closed=True)


# ---- visits ----------------------------------------------------------------------


@_query
def new_visitor_repair_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The repair as a stream, with one value of state for each device."""
    pages = shop.page_log(shop.stream_table(spark, sf, "events"))
    fixed = repair_new_visitor(pages.withColumn("was_new", F.col("common.is_new")), tiebreak=B.TIEBREAK)
    done = run_available(fixed, "new-visitor")
    return done.select("event_id", "common.mid", "was_new", "common.is_new")


_THREE = replace(B.SETTINGS, bounce_times=3)


@_query
def bounce_three(spark: SparkSession, sf: str) -> DataFrame:
    """Bounces of a pattern of three entry pages."""
    found = logs.bounce_detail(B._pages(spark, sf), _THREE, tiebreak=B.TIEBREAK)
    return B._page_report(found, "reason")


@_query
def bounce_three_stream(spark: SparkSession, sf: str) -> DataFrame:
    pages = shop.page_log(shop.stream_table(spark, sf, "events"))
    pages = B._ended(pages, common='{"mid": "end"}', event_id="-1")
    found = logs.bounce_detail(pages, _THREE, tiebreak=B.TIEBREAK)
    return B._page_report(run_available(found, "bounce-three"), "reason")


# ---- change feeds ----------------------------------------------------------------

_CHUNK = 5000


def _moving_orders(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Orders as a table at its start, and the changes made to it, at places 1 to 2000."""
    o = shop.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    key, kind = F.col("o_orderkey"), F.col("o_orderkey") % 5
    at = key * 7919 % 1000 + 1
    image = lambda status: F.create_map(F.lit("o_orderkey"), key.cast("string"), F.lit("o_orderstatus"), status)
    nothing = F.lit(None).cast("map<string,string>")

    def change(when, type_, status, place):
        known = image(F.lit("?"))
        return o.filter(when).select(
            F.lit("shop").alias("database"), F.lit("order_info").alias("table"), F.lit(type_).alias("type"),
            (known if type_ == "delete" else nothing).alias("before"),
            (nothing if type_ == "delete" else image(status)).alias("after"), place.alias("ts"),
        )

    changes = change(kind == 0, "insert", F.col("o_orderstatus"), at)
    changes = changes.unionByName(change(kind == 1, "update", F.lit("U"), at))
    changes = changes.unionByName(change((kind < 2) & (key % 2 == 0), "update", F.lit("V"), at + 1000))
    changes = changes.unionByName(change(kind == 2, "delete", None, at))
    return o.filter(kind != 0), changes


@_query
def cdc_chunked_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    """Orders read in chunks while they change: the feed's state, and its events by key.

    Chunk c is read at place 100 c + 100 (modulo 1500) of the log, between marks 100 before
    and 100 after it.
    """
    start, changes = _moving_orders(spark, sf)
    columns = {"o_orderkey": "bigint", "o_orderstatus": "string"}
    chunk = number_chunk("o_orderkey", _CHUNK)
    low = lambda c: c * 100 % 1500
    opening = snapshot_changes(start, "shop", "order_info")
    past = opening.unionByName(changes.filter(F.col("ts") <= low(chunk) + 100))
    read = snapshot_changes(current_state(past, "o_orderkey", columns), "shop", "order_info")
    chunks = shop.table(spark, sf, "orders").select(F.floor(F.col("o_orderkey") / _CHUNK).alias("chunk")).distinct()
    marks = chunks.select("chunk", low(F.col("chunk")).alias("low"), (low(F.col("chunk")) + 200).alias("high"))
    feed = B._kept(whole_feed(read.withColumn("chunk", chunk), marks, changes, "o_orderkey", chunk), "snapshot-feed")
    state = current_state(feed, "o_orderkey", columns)
    image = F.coalesce("after", "before")
    events = feed.groupBy(image["o_orderkey"].cast("bigint").alias("o_orderkey")).agg(F.count("*").alias("events"))
    return events.join(state, "o_orderkey", "left").select("o_orderkey", "o_orderstatus", "events")


@_query
def cdc_retract_stateful(spark: SparkSession, sf: str) -> DataFrame:
    """Rows leaving and entering the table, from changes that do not tell the old image."""
    _, changes = _moving_orders(spark, sf)
    return retract_by_key(changes, "o_orderkey", {"o_orderkey": "bigint", "o_orderstatus": "string"})


@_query
def cdc_retract_stateful_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The same from two loads of a stream: the last image of a key is its state."""
    _, changes = _moving_orders(spark, sf)
    base = run_dir(spark, "retract")
    changes.filter("false").write.parquet(f"{base}/in")
    stream = spark.readStream.schema(changes.schema).parquet(f"{base}/in")
    rows = retract_by_key(stream, "o_orderkey", {"o_orderkey": "bigint", "o_orderstatus": "string"})
    for condition in ("ts <= 1200", "ts > 1200"):
        changes.filter(condition).write.mode("append").parquet(f"{base}/in")
        finish(table_writer(rows, f"{base}/out", f"{base}/checkpoint").trigger(availableNow=True).start())
    return spark.read.schema(rows.schema).parquet(f"{base}/out")


# ---- topics ----------------------------------------------------------------------


def _forget_last_batch(w: jobs.Warehouse, job: str) -> None:
    """Let a job run its last batch again, as after a crash before the batch was noted."""
    files = w.topics._files()
    folder = w.topics._path(f"{w.checkpoint(job)}/commits")
    names = [f.getPath().getName() for f in files.listStatus(folder)]
    last = max(int(n) for n in names if n.isdigit())
    files.delete(w.topics._path(f"{folder.toString()}/{last}"), False)


@_query
def chained_topics_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Two jobs chained by a topic, the first of which runs its batch again after the second
    has read it: every event arrives once, in the topic that its type names."""
    base = run_dir(spark, "chained")
    w = jobs.Warehouse(spark, FolderTopics(spark, f"{base}/topics"), base, Settings(business_tz="UTC"), once=True)
    events = shop.stream_table(spark, sf, "events").select("event_id", "event_type")

    def ingest() -> None:
        finish(w.to_topic(events, "raw_events", "ingest"))

    def separate() -> None:
        schema = events.schema
        rows = parse_records(w.topics.stream("raw_events"), schema)
        rows = rows.select(F.concat(F.lit("event_"), "event_type").alias("topic"), F.to_json(F.struct("event_id")).alias("value"))
        finish(w.each_batch(rows, "separate", lambda batch, b: w.topics.write(batch, None, b, "separate")))

    ingest()
    separate()
    for job, run in (("ingest", ingest), ("separate", separate)):
        _forget_last_batch(w, job)
        run()
        separate()
    read = spark.read.option("basePath", f"{base}/topics").text(f"{base}/topics/topic=event_*")
    return read.select(F.get_json_object("value", "$.event_id").cast("bigint").alias("event_id"), "topic")


# ---- dimensions ------------------------------------------------------------------


@_query
def dim_written_then_read(spark: SparkSession, sf: str) -> DataFrame:
    """A dimension folded in place from three batches of changes, then looked up for the
    keys of the order details."""
    root, columns = run_dir(spark, "dims"), ["o_orderkey", "o_custkey", "o_orderstatus"]
    table = DimTable(spark, root, "dim_order", columns, "o_orderkey").create()
    live = B._kept(B._changes(spark, sf).filter("type <> 'delete'"), "dim-changes")
    for batch in range(3):
        table.upsert(live.filter(F.col("ts") % 3 == batch), batch, ["ts"])
    details = shop.table(spark, sf, "lineitem").filter("l_linenumber = 1").select(F.col("l_orderkey").alias("key"))
    return table.read(only=details)


@_query
def hot_user_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """The user lookup where half of the orders are one user's, whose rows are dealt out."""
    o = shop.table(spark, sf, "orders")
    user = F.when(F.col("o_orderkey") % 2 == 0, 7).otherwise(F.col("o_custkey"))
    facts = o.select(F.col("o_orderkey").alias("order_id"), user.cast("bigint").alias("user_id"))
    dims = shop.dims(spark, sf)
    return orders.add_user(facts, dims["user"], B.SETTINGS, B._as_of(), spread=B.SETTINGS.lookup_ways)
