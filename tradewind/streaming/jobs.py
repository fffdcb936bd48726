"""The warehouse jobs as running streaming queries between topics and tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tradewind import schemas
from tradewind.config import KEYWORD_SOURCE, TOPICS, Settings
from tradewind.functions import times
from tradewind.operators.keywords import piece_counts, word_counts
from tradewind.operators.parse import (
    mark_json,
    parse_changes,
    parse_records,
    snapshot_changes,
    to_topic_rows,
    with_create_times,
)
from tradewind.operators.route import explode_displays, fact_topic_rows
from tradewind.operators.snapshots import MARKS, opened
from tradewind.operators.windows import label_window
from tradewind.plans import changes as C
from tradewind.plans import logs, orders, stats
from tradewind.sources.dims import DimTable, StoredDims
from tradewind.streaming.heartbeats import newest_times, parse_heartbeats, with_heartbeat
from tradewind.streaming.sinks import RefinedTable, batch_watermark, console, stored, table_writer, write_routes

# Pieces of a phrase, and those of them that a vocabulary cuts into words.
CUT_SCRIPT = r"\p{IsHan}"
VOCABULARY_PIECES = rf"{CUT_SCRIPT}+|[\p{{L}}\p{{M}}\p{{N}}&&[^{CUT_SCRIPT}]]+"

Dims = Callable[[], Mapping[str, DataFrame]]


def _dims_for(dims: Dims, batch: DataFrame) -> Mapping[str, DataFrame]:
    """The dimension tables as they are now; stored ones for the keys of the batch only."""
    return dims(batch) if isinstance(dims, StoredDims) else dims()


@dataclass
class Warehouse:
    """Where the jobs read and write, and their parameters.

    ``root`` is a folder every executor reaches: it holds checkpoints, dimension tables,
    the visitor register and statistics tables. A checkpoint belongs to the outputs
    written under it; a job started without its checkpoint needs a fresh root as well.
    """

    spark: SparkSession
    topics: object
    root: str
    settings: Settings = field(default_factory=Settings)
    once: bool = False
    #: Let heartbeats advance sources that are silent (see :func:`heartbeats`).
    heartbeats: bool = False

    def checkpoint(self, job: str) -> str:
        return f"{self.root.rstrip('/')}/checkpoints/{job}"

    def table(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/tables/{name}"

    def start(self, writer: DataStreamWriter) -> StreamingQuery:
        if self.once:
            writer = writer.trigger(availableNow=True)
        return writer.start()

    def to_topic(self, rows: DataFrame, topic: str, job: str) -> StreamingQuery:
        return self.text_to_topic(to_topic_rows(rows), topic, job)

    def text_to_topic(self, text: DataFrame, topic: str, job: str) -> StreamingQuery:
        writer = self.topics.write_stream(text, topic, self.checkpoint(job), job)
        return self.start(writer.queryName(job))

    def each_batch(
        self, source: DataFrame, job: str, fn: Callable[[DataFrame, int], None]
    ) -> StreamingQuery:
        return self.start(
            source.writeStream.foreachBatch(fn)
            .option("checkpointLocation", self.checkpoint(job))
            .queryName(job)
        )

    def records(self, topic: str, schema: T.StructType) -> DataFrame:
        """A topic of records that carry ``create_time``, with event time derived."""
        parsed = parse_records(self.topics.stream(TOPICS[topic]), schema)
        return with_create_times(parsed, self.settings)

    def pages(self) -> DataFrame:
        return logs.parse_pages(self.topics.stream(TOPICS["page_log"]))

    def page_like(self, topic: str) -> DataFrame:
        return logs.parse_pages(self.topics.stream(TOPICS[topic]))

    def watched(self, df: DataFrame, source: str, delay: timedelta) -> DataFrame:
        """A source with its watermark; with heartbeats, those of its name advance it, too."""
        if not self.heartbeats:
            return df
        beats = parse_heartbeats(self.topics.stream(TOPICS["heartbeat"]))
        return with_heartbeat(df, beats, source, delay)

    def stats_table(self, rows: DataFrame, name: str, columns: Sequence[str]) -> StreamingQuery:
        final = stats.stamp(rows).select(*columns)
        return self.start(
            table_writer(final, self.table(name), self.checkpoint(name)).queryName(name)
        )


# ---- logs ------------------------------------------------------------------------


def separate_logs(w: Warehouse, seen: DataFrame | None = None) -> StreamingQuery:
    """Raw log -> start, page and display topics, and dirty lines.

    Whether a device was seen before is keyed state of the query, so a batch costs what it
    holds, however many devices there have been. ``seen`` (column ``mid``) names devices
    known when the job first starts, such as those of :func:`seen_visitors`.
    """
    marked = mark_json(w.topics.stream(TOPICS["raw_log"]))
    routed = logs.repaired_logs(marked.filter("is_valid"), seen=seen).drop("rowtime")
    dirty = marked.filter("NOT is_valid").select("value", F.lit("dirty").alias("route"))
    both = routed.unionByName(dirty, allowMissingColumns=True)

    def bad(df: DataFrame, b: int) -> None:
        w.topics.write(df.select("value"), "dirty", b, "separate_logs")

    def starts(df: DataFrame, b: int) -> None:
        rows = to_topic_rows(logs.start_records(df))
        w.topics.write(rows, TOPICS["start_log"], b, "separate_logs")

    def pages(df: DataFrame, b: int) -> None:
        page = logs.page_records(df.drop("value"))
        w.topics.write(to_topic_rows(page), TOPICS["page_log"], b, "separate_logs")
        w.topics.write(
            to_topic_rows(explode_displays(page)), TOPICS["display_log"], b, "separate_logs"
        )

    def each(batch: DataFrame, batch_id: int) -> None:
        write_routes(batch, batch_id, {"dirty": bad, "start": starts, "page": pages})

    return w.each_batch(both, "separate_logs", each)


def seen_visitors(w: Warehouse) -> DataFrame:
    """The devices (``mid``) that the log job of a warehouse has seen, out of its state; with
    them a job under another root goes on where this one stopped."""
    state = w.spark.read.format("statestore").option("stateVarName", "seen")
    return state.load(w.checkpoint("separate_logs")).select(F.col("key._mid").alias("mid"))


def unique_visits(w: Warehouse) -> StreamingQuery:
    visits = logs.unique_visit_detail(w.pages(), w.settings)
    return w.to_topic(visits.drop("rowtime"), TOPICS["unique_visit"], "unique_visits")


def bounces(w: Warehouse) -> StreamingQuery:
    found = logs.bounce_detail(w.pages(), w.settings)
    return w.to_topic(found.drop("rowtime"), TOPICS["bounce"], "bounces")


# ---- change feeds ----------------------------------------------------------------


def route_changes(
    w: Warehouse, config: Callable[[], DataFrame], dims_root: str
) -> StreamingQuery:
    """Change feed -> fact topics and dimension tables, as the route table says.

    ``config`` gives the routes in force and is asked once per batch. Changes without a
    route, and those of sinks not served here, go to the ``unrouted`` topic.
    """

    def each(batch: DataFrame, batch_id: int) -> None:
        routes = config()
        # Changes of one key in one millisecond are told apart by their arrival.
        numbered = batch.withColumn("_id", F.monotonically_increasing_id())
        routed = C.routed_changes(parse_changes(numbered, keep=["_id"]), routes)

        def facts(df: DataFrame, b: int) -> None:
            w.topics.write(fact_topic_rows(df), None, b, "route_changes")

        def unrouted(df: DataFrame, b: int) -> None:
            w.topics.write(
                to_topic_rows(df.drop("route", "sink_table", "sink_pk", "_id")), "unrouted", b,
                "route_changes",
            )

        def dims(df: DataFrame, b: int) -> None:
            for sink, columns, pk in dim_sinks(routes):
                table = DimTable(w.spark, dims_root, sink, columns, pk).create()
                table.upsert(df.filter(F.col("sink_table") == sink), b, ("ts", "_id"))

        merged = routed.withColumn(
            "route",
            F.when(F.col("route") == "ignored", "unmatched").otherwise(F.col("route")),
        )
        write_routes(
            merged, batch_id, {"fact": facts, "dim": dims, "unmatched": unrouted}
        )

    return w.each_batch(w.topics.stream(TOPICS["raw_changes"]), "route_changes", each)


def seed_feed(w: Warehouse, table: DataFrame, database: str, name: str) -> None:
    """Open a change feed with the table's present rows, before its changes are read."""
    first = snapshot_changes(table, database, name)
    w.topics.write(to_topic_rows(first), TOPICS["raw_changes"], -1, f"seed_{database}_{name}")


def seed_in_chunks(
    w: Warehouse, database: str, name: str, key: str, chunk: Column, chunks: Sequence[int],
    read: Callable[[int], DataFrame], position: Callable[[], int], log: Callable[[], DataFrame],
) -> DataFrame:
    """Open a change feed with a table that goes on changing, read chunk by chunk.

    ``read`` gives the rows of a chunk, ``position`` the log's present end and ``log`` its
    changes so far. A chunk's rows go to the topic as of its high mark, and the marks
    (``MARKS``) to the table ``marks_<database>_<name>``, which is returned; readers of the
    log drop what the snapshot holds by :func:`~tradewind.operators.snapshots.changes_after`.
    Chunks that have their marks are not read again, so a run that broke off goes on.
    """
    path = w.table(f"marks_{database}_{name}")
    w.spark.createDataFrame([], MARKS).write.mode("ignore").parquet(f"{path}/part=-1")
    marks = w.spark.read.schema(MARKS)
    done = {r.chunk for r in marks.parquet(path).select("chunk").collect()}
    for number in (c for c in chunks if c not in done):
        low = position()
        rows = snapshot_changes(read(number), database, name).withColumn("chunk", F.lit(number).cast("bigint"))
        rows = stored(rows, f"{path}_rows/chunk={number}")
        mark = w.spark.createDataFrame([(number, low, position())], MARKS)
        feed = opened(rows, mark, log(), key, chunk)
        w.topics.write(to_topic_rows(feed), TOPICS["raw_changes"], number, f"seed_{database}_{name}")
        mark.coalesce(1).write.mode("overwrite").parquet(f"{path}/part={number}")
    return marks.parquet(path)


def dim_sinks(routes: DataFrame) -> list[tuple[str, list[str], str]]:
    """The dimension tables a route table names: (name, columns, primary key).

    Routes of one table may list different columns; the table has them all. Only route
    metadata reaches the driver, one row per dimension table.
    """
    from tradewind.config import ROUTE_DIM

    rows = (
        routes.filter(F.col("sinkType") == ROUTE_DIM)
        .groupBy("sinkTable")
        .agg(
            F.array_sort(
                F.array_distinct(F.flatten(F.collect_list(F.split("sinkColumns", ","))))
            ).alias("columns"),
            F.max(F.coalesce("sinkPk", F.lit("id"))).alias("pk"),
        )
        .collect()
    )
    return [(r["sinkTable"], r["columns"], r["pk"]) for r in rows]


def feed_to_topic(w: Warehouse, records: DataFrame, topic: str) -> StreamingQuery:
    """Connector records (``topic, op, after``) -> a topic of envelopes."""
    return w.text_to_topic(C.feed_to_topic(records), topic, f"feed_to_{topic}")


def print_feed(w: Warehouse, rows: DataFrame) -> StreamingQuery:
    return w.start(console(rows, w.checkpoint("print_feed")))


# ---- facts -----------------------------------------------------------------------


def order_wide(w: Warehouse, dims: Dims) -> StreamingQuery:
    """Orders with details, then attributes.

    The join is the stream; attributes are looked up per batch, so each batch sees the
    dimension tables as they are then.
    """
    delay = w.settings.order_delay
    joined = orders.join_orders(
        w.watched(w.records("order_info", schemas.ORDER_INFO), "order_info", delay),
        w.watched(w.records("order_detail", schemas.ORDER_DETAIL), "order_detail", delay),
        w.settings,
    )

    def each(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            # A stateful stream's batches are planned without the adaptive skew join.
            wide = orders.enrich_orders(
                batch, _dims_for(dims, batch), w.settings, spread=w.settings.lookup_ways
            )
            w.topics.write(
                to_topic_rows(wide.drop("rowtime")), TOPICS["order_wide"], batch_id, "order_wide"
            )
        finally:
            batch.unpersist()

    return w.each_batch(joined, "order_wide", each)


def payment_wide(w: Warehouse) -> StreamingQuery:
    delay = w.settings.payment_delay
    wide = orders.payment_wide(
        w.watched(w.records("payment_info", schemas.PAYMENT_INFO), "payment_info", delay),
        w.watched(w.records("order_wide", schemas.ORDER_WIDE), "order_wide", delay),
        w.settings,
    )
    return w.to_topic(wide.drop("rowtime"), TOPICS["payment_wide"], "payment_wide")


# ---- statistics ------------------------------------------------------------------


def visitor_rows(w: Warehouse) -> DataFrame:
    delay = w.settings.visitor_delay + w.settings.visitor_lateness
    sources = (w.watched(w.page_like(name), name, delay) for name in ("page_log", "unique_visit", "bounce"))
    return stats.visitor_stats(*sources, w.settings)


def visitor_stats(w: Warehouse) -> StreamingQuery:
    return w.stats_table(visitor_rows(w), "visitor_stats", schemas.VISITOR_STATS_COLUMNS)


def visitor_stats_refined(w: Warehouse) -> tuple[StreamingQuery, RefinedTable]:
    """Emit windows as they fill and again when late rows refine them (update mode). Windows
    that the watermark has passed are final and are folded away from the open ones."""
    return refined_table(w, visitor_rows(w), "visitor_stats_refined", ["vc", "ch", "ar", "is_new"], schemas.VISITOR_STATS_COLUMNS)


def refined_table(
    w: Warehouse, rows: DataFrame, name: str, keys: Sequence[str], columns: Sequence[str]
) -> tuple[StreamingQuery, RefinedTable]:
    """Windowed rows (``stt``, ``edt``, keys, values) in update mode, kept as a refined table."""
    table = RefinedTable(w.spark, w.table(name), ["stt", "edt", *keys])

    def each(batch: DataFrame, batch_id: int) -> None:
        seen = batch_watermark(w.spark, w.checkpoint(name), batch_id)
        closed = times.parse_time(F.col("edt"), w.settings.business_tz) <= F.lit(seen)
        table.write(stats.stamp(batch).select(*columns), batch_id, closed)

    query = w.start(
        rows.writeStream.outputMode("update")
        .foreachBatch(each)
        .option("checkpointLocation", w.checkpoint(name))
        .queryName(name)
    )
    return query, table


def product_sources(w: Warehouse) -> dict[str, DataFrame]:
    """The seven topics that product statistics are made of."""
    paid = parse_records(w.topics.stream(TOPICS["payment_wide"]), schemas.PAYMENT_WIDE)
    paid_at = times.parse_time(F.col("payment_create_time"), w.settings.business_tz)
    return {
        "page": w.pages(),
        "order_wide": w.records("order_wide", schemas.ORDER_WIDE),
        "payment_wide": paid.withColumn("rowtime", paid_at),
        "cart": w.records("cart_info", schemas.CART_INFO),
        "favor": w.records("favor_info", schemas.FAVOR_INFO),
        "refund": w.records("refund_info", schemas.REFUND_INFO),
        "comment": w.records("comment_info", schemas.COMMENT_INFO),
    }


def heartbeats(w: Warehouse, sources: Mapping[str, DataFrame]) -> StreamingQuery:
    """Heartbeats for all sources out of those that have records.

    Each batch writes one: the newest time of any source, less ``heartbeat_allowance``. A
    silent source is then waited for no longer than that, in event time. A query that is
    started again hears of a silent source with the first heartbeat after that.
    """
    both = [df.select("rowtime") for df in sources.values()]

    def each(batch: DataFrame, batch_id: int) -> None:
        beat = newest_times({"all": batch}, w.settings.heartbeat_allowance)
        w.topics.write(beat, TOPICS["heartbeat"], batch_id, "heartbeats")

    return w.each_batch(reduce(DataFrame.unionByName, both), "heartbeats", each)


def product_stats(w: Warehouse, dims: Dims) -> StreamingQuery:
    """Product metrics per window; attributes are looked up per batch of final windows, so
    they are those of the dimension tables at that time."""
    delay = w.settings.product_delay
    rows = stats.product_sums(
        {name: w.watched(df, name, delay) for name, df in product_sources(w).items()}, w.settings
    )

    def each(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            final = stats.stamp(stats.with_products(batch, _dims_for(dims, batch)))
            final.select(*schemas.PRODUCT_STATS_COLUMNS).write.mode("overwrite").parquet(
                f"{w.table('product_stats')}/batch_id={batch_id}"
            )
        finally:
            batch.unpersist()

    return w.each_batch(rows, "product_stats", each)


def province_stats(w: Warehouse) -> StreamingQuery:
    rows = stats.province_stats(w.records("order_wide", schemas.ORDER_WIDE), w.settings)
    return w.stats_table(rows, "province_stats", schemas.PROVINCE_STATS_COLUMNS)


def keyword_stats(w: Warehouse) -> StreamingQuery:
    rows = stats.keyword_stats(stats.search_pages(w.pages()), w.settings)
    return w.stats_table(rows, "keyword_stats", schemas.KEYWORD_STATS_COLUMNS)


def keyword_stats_by_vocabulary(
    w: Warehouse, vocabulary: Callable[[], DataFrame]
) -> StreamingQuery:
    """Keyword statistics with a vocabulary table (column ``word``), asked once per batch.

    A window's piece counts all come in the batch that closes it, so its word counts
    are complete there.
    """
    phrases = stats.search_pages(w.pages())
    counted = piece_counts(phrases, w.settings, VOCABULARY_PIECES)
    path = w.table("keyword_stats_by_vocabulary")

    def each(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            # Text outside the vocabulary's script stays whole.
            plain = batch.filter(~F.col("piece").rlike(CUT_SCRIPT)).select(
                "window", F.col("piece").alias("keyword"), F.col("n").alias("ct")
            )
            cut = word_counts(
                batch.filter(F.col("piece").rlike(CUT_SCRIPT)), vocabulary()
            )
            rows = label_window(plain.unionByName(cut), w.settings.business_tz)
            final = stats.stamp(rows.withColumn("source", F.lit(KEYWORD_SOURCE)))
            final.select(*schemas.KEYWORD_STATS_COLUMNS).write.mode("overwrite").parquet(
                f"{path}/batch_id={batch_id}"
            )
        finally:
            batch.unpersist()

    return w.each_batch(counted, "keyword_stats_by_vocabulary", each)
