"""The jobs and single operators bound to the analytic tables in a folder.

Each function takes (spark, folder) and returns a DataFrame over the whole tables. The
tables are sparse in time, so bounds and windows are wider than the production defaults.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import replace
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind.config import SEARCH_PAGE, TIME_FORMAT, Settings
from tradewind.functions import text, times
from tradewind.operators import metrics as M
from tradewind.operators.changes import current_state, retract_stream, upserted
from tradewind.operators.joins import (
    flatten_sku,
    interval_join,
    lookup_first,
    lookup_join,
    merge_first_non_null,
)
from tradewind.operators.keywords import piece_counts, word_counts
from tradewind.operators.parse import (
    mark_json,
    normalise_changes,
    parse_changes,
    parse_records,
    snapshot_changes,
    split_lines,
    to_topic_rows,
    with_create_times,
)
from tradewind.operators.route import (
    by_route,
    explode_displays,
    fact_topic_rows,
    latest_config,
    mark_log,
)
from tradewind.operators.visits import entry_page, repair_new_visitor
from tradewind.operators.windows import label_window
from tradewind.plans import changes as C
from tradewind.plans import logs, orders, stats
from tradewind.session import run_dir
from tradewind.sources import shop
from tradewind.streaming.sinks import run_available

SETTINGS = Settings(
    business_tz="UTC",
    window=timedelta(days=1),
    order_lower=timedelta(days=-5),
    order_upper=timedelta(days=5),
    bounce_within=timedelta(hours=6),
)
# The pieces that a vocabulary cuts.
PIECES = r"[\p{L}\p{M}\p{N}]+"
MONTHLY = replace(SETTINGS, window=timedelta(days=30))
SEARCH = replace(SETTINGS, window=timedelta(seconds=10))
TIEBREAK = ["event_id"]

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def _query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _as_of():
    return F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").cast("timestamp")


def _text(column: str):
    return F.date_format(column, TIME_FORMAT)


def _doubles(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


def _orders(spark: SparkSession, sf: str) -> DataFrame:
    return shop.order_info(
        shop.table(spark, sf, "orders"), shop.table(spark, sf, "customer")
    )


def _details(spark: SparkSession, sf: str) -> DataFrame:
    return shop.order_detail(shop.table(spark, sf, "lineitem"))


def _payments(spark: SparkSession, sf: str) -> DataFrame:
    return shop.payment_info(shop.table(spark, sf, "orders"))


def _pages(spark: SparkSession, sf: str) -> DataFrame:
    return shop.page_log(shop.table(spark, sf, "events"))


def _wide(spark: SparkSession, sf: str) -> DataFrame:
    return orders.order_wide(
        _orders(spark, sf), _details(spark, sf), shop.dims(spark, sf), SETTINGS,
        _as_of(), unique_dims=True,
    )


def _paid(spark: SparkSession, sf: str) -> DataFrame:
    return orders.payment_wide(_payments(spark, sf), _wide(spark, sf), SETTINGS)


def _joined(spark: SparkSession, sf: str) -> DataFrame:
    """Order rows without attributes, for jobs that read none of them."""
    return orders.join_orders(_orders(spark, sf), _details(spark, sf), SETTINGS)


def _placed(spark: SparkSession, sf: str) -> DataFrame:
    """Order rows with the province attributes only."""
    province = shop.dim_province(shop.table(spark, sf, "nation"))
    return orders.add_province(_joined(spark, sf), province, unique=True)


def _visits(spark: SparkSession, sf: str) -> DataFrame:
    return logs.unique_visit_detail(_pages(spark, sf), SETTINGS, tiebreak=TIEBREAK)


def _bounced(spark: SparkSession, sf: str) -> DataFrame:
    return logs.bounce_detail(_pages(spark, sf), SETTINGS, tiebreak=TIEBREAK)


# Rows of a slice of a replayed table: facts, and texts.
FACT_ROWS, TEXT_ROWS = 2_000_000, 40_000


def _order_streams(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """Both fact tables as streams in the order of their times."""
    columns = {
        "orders": "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate",
        "lineitem": "l_orderkey l_linenumber l_partkey l_quantity l_extendedprice l_discount l_shipdate",
    }
    rows = {name: shop.table(spark, sf, name).select(*c.split()) for name, c in columns.items()}
    return shop.replayed(
        {name: (df, F.col(df.columns[-1]).cast("timestamp")) for name, df in rows.items()}, FACT_ROWS
    )


def _as_stream(df: DataFrame, purpose: str) -> DataFrame:
    """A job's output as the next job receives it: written out, then read as a stream."""
    path = run_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.readStream.schema(df.schema).parquet(path)


def _ended(stream: DataFrame, **values: str) -> DataFrame:
    """A stream and one last record far in the future, which carries its watermark past
    everything before it; what it adds itself stays in a window that never closes.

    ``values`` are columns of the last record as text or JSON; the others are null. Filters may
    run before the watermark is taken, so it has to pass those of the job.
    """
    spark, path = stream.sparkSession, run_dir(stream.sparkSession, "end")
    _end_record(spark, stream.schema, values).write.parquet(path)
    nullable = T.StructType([T.StructField(f.name, f.dataType) for f in stream.schema])
    return stream.unionByName(spark.readStream.schema(nullable).parquet(path))


def _end_record(spark: SparkSession, schema: T.StructType, values: Mapping[str, str]) -> DataFrame:
    def value(f: T.StructField):
        if f.name == "rowtime":
            return F.lit("2100-01-01").cast(f.dataType)
        given = F.lit(values.get(f.name))
        if f.name in values and isinstance(f.dataType, T.StructType):
            return F.from_json(given, f.dataType)
        return given.cast(f.dataType)

    return spark.range(1).select(*(value(f).alias(f.name) for f in schema))


# ---- orders and payments ---------------------------------------------------------


@_query
def order_join(spark: SparkSession, sf: str) -> DataFrame:
    return _doubles(
        _joined(spark, sf).select(
            "detail_id", "order_id", "sku_id", "order_price", "sku_num",
            "split_total_amount", "province_id", "order_status", "user_id",
            "total_amount", "create_time",
        ),
        "order_price", "split_total_amount", "total_amount",
    )


@_query
def order_wide(spark: SparkSession, sf: str) -> DataFrame:
    return _order_wide_report(_wide(spark, sf))


def _order_wide_report(wide: DataFrame) -> DataFrame:
    return _doubles(
        wide.select(
            "detail_id", "order_id", "sku_id", "order_price", "sku_num", "sku_name",
            "province_id", "order_status", "user_id", "total_amount",
            "split_total_amount", "create_time", "create_date", "create_hour",
            "province_name", "province_area_code", "province_iso_code",
            "province_3166_2_code", "user_age", "user_gender", "spu_id", "tm_id",
            "category3_id", "spu_name", "tm_name", "category3_name",
        ),
        "order_price", "total_amount", "split_total_amount",
    )


@_query
def order_wide_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The order job on streams of both fact tables, dimensions read as tables."""
    source = _order_streams(spark, sf)
    wide = orders.order_wide(
        shop.order_info(source["orders"], shop.table(spark, sf, "customer")),
        shop.order_detail(source["lineitem"]),
        shop.dims(spark, sf), SETTINGS, _as_of(), unique_dims=True,
    )
    return _order_wide_report(run_available(wide, "order-wide"))


@_query
def interval_join_exclusive(spark: SparkSession, sf: str) -> DataFrame:
    joined = interval_join(
        _orders(spark, sf), _details(spark, sf), {"id": "order_id"}, "rowtime", "rowtime",
        SETTINGS.order_lower, SETTINGS.order_upper,
        lower_inclusive=False, upper_inclusive=False,
    )
    return joined.select(
        F.col("l.id").alias("order_id"), F.col("r.id").alias("detail_id"), "r.sku_id"
    )


@_query
def interval_join_exclusive_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The same join with both sides as streams."""
    source = _order_streams(spark, sf)
    orders_in = shop.order_info(source["orders"], shop.table(spark, sf, "customer"))
    details_in = shop.order_detail(source["lineitem"])
    joined = interval_join(
        orders_in.withWatermark("rowtime", "0 seconds"),
        details_in.withWatermark("rowtime", "0 seconds"),
        {"id": "order_id"}, "rowtime", "rowtime", SETTINGS.order_lower, SETTINGS.order_upper,
        lower_inclusive=False, upper_inclusive=False,
    ).select(F.col("l.id").alias("order_id"), F.col("r.id").alias("detail_id"), "r.sku_id")
    return run_available(joined, "exclusive")


@_query
def line_interval_join(spark: SparkSession, sf: str) -> DataFrame:
    """Two delimited-text sources joined strictly inside an interval."""
    o, li = shop.table(spark, sf, "orders"), shop.table(spark, sf, "lineitem")

    def lines(df: DataFrame, key: str, word: str, moment: str) -> DataFrame:
        seconds = F.unix_seconds(F.col(moment).cast("timestamp"))
        return df.select(F.concat_ws(",", key, word, seconds).alias("value"))

    left = split_lines(
        lines(o, "o_orderkey", "o_orderstatus", "o_orderdate"),
        {"id": "string", "name": "string", "ts": "bigint"},
    ).withColumn("rowtime", F.timestamp_seconds("ts"))
    right = split_lines(
        lines(li, "l_orderkey", "l_returnflag", "l_shipdate"),
        {"id": "string", "sex": "string", "ts": "bigint"},
    ).withColumn("rowtime", F.timestamp_seconds("ts"))
    joined = interval_join(
        left, right, {"id": "id"}, "rowtime", "rowtime",
        SETTINGS.order_lower, SETTINGS.order_upper,
        lower_inclusive=False, upper_inclusive=False,
    )
    return joined.select(
        "l.id", "l.name", "r.sex", F.col("l.ts").alias("left_ts"),
        F.col("r.ts").alias("right_ts"),
    )


@_query
def payment_wide(spark: SparkSession, sf: str) -> DataFrame:
    return _payment_wide_report(_paid(spark, sf))


@_query
def payment_wide_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The payment job on streams of payments and of the order job's output."""
    payments = shop.payment_info(shop.stream_table(spark, sf, "orders"))
    wide = _as_stream(_wide(spark, sf), "order-wide")
    return _payment_wide_report(run_available(orders.payment_wide(payments, wide, SETTINGS), "paid"))


def _payment_wide_report(paid: DataFrame) -> DataFrame:
    return _doubles(
        paid.select(
            "payment_id", "payment_type", "payment_create_time", "order_id", "user_id",
            "total_amount", "detail_id", "sku_id", "sku_num", "split_total_amount",
            "province_name", "user_age", "user_gender", "sku_name", "spu_name", "tm_name",
            "category3_name", "order_create_time",
        ),
        "total_amount", "split_total_amount",
    )


@_query
def payment_order_join(spark: SparkSession, sf: str) -> DataFrame:
    """Payments against whole orders: the one-sided interval on a bigger pair."""
    joined = interval_join(
        _payments(spark, sf), _orders(spark, sf), {"order_id": "id"}, "rowtime", "rowtime",
        SETTINGS.payment_lower, SETTINGS.payment_upper,
    )
    return joined.select(
        F.col("l.id").alias("payment_id"), "l.payment_type", "r.province_id",
        "r.order_status", F.col("l.create_time").alias("payment_create_time"),
    )


@_query
def order_wide_merge(spark: SparkSession, sf: str) -> DataFrame:
    o = shop.table(spark, sf, "orders")
    key, total = F.col("o_orderkey"), F.col("o_totalprice")
    mine = o.select(
        key.alias("order_id"),
        F.nullif("o_orderstatus", F.lit("F")).alias("order_status"),
        F.when(key % 2 == 0, F.col("o_custkey")).alias("user_id"),
        F.when(key % 3 == 0, total).alias("split_total_amount"),
    )
    other = o.filter(key % 5 != 0).select(
        key.alias("order_id"),
        F.concat("o_orderstatus", F.lit("2")).alias("order_status"),
        (-F.col("o_custkey")).alias("user_id"),
        F.lit(0.0).alias("split_total_amount"),
    )
    return merge_first_non_null(mine, other, ["order_id"], ("split_total_amount",))


# ---- dimensions ------------------------------------------------------------------


@_query
def dim_lookup_composite(spark: SparkSession, sf: str) -> DataFrame:
    """A two-key lookup in a dimension that repeats keys, with nulls and misses."""
    part = shop.table(spark, sf, "part")
    detail = _details(spark, sf).join(part, F.col("sku_id") == part.p_partkey)
    turn = F.col("order_id") % 10
    facts = detail.select(
        F.col("id").alias("detail_id"), "order_id", F.col("p_brand").alias("brand"),
        F.when(turn == 0, None).when(turn == 1, -1).otherwise(F.col("p_size")).alias("size"),
    )
    return lookup_join(
        facts, part, {"brand": "p_brand", "size": "p_size"}, {"part_name": "p_name"}
    )


@_query
def dim_point_lookup(spark: SparkSession, sf: str) -> DataFrame:
    part = shop.table(spark, sf, "part")
    brand = part.agg(F.min("p_brand")).first()[0]
    return lookup_first(
        part.select("p_partkey", "p_name", "p_brand", "p_size"), p_brand=brand
    )


@_query
def sku_dimension(spark: SparkSession, sf: str) -> DataFrame:
    d = shop.dims(spark, sf)
    flat = flatten_sku(
        d["sku"], d["spu"], d["trademark"], d["category3"], unique=True
    )
    return flat.select(
        F.col("ID").alias("id"), F.col("SKU_NAME").alias("sku_name"),
        F.col("PRICE").cast("double").alias("sku_price"), F.col("SPU_ID").alias("spu_id"),
        F.col("SPU_NAME").alias("spu_name"), F.col("TM_ID").alias("tm_id"),
        F.col("TM_NAME").alias("tm_name"), F.col("CATEGORY3_ID").alias("category3_id"),
        F.col("CATEGORY3_NAME").alias("category3_name"),
    )


# ---- visits ----------------------------------------------------------------------


def _page_report(df: DataFrame, *more: str) -> DataFrame:
    return df.select(
        "event_id", "common.mid", "page.page_id", "common.vc", "common.ch", "common.ar",
        "common.is_new", *more,
    )


@_query
def unique_visit(spark: SparkSession, sf: str) -> DataFrame:
    return _page_report(_visits(spark, sf))


@_query
def unique_visit_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Device-days only: which of a day's entries arrives first is not fixed."""
    pages = _ended(shop.page_log(shop.stream_table(spark, sf, "events")))
    visits = logs.unique_visit_detail(pages, SETTINGS, tiebreak=TIEBREAK)
    done = run_available(visits, "unique-visit")
    return done.filter("common IS NOT NULL").select(
        "common.mid", F.date_format("rowtime", "yyyy-MM-dd").alias("day")
    )


@_query
def bounce_detail(spark: SparkSession, sf: str) -> DataFrame:
    return _page_report(_bounced(spark, sf), "reason")


@_query
def bounce_detail_stream(spark: SparkSession, sf: str) -> DataFrame:
    pages = shop.page_log(shop.stream_table(spark, sf, "events"))
    pages = _ended(pages, common='{"mid": "end"}', event_id="-1")
    found = logs.bounce_detail(pages, SETTINGS, tiebreak=TIEBREAK)
    return _page_report(run_available(found, "bounce"), "reason")


@_query
def new_visitor_repair(spark: SparkSession, sf: str) -> DataFrame:
    pages = _pages(spark, sf).withColumn("was_new", F.col("common.is_new"))
    fixed = repair_new_visitor(pages, tiebreak=TIEBREAK)
    return fixed.select("event_id", "common.mid", "was_new", "common.is_new")


@_query
def page_entries(spark: SparkSession, sf: str) -> DataFrame:
    entries = _pages(spark, sf).filter(entry_page())
    return _page_report(entries).drop("page_id")


# ---- statistics ------------------------------------------------------------------


@_query
def visitor_metric_rows(spark: SparkSession, sf: str) -> DataFrame:
    pages = _pages(spark, sf)
    rows = {
        "page": M.page_metrics(pages),
        "visit": M.unique_visit_metrics(_visits(spark, sf)),
        "session": M.session_metrics(pages),
        "bounce": M.bounce_metrics(_bounced(spark, sf)),
    }
    named = [df.withColumn("metric", F.lit(name)) for name, df in rows.items()]
    return M.union_metrics(named).withColumn("at", _text("rowtime")).drop("rowtime")


@_query
def visitor_stats(spark: SparkSession, sf: str) -> DataFrame:
    return stats.visitor_stats(
        _pages(spark, sf), _visits(spark, sf), _bounced(spark, sf), SETTINGS
    )


@_query
def visitor_stats_stream(spark: SparkSession, sf: str) -> DataFrame:
    running = stats.visitor_stats(
        _ended(shop.page_log(shop.stream_table(spark, sf, "events"))),
        _ended(_as_stream(_visits(spark, sf), "visits")),
        _ended(_as_stream(_bounced(spark, sf), "bounces")),
        SETTINGS,
    )
    return run_available(running, "visitor-stats")


def _kept(df: DataFrame, purpose: str) -> DataFrame:
    """A job's output as later jobs receive it: written once to the shared folder."""
    path = run_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _product_sources(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    events = shop.table(spark, sf, "events")
    # Read twice below: as orders and, joined to payments, as paid orders.
    joined = _kept(_joined(spark, sf), "order-join")
    return {
        "page": shop.page_log(events),
        "order_wide": joined,
        "payment_wide": orders.payment_wide(_payments(spark, sf), joined, SETTINGS),
        "cart": shop.cart_info(events),
        "favor": shop.favor_info(events),
        "refund": shop.refund_info(events),
        "comment": shop.comment_info(events),
    }


_AMOUNTS = ("order_amount", "payment_amount", "refund_amount")


@_query
def product_metric_rows(spark: SparkSession, sf: str) -> DataFrame:
    rows = stats.product_metrics(_product_sources(spark, sf))
    return _doubles(rows, *_AMOUNTS).withColumn("at", _text("rowtime")).drop("rowtime")


@_query
def product_stats(spark: SparkSession, sf: str) -> DataFrame:
    found = stats.product_stats(
        _product_sources(spark, sf), shop.dims(spark, sf), MONTHLY, unique_dims=True
    )
    return _doubles(found, *_AMOUNTS, "sku_price")


@_query
def product_stats_stream(spark: SparkSession, sf: str) -> DataFrame:
    events = shop.stream_table(spark, sf, "events")
    # Read twice: as the order job's stream and, joined to payments, as paid orders.
    wide = _kept(_wide(spark, sf), "order-wide")
    paid = orders.payment_wide(_payments(spark, sf), wide, SETTINGS)
    sources = {
        "page": shop.page_log(events),
        "order_wide": _as_stream(wide, "order-wide"),
        "payment_wide": _as_stream(paid, "payment-wide"),
        "cart": shop.cart_info(events),
        "favor": shop.favor_info(events),
        "refund": shop.refund_info(events),
        "comment": shop.comment_info(events),
    }
    running = stats.product_stats(
        {name: _ended(df) for name, df in sources.items()},
        shop.dims(spark, sf), MONTHLY, unique_dims=True,
    )
    return _doubles(run_available(running, "product-stats"), *_AMOUNTS, "sku_price")


@_query
def province_stats(spark: SparkSession, sf: str) -> DataFrame:
    return _doubles(stats.province_stats(_placed(spark, sf), SETTINGS), "order_amount")


@_query
def province_stats_split(spark: SparkSession, sf: str) -> DataFrame:
    found = stats.province_stats(
        _placed(spark, sf), SETTINGS, measure="split_total_amount"
    )
    return _doubles(found, "order_amount")


@_query
def province_stats_stream(spark: SparkSession, sf: str) -> DataFrame:
    wide = _ended(_as_stream(_placed(spark, sf), "order-wide"))
    running = run_available(stats.province_stats(wide, SETTINGS), "province-stats")
    return _doubles(running, "order_amount")


@_query
def province_stats_sql(spark: SparkSession, sf: str) -> DataFrame:
    """The province job as SQL over a table of order rows."""
    _placed(spark, sf).createOrReplaceTempView("order_wide_rows")
    found = stats.province_stats_sql(spark, "order_wide_rows", "1 day", SETTINGS.business_tz)
    return _doubles(found, "order_amount")


@_query
def province_stats_sql_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The same SQL over a stream of order rows, in a business zone east of the session's."""
    wide = _ended(_as_stream(_placed(spark, sf), "order-wide")).withWatermark("rowtime", "1 second")
    wide.createOrReplaceTempView("order_wide_stream_rows")
    found = stats.province_stats_sql(spark, "order_wide_stream_rows", "1 day", "+08:00")
    return _doubles(run_available(found, "province-sql"), "order_amount")


@_query
def keyword_stats(spark: SparkSession, sf: str) -> DataFrame:
    phrases = shop.search_phrases(shop.table(spark, sf, "documents"))
    return stats.keyword_stats(phrases, SEARCH)


@_query
def keyword_stats_stream(spark: SparkSession, sf: str) -> DataFrame:
    phrases = shop.search_phrases(shop.table(spark, sf, "documents"))
    # The end comes in the last slice: it would make the slices after it late.
    ended = phrases.unionByName(_end_record(spark, phrases.schema, {}))
    phrases = shop.replayed({"phrases": (ended, F.col("rowtime"))}, TEXT_ROWS)["phrases"]
    return run_available(stats.keyword_stats(phrases, SEARCH), "keyword-stats")


@_query
def keyword_vocabulary_stats(spark: SparkSession, sf: str) -> DataFrame:
    """Keywords through a vocabulary table: the short words of the texts themselves."""
    documents = shop.table(spark, sf, "documents")
    pieces = text.keyword_tokens(F.col("text"), PIECES)
    words = documents.select(F.explode(pieces).alias("word")).distinct()
    vocabulary = words.filter(F.length("word").between(2, 4))
    # Read twice below: to find the distinct pieces and to count their words.
    counted = _kept(
        piece_counts(shop.search_phrases(documents), SETTINGS, PIECES), "pieces"
    )
    found = word_counts(counted, vocabulary)
    return label_window(found, SETTINGS.business_tz)


def _page_view(spark: SparkSession, sf: str) -> DataFrame:
    """Page records with a text map ``page``; a signup page is a search."""
    kind = F.col("event_type")
    page_id = F.when(kind == "signup", SEARCH_PAGE).otherwise(kind)
    return shop.table(spark, sf, "events").select(
        F.create_map(
            F.lit("page_id"), page_id, F.lit("item"), F.col("props")
        ).alias("page"),
        times.millis_to_time(F.unix_millis(F.col("ts").cast("timestamp"))).alias("rowtime"),
    )


@_query
def keyword_stats_sql(spark: SparkSession, sf: str) -> DataFrame:
    text.register_keyword_split(spark, SETTINGS.keyword_pattern)
    _page_view(spark, sf).createOrReplaceTempView("page_view")
    return stats.keyword_stats_sql(spark, "page_view", "1 day", SETTINGS.business_tz)


@_query
def search_phrases_sql(spark: SparkSession, sf: str) -> DataFrame:
    found = stats.search_pages(_page_view(spark, sf))
    return found.select("fullword", _text("rowtime").alias("at"))


# ---- logs ------------------------------------------------------------------------


@_query
def log_json_split(spark: SparkSession, sf: str) -> DataFrame:
    cut = F.when(F.col("event_id") % 10 == 0, F.substring("props", 1, 4)).otherwise(
        F.col("props")
    )
    raw = shop.table(spark, sf, "events").select("event_id", cut.alias("value"))
    return mark_json(raw)


@_query
def log_start_split(spark: SparkSession, sf: str) -> DataFrame:
    opening = F.when(F.col("event_type") == "signup", F.col("props")).when(
        F.col("event_id") % 2 == 0, F.lit(" ")
    )
    raw = shop.table(spark, sf, "events").select("event_id", opening.alias("start"))
    return mark_log(raw).select("event_id", "route")


@_query
def log_display_explode(spark: SparkSession, sf: str) -> DataFrame:
    return explode_displays(_pages(spark, sf))


@_query
def json_records(spark: SparkSession, sf: str) -> DataFrame:
    """Text to record and back: rows are rendered as topic text, then parsed."""
    inner = T.StructType([T.StructField("k", T.LongType())])
    outer = T.StructType(
        [T.StructField("event_id", T.LongType()), T.StructField("props", T.StringType())]
    )
    events = shop.table(spark, sf, "events").select("event_id", "props")
    rows = parse_records(to_topic_rows(events), outer)
    schema = T.StructType([*outer.fields[:1], T.StructField("props", inner)])
    nested = rows.select(
        F.to_json(
            F.struct("event_id", F.from_json("props", inner).alias("props"))
        ).alias("value")
    )
    return parse_records(nested, schema).select("event_id", "props.k")


# ---- change feeds ----------------------------------------------------------------

_ORDER_COLUMNS = {"o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string"}


def _changes(spark: SparkSession, sf: str) -> DataFrame:
    return shop.order_changes(shop.table(spark, sf, "orders"))


def _route_table(spark: SparkSession) -> DataFrame:
    schema = (
        "type string, sourceTable string, operateType string, sinkType string, "
        "sinkTable string, sinkColumns string, sinkPk string, sinkExtend string, ts bigint"
    )
    fact = ("kafka", "dwd_order_info", "o_orderkey,o_orderstatus", None, None)
    dim = ("hbase", "dim_order", "o_orderkey,o_custkey", "o_orderkey", None)
    rows = [
        ("insert", "order_info", "insert", *fact, 1),
        ("insert", "order_info", "update", "kafka", "elsewhere", "o_orderkey", None, None, 2),
        ("update", "order_info", "update", *dim, 3),
        ("insert", "order_info", "delete", *dim, 4),
        ("delete", "order_info", "delete", *dim, 5),
    ]
    return latest_config(spark.createDataFrame(rows, schema))


def _routed(spark: SparkSession, sf: str) -> DataFrame:
    return C.routed_changes(_changes(spark, sf), _route_table(spark))


@_query
def cdc_route_fact(spark: SparkSession, sf: str) -> DataFrame:
    return by_route(_routed(spark, sf), "fact").select(
        "type", "sink_table", F.col("after")["o_orderkey"].alias("o_orderkey"),
        F.col("after")["o_orderstatus"].alias("o_orderstatus"),
    )


@_query
def cdc_route_dim(spark: SparkSession, sf: str) -> DataFrame:
    return by_route(_routed(spark, sf), "dim").select(
        "type", "sink_table", F.col("after")["o_orderkey"].alias("o_orderkey"),
        F.try_element_at("after", F.lit("o_custkey")).alias("o_custkey"),
    )


@_query
def cdc_fact_topic(spark: SparkSession, sf: str) -> DataFrame:
    return fact_topic_rows(_routed(spark, sf))


@_query
def cdc_route_counts(spark: SparkSession, sf: str) -> DataFrame:
    return _routed(spark, sf).groupBy("route").agg(F.count("*").alias("n"))


@_query
def cdc_config_in_force(spark: SparkSession, sf: str) -> DataFrame:
    """The orders read as a feed of route changes, a tenth of them removals."""
    key = F.col("o_orderkey")
    feed = shop.table(spark, sf, "orders").select(
        F.when(key % 7 == 0, "delete").otherwise("update").alias("type"),
        F.col("o_orderpriority").alias("sourceTable"),
        F.col("o_orderstatus").alias("operateType"),
        F.lit("kafka").alias("sinkType"),
        F.concat(F.lit("sink_"), key.cast("string")).alias("sinkTable"),
        F.lit("id").alias("sinkColumns"),
        F.lit(None).cast("string").alias("sinkPk"),
        F.lit(None).cast("string").alias("sinkExtend"),
        key.alias("ts"),
    )
    return latest_config(feed).select(
        F.col("sourceTable").alias("source_table"),
        F.col("operateType").alias("operate_type"),
        F.col("sinkTable").alias("sink_table"),
    )


@_query
def cdc_current_state(spark: SparkSession, sf: str) -> DataFrame:
    return current_state(_changes(spark, sf), "o_orderkey", _ORDER_COLUMNS)


@_query
def cdc_table_sql(spark: SparkSession, sf: str) -> DataFrame:
    """A change feed queried as the table it describes."""
    state = current_state(_changes(spark, sf), "o_orderkey", _ORDER_COLUMNS)
    state.createOrReplaceTempView("orders_now")
    return spark.sql("SELECT * FROM orders_now")


@_query
def cdc_retract_rows(spark: SparkSession, sf: str) -> DataFrame:
    return retract_stream(_changes(spark, sf), _ORDER_COLUMNS)


def _connector_records(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("o_orderkey")
    image = F.create_map(F.lit("o_orderkey"), key.cast("string"))
    turn = key % 4
    return shop.table(spark, sf, "orders").select(
        F.lit("server.shop.order_info").alias("topic"),
        F.when(turn == 0, "DELETE").when(turn == 1, "UPDATE").when(turn == 2, "CREATE")
        .otherwise("READ").alias("op"),
        F.when(turn < 2, image).alias("before"),
        F.when(turn != 0, image).alias("after"),
        F.col("o_orderkey"),
    )


@_query
def cdc_envelope(spark: SparkSession, sf: str) -> DataFrame:
    full = normalise_changes(_connector_records(spark, sf))
    return full.select(
        "operation", "database", F.col("table").alias("table_name"),
        F.col("after")["o_orderkey"].cast("bigint").alias("after_key"),
        F.col("before")["o_orderkey"].cast("bigint").alias("before_key"),
    )


@_query
def cdc_envelope_text(spark: SparkSession, sf: str) -> DataFrame:
    image = F.create_map(F.lit("o_orderkey"), F.col("o_orderkey").cast("string"))
    records = _connector_records(spark, sf).withColumn("after", image)
    return C.feed_to_topic(records)


@_query
def cdc_parse_text(spark: SparkSession, sf: str) -> DataFrame:
    """Envelope text in every producer's spelling -> the one canonical shape."""
    turn = F.col("o_orderkey") % 3
    image = F.struct("o_orderkey", "o_orderstatus")
    envelope = F.struct(
        F.lit("shop").alias("database"), F.lit("order_info").alias("table"),
        F.when(turn == 0, "create").alias("operation"),
        F.when(turn == 1, "UPDATE").alias("type"),
        F.when(turn == 2, "d").alias("op"),
        F.when(turn == 0, image).alias("after"),
        F.when(turn == 1, image).alias("data"),
        F.when(turn == 2, image).alias("before"),
        F.col("o_orderkey").alias("ts_ms"),
    )
    raw = shop.table(spark, sf, "orders").select(F.to_json(envelope).alias("value"))
    return parse_changes(raw).select(
        "database", F.col("table").alias("table_name"), "type", "ts",
        F.try_element_at("after", F.lit("o_orderkey")).cast("bigint").alias("after_key"),
        F.try_element_at("after", F.lit("o_orderstatus")).cast("string").alias("after_status"),
        F.try_element_at("before", F.lit("o_orderkey")).cast("bigint").alias("before_key"),
    )


@_query
def cdc_snapshot_and_changes(spark: SparkSession, sf: str) -> DataFrame:
    """A feed that starts from the present rows and goes on with the changes."""
    o = shop.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    first = snapshot_changes(o, "shop", "order_info")
    later = o.filter("o_orderkey % 4 = 1").select(
        F.lit("shop").alias("database"), F.lit("order_info").alias("table"),
        F.lit("update").alias("type"), F.lit(None).cast("map<string,string>").alias("before"),
        F.create_map(
            F.lit("o_orderkey"), F.col("o_orderkey").cast("string"),
            F.lit("o_orderstatus"), F.lit("X"),
        ).alias("after"),
        F.lit(1).cast("bigint").alias("ts"),
    )
    return first.unionByName(later).select(
        "type", F.col("after")["o_orderkey"].alias("o_orderkey"),
        F.col("after")["o_orderstatus"].alias("o_orderstatus"),
    )


@_query
def dim_upsert(spark: SparkSession, sf: str) -> DataFrame:
    live = _changes(spark, sf).filter("type <> 'delete'")
    return upserted(live, "o_orderkey", list(_ORDER_COLUMNS))


# ---- scalar functions ------------------------------------------------------------


@_query
def time_functions(spark: SparkSession, sf: str) -> DataFrame:
    o = shop.table(spark, sf, "orders").select(
        "o_orderkey",
        F.col("o_orderdate").cast("timestamp").alias("at"),
        F.date_format("o_orderdate", TIME_FORMAT).alias("create_time"),
    )
    maybe = F.when(F.col("o_orderkey") % 2 == 0, F.col("create_time")).otherwise("n/a")
    return with_create_times(o, SETTINGS).select(
        "o_orderkey",
        times.time_to_millis(F.col("create_time"), "+08:00").alias("ms_plus8"),
        times.format_time(F.col("at"), "UTC").alias("as_text"),
        F.col("create_ts").alias("parsed_ms"),
        "create_date",
        "create_hour",
        F.date_format(times.local_day(F.col("at"), "+08:00"), "yyyy-MM-dd").alias(
            "day_plus8"
        ),
        times.time_to_millis(maybe, "UTC").alias("lenient_ms"),
    )


@_query
def event_second(spark: SparkSession, sf: str) -> DataFrame:
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    return shop.table(spark, sf, "events").select(
        "event_id", ms.alias("ms"),
        F.date_format(times.millis_to_time(ms), TIME_FORMAT).alias("second"),
    )


@_query
def user_age(spark: SparkSession, sf: str) -> DataFrame:
    users = shop.dim_user(shop.table(spark, sf, "customer"))
    return users.select(
        F.col("ID").alias("c_custkey"),
        times.age_years(F.col("BIRTHDAY"), _as_of(), "UTC").alias("user_age"),
    )


@_query
def text_functions(spark: SparkSession, sf: str) -> DataFrame:
    size = F.col("p_size")
    spaced = F.when(size % 5 == 0, None).when(size % 5 == 1, " \t").otherwise(F.col("p_name"))
    return shop.table(spark, sf, "part").select(
        "p_partkey",
        F.lower("p_brand").alias("lower_brand"),
        F.upper("p_type").alias("upper_type"),
        F.concat_ws("-", "p_brand", "p_type").alias("joined_name"),
        F.split("p_name", " ")[0].alias("first_word"),
        text.is_blank(spaced).alias("blank"),
        spaced.eqNullSafe(F.lit(None)).alias("same_as_null"),
        F.coalesce(F.when(size % 2 == 0, F.col("p_brand")), F.col("p_type")).alias(
            "first_non_null"
        ),
    )
