"""Windowed visitor, product, province and keyword statistics."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.config import KEYWORD_SOURCE, SEARCH_PAGE, Settings
from tradewind.functions import times
from tradewind.functions.text import keyword_tokens
from tradewind.operators import metrics as M
from tradewind.operators.joins import flatten_sku, lookup_join
from tradewind.operators.windows import (
    label_window,
    tumbling,
    tumbling_distinct,
    tumbling_sum,
    watermarked,
)


def visitor_stats(
    pages: DataFrame,
    visits: DataFrame,
    bounced: DataFrame,
    settings: Settings,
) -> DataFrame:
    """Visits, page views, sessions, bounces and stay per visitor class and window.

    Visits and bounces reach their topics later than the pages they are derived from, so
    each source has its own watermark (disorder plus lateness) and a window's row is final
    once the slowest source has passed its end; a source without any record holds all
    windows open. For a sink that upserts by (stt, keys), run the same plan in update mode.
    """
    delay = settings.visitor_delay + settings.visitor_lateness
    pages, visits, bounced = (
        watermarked(df, "rowtime", delay) for df in (pages, visits, bounced)
    )
    parts = M.union_metrics(
        [
            M.page_visit_metrics(pages),
            M.unique_visit_metrics(visits),
            M.bounce_metrics(bounced),
        ]
    )
    sums = tumbling_sum(parts, M.VISITOR_KEYS, M.VISITOR_SUMS, "rowtime", settings.window)
    return label_window(sums, settings.business_tz)


def product_metrics(sources: Mapping[str, DataFrame]) -> DataFrame:
    """All product metric rows of the seven sources, one shape."""
    lifts = {
        "page": (M.page_product_metrics,),
        "order_wide": (M.order_metrics,),
        "cart": (M.cart_metrics,),
        "payment_wide": (M.payment_metrics,),
        "refund": (M.refund_metrics,),
        "favor": (M.favor_metrics,),
        "comment": (M.comment_metrics,),
    }
    return M.union_metrics(
        [lift(sources[name]) for name, group in lifts.items() for lift in group]
    )


def product_stats(
    sources: Mapping[str, DataFrame],
    dims: Mapping[str, DataFrame],
    settings: Settings,
    *,
    unique_dims: bool = False,
) -> DataFrame:
    """Exposure to comment metrics per product and window, then product attributes.

    Each source has its own watermark, as orders and payments trail the page log; the
    slowest decides when a window is final. Attributes are joined after the aggregation,
    to one row per product and window.
    """
    stats = product_sums(sources, settings)
    return with_products(stats, dims, unique_dims=unique_dims)


def product_sums(sources: Mapping[str, DataFrame], settings: Settings) -> DataFrame:
    """The windowed metrics of :func:`product_stats`, without attributes."""
    rows = product_metrics(
        {k: watermarked(df, "rowtime", settings.product_delay) for k, df in sources.items()}
    )
    sums = [*M.PRODUCT_COUNTS, *M.PRODUCT_AMOUNTS]
    stats = tumbling_distinct(
        rows,
        ["sku_id"],
        sums,
        ["ref_kind", "ref_id"],
        {
            "order_ct": F.col("ref_kind") == "order",
            "paid_order_ct": F.col("ref_kind") == "payment",
            "refund_order_ct": F.col("ref_kind") == "refund",
        },
        "rowtime",
        settings.window,
    )
    return label_window(M.zero_fill(stats, sums), settings.business_tz)


def with_products(
    stats: DataFrame, dims: Mapping[str, DataFrame], *, unique_dims: bool = False
) -> DataFrame:
    """Product attributes for the rows of :func:`product_sums`."""
    sku = flatten_sku(
        dims["sku"], dims["spu"], dims["trademark"], dims["category3"],
        unique=unique_dims,
    )
    return lookup_join(
        stats, sku, {"sku_id": "ID"},
        {
            "sku_name": "SKU_NAME", "sku_price": "PRICE", "spu_id": "SPU_ID",
            "spu_name": "SPU_NAME", "tm_id": "TM_ID", "tm_name": "TM_NAME",
            "category3_id": "CATEGORY3_ID", "category3_name": "CATEGORY3_NAME",
        },
        unique=unique_dims,
    )


PROVINCE_KEYS = (
    "province_id", "province_name", "province_area_code", "province_iso_code",
    "province_3166_2_code",
)


def province_stats(
    order_wide: DataFrame, settings: Settings, *, measure: str = "total_amount"
) -> DataFrame:
    """Orders and amount per province and window.

    ``total_amount`` is the whole order's amount and counts once per order row;
    ``measure="split_total_amount"`` sums each row's own share instead.
    """
    rows = watermarked(
        order_wide.select(
            "rowtime", *PROVINCE_KEYS, "order_id", F.col(measure).alias("order_amount")
        ),
        "rowtime",
        settings.province_delay,
    )
    stats = tumbling_distinct(
        rows, PROVINCE_KEYS, ["order_amount"], ["order_id"],
        {"order_count": F.col("order_id").isNotNull()}, "rowtime", settings.window,
    )
    return label_window(stats, settings.business_tz)


def province_stats_sql(spark: SparkSession, table: str, width: str, tz: str) -> DataFrame:
    """The province job as SQL over a table with ``rowtime``, batch or stream.

    Orders are reduced to one row each first: a stream has no distinct aggregate. Window
    bounds are printed in the zone ``tz``.
    """
    keys = ", ".join(PROVINCE_KEYS)
    return label_window(spark.sql(f"""
        SELECT window, {keys}, count(order_id) AS order_count,
               sum(order_amount) AS order_amount
        FROM (
            SELECT window(rowtime, '{width}') AS window, {keys}, order_id,
                   sum(total_amount) AS order_amount
            FROM {table} GROUP BY window(rowtime, '{width}'), {keys}, order_id
        ) GROUP BY window, {keys}
    """), tz)


def search_pages(pages: DataFrame) -> DataFrame:
    """Search phrases out of page records (``page`` is a struct or a text map)."""
    return pages.filter(
        (F.col("page")["page_id"] == SEARCH_PAGE) & F.col("page")["item"].isNotNull()
    ).select(F.col("page")["item"].alias("fullword"), "rowtime")


def keyword_stats(phrases: DataFrame, settings: Settings) -> DataFrame:
    """Keyword counts per window. The window is computed once per phrase, not per word."""
    words = (
        watermarked(phrases, "rowtime", settings.keyword_delay)
        .select(tumbling("rowtime", settings.window), "fullword")
        .select(
            "window",
            F.explode(
                keyword_tokens(F.col("fullword"), settings.keyword_pattern)
            ).alias("keyword"),
        )
    )
    counts = words.groupBy("window", "keyword").agg(F.count("*").alias("ct"))
    return label_window(counts, settings.business_tz).withColumn(
        "source", F.lit(KEYWORD_SOURCE)
    )


def keyword_stats_sql(spark: SparkSession, table: str, width: str, tz: str) -> DataFrame:
    """The keyword job as SQL over a declared table with ``page`` and ``rowtime``.

    Needs :func:`tradewind.functions.text.register_keyword_split`. Window bounds are
    printed in the zone ``tz``.
    """
    return label_window(spark.sql(f"""
        SELECT window(rowtime, '{width}') AS window, keyword, count(*) AS ct,
               '{KEYWORD_SOURCE}' AS source
        FROM (
            SELECT word AS keyword, rowtime
            FROM (
                SELECT page['item'] AS fullword, rowtime FROM {table}
                WHERE page['page_id'] = '{SEARCH_PAGE}' AND page['item'] IS NOT NULL
            ), LATERAL keyword_split(fullword) AS t(word)
        )
        GROUP BY window(rowtime, '{width}'), keyword
    """), tz)


def stamp(stats: DataFrame) -> DataFrame:
    """Add ``ts``, the processing time in milliseconds that sinks expect."""
    return stats.withColumn("ts", times.clock_millis())
