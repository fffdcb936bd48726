"""Lifts of single records to the common metric rows the statistics sum up."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.config import APPRAISE_GOOD, CLICK_PAGE, SKU_ITEM
from tradewind.functions.text import is_blank

VISITOR_KEYS = ("vc", "ch", "ar", "is_new")
VISITOR_SUMS = ("uv_ct", "pv_ct", "sv_ct", "uj_ct", "dur_sum")

PRODUCT_COUNTS = (
    "display_ct", "click_ct", "favor_ct", "cart_ct", "order_sku_num", "comment_ct",
    "good_comment_ct",
)
PRODUCT_AMOUNTS = ("order_amount", "payment_amount", "refund_amount")


def union_metrics(parts: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL by name; a metric a source does not supply is null there."""
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def zero_fill(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in columns})


def _visitor(df: DataFrame, time: str, **metrics: Column) -> DataFrame:
    zeros = {m: F.lit(0) for m in VISITOR_SUMS} | metrics
    return df.select(
        F.col(time).alias("rowtime"),
        *(F.col(f"common.{k}").alias(k) for k in VISITOR_KEYS),
        *(v.cast("bigint").alias(m) for m, v in zeros.items()),
    )


def page_metrics(pages: DataFrame, time: str = "rowtime") -> DataFrame:
    stay = F.coalesce(F.col("page.during_time"), F.lit(0))
    return _visitor(pages, time, pv_ct=F.lit(1), dur_sum=stay)


def unique_visit_metrics(visits: DataFrame, time: str = "rowtime") -> DataFrame:
    return _visitor(visits, time, uv_ct=F.lit(1))


def session_metrics(pages: DataFrame, time: str = "rowtime") -> DataFrame:
    entries = pages.filter(is_blank(F.col("page.last_page_id")))
    return _visitor(entries, time, sv_ct=F.lit(1))


def bounce_metrics(bounced: DataFrame, time: str = "rowtime") -> DataFrame:
    return _visitor(bounced, time, uj_ct=F.lit(1))


def page_visit_metrics(pages: DataFrame, time: str = "rowtime") -> DataFrame:
    """Page and session metrics of a page in one row.

    Sums the same as the union of :func:`page_metrics` and :func:`session_metrics`, with
    the page log read once and half the rows.
    """
    stay = F.coalesce(F.col("page.during_time"), F.lit(0))
    entry = F.when(is_blank(F.col("page.last_page_id")), 1).otherwise(0)
    return _visitor(pages, time, pv_ct=F.lit(1), sv_ct=entry, dur_sum=stay)


def _product(df: DataFrame, time: str, sku: Column, **metrics: Column) -> DataFrame:
    return df.select(
        F.col(time).alias("rowtime"),
        sku.try_cast("bigint").alias("sku_id"),
        *(v.alias(m) for m, v in metrics.items()),
    )


def _ref(kind: str, column: str) -> dict[str, Column]:
    return {"ref_kind": F.lit(kind), "ref_id": F.col(column).cast("bigint")}


def click_metrics(pages: DataFrame, time: str = "rowtime") -> DataFrame:
    clicked = pages.filter(
        (F.col("page.page_id") == CLICK_PAGE) & (F.col("page.item_type") == SKU_ITEM)
    )
    return _product(clicked, time, F.col("page.item"), click_ct=F.lit(1))


def display_metrics(pages: DataFrame, time: str = "rowtime") -> DataFrame:
    shown = pages.select(time, F.explode("displays").alias("_d")).filter(
        F.col("_d.item_type") == SKU_ITEM
    )
    return _product(shown, time, F.col("_d.item"), display_ct=F.lit(1))


def page_product_metrics(pages: DataFrame, time: str = "rowtime") -> DataFrame:
    """The rows of :func:`click_metrics` and :func:`display_metrics` in one pass."""

    def row(item: Column, click: int | None, display: int | None) -> Column:
        return F.struct(
            item.cast("string").alias("item"), F.lit(click).cast("int").alias("click_ct"),
            F.lit(display).cast("int").alias("display_ct"),
        )

    clicked = (F.col("page.page_id") == CLICK_PAGE) & (F.col("page.item_type") == SKU_ITEM)
    click = F.when(clicked, F.array(row(F.col("page.item"), 1, None))).otherwise(F.array())
    shown = F.transform(
        F.filter(F.coalesce("displays", F.array()), lambda d: d.item_type == SKU_ITEM),
        lambda d: row(d.item, None, 1),
    )
    found = pages.select(time, F.inline(F.concat(click, shown)))
    return _product(
        found, time, F.col("item"), click_ct=F.col("click_ct"), display_ct=F.col("display_ct")
    )


def order_metrics(order_wide: DataFrame, time: str = "rowtime") -> DataFrame:
    return _product(
        order_wide, time, F.col("sku_id"),
        order_sku_num=F.col("sku_num"), order_amount=F.col("split_total_amount"),
        **_ref("order", "order_id"),
    )


def payment_metrics(payment_wide: DataFrame, time: str = "rowtime") -> DataFrame:
    return _product(
        payment_wide, time, F.col("sku_id"),
        payment_amount=F.col("split_total_amount"), **_ref("payment", "order_id"),
    )


def favor_metrics(favors: DataFrame, time: str = "rowtime") -> DataFrame:
    return _product(favors, time, F.col("sku_id"), favor_ct=F.lit(1))


def cart_metrics(carts: DataFrame, time: str = "rowtime") -> DataFrame:
    return _product(carts, time, F.col("sku_id"), cart_ct=F.lit(1))


def refund_metrics(refunds: DataFrame, time: str = "rowtime") -> DataFrame:
    return _product(
        refunds, time, F.col("sku_id"),
        refund_amount=F.col("refund_amount"), **_ref("refund", "order_id"),
    )


def comment_metrics(comments: DataFrame, time: str = "rowtime") -> DataFrame:
    good = F.when(F.col("appraise") == APPRAISE_GOOD, 1).otherwise(0)
    return _product(
        comments, time, F.col("sku_id"), comment_ct=F.lit(1), good_comment_ct=good
    )
