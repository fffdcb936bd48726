"""Order-wide and payment-wide fact rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.config import Settings
from tradewind.functions import times
from tradewind.operators.joins import flatten_sku, interval_join, lookup_join
from tradewind.operators.windows import watermarked

_FROM_ORDER = (
    "province_id order_status user_id total_amount activity_reduce_amount "
    "coupon_reduce_amount original_total_amount feight_fee create_time create_date "
    "create_hour".split()
)
_FROM_DETAIL = (
    "sku_id order_price sku_num sku_name split_activity_amount split_coupon_amount "
    "split_total_amount".split()
)
# Part of the wide row's shape, but neither source fills them.
_NEVER_SET = {
    "expire_time": "string", "operate_time": "string",
    "split_feight_fee": "decimal(16,2)",
}


def join_orders(
    orders: DataFrame, details: DataFrame, settings: Settings
) -> DataFrame:
    """Orders with their details, close in time; one row per detail."""
    joined = interval_join(
        watermarked(orders, "rowtime", settings.order_delay),
        watermarked(details, "rowtime", settings.order_delay),
        {"id": "order_id"},
        "rowtime", "rowtime",
        settings.order_lower, settings.order_upper,
    )
    return joined.select(
        F.col("r.id").alias("detail_id"),
        F.col("l.id").alias("order_id"),
        *(F.col(f"r.{c}").alias(c) for c in _FROM_DETAIL),
        *(F.col(f"l.{c}").alias(c) for c in _FROM_ORDER),
        *(F.lit(None).cast(t).alias(c) for c, t in _NEVER_SET.items()),
        F.col("l.rowtime").alias("rowtime"),
    )


def add_user(
    wide: DataFrame, user: DataFrame, settings: Settings, as_of: Column | None = None,
    *, unique: bool = False, spread: int = 0,
) -> DataFrame:
    """Gender, and age at ``as_of`` (by default now)."""
    at = F.current_timestamp() if as_of is None else as_of
    aged = user.select(
        "ID", "GENDER",
        times.age_years(F.col("BIRTHDAY"), at, settings.business_tz).alias("AGE"),
    )
    return lookup_join(
        wide, aged, {"user_id": "ID"}, {"user_age": "AGE", "user_gender": "GENDER"},
        unique=unique, spread=spread,
    )


def add_province(wide: DataFrame, province: DataFrame, *, unique: bool = False) -> DataFrame:
    return lookup_join(
        wide, province, {"province_id": "ID"},
        {
            "province_name": "NAME", "province_area_code": "AREA_CODE",
            "province_iso_code": "ISO_CODE", "province_3166_2_code": "ISO_3166_2",
        },
        unique=unique,
    )


def add_product(
    wide: DataFrame, dims: Mapping[str, DataFrame], *, unique: bool = False, spread: int = 0
) -> DataFrame:
    sku = flatten_sku(
        dims["sku"], dims["spu"], dims["trademark"], dims["category3"], unique=unique
    )
    return lookup_join(
        wide.drop("sku_name"), sku, {"sku_id": "ID"},
        {
            "sku_name": "SKU_NAME", "category3_id": "CATEGORY3_ID", "spu_id": "SPU_ID",
            "tm_id": "TM_ID", "spu_name": "SPU_NAME", "tm_name": "TM_NAME",
            "category3_name": "CATEGORY3_NAME",
        },
        unique=unique, spread=spread,
    )


def enrich_orders(
    wide: DataFrame,
    dims: Mapping[str, DataFrame],
    settings: Settings,
    as_of: Column | None = None,
    *,
    unique_dims: bool = False,
    spread: int = 0,
) -> DataFrame:
    """Add user, province and product attributes to order rows.

    ``spread`` deals the rows of a hot user or product over so many ways.
    """
    wide = add_user(wide, dims["user"], settings, as_of, unique=unique_dims, spread=spread)
    wide = add_province(wide, dims["province"], unique=unique_dims)
    return add_product(wide, dims, unique=unique_dims, spread=spread)


def order_wide(
    orders: DataFrame,
    details: DataFrame,
    dims: Mapping[str, DataFrame],
    settings: Settings,
    as_of: Column | None = None,
    *,
    unique_dims: bool = False,
) -> DataFrame:
    return enrich_orders(
        join_orders(orders, details, settings), dims, settings, as_of,
        unique_dims=unique_dims,
    )


# Wide-order columns that a payment row does not carry on.
_ORDER_ONLY = (
    "expire_time", "create_time", "operate_time", "create_date", "create_hour", "rowtime",
)
# Same-named columns: the payment's value stands, null or not.
_PAYMENT_WINS = ("order_id", "user_id", "total_amount")


def payment_wide(
    payments: DataFrame, wide_orders: DataFrame, settings: Settings
) -> DataFrame:
    """Payments with the order rows made up to a quarter of an hour before them."""
    joined = interval_join(
        watermarked(payments, "rowtime", settings.payment_delay),
        watermarked(wide_orders, "rowtime", settings.payment_delay),
        {"order_id": "order_id"},
        "rowtime", "rowtime",
        settings.payment_lower, settings.payment_upper,
    )
    carried = [
        c for c in wide_orders.columns if c not in _ORDER_ONLY and c not in _PAYMENT_WINS
    ]
    return joined.select(
        F.col("l.id").alias("payment_id"),
        F.col("l.subject").alias("subject"),
        F.col("l.payment_type").alias("payment_type"),
        F.col("l.create_time").alias("payment_create_time"),
        F.col("l.callback_time").alias("callback_time"),
        *(F.col(f"l.{c}").alias(c) for c in _PAYMENT_WINS),
        *(F.col(f"r.{c}").alias(c) for c in carried),
        F.col("r.create_time").alias("order_create_time"),
        F.col("l.rowtime").alias("rowtime"),
    )
