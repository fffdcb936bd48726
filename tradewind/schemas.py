"""Declared record schemas, one per topic or dimension table."""

from __future__ import annotations

import re

from pyspark.sql import types as T


_SCALARS = {
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "string": T.StringType(),
    "decimal(16,2)": T.DecimalType(16, 2),
}


def _record(text: str) -> T.StructType:
    """``name type, name type, ...`` over the scalar types above."""
    pairs = re.findall(r"(\w+)\s+(\w+(?:\(\d+,\d+\))?)", text)
    return T.StructType([T.StructField(name, _SCALARS[kind]) for name, kind in pairs])


_COMMON = _record("mid string, vc string, ch string, ar string, is_new string")
_PAGE = _record(
    "page_id string, last_page_id string, item string, item_type string, "
    "during_time bigint"
)
_DISPLAY = _record("item string, item_type string")

PAGE_LOG = T.StructType(
    [
        T.StructField("common", _COMMON),
        T.StructField("page", _PAGE),
        T.StructField("displays", T.ArrayType(_DISPLAY)),
        T.StructField("ts", T.LongType()),
    ]
)

ORDER_INFO = _record("""
    id bigint, province_id bigint, order_status string, user_id bigint,
    total_amount decimal(16,2), activity_reduce_amount decimal(16,2),
    coupon_reduce_amount decimal(16,2), original_total_amount decimal(16,2),
    feight_fee decimal(16,2), expire_time string, create_time string, operate_time string
""")

ORDER_DETAIL = _record("""
    id bigint, order_id bigint, sku_id bigint, order_price decimal(16,2), sku_num bigint,
    sku_name string, create_time string, split_total_amount decimal(16,2),
    split_activity_amount decimal(16,2), split_coupon_amount decimal(16,2)
""")

PAYMENT_INFO = _record("""
    id bigint, order_id bigint, user_id bigint, total_amount decimal(16,2),
    subject string, payment_type string, create_time string, callback_time string
""")

ORDER_WIDE = _record("""
    detail_id bigint, order_id bigint, sku_id bigint, order_price decimal(16,2),
    sku_num bigint, sku_name string, province_id bigint, order_status string,
    user_id bigint, total_amount decimal(16,2), activity_reduce_amount decimal(16,2),
    coupon_reduce_amount decimal(16,2), original_total_amount decimal(16,2),
    feight_fee decimal(16,2), split_feight_fee decimal(16,2),
    split_activity_amount decimal(16,2), split_coupon_amount decimal(16,2),
    split_total_amount decimal(16,2), expire_time string, create_time string,
    operate_time string, create_date string, create_hour string,
    province_name string, province_area_code string, province_iso_code string,
    province_3166_2_code string, user_age int, user_gender string, spu_id bigint,
    tm_id bigint, category3_id bigint, spu_name string, tm_name string,
    category3_name string
""")

PAYMENT_WIDE = _record("""
    payment_id bigint, subject string, payment_type string, payment_create_time string,
    callback_time string, detail_id bigint, order_id bigint, sku_id bigint,
    order_price decimal(16,2), sku_num bigint, sku_name string, province_id bigint,
    order_status string, user_id bigint, total_amount decimal(16,2),
    activity_reduce_amount decimal(16,2), coupon_reduce_amount decimal(16,2),
    original_total_amount decimal(16,2), feight_fee decimal(16,2),
    split_feight_fee decimal(16,2), split_activity_amount decimal(16,2),
    split_coupon_amount decimal(16,2), split_total_amount decimal(16,2),
    order_create_time string, province_name string, province_area_code string,
    province_iso_code string, province_3166_2_code string, user_age int,
    user_gender string, spu_id bigint, tm_id bigint, category3_id bigint,
    spu_name string, tm_name string, category3_name string
""")

CART_INFO = _record("sku_id bigint, create_time string")
FAVOR_INFO = CART_INFO
REFUND_INFO = _record(
    "sku_id bigint, order_id bigint, refund_amount decimal(16,2), create_time string"
)
COMMENT_INFO = _record("sku_id bigint, appraise string, create_time string")

TABLE_PROCESS = _record("""
    sourceTable string, operateType string, sinkType string, sinkTable string,
    sinkColumns string, sinkPk string, sinkExtend string
""")

VISITOR_STATS_COLUMNS = (
    "stt edt vc ch ar is_new uv_ct pv_ct sv_ct uj_ct dur_sum ts".split()
)
PRODUCT_STATS_COLUMNS = (
    "stt edt sku_id sku_name sku_price spu_id spu_name tm_id tm_name category3_id "
    "category3_name display_ct click_ct favor_ct cart_ct order_sku_num order_amount "
    "order_ct payment_amount paid_order_ct refund_order_ct refund_amount comment_ct "
    "good_comment_ct ts".split()
)
PROVINCE_STATS_COLUMNS = (
    "stt edt province_id province_name province_area_code province_iso_code "
    "province_3166_2_code order_amount order_count ts".split()
)
KEYWORD_STATS_COLUMNS = "keyword ct source stt edt ts".split()
