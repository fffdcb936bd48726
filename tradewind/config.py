"""Every tunable of the warehouse jobs, with the production values as defaults."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import timedelta

# Topic names shared by the jobs that write and read them.
TOPICS = {
    "raw_changes": "ods_base_db",
    "raw_log": "ods_base_log",
    "start_log": "dwd_start_log",
    "page_log": "dwd_page_log",
    "display_log": "dwd_display_log",
    "order_info": "dwd_order_info",
    "order_detail": "dwd_order_detail",
    "payment_info": "dwd_payment_info",
    "cart_info": "dwd_cart_info",
    "favor_info": "dwd_favor_info",
    "refund_info": "dwd_order_refund_info",
    "comment_info": "dwd_comment_info",
    "unique_visit": "dwm_unique_visit",
    "bounce": "dwm_user_jump_detail",
    "order_wide": "dwm_order_wide",
    "payment_wide": "dwm_payment_wide",
    "heartbeat": "heartbeat",
}

# Codes the metrics test for.
APPRAISE_GOOD = "1201"
KEYWORD_SOURCE = "SEARCH"
CLICK_PAGE = "good_detail"
SEARCH_PAGE = "good_list"
SKU_ITEM = "sku_id"
ROUTE_FACT = "kafka"
ROUTE_DIM = "hbase"

# The text form of times in every record.
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"


@dataclass(frozen=True)
class Settings:
    """Parameters of the jobs.

    ``business_tz`` is the zone (offset or region id) in which record times are
    written, days are cut and window labels are printed.
    """

    business_tz: str = "+08:00"

    window: timedelta = timedelta(seconds=10)

    order_lower: timedelta = timedelta(seconds=-5)
    order_upper: timedelta = timedelta(seconds=5)
    payment_lower: timedelta = timedelta(minutes=-15)
    payment_upper: timedelta = timedelta(0)

    bounce_within: timedelta = timedelta(seconds=10)
    bounce_times: int = 2

    order_delay: timedelta = timedelta(0)
    payment_delay: timedelta = timedelta(0)
    bounce_delay: timedelta = timedelta(seconds=2)
    visitor_delay: timedelta = timedelta(seconds=1)
    visitor_lateness: timedelta = timedelta(seconds=2)
    product_delay: timedelta = timedelta(0)
    province_delay: timedelta = timedelta(seconds=1)
    keyword_delay: timedelta = timedelta(seconds=2)
    visit_delay: timedelta = timedelta(days=1)

    # How far a source may lag behind the others before heartbeats pass it by.
    heartbeat_allowance: timedelta = timedelta(minutes=1)

    # How many ways a hot device is split before the streaming de-duplication.
    dedup_salts: int = 8

    # How many buckets the keys of a stream's Python state are dealt into; a bucket is one
    # call, so its keys should be some hundreds to thousands.
    state_buckets: int = 4096

    # How many ways the rows of a hot key are dealt in a stream's lookups.
    lookup_ways: int = 64

    # The tokens of a search phrase, in any script: runs of letters, marks and digits;
    # Han, which is written without spaces, character by character.
    keyword_pattern: str = r"\p{IsHan}|[\p{L}\p{M}\p{N}&&[^\p{IsHan}]]+"


def span(value: timedelta) -> str:
    """A duration in the text form Spark's window and watermark clauses take."""
    return f"{micros(value)} microseconds"


def micros(value: timedelta) -> int:
    return value // timedelta(microseconds=1)
