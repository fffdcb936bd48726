"""Per-device operators on page events: new-visitor repair, unique visits, bounces."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewind.config import Settings, micros, span
from tradewind.functions import times
from tradewind.functions.text import is_blank


def entry_page(last_page: str = "page.last_page_id") -> Column:
    """True for a page reached from no other page."""
    return is_blank(F.col(last_page))


def replaced(df: DataFrame, path: str, value: Column) -> DataFrame:
    if "." not in path:
        return df.withColumn(path, value)
    parent, child = path.split(".", 1)
    return df.withColumn(parent, F.col(parent).withField(child, value))


def first_new_visits(
    logs: DataFrame, mid: str, flag: str, time: str, tiebreak: Sequence[str]
) -> DataFrame:
    """Per device, the (time, tiebreak) of its first record flagged new.

    Records without a time come after those with one.
    """
    flagged = logs.filter(flagged_new(mid, flag))
    by_device = flagged.groupBy(F.col(mid).alias("_mid"))
    if not tiebreak:
        return by_device.agg(F.min(time).alias("_t"))
    order = F.struct(
        F.col(time).isNull().alias("_timeless"),
        F.col(time).alias("_t"),
        *(F.col(c).alias(f"_t{i}") for i, c in enumerate(tiebreak)),
    )
    return by_device.agg(F.min(order).alias("_first")).select(
        "_mid", "_first.*"
    ).drop("_timeless")


def flagged_new(mid: str, flag: str) -> Column:
    return F.coalesce((F.col(flag) == "1") & F.col(mid).isNotNull(), F.lit(False))


def repair_new_visitor(
    logs: DataFrame,
    *,
    mid: str = "common.mid",
    flag: str = "common.is_new",
    time: str = "rowtime",
    tiebreak: Sequence[str] = (),
    seen: DataFrame | None = None,
) -> DataFrame:
    """Keep the new-visitor flag only on a device's first flagged record.

    Later flagged records become ``"0"``; unflagged records are untouched. ``time`` plus
    ``tiebreak`` must identify a record within its device. ``seen`` (column ``mid``)
    names devices already known from earlier data; none of their records stays new.

    On a stream, ``seen`` is where the state of seen devices starts, and of one device the
    first record to arrive (the earliest of a batch) stays new.

    Only flagged records can change: the others pass by without a shuffle. Firsts are
    found by an aggregation that combines on the map side, and are joined back on device,
    time and tiebreak together, so the rows of one busy device spread over all tasks
    instead of meeting in one.
    """
    if logs.isStreaming:
        from tradewind.streaming.stateful import streaming_new_visitors

        return streaming_new_visitors(logs, mid=mid, flag=flag, time=time, tiebreak=tiebreak, seen=seen)
    firsts = first_new_visits(logs, mid, flag, time, tiebreak)
    if seen is not None:
        known = seen.select(F.col("mid").alias("_mid"))
        firsts = firsts.join(known, "_mid", "left_anti")
    firsts = firsts.withColumn("_is_first", F.lit(True))
    condition = (F.col(mid) == F.col("_mid")) & F.col(time).eqNullSafe(F.col("_t"))
    for i, c in enumerate(tiebreak):
        condition = condition & F.col(c).eqNullSafe(F.col(f"_t{i}"))
    joined = logs.filter(flagged_new(mid, flag)).join(firsts, condition, "left")
    fixed = F.when(F.col("_is_first").isNull(), F.lit("0")).otherwise(F.col(flag))
    repaired = replaced(joined, flag, fixed).select(*logs.columns)
    return logs.filter(~flagged_new(mid, flag)).unionByName(repaired)


def unique_visits(
    pages: DataFrame,
    settings: Settings,
    *,
    mid: str = "common.mid",
    last_page: str = "page.last_page_id",
    time: str = "rowtime",
    tiebreak: Sequence[str] = (),
) -> DataFrame:
    """The first entry page per device and calendar day.

    Batch: the earliest by time. The rank filter lets Spark cut each map task's rows to
    one per device-day before the shuffle. Streaming: the first to arrive, with state
    dropped once the day is past; a salted first pass spreads a busy device, so at most
    ``dedup_salts`` rows per device-day reach the second.
    """
    entries = pages.filter(entry_page(last_page) & F.col(mid).isNotNull())
    if not pages.isStreaming:
        return (
            entries.withColumn("_day", times.local_day(F.col(time), settings.business_tz))
            .withColumn(
                "_rn",
                F.row_number().over(
                    Window.partitionBy(mid, "_day").orderBy(time, *tiebreak)
                ),
            )
            .filter("_rn = 1")
            .drop("_day", "_rn")
        )
    salt = F.pmod(F.xxhash64(time, *tiebreak, last_page), F.lit(settings.dedup_salts))
    day = times.local_day(F.col(time), settings.business_tz).cast("timestamp")
    return (
        entries.withColumn("_day", day)
        .withColumn("_mid", F.col(mid))
        .withColumn("_salt", salt)
        .withWatermark("_day", span(settings.visit_delay))
        .dropDuplicates(["_mid", "_day", "_salt"])
        .dropDuplicates(["_mid", "_day"])
        .drop("_day", "_mid", "_salt")
    )


def tiled_events(
    pages: DataFrame, time: str, within: timedelta, tile: timedelta
) -> DataFrame:
    """Cut time into tiles that overlap by one pattern length.

    Every event goes to its own tile; one in the first ``within`` of a tile is also shown
    to the tile before (``_probe``), so each tile sees all that its own events need.
    """
    here = times.tile(F.col(time), tile)
    into = F.unix_micros(time) - here * F.lit(micros(tile))
    both = F.array(here, here - 1)
    return (
        pages.withColumn("_here", here)
        .withColumn(
            "_tile",
            F.explode(F.when(into < micros(within), both).otherwise(F.array(here))),
        )
        .withColumn("_probe", F.col("_tile") != F.col("_here"))
        .drop("_here")
    )


def bounces(
    pages: DataFrame,
    settings: Settings,
    *,
    mid: str = "common.mid",
    last_page: str = "page.last_page_id",
    time: str = "rowtime",
    tiebreak: Sequence[str] = (),
    tile: timedelta | None = None,
) -> DataFrame:
    """Entry pages from which the visit did not go on.

    The pattern is ``bounce_times`` consecutive entry pages of one device within
    ``bounce_within``. Its first page is emitted when the pattern completes (``reason``
    ``matched``) and when time runs out before a different page breaks it
    (``timeout``): an entry page followed in time by a non-entry page is not a bounce.

    Only events less than one pattern length later matter, so device and time tile form
    the partition key and no device is ever ordered as a whole.
    """
    within = settings.bounce_within
    width = tile or 60 * within
    if width < within:
        raise ValueError("bounces: a tile must be at least one pattern length wide")
    if pages.isStreaming:
        from tradewind.streaming.stateful import streaming_bounces

        return streaming_bounces(
            pages, settings, mid=mid, last_page=last_page, time=time,
            tiebreak=tiebreak, tile=width,
        )
    steps = settings.bounce_times - 1
    w = Window.partitionBy("_mid", "_tile").orderBy(time, *tiebreak)
    df = (
        tiled_events(pages, time, within, width)
        .withColumn("_mid", F.col(mid))
        .filter(F.col("_mid").isNotNull())
        .withColumn("_entry", entry_page(last_page))
    )
    reason = F.lit("matched")
    for i in range(steps, 0, -1):
        df = df.withColumn(f"_t{i}", F.lead(time, i).over(w)).withColumn(
            f"_e{i}", F.lead("_entry", i).over(w)
        )
        gap = F.unix_micros(f"_t{i}") - F.unix_micros(time)
        late = F.coalesce(gap >= micros(within), F.lit(True))
        reason = F.when(late, "timeout").when(F.col(f"_e{i}"), reason)
    return (
        df.filter(F.col("_entry") & ~F.col("_probe"))
        .withColumn("reason", reason)
        .filter(F.col("reason").isNotNull())
        .select(*pages.columns, "reason")
    )
