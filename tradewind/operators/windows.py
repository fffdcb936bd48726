"""Tumbling windows, their labels, and aggregation with exact distinct counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.config import span
from tradewind.functions import times


def watermarked(df: DataFrame, time: str, delay: timedelta) -> DataFrame:
    """Let ``time`` lag by ``delay``; a column that has its watermark already keeps it."""
    if "spark.watermarkDelayMs" in df.schema[time].metadata:
        return df
    return df.withWatermark(time, span(delay))


def tumbling(time: str, width: timedelta) -> Column:
    """Epoch-aligned ``[start, end)`` windows."""
    return F.window(time, span(width)).alias("window")


def tumbling_sum(
    df: DataFrame,
    keys: Sequence[str],
    sums: Sequence[str],
    time: str,
    width: timedelta,
) -> DataFrame:
    return df.groupBy(tumbling(time, width), *keys).agg(
        *(F.sum(c).alias(c) for c in sums)
    )


def tumbling_distinct(
    df: DataFrame,
    keys: Sequence[str],
    sums: Sequence[str],
    distinct: Sequence[str],
    counts: Mapping[str, Column],
    time: str,
    width: timedelta,
) -> DataFrame:
    """Sums plus exact distinct counts per key and window.

    Rows are first reduced to one per (window, keys, ``distinct``), which spreads a hot
    key over its ids; the second aggregation sums the partials and counts the groups
    that satisfy each condition in ``counts``. The same two steps run on a stream, where
    a distinct aggregate itself is not available, and no set of ids is ever built.
    """
    first = df.groupBy(tumbling(time, width), *keys, *distinct).agg(
        *(F.sum(c).alias(c) for c in sums)
    )
    return first.groupBy("window", *keys).agg(
        *(F.sum(c).alias(c) for c in sums),
        *(F.count(F.when(cond, 1)).alias(name) for name, cond in counts.items()),
    )


def label_window(df: DataFrame, tz: str) -> DataFrame:
    """Replace ``window`` by its bounds as text, ``stt`` and ``edt``."""
    return (
        df.withColumn("stt", times.format_time(F.col("window.start"), tz))
        .withColumn("edt", times.format_time(F.col("window.end"), tz))
        .drop("window")
    )
