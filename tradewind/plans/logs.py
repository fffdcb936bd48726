"""Application log separation and the page-event details derived from it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind import schemas
from tradewind.config import Settings
from tradewind.operators.parse import mark_json, parse_records
from tradewind.operators.route import explode_displays, mark_log
from tradewind.operators.visits import bounces, repair_new_visitor, unique_visits
from tradewind.operators.windows import watermarked


def parse_pages(
    raw: DataFrame, schema: T.StructType = schemas.PAGE_LOG, keep: Sequence[str] = ()
) -> DataFrame:
    """Page-log text -> records with ``rowtime``; ``keep`` names raw columns to carry."""
    parsed = parse_records(raw, schema, keep=keep)
    return parsed.withColumn("rowtime", F.timestamp_millis("ts"))


def repaired_logs(
    valid: DataFrame,
    *,
    tiebreak: Sequence[str] = (),
    seen: DataFrame | None = None,
    schema: T.StructType = schemas.PAGE_LOG,
) -> DataFrame:
    """Valid log text -> records with the new-visitor flag repaired, and their ``route``.

    ``tiebreak`` names raw columns that order records of one device and time.
    """
    wanted = T.StructType([*schema.fields, T.StructField("start", T.StringType())])
    records = parse_pages(valid, wanted, tiebreak)
    return mark_log(repair_new_visitor(records, tiebreak=tiebreak, seen=seen))


def page_records(routed: DataFrame) -> DataFrame:
    return routed.filter("route = 'page'").drop("route", "start")


def start_records(routed: DataFrame) -> DataFrame:
    return routed.filter("route = 'start'").select("common", "start", "ts")


def separate_logs(raw: DataFrame, **options) -> dict[str, DataFrame]:
    """Raw log text -> ``dirty``, ``start``, ``page`` and ``display`` rows (batch).

    Options are those of :func:`repaired_logs`.
    """
    marked = mark_json(raw)
    routed = repaired_logs(marked.filter("is_valid"), **options)
    page = page_records(routed)
    return {
        "dirty": marked.filter("NOT is_valid").select("value"),
        "start": start_records(routed),
        "page": page,
        "display": explode_displays(page),
    }


def unique_visit_detail(pages: DataFrame, settings: Settings, **columns) -> DataFrame:
    return unique_visits(pages, settings, **columns)


def bounce_detail(pages: DataFrame, settings: Settings, **columns) -> DataFrame:
    time = columns.get("time", "rowtime")
    timed = watermarked(pages, time, settings.bounce_delay)
    return bounces(timed, settings, **columns)
