"""Routing: change events by configuration, log records by content."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewind.config import ROUTE_DIM, ROUTE_FACT
from tradewind.functions.text import is_blank


def drop_deletes(changes: DataFrame, op: str = "type") -> DataFrame:
    """Keep every change but deletes; an unknown operation passes."""
    return changes.filter(~F.col(op).eqNullSafe("delete"))


def latest_config(config_changes: DataFrame, order: str = "ts") -> DataFrame:
    """The route table in force: last change per (source table, operation).

    ``config_changes`` holds ``type`` and the route fields. A delete removes its route;
    rows without a key are ignored.
    """
    last = Window.partitionBy("sourceTable", "operateType").orderBy(F.desc(order))
    return (
        config_changes.filter(
            F.col("sourceTable").isNotNull() & F.col("operateType").isNotNull()
        )
        .withColumn("_rn", F.row_number().over(last))
        .filter((F.col("_rn") == 1) & ~F.col("type").eqNullSafe("delete"))
        .select(
            "sourceTable", "operateType", "sinkType", "sinkTable", "sinkColumns",
            "sinkPk", "sinkExtend",
        )
    )


def keep_columns(image: Column, column_list: Column) -> Column:
    """Keep the map entries named in a comma list; names match exactly."""
    names = F.split(column_list, ",")
    return F.map_filter(image, lambda k, _: F.array_contains(names, k))


def route_changes(changes: DataFrame, config: DataFrame) -> DataFrame:
    """Look each change's route up and cut its new image to the configured columns.

    Adds ``sink_table``, ``sink_pk`` and ``route``: ``fact``, ``dim``, ``ignored`` (a
    sink this job does not serve) or ``unmatched`` (no route). No broadcast is forced:
    the planner broadcasts the route table when its size allows.
    """
    c = config.select(
        F.col("sourceTable").alias("_table"),
        F.col("operateType").alias("_op"),
        F.col("sinkType").alias("_sink"),
        F.col("sinkTable").alias("sink_table"),
        F.col("sinkColumns").alias("_columns"),
        F.coalesce("sinkPk", F.lit("id")).alias("sink_pk"),
    )
    routed = changes.join(
        c, (changes["table"] == c["_table"]) & (changes["type"] == c["_op"]), "left"
    )
    route = (
        F.when(F.col("_table").isNull(), "unmatched")
        .when(F.col("_sink") == ROUTE_FACT, "fact")
        .when(F.col("_sink") == ROUTE_DIM, "dim")
        .otherwise("ignored")
    )
    kept = F.when(
        F.col("_columns").isNotNull(), keep_columns(F.col("after"), F.col("_columns"))
    ).otherwise(F.col("after"))
    return routed.withColumn("route", route).withColumn("after", kept).drop(
        "_table", "_op", "_sink", "_columns"
    )


def by_route(changes: DataFrame, route: str) -> DataFrame:
    return changes.filter(F.col("route") == route)


def fact_topic_rows(routed: DataFrame) -> DataFrame:
    """Fact changes -> topic rows whose ``topic`` is chosen by the route."""
    return by_route(routed, "fact").select(
        F.col("sink_table").alias("topic"), F.to_json("after").alias("value")
    )


def mark_log(parsed: DataFrame, start: str = "start") -> DataFrame:
    """Add ``route``: ``start`` for a record with a non-blank start block, else ``page``."""
    return parsed.withColumn(
        "route", F.when(is_blank(F.col(start)), "page").otherwise("start")
    )


def explode_displays(pages: DataFrame) -> DataFrame:
    """One row per displayed item, stamped with its page; nothing else is carried."""
    return pages.select(
        F.explode("displays").alias("_d"), F.col("page.page_id").alias("page_id")
    ).select("_d.*", "page_id")
