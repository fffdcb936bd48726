"""Change-feed jobs: configured routing, feed to topic, feed as a table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.functions import json as J
from tradewind.operators.changes import current_state, image_columns, retract_stream
from tradewind.operators.parse import normalise_changes, parse_changes
from tradewind.operators.route import drop_deletes, latest_config, route_changes


def config_table(config_changes: DataFrame) -> DataFrame:
    """Route configuration from its own change feed (canonical envelope columns)."""
    names = {
        c: "string"
        for c in (
            "sourceTable", "operateType", "sinkType", "sinkTable", "sinkColumns",
            "sinkPk", "sinkExtend",
        )
    }
    image = F.coalesce("after", "before")
    flat = config_changes.withColumn("_image", image).select(
        "type", "ts", *image_columns("_image", names)
    )
    return latest_config(flat)


def routed_changes(changes: DataFrame, config: DataFrame) -> DataFrame:
    """Deletes dropped, each change matched with its route and cut to its columns."""
    return route_changes(drop_deletes(changes), config)


def feed_to_topic(records: DataFrame, variant: str = "data") -> DataFrame:
    """Connector records -> one JSON envelope per change, ready for a topic."""
    return normalise_changes(records, variant=variant).select(
        J.to_json_row().alias("value")
    )


def feed_as_table(
    raw: DataFrame, columns: Mapping[str, str], key: str, order: Sequence[str] = ("ts",)
) -> tuple[DataFrame, DataFrame]:
    """Change envelope text -> (present rows, retract rows)."""
    changes = parse_changes(raw)
    return current_state(changes, key, columns, order), retract_stream(
        changes, columns, order
    )
