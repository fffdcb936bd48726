"""Raw text to records, and change envelopes to one canonical shape."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind.config import Settings
from tradewind.functions import json as J
from tradewind.functions import times


def parse_records(
    raw: DataFrame, schema: T.StructType, value: str = "value", keep: Sequence[str] = ()
) -> DataFrame:
    """JSON text column -> one typed column per schema field.

    A number may be written bare or quoted. The text is parsed once: the parsed struct
    is its own projection and the casts read from it. ``keep`` names raw columns to carry.
    """
    text = F.from_json(F.col(value), J.text_schema(schema))
    return raw.select(text.alias("_r"), *keep).select(
        *(J.typed(F.col("_r")[f.name], f.dataType).alias(f.name) for f in schema), *keep
    )


def mark_json(raw: DataFrame, value: str = "value") -> DataFrame:
    """Add ``is_valid``: whether the text is exactly one JSON object."""
    return raw.withColumn("is_valid", J.is_json_object(F.col(value)))


def to_topic_rows(df: DataFrame, *, key: str | None = None) -> DataFrame:
    """Rows -> topic rows: the whole row as JSON text in ``value``."""
    cols = [J.to_json_row().alias("value")]
    if key:
        cols.insert(0, F.col(key).cast("string").alias("key"))
    return df.select(*cols)


def split_lines(raw: DataFrame, columns: dict[str, str], sep: str = ",") -> DataFrame:
    """Delimited text lines -> named columns, positions as given."""
    parts = F.split(F.col("value"), f"[{sep}]")
    return raw.select(parts.alias("_p")).select(
        *(
            F.try_element_at("_p", F.lit(i + 1)).try_cast(kind).alias(name)
            for i, (name, kind) in enumerate(columns.items())
        )
    )


def with_create_times(df: DataFrame, settings: Settings) -> DataFrame:
    """Derive ``create_date``, ``create_hour``, ``create_ts`` and ``rowtime``."""
    moment = times.parse_time(F.col("create_time"), settings.business_tz)
    return (
        df.withColumn("rowtime", moment)
        .withColumn("create_date", F.substring_index("create_time", " ", 1))
        .withColumn(
            "create_hour",
            F.substring_index(F.substring_index("create_time", " ", -1), ":", 1),
        )
        .withColumn("create_ts", F.unix_millis("rowtime"))
    )


def _operation(op: Column) -> Column:
    """One spelling per operation; the snapshot's reads count as inserts."""
    text = F.lower(op)
    full = (
        F.when(text.isin("c", "create", "r", "read"), "insert")
        .when(text == "u", "update")
        .when(text == "d", "delete")
    )
    return F.coalesce(full, text)


# Every field an envelope may carry. Producers disagree on two names: the operation is
# ``type``, ``operation`` or ``op``, and the new image is ``after`` or ``data``.
_ENVELOPE = """
    database string, table string, type string, operation string, op string,
    before map<string, variant>, after map<string, variant>, data map<string, variant>,
    ts bigint, ts_ms bigint
"""


def parse_changes(
    raw: DataFrame, value: str = "value", keep: Sequence[str] = ()
) -> DataFrame:
    """Change envelope text -> ``database, table, type, before, after, ts``.

    ``keep`` names raw columns to carry, such as an arrival number.
    """
    e = F.col("_e")
    return raw.select(F.from_json(F.col(value), _ENVELOPE).alias("_e"), *keep).select(
        e["database"].alias("database"),
        e["table"].alias("table"),
        _operation(F.coalesce(e["type"], e["operation"], e["op"])).alias("type"),
        e["before"].alias("before"),
        F.coalesce(e["after"], e["data"]).alias("after"),
        F.coalesce(e["ts"], e["ts_ms"]).alias("ts"),
        *keep,
    )


def normalise_changes(
    records: DataFrame,
    *,
    topic: str = "topic",
    op: str = "op",
    before: str = "before",
    after: str = "after",
    variant: str = "full",
) -> DataFrame:
    """Connector records -> envelope columns.

    The topic reads ``server.database.table``. ``variant="full"`` gives
    ``operation, after, before, database, table`` with creates renamed to inserts;
    ``variant="data"`` gives ``operation, data, database, table`` with the operation
    only lower-cased.
    """
    parts = F.split(F.col(topic), r"\.")
    place = [
        F.try_element_at(parts, F.lit(2)).alias("database"),
        F.try_element_at(parts, F.lit(3)).alias("table"),
    ]
    operation = F.lower(F.col(op))
    if variant == "data":
        return records.select(
            operation.alias("operation"), F.col(after).alias("data"), *place
        )
    if variant != "full":
        raise ValueError(f"unknown envelope variant: {variant}")
    renamed = F.when(operation == "create", "insert").otherwise(operation)
    return records.select(
        renamed.alias("operation"),
        F.col(after).alias("after"),
        F.col(before).alias("before"),
        *place,
    )


def snapshot_changes(
    table: DataFrame, database: str, name: str, order: Column | None = None
) -> DataFrame:
    """A table's present rows as the insert events that open its change feed."""
    image = F.map_from_arrays(
        F.array(*(F.lit(c) for c in table.columns)),
        F.array(*(F.col(c).cast("string") for c in table.columns)),
    )
    return table.select(
        F.lit(database).alias("database"),
        F.lit(name).alias("table"),
        F.lit("insert").alias("type"),
        F.lit(None).cast("map<string,string>").alias("before"),
        image.alias("after"),
        (F.lit(0) if order is None else order).cast("bigint").alias("ts"),
    )
