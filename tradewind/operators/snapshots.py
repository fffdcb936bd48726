"""A table's snapshot and its change log, put together without overlap or gap.

The table is read in chunks of keys while changes go on. Of every chunk two places of the
log are kept: ``low``, taken before the chunk was read, and ``high``, taken after. What was
read holds every change up to ``low``, none after ``high``, and some of those between. So the
changes between the marks are laid over the rows read, which gives the chunk as of ``high``
whichever of them it held, and the log goes on after ``high``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MARKS = "chunk bigint, low bigint, high bigint"


def key_text(key: str) -> Column:
    """A change's key as text, out of its new image or else its old one."""
    new, old = (F.try_element_at(image, F.lit(key)).cast("string") for image in ("after", "before"))
    return F.coalesce(new, old)


def number_chunk(key: str, size: int) -> Column:
    """Chunks of so many consecutive whole-number keys."""
    return F.floor(key_text(key).try_cast("decimal(38,0)") / size).cast("bigint")


def changes_after(changes: DataFrame, marks: DataFrame, chunk: Column, position: str = "ts") -> DataFrame:
    """The changes that the snapshot of their chunk does not hold yet; those of a chunk that
    was never read all pass. ``changes`` may be a stream."""
    high = marks.select(F.col("chunk").alias("_chunk"), F.col("high").alias("_high"))
    placed = changes.withColumn("_own", chunk)
    joined = placed.join(high, F.col("_own") == F.col("_chunk"), "left")
    new = F.col("_high").isNull() | (F.col(position) > F.col("_high"))
    return joined.filter(new).select(*changes.columns)


def opened(
    snapshot: DataFrame, marks: DataFrame, changes: DataFrame, key: str, chunk: Column, position: str = "ts"
) -> DataFrame:
    """The rows of all chunks read, each as of its high mark, as insert changes there.

    ``snapshot`` has change columns (``after`` holds the row) and ``chunk``; ``changes`` may
    be the whole log, of which the stretches between the marks are used. Per key the last
    image wins, found by an aggregation that combines on the map side; deleted keys go.
    """
    columns = [c for c in changes.columns if c != position]
    # Changes to chunks that were read, between their marks.
    between = changes.withColumn("chunk", chunk).join(marks, "chunk")
    between = between.filter((F.col(position) > F.col("low")) & (F.col(position) <= F.col("high")))
    rows = snapshot.join(marks, "chunk")
    image = F.struct(*columns)
    both = rows.select("chunk", "high", key_text(key).alias("_key"), F.lit(None).cast("bigint").alias("_at"), image.alias("_row"))
    both = both.unionByName(
        between.select("chunk", "high", key_text(key).alias("_key"), F.col(position).cast("bigint").alias("_at"), image.alias("_row"))
    )
    last = both.filter("_key IS NOT NULL").groupBy("_key").agg(
        # A row read is older than any change: a null comes first.
        F.max_by(F.struct("high", "_row"), F.struct("_at", "chunk")).alias("_last")
    )
    kept = last.filter(~F.col("_last._row.type").eqNullSafe("delete"))
    return kept.select("_last._row.*", F.col("_last.high").alias(position)).withColumns(
        {"type": F.lit("insert"), "before": F.lit(None).cast(changes.schema["before"].dataType)}
    ).select(*changes.columns)


def whole_feed(
    snapshot: DataFrame, marks: DataFrame, changes: DataFrame, key: str, chunk: Column, position: str = "ts"
) -> DataFrame:
    """The snapshot as of its marks, then every change after them, each once."""
    return opened(snapshot, marks, changes, key, chunk, position).unionByName(
        changes_after(changes, marks, chunk, position)
    )
