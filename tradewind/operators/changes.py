"""Change feeds as tables: current state, retract view, dimension upsert."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewind.operators.snapshots import key_text


def image_columns(image: str, columns: Mapping[str, str]) -> list[Column]:
    """Typed columns out of a row image; ``columns`` maps name -> type."""
    return [
        F.try_element_at(image, F.lit(c)).cast("string").try_cast(kind).alias(c)
        for c, kind in columns.items()
    ]


def current_state(
    changes: DataFrame,
    key: str,
    columns: Mapping[str, str],
    order: Sequence[str] = ("ts",),
) -> DataFrame:
    """The table a change feed describes: last image per key, deleted keys gone.

    ``order`` must tell all changes of a key apart (add an arrival number to ``ts`` where
    times repeat). Changes without a key describe no row and are left out. The rank filter
    is applied inside each map task too, so a key with many changes sends one row per task
    to the shuffle.
    """
    image = F.coalesce("after", "before")
    last = Window.partitionBy("_key").orderBy(*(F.desc(c) for c in order))
    return (
        changes.withColumn(
            "_key", F.try_element_at(image, F.lit(key)).cast("string")
        )
        .filter("_key IS NOT NULL")
        .withColumn("_rn", F.row_number().over(last))
        .filter((F.col("_rn") == 1) & ~F.col("type").eqNullSafe("delete"))
        .select(*image_columns("after", columns))
    )


def retract_stream(
    changes: DataFrame, columns: Mapping[str, str], order: Sequence[str] = ("ts",)
) -> DataFrame:
    """Each change as rows leaving (``is_add`` false) and entering (true) the table."""
    pair = F.array(
        F.struct(F.lit(False).alias("is_add"), F.col("before").alias("image")),
        F.struct(F.lit(True).alias("is_add"), F.col("after").alias("image")),
    )
    return (
        changes.select(*order, F.explode(pair).alias("_c"))
        .filter(F.col("_c.image").isNotNull())
        .select(*order, "_c.is_add", "_c.image")
        .select(*order, "is_add", *image_columns("image", columns))
    )


def retract_by_key(
    changes: DataFrame, key: str, columns: Mapping[str, str], order: Sequence[str] = ("ts",)
) -> DataFrame:
    """As :func:`retract_stream`, for a feed whose changes need not tell the old image.

    The row that leaves is the one the same key's last change left behind: by a window over
    the key's changes on a table, in keyed state on a stream (where it goes on from batch to
    batch). ``order`` must tell all changes of a key apart; changes without a key are left
    out. A delete may name its key in either image. A new image stands for the whole row.
    """
    kept = changes.select(
        key_text(key).alias("_key"), *order,
        F.when(~F.col("type").eqNullSafe("delete"), F.transform_values("after", lambda _, v: v.cast("string"))).alias("_new"),
    ).filter("_key IS NOT NULL")
    if changes.isStreaming:
        from tradewind.streaming.stateful import streaming_last_images

        pairs = streaming_last_images(kept, order)
    else:
        before = F.lag("_new").over(Window.partitionBy("_key").orderBy(*order))
        pairs = kept.withColumn("_old", before)
    pair = F.array(
        F.struct(F.lit(False).alias("is_add"), F.col("_old").alias("image")),
        F.struct(F.lit(True).alias("is_add"), F.col("_new").alias("image")),
    )
    return (
        pairs.select(*order, F.explode(pair).alias("_c"))
        .filter(F.col("_c.image").isNotNull())
        .select(*order, "_c.is_add", "_c.image")
        .select(*order, "is_add", *image_columns("image", columns))
    )


def upserted(
    changes: DataFrame,
    pk: str,
    columns: Sequence[str],
    order: Sequence[str] = ("ts",),
) -> DataFrame:
    """A dimension after a run of upserts: per key and column, the last value written.

    A change writes just the columns its image names; a column it does not name keeps
    its earlier value, while one named with a null is set to null. All values are text.
    """
    version = F.struct(*order)
    keyed = changes.withColumn("_pk", F.try_element_at("after", F.lit(pk)).cast("string"))
    last = [
        F.max_by(
            F.struct(F.try_element_at("after", F.lit(c)).cast("string").alias("v")),
            F.when(F.map_contains_key("after", F.lit(c)), version),
        ).alias(c)
        for c in columns
        if c != pk
    ]
    return (
        keyed.filter(F.col("_pk").isNotNull())
        .groupBy("_pk")
        .agg(*last)
        .select(
            F.col("_pk").alias(pk),
            *(F.col(f"{c}.v").alias(c) for c in columns if c != pk),
        )
        .select(*columns)
    )
