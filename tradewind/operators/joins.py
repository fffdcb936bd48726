"""Interval joins, dimension lookups and the merges that follow them."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind.config import micros
from tradewind.functions import times


def interval_join(
    left: DataFrame,
    right: DataFrame,
    on: Mapping[str, str],
    left_time: str,
    right_time: str,
    lower: timedelta,
    upper: timedelta,
    *,
    lower_inclusive: bool = True,
    upper_inclusive: bool = True,
    tile: timedelta | None = None,
) -> DataFrame:
    """Pair rows of equal key whose times differ by a bounded amount.

    Inner join on ``on`` (left column -> right column) and ``left.t + lower <= right.t
    <= left.t + upper``; either bound can be strict. The result carries the sides as
    aliases ``l`` and ``r`` for the caller to project.

    Time tiles are part of the equi-key: a right row sits in one tile, a left row is
    copied to the one or two tiles its interval touches. A key with very many rows on
    both sides is thus spread over tasks and compared only with rows close in time; on a
    stream the same holds for the join's state, which the watermark bounds in time.
    Both sides are facts that grow without bound, so in batch the join is a sort-merge
    join, which spills and which the adaptive skew join can split; neither side is ever
    broadcast.
    """
    if upper < lower:
        raise ValueError("interval join: upper bound lies below the lower bound")
    width = tile or max(4 * (upper - lower), timedelta(seconds=1))
    if width < upper - lower:
        raise ValueError("interval join: a tile must be at least one interval wide")
    lt, size = F.unix_micros(left_time), F.lit(micros(width))
    first = F.floor((lt + F.lit(micros(lower))) / size)
    last = F.floor((lt + F.lit(micros(upper))) / size)
    a = left.withColumn("_tile", F.explode(F.sequence(first, last))).alias("l")
    b = right.withColumn("_tile", times.tile(F.col(right_time), width))
    if not (left.isStreaming or right.isStreaming):
        b = b.hint("merge")
    b = b.alias("r")

    lt, rt = F.col(f"l.{left_time}"), F.col(f"r.{right_time}")
    low, high = lt + _shift(lower), lt + _shift(upper)
    condition = F.col("l._tile") == F.col("r._tile")
    for x, y in on.items():
        condition &= F.col(f"l.{x}") == F.col(f"r.{y}")
    condition &= rt >= low if lower_inclusive else rt > low
    condition &= rt <= high if upper_inclusive else rt < high
    return a.join(b, condition, "inner")


def _shift(value: timedelta) -> Column:
    return F.expr(f"INTERVAL '{value.total_seconds():.6f}' SECOND")


def lookup_join(
    facts: DataFrame,
    dim: DataFrame,
    on: Mapping[str, str],
    columns: Mapping[str, str],
    *,
    unique: bool = False,
    spread: int = 0,
) -> DataFrame:
    """Left-join dimension columns onto facts by any conjunction of keys.

    ``on`` maps fact column -> dimension column and ``columns`` maps new column ->
    dimension column. Every fact survives exactly once; a miss leaves nulls. Unless the
    dimension is known to hold one row per key (``unique``), one is picked per key.

    A text key column in the dimension is compared as text. No broadcast is forced: a
    user dimension grows with the business, so the planner decides by measured size,
    and a hot fact key in the sort-merge case is split by the adaptive skew join. Where
    that is not at hand, as in the batches of a stateful stream, ``spread`` deals the rows
    of each hot key over so many ways (see :func:`spread_hot`); a table only.
    """
    if not on:
        raise ValueError("a dimension lookup needs at least one key")
    keys = {f"_k{i}": d for i, d in enumerate(on.values())}
    side = dim.select(
        *(F.col(d).alias(k) for k, d in keys.items()),
        *(F.col(d).alias(name) for name, d in columns.items()),
    )
    for k in keys:
        side = side.filter(F.col(k).isNotNull())
    if not unique:
        picked = F.min(F.struct(*columns)).alias("_row")
        side = side.groupBy(*keys).agg(picked).select(*keys, "_row.*")
    fact_keys = []
    for k, fact_key in zip(keys, on, strict=True):
        f = F.col(fact_key)
        if isinstance(side.schema[k].dataType, T.StringType):
            f = f.cast("string")
        fact_keys.append(f)
    kinds = [(facts.select(f).schema[0].dataType, side.schema[k].dataType) for f, k in zip(fact_keys, keys, strict=True)]
    alike = all(a == b or {a, b} <= {T.LongType(), T.IntegerType()} for a, b in kinds)  # equal means equal as text
    if spread > 1 and alike and not facts.isStreaming:
        facts, side = spread_hot(facts, fact_keys, side, list(keys), spread)
        fact_keys.append(F.col("_way"))
        keys = {**keys, "_dim_way": ""}
    terms = [f == side[k] for f, k in zip(fact_keys, keys, strict=True)]
    return facts.join(side, reduce(Column.__and__, terms), "left").drop(*keys, "_way")


def spread_hot(
    facts: DataFrame, fact_keys: list[Column], side: DataFrame, keys: list[str], ways: int
) -> tuple[DataFrame, DataFrame]:
    """Rows of hot keys dealt over ``_way`` 0.., and side rows of those keys once for each
    ``_dim_way``; all other rows have way 0.

    A key is hot from one part in 4 x ways of the rows on. There are 4 x ways of them at
    most, found by a sketch that combines on the map side, so joining their list by a
    broadcast is bounded by that number. What the sketch overrates is dealt out needlessly,
    with the same result.
    """
    most = 4 * ways
    own = F.xxhash64(*(f.cast("string") for f in fact_keys))
    facts = facts.withColumn("_hash", own)
    top = facts.agg(F.expr(f"approx_top_k(_hash, {most}, {16 * most})").alias("top"), F.count("*").alias("n"))
    hot = top.select("n", F.inline("top")).filter(F.col("count") * most > F.col("n")).select(F.col("item").alias("_hot"))
    hot = F.broadcast(hot)
    is_hot = F.col("_hot").isNotNull()
    way = F.when(is_hot, F.pmod(F.monotonically_increasing_id(), F.lit(ways)).cast("int")).otherwise(0)
    facts = facts.join(hot, F.col("_hash") == F.col("_hot"), "left").withColumn("_way", way).drop("_hash", "_hot")
    side = side.withColumn("_hash", F.xxhash64(*(F.col(k).cast("string") for k in keys)))
    each = F.when(is_hot, F.sequence(F.lit(0), F.lit(ways - 1))).otherwise(F.array(F.lit(0)))
    side = side.join(hot, F.col("_hash") == F.col("_hot"), "left").withColumn("_dim_way", F.explode(each))
    return facts, side.drop("_hash", "_hot")


def lookup_first(dim: DataFrame, **equals) -> DataFrame:
    """The row of a dimension with the given column values; one row at most."""
    if not equals:
        raise ValueError("a dimension lookup needs at least one key")
    found = dim
    for column, value in equals.items():
        found = found.filter(F.col(column).cast("string") == F.lit(str(value)))
    return found.agg(F.min(F.struct(*dim.columns)).alias("_row")).filter(
        "_row IS NOT NULL"
    ).select("_row.*")


def flatten_sku(
    sku: DataFrame,
    spu: DataFrame,
    trademark: DataFrame,
    category3: DataFrame,
    *,
    unique: bool = False,
) -> DataFrame:
    """Resolve the SKU dimension's own references once.

    SPU, trademark and category are all reached through the SKU, so joining them to the
    SKU table first leaves facts with one lookup instead of four.
    """
    wide = lookup_join(
        sku, spu, {"SPU_ID": "ID"}, {"SPU_NAME": "SPU_NAME"}, unique=unique
    )
    wide = lookup_join(
        wide, trademark, {"TM_ID": "ID"}, {"TM_NAME": "TM_NAME"}, unique=unique
    )
    return lookup_join(
        wide, category3, {"CATEGORY3_ID": "ID"}, {"CATEGORY3_NAME": "NAME"}, unique=unique
    )


def merge_first_non_null(
    left: DataFrame, right: DataFrame, on: list[str], keep_left: tuple[str, ...] = ()
) -> DataFrame:
    """Fill the left row's nulls from the right row with the same key.

    Columns in ``keep_left``, and columns the right side lacks, stay as they are.
    """
    a, b = left.alias("a"), right.alias("b")
    cols = []
    for c in left.columns:
        if c in on or c in keep_left or c not in right.columns:
            cols.append(F.col(f"a.{c}").alias(c))
        else:
            cols.append(F.coalesce(F.col(f"a.{c}"), F.col(f"b.{c}")).alias(c))
    condition = None
    for k in on:
        term = F.col(f"a.{k}") == F.col(f"b.{k}")
        condition = term if condition is None else condition & term
    return a.join(b, condition, "left").select(*cols)
