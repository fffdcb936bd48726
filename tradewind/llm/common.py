"""What the operators share: tables, stored steps, running totals, components, id filters.

Rules that hold for all operators of this subpackage:

- a null text counts as empty; a null ``doc_id`` is an id of its own that sorts before all
  others and is returned as null;
- only the named columns are read, so other columns of the input never clash;
- an empty table gives an empty result with the same columns.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tradewind.session import run_dir

NO_ID = -(2**63)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_in(column: str = "doc_id") -> Column:
    return F.coalesce(F.col(column).cast("long"), F.lit(NO_ID))


def id_out(column: str) -> Column:
    return F.nullif(F.col(column), F.lit(NO_ID))


def texts(docs: DataFrame, *more: Column) -> DataFrame:
    """The two columns most operators read, with the null rules applied."""
    return docs.select(
        id_in().alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        *more,
    )


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write to the shared folder and read back.

    What follows reads files instead of the lineage, so an executor lost later costs only
    the tasks it ran, and a step whose rows depend on the partitioning is fixed once.
    """
    path = run_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def running_starts(df: DataFrame, order: list[str], size: str, purpose: str) -> DataFrame:
    """Add ``start``: the sum of ``size`` over all rows before this one in the given order.

    Range partitions are summed on their own; only one total a partition reaches the driver
    (Spark's range partitioner keeps as many bounds there) and goes back as a small join
    side. ``order`` must be a total order up to rows that may change places. Only
    ``order`` and ``size`` columns should be given, not the texts.
    """
    spark = df.sparkSession

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before = TaskContext.get().partitionId(), 0
        for batch in batches:
            sizes = batch.column(batch.schema.get_field_index(size)).to_numpy(zero_copy_only=False)
            ends = sizes.astype("int64").cumsum() + before
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([part] * len(sizes), pa.int32()), pa.array(ends - sizes)],
                [*batch.schema.names, "_part", "_at"],
            )
            before = int(ends[-1]) if len(ends) else before

    given = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    ranged = stored(
        df.orderBy(*order).mapInArrow(local, f"{given}, _part int, _at bigint"), purpose
    )
    totals = ranged.groupBy("_part").agg(F.sum(size).alias("n")).collect()
    offsets, before = [], 0
    for row in sorted(totals):
        offsets.append((row["_part"], before))
        before += row["n"]
    bases = spark.createDataFrame(offsets, "_part int, _base bigint")
    return (
        ranged.join(F.broadcast(bases), "_part")
        .withColumn("start", F.col("_at") + F.col("_base"))
        .drop("_part", "_at", "_base")
    )


def components(edges: DataFrame, purpose: str) -> DataFrame:
    """(node, component) for every node of the edges (a, b): the smallest node reachable.

    Alternating large-star and small-star steps: each step is a map-side combined minimum
    per node and a join back, so a node with very many edges is never gathered anywhere.
    Every round of two steps is cut by a stored table; the number of rounds grows with the
    logarithm of the longest path.
    """
    def stars(both: DataFrame) -> DataFrame:
        lowest = both.groupBy("a").agg(F.min("b").alias("m"))
        lowest = lowest.select("a", F.least("a", "m").alias("m"))
        return both.join(lowest, "a")

    def each_of(links: DataFrame, *ends: tuple[str, str]) -> DataFrame:
        """Several links (a, b) out of every row, in one pass."""
        made = F.array(*(F.struct(F.col(x).alias("a"), F.col(y).alias("b")) for x, y in ends))
        return links.select(F.inline(made))

    def kept(links: DataFrame) -> tuple[DataFrame, dict]:
        """Distinct links, stored, with what tells one state from another."""
        seen = Observation()
        hashed = F.xxhash64("a", "b").cast("decimal(38,0)")
        links = links.where("a <> b").distinct().observe(seen, F.count("*").alias("n"), F.sum(hashed).alias("h"))
        return stored(links, f"{purpose}-links"), seen.get

    pairs, state = kept(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")))
    before = None
    while state != before and state["n"]:
        before = state
        large = stars(each_of(pairs, ("a", "b"), ("b", "a"))).where("b > a AND b <> m")
        starred = stars(large.select(F.col("b").alias("a"), F.col("m").alias("b")))
        small = each_of(starred, ("b", "m"), ("a", "m"))
        pairs, state = kept(small)
    heads = pairs.select(F.col("b").alias("node"), F.col("b").alias("component"))
    return (
        pairs.select(F.col("a").alias("node"), F.col("b").alias("component"))
        .unionByName(heads)
        .groupBy("node")
        .agg(F.min("component").alias("component"))
    )


def maybe_in(df: DataFrame, key: Column, members: DataFrame, member: Column, bits: int = 22) -> DataFrame:
    """The rows whose key may be one of the members: all that are, and few others.

    A bit map of 2**bits places is built by a combined bitwise-or and broadcast as a table
    of at most 2**bits / 64 rows, whatever the number of members: that is its proven bound
    (1 MB of rows at 22 bits). It saves the shuffle of rows that cannot match. More members
    than places make it pass more rows, never fewer; callers confirm what passes.
    """
    kept = df.withColumn("_place", _place(key, bits))
    kept = kept.join(
        F.broadcast(_bit_map(members, member, bits)), F.shiftright(F.col("_place"), 6) == F.col("_word"), "inner"
    ).where(_bit_is_set())
    return kept.drop("_place", "_word", "_set")


def maybe_marked(df: DataFrame, key: Column, members: DataFrame, member: Column, bits: int = 22) -> DataFrame:
    """All rows, with ``_maybe``: false only where the key is surely none of the members."""
    marked = df.withColumn("_place", _place(key, bits))
    marked = marked.join(
        F.broadcast(_bit_map(members, member, bits)), F.shiftright(F.col("_place"), 6) == F.col("_word"), "left"
    )
    return marked.withColumn("_maybe", F.coalesce(_bit_is_set(), F.lit(False))).drop("_place", "_word", "_set")


def _place(key: Column, bits: int) -> Column:
    return F.shiftrightunsigned(F.xxhash64(F.lit("place"), key), 64 - bits)


def _bit_is_set() -> Column:
    return F.call_function("shiftright", F.col("_set"), (F.col("_place") % 64).cast("int")) % 2 != 0


def _bit_map(members: DataFrame, member: Column, bits: int) -> DataFrame:
    """(_word, _set): 64 places a row, at most 2**bits / 64 rows."""
    place = _place(member, bits)
    return (
        members.select(
            F.shiftright(place, 6).alias("_word"),
            F.expr("1L").alias("_one"),
            (place % 64).cast("int").alias("_bit"),
        )
        .groupBy("_word")
        .agg(F.bit_or(F.call_function("shiftleft", F.col("_one"), F.col("_bit"))).alias("_set"))
    )
