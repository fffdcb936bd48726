"""Mixing sources to target weights by Pfair scheduling.

A source's documents are dealt into blocks. In the ideal mix all sources that have blocks
left flow at once, each at its exact weight among them, one block a slot together: when the
flow V has passed, source s has given min(w V, n) of its n blocks, and the slot is the sum of
these over all sources. Block j may not go before the slot in which it begins to flow and is
due by the slot in which it has flowed; of the blocks that may go, the one with the earliest
deadline goes. So no source is ever a whole block ahead of or behind its exact weight, for
however long; when it has no blocks left, the others share its weight in proportion.

The bounds are exact (whole numbers, no rounding). One task deals the blocks, of which there
is one to ``block_docs`` documents, from a heap with one entry a source, and writes them to
a stored table as it goes; documents never pass it. Every document then finds its
slot by a join on its block; places come from a range sort by (source, hash), so a source
that holds most rows is spread over many tasks.
"""

from __future__ import annotations

import heapq
import math
from bisect import bisect_right
from collections.abc import Iterator
from fractions import Fraction
from itertools import accumulate, islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import id_in, id_out, running_starts, stored

NO_SOURCE = "-"
BATCH = 50_000


def schedule(blocks: dict[str, int], weights: dict[str, float]) -> Iterator[tuple[str, int, int, int, int]]:
    """(source, block, slot, release, deadline) of all blocks in the order of their slots.

    Sources of weight zero come when all others are used up, in equal parts.
    """
    exact = {s: Fraction(weights[s]) for s, n in blocks.items() if n and weights[s]}
    if not exact:
        rest = {s: n for s, n in blocks.items() if n}
        if rest:
            yield from schedule(rest, dict.fromkeys(rest, 1))
        return
    scale = math.lcm(*(w.denominator for w in exact.values()))
    names = sorted(exact, key=lambda s: (Fraction(blocks[s]) / exact[s], s))  # in the order they end
    weight, many = [int(exact[s] * scale) for s in names], [blocks[s] for s in names]
    ends = [n / w for n, w in zip(many, weight, strict=True)]
    ended = [0, *accumulate(many)]
    flowing = [*reversed([0, *accumulate(reversed(weight))])]

    def slot_of(j: int, w: int) -> tuple[int, int]:
        """Floor and ceiling of the ideal slot at which the flow is j / w."""
        i = bisect_right(ends, j / w)  # rounded; what is rounded away is made good exactly
        while i < len(ends) and many[i] * w <= j * weight[i]:
            i += 1
        while i and many[i - 1] * w > j * weight[i - 1]:
            i -= 1
        whole, rest = divmod(j * flowing[i], w)
        return ended[i] + whole, ended[i] + whole + bool(rest)

    dealt, release = [0] * len(names), [0] * len(names)
    waiting, ready = [(0, i) for i in range(len(names))], []
    for slot in range(ended[-1]):
        while waiting and waiting[0][0] <= slot:
            _, i = heapq.heappop(waiting)
            heapq.heappush(ready, (slot_of(dealt[i] + 1, weight[i])[1], i))
        due, i = heapq.heappop(ready)
        yield names[i], dealt[i], slot, release[i], due
        dealt[i] += 1
        if dealt[i] < many[i]:
            release[i] = slot_of(dealt[i], weight[i])[0]
            heapq.heappush(waiting, (release[i], i))
    last = {s: n for s, n in blocks.items() if s not in exact}
    for s, block, slot, first, due in schedule(last, dict.fromkeys(last, 1)):
        yield s, block, ended[-1] + slot, ended[-1] + first, ended[-1] + due


PLAN = pa.schema([("_source", pa.string()), *((c, pa.int64()) for c in ("block", "slot", "release", "deadline"))])
PLAN_DDL = "_source string, block long, slot long, release long, deadline long"


def mix_sources(
    docs: DataFrame,
    weights: dict[str | None, float] | None = None,
    power: float = 0.5,
    block_docs: int = 32,
    row: Column | None = None,
) -> DataFrame:
    """(doc_id, source, block, place, slot, release, deadline) for every row of docs.

    ``block`` counts the source's blocks, ``place`` the documents inside the block; the mix
    is the order by (slot, place). ``release`` and ``deadline`` bound the slot. Without
    weights a source has its number of documents to the given power; a source that the
    weights leave out has their mean. A null source is a source of its own. Documents of a
    source come in hashed order, repeated rows side by side; none is left out or repeated.
    A source of weight zero comes after all others; a weight below zero, or one that is no
    finite number, is an error. ``row``, a column that tells rows of one doc_id apart, is
    returned as ``row``. Texts are not read; an empty table has no rows.
    """
    bad = {k: v for k, v in (weights or {}).items() if not 0 <= v < math.inf}
    if bad:
        raise ValueError(f"weights must be finite and not below zero: {bad}")
    keyed = docs.select(
        id_in().alias("doc_id"),
        F.when(F.col("source").isNull(), NO_SOURCE)
        .otherwise(F.concat(F.lit("+"), F.col("source").cast("string")))
        .alias("_source"),
        F.lit(1).cast("long").alias("one"),
        *([] if row is None else [row.alias("row")]),
    )
    own = ["doc_id"] if row is None else ["doc_id", "row"]
    keyed = keyed.withColumn("h", F.xxhash64(*own))
    placed = running_starts(keyed, ["_source", "h", *own], "one", "mix-order")
    sources = stored(
        placed.groupBy("_source").agg(F.count("*").alias("n"), F.min("start").alias("base")), "mix-sources"
    )
    named = {NO_SOURCE if k is None else f"+{k}": v for k, v in (weights or {}).items()}
    mean = sum(named.values()) / len(named) if named else None

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = {s: n for b in batches for s, n in zip(*(c.to_pylist() for c in b.columns), strict=True)}
        target = {s: named.get(s, n**power if mean is None else mean) for s, n in sizes.items()}
        plan = schedule({s: -(-n // block_docs) for s, n in sizes.items()}, target)
        while rows := list(islice(plan, BATCH)):
            columns = zip(PLAN, zip(*rows, strict=True), strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for f, c in columns], schema=PLAN)

    plan = stored(sources.select("_source", "n").coalesce(1).mapInArrow(dealt, PLAN_DDL), "mix-plan")
    return (
        placed.join(sources.select("_source", "base"), "_source")
        .withColumn("rank", F.col("start") - F.col("base"))
        .withColumns({"block": F.expr(f"rank div {block_docs}"), "place": F.col("rank") % block_docs})
        .join(plan, ["_source", "block"])
        .select(
            id_out("doc_id").alias("doc_id"),
            F.expr(f"CASE WHEN _source <> '{NO_SOURCE}' THEN substring(_source, 2) END").alias("source"),
            "block",
            "place",
            "slot",
            "release",
            "deadline",
            *own[1:],
        )
    )
