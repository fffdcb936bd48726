"""Shards for documents by a hierarchical weighted hash tree: region, rack, shard.

Every shard draws for a ``doc_id`` from a hash of the id and the shard's path: an
exponential variate whose rate is the shard's weight. A rack's draw is the least of its
shards', a region's the least of its racks', which is again a weighted draw, with the sum of
the weights as its rate. A document descends from the root to the region, the rack and the
shard of least draw, so each gets documents in proportion to its weight.

A subtree's draw depends on nothing outside it. If a weight grows, documents only move into
that shard, if it falls they only leave it; a shard added or removed is the case of a weight
from or to zero. Draws of untouched subtrees stay, so no document moves between two of them.

Odd cases: a null ``doc_id`` is an id of its own; rows of one id share a shard, whatever
their texts, and are numbered there by text hash and size; a null or empty text has size 1;
texts of any length are read once, for their size and hash; an empty table has no rows.
Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import id_in, id_out, running_starts, stored

#: regions of racks of (shard number, weight)
Topology = list[list[list[tuple[int, float]]]]
HASH_BITS = 48


def topology(shards: int, rack: int = 4, region: int = 2, weights: dict[int, float] | None = None) -> Topology:
    """Shards 0.. filling racks of so many shards and regions of so many racks."""
    given = weights or {}
    racks = [[(s, given.get(s, 1.0)) for s in range(a, min(a + rack, shards))] for a in range(0, shards, rack)]
    return [racks[a : a + region] for a in range(0, len(racks), region)]


def _draw(key: Column, path: str, weight: float) -> Column:
    """-ln(u) / weight for a uniform u of the hash of key and path; none for weight 0."""
    if weight < 0:
        raise ValueError(f"weight of {path} is below zero")
    if weight == 0:
        return F.lit(float("inf"))
    digits = F.substring(F.md5(F.concat(key, F.lit(f":{path}"))), 1, HASH_BITS // 4)
    uniform = (F.conv(digits, 16, 10).cast("double") + 0.5) / float(2**HASH_BITS)
    return -F.log(uniform) / weight


def _least(candidates: list[tuple[int, Column]]) -> Column:
    """(draw, number) of the least draw; the smaller number if draws tie."""
    return F.array_min(F.array(*(F.struct(draw.alias("draw"), F.lit(n).alias("number")) for n, draw in candidates)))


def descend(tree: Topology, draws: dict[int, Column]) -> Column:
    """The shard that a document reaches, given every shard's draw for it."""
    rack_draw = [[F.least(*(draws[s] for s, _ in rack), F.lit(float("inf"))) for rack in racks] for racks in tree]
    region_draw = [F.least(*racks, F.lit(float("inf"))) for racks in rack_draw]
    region = _least(list(enumerate(region_draw)))["number"]
    shard = F.lit(None).cast("int")
    for i, racks in enumerate(tree):
        rack = _least(list(enumerate(rack_draw[i])))["number"]
        inside = F.lit(None).cast("int")
        for j, shards in enumerate(racks):
            inside = F.when(rack == j, _least([(s, draws[s]) for s, _ in shards])["number"]).otherwise(inside)
        shard = F.when(region == i, inside).otherwise(shard)
    return shard


def assign_shards(docs: DataFrame, tree: Topology, grown: Topology | None = None) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) for every row of docs.

    ``size`` is the text's UTF-8 bytes plus 1, ``slot`` the row's number in its shard without
    gaps, ``grown_shard`` the shard in the tree ``grown`` (null if none is given). Only a
    row's id and the trees decide its shards; ties for a slot are between equal rows.
    """
    trees = [tree] + ([grown] if grown else [])
    if any(not [s for racks in t for rack in racks for s, w in rack if w > 0] for t in trees):
        raise ValueError("a tree without any weight has no place for documents")
    paths = [
        {s: (f"{i}/{j}/{s}", w) for i, racks in enumerate(t) for j, rack in enumerate(racks) for s, w in rack}
        for t in trees
    ]
    wanted = sorted({(s, *own[s]) for own in paths for s in own})
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        id_in().alias("doc_id"),
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    name = F.coalesce(id_out("doc_id").cast("string"), F.lit("-"))
    drawn = rows.select("*", *(_draw(name, path, w).alias(f"draw{k}") for k, (_, path, w) in enumerate(wanted)))
    column = {entry: F.col(f"draw{k}") for k, entry in enumerate(wanted)}
    places = [descend(t, {s: column[(s, *own[s])] for s in own}) for t, own in zip(trees, paths, strict=True)]
    placed = drawn.select(
        *rows.columns, places[0].alias("shard"), (places[1] if grown else F.lit(None).cast("int")).alias("grown_shard"),
        F.expr("1L").alias("one"),
    )
    numbered = running_starts(
        stored(placed, "shard-rows"), ["shard", "doc_id", "text_crc32", "size"], "one", "shard-sorted"
    )
    firsts = numbered.groupBy("shard").agg(F.min("start").alias("first"))
    # One row a shard of the tree: its number is the bound.
    return numbered.join(F.broadcast(firsts), "shard").select(
        id_out("doc_id").alias("doc_id"), "size", "text_crc32", F.lit("key").alias("law"), "shard",
        (F.col("start") - F.col("first")).alias("slot"), "grown_shard",
    )
