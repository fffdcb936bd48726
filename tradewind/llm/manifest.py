"""Merkle manifest of a table of documents: leaves, one tree a language, one tree above.

H is SHA-256 as lowercase hex of its inputs joined, digests taken as hex text. A row's leaf
is H of its five columns, each as its UTF-8 byte count, ``:`` and value, or ``-`` where null.

- **Places**: leaves are narrow rows (no text) sorted by range, so no language is gathered.
- **Build**: nodes are folded in blocks of 2**HEIGHT consecutive places of a tree; a block
  yields its nodes of HEIGHT levels, each linked to its parent, and one open node, with
  which the next tier goes on. A task holds one block, whatever the size of the tree.
- **Climb**: a recursive query per tier takes every leaf's (perhaps tampered) hash from
  node to parent: it appends the sibling met as a row and folds it into the hash. Siblings
  are put in order once, after the last tier, so the rows that climb stay narrow.

Odd cases: a null ``doc_id`` sorts first and is never tampered with; a null ``lang`` is a
language of its own, the first; rows that tie in ``lang`` and ``doc_id`` are ordered by their
leaf, and whole repeated rows are leaves of their own; an empty text is ``0:``; a text of any
length is hashed in one pass; a lone leaf is its own subroot with an empty proof (the hash of
nothing); an empty table has no rows and no root. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from functools import reduce
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import running_starts, stored

HEIGHT = 8
#: A node's number is its level times 2**48 plus its tree's first place and its place there.
LEVEL = 48
#: Levels of the upper tree are counted from here.
UPPER = 64
#: Where a node's parent lies: inside its tier, at the tier's top, at the tree's top.
INSIDE, TIER_TOP, TREE_TOP = 0, 1, 2

NODES = "tree long, n long, place long, node long, hash binary, parent long, before binary, after binary, ends int"


class Manifest(NamedTuple):
    """Stored tables and the root.

    ``leaves``: doc_id, lang, leaf, climbing (the hash that climbs), start (place in the
    whole table), place, tree, n. ``tiers``, ``upper``: parent-linked nodes (see ``NODES``) of
    the languages' trees and of the tree above, from the leaves up. ``subroots``: tree, lang,
    subroot. ``root``: hex, None for an empty table.
    """

    leaves: DataFrame
    tiers: list[DataFrame]
    upper: list[DataFrame]
    subroots: DataFrame
    root: str | None


def leaf_hash(n_chars: Column | None = None) -> Column:
    """H of the columns of a document's row; ``n_chars`` may be given in place of the row's."""
    columns = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    if n_chars is not None:
        columns[3] = n_chars
    fields = []
    for column in columns:
        value = column.cast("string")
        fields.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*fields), 256)


_KINDS = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
SCHEMA = pa.schema([(name, _KINDS[kind]) for name, kind in (c.split() for c in NODES.split(", "))])


def _fold(level: int):
    """One block of a tree: its nodes of up to HEIGHT levels, and its open node (parent null)."""

    def run(block: pa.Table) -> pa.Table:
        rows = sorted(block.select(["place", "node", "hash"]).to_pylist(), key=lambda r: r["place"])
        tree, n, at = block["tree"][0].as_py(), block["n"][0].as_py(), level
        out = []
        for step in range(HEIGHT):
            if n == 1:
                break
            n, at, above = (n + 1) // 2, at + 1, []
            for i in range(0, len(rows), 2):
                pair = rows[i : i + 2]
                digest = hashlib.sha256("".join(r["hash"].hex() for r in pair).encode()).digest()
                place = pair[0]["place"] // 2
                parent = {"place": place, "node": (at << LEVEL) + tree + place, "hash": digest}
                ends = TREE_TOP if n == 1 else TIER_TOP if step == HEIGHT - 1 else INSIDE
                for own, other in zip(pair, pair[::-1], strict=True):
                    before = other["hash"] if other["place"] < own["place"] else None
                    after = other["hash"] if other["place"] > own["place"] else None
                    out.append(own | {"parent": parent["node"], "before": before, "after": after, "ends": ends})
                above.append(parent)
            rows = above
        out += [r | {"parent": None, "before": None, "after": None, "ends": None} for r in rows]
        out = [r | {"tree": tree, "n": n} for r in out]
        return pa.Table.from_pylist(out, SCHEMA)

    return run


def _built(nodes: DataFrame, level: int) -> tuple[list[DataFrame], DataFrame]:
    """The tiers over nodes (tree, n, place, node, hash), and the top node of every tree."""
    tiers, tops = [], nodes.where("n = 1")
    most = nodes.agg(F.max("n")).first()[0] or 1
    while most > 1:
        blocks = nodes.where("n > 1").groupBy("tree", F.shiftright("place", HEIGHT).alias("block"))
        tier = stored(blocks.applyInArrow(_fold(level), NODES), "manifest-nodes")
        tiers.append(tier.where("parent IS NOT NULL"))
        nodes = tier.where("parent IS NULL").select("tree", "n", "place", "node", "hash")
        tops = tops.unionByName(nodes.where("n = 1"))
        most, level = -(-most // 2**HEIGHT), level + HEIGHT
    return tiers, tops


def build(docs: DataFrame, tampered: Column | None = None) -> Manifest:
    """The manifest; where ``tampered`` holds, a changed row (n_chars + 1) is set to climb."""
    changed = F.when(F.lit(False) if tampered is None else tampered, F.unhex(leaf_hash(F.col("n_chars") + 1)))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"),
        F.unhex(leaf_hash()).alias("leaf"), changed.alias("changed"), F.expr("1L").alias("one"),
    )
    rows = stored(rows.withColumn("climbing", F.coalesce("changed", "leaf")).drop("changed"), "manifest-rows")
    leaves = running_starts(rows, ["lang", "doc_id", "leaf"], "one", "manifest-sorted").drop("one")
    trees = leaves.groupBy("lang").agg(F.min("start").alias("tree"), F.count("*").alias("n"))
    trees = stored(trees.withColumn("one", F.expr("1L")), "manifest-trees")
    own = trees.select(F.col("lang").alias("_lang"), "tree", "n")
    leaves = leaves.join(own, F.col("lang").eqNullSafe(F.col("_lang"))).drop("_lang")
    leaves = stored(leaves.withColumn("place", F.col("start") - F.col("tree")), "manifest-leaves")

    tiers, tops = _built(leaves.select("tree", "n", "place", F.col("start").alias("node"), F.col("leaf").alias("hash")), 0)
    ranks = running_starts(trees.select("lang", "tree", "one"), ["lang"], "one", "manifest-langs")
    subroots = stored(tops.drop("n", "place").join(ranks.drop("one"), "tree"), "manifest-subroots")
    count = subroots.count()
    upper = subroots.select(
        F.expr("0L").alias("tree"), F.lit(count).cast("long").alias("n"), F.col("start").alias("place"), "node", "hash"
    )
    upper_tiers, top = _built(upper, UPPER)
    root = top.select(F.lower(F.hex("hash"))).first()
    subroots = subroots.select("tree", "lang", F.lower(F.hex("hash")).alias("subroot"))
    return Manifest(leaves, tiers, upper_tiers, subroots, root[0] if root else None)


CLIMB = """
WITH RECURSIVE climb(leaf, level, node, sibling, ends, folded) AS (
  SELECT leaf, level, node, CAST(NULL AS BINARY), 0, folded FROM {walkers}
  UNION ALL
  SELECT c.leaf, c.level + 1, n.parent, coalesce(n.before, n.after), n.ends,
         unhex(sha2(concat(coalesce(lower(hex(n.before)), ''), lower(hex(c.folded)),
                           coalesce(lower(hex(n.after)), '')), 256))
  FROM climb c JOIN {nodes} n ON n.node = c.node)
SELECT leaf, level, sibling, ends, CASE WHEN ends > 0 THEN node END AS node, CASE WHEN ends > 0 THEN folded END AS folded
FROM climb WHERE sibling IS NOT NULL OR ends > 0 LIMIT ALL
"""


def climb(manifest: Manifest) -> tuple[DataFrame, DataFrame]:
    """All leaves' ways up: siblings met (leaf, level, sibling) and ends (leaf, folded).

    ``leaf`` is the leaf's place in the whole table; levels ascend from leaf to root.
    """
    spark = manifest.leaves.sparkSession
    start = manifest.leaves.select(
        "n", F.col("start").alias("leaf"), F.lit(0).alias("level"), F.col("start").alias("node"),
        F.col("climbing").alias("folded"),
    )
    columns = ["leaf", "level", "node", "folded"]
    siblings = []

    def ascend(walkers: DataFrame, tiers: list[DataFrame], done: list[DataFrame]) -> list[DataFrame]:
        for tier in tiers:
            steps = stored(spark.sql(CLIMB, walkers=walkers, nodes=tier), "manifest-climb")
            siblings.append(steps.where("sibling IS NOT NULL").select("leaf", "level", "sibling"))
            done = [*done, steps.where(f"ends = {TREE_TOP}").select(*columns)]
            walkers = steps.where(f"ends = {TIER_TOP}").select(*columns)
        return done

    at_subroots = ascend(start.where("n > 1").select(*columns), manifest.tiers, [start.where("n = 1").select(*columns)])
    walkers = reduce(DataFrame.unionByName, at_subroots)
    ends = reduce(DataFrame.unionByName, ascend(walkers, manifest.upper, []) if manifest.upper else at_subroots)
    nothing = spark.createDataFrame([], "leaf long, level int, sibling binary")
    return reduce(DataFrame.unionByName, siblings, nothing), ends.select("leaf", "folded")


def verify(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) for every row.

    ``proof_sha256`` is H of the siblings of the untampered tree from leaf to root;
    ``folded_root`` is what the climbing hash comes to with them.
    """
    manifest = build(docs, tampered)
    met, ends = climb(manifest)
    in_order = F.array_sort(F.collect_list(F.struct("level", F.lower(F.hex("sibling")).alias("hex"))))
    proofs = met.groupBy("leaf").agg(F.array_join(in_order["hex"], "").alias("proof"))
    folded = F.lower(F.hex("folded"))
    return (
        manifest.leaves.withColumnRenamed("leaf", "digest")
        .join(ends, F.col("start") == ends["leaf"])
        .drop("leaf")
        .join(proofs, F.col("start") == proofs["leaf"], "left")
        .drop("leaf")
        .join(manifest.subroots.select("tree", "subroot"), "tree")
        .select(
            "doc_id", F.lower(F.hex("digest")).alias("leaf"), "subroot", F.lit(manifest.root).alias("root"),
            F.sha2(F.coalesce("proof", F.lit("")), 256).alias("proof_sha256"),
            folded.alias("folded_root"), (folded == F.lit(manifest.root)).alias("verified"),
        )
    )
