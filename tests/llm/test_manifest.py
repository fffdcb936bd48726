"""The Merkle manifest against a plain fold of the whole list, and its odd cases."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from tradewind.llm import manifest as M
from tradewind.llm.queries import QUERIES

CLASH = ["leaf", "node", "place", "tree", "n", "start", "one", "hash", "level"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASH)


def H(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(doc_id, text, lang, source, n_chars):
    fields = (doc_id, source, lang, n_chars, text)
    return H("".join("-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([H("".join(out[-1][i : i + 2])) for i in range(0, len(out[-1]), 2)])
    return out


def way(tree, place):
    """(sibling, is it before) from the bottom up; None where a node is alone."""
    for nodes in tree[:-1]:
        other = place ^ 1
        yield (nodes[other], other < place) if other < len(nodes) else None
        place //= 2


def plain(rows):
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    trees, order = {}, {}
    for lang in langs:
        order[lang] = sorted((r for r in rows if r[2] == lang), key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r)))
        trees[lang] = levels([leaf(*r) for r in order[lang]])
    top = levels([trees[x][-1][0] for x in langs])
    out = []
    for i, lang in enumerate(langs):
        for place, r in enumerate(order[lang]):
            path = [*way(trees[lang], place), *way(top, i)]
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 and r[4] is not None
            folded = leaf(*r[:4], r[4] + 1) if hit else leaf(*r)
            for step in path:
                folded = H(folded) if step is None else H(step[0] + folded if step[1] else folded + step[0])
            root = top[-1][0]
            proof = H("".join(s[0] for s in path if s))
            out.append((r[0], leaf(*r), trees[lang][-1][0], root, proof, folded, folded == root))
    return sorted(out, key=str)


def frame(spark, rows):
    return spark.createDataFrame([(*r, *CLASH) for r in rows], SCHEMA)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(13)
    sizes = {"en": 700, "dé": 65, None: 256, "fr": 1, "": 3, "zz": 257}
    out = [
        (rng.randrange(10**6), rng.choice(["", "é", "a text " * rng.randint(1, 9), None]), lang, rng.choice(["s", None]), rng.choice([1, 5, None]))
        for lang, n in sizes.items()
        for _ in range(n)
    ]
    out += [(None, "no id", "en", "s", 4), (None, "no id", "en", "s", 4), (None, "other", "en", "s", 4)]
    return out + [(5, "x" * 200000, "en", "s", 1), (5, "again", "en", "s", 1), (5, "again", "en", "s", 1)]


def test_query_equals_plain_fold(spark, rows, tmp_path):
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op13_merkle"](spark, str(tmp_path))
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    got = sorted((tuple(r) for r in got.collect()), key=str)
    assert got == plain(rows)
    assert 0 < sum(not r[-1] for r in got) < len(got) // 3


@pytest.mark.parametrize("n, langs", [(0, 1), (1, 1), (2, 1), (3, 1), (256, 1), (257, 1), (5, 5)])
def test_small_trees(spark, n, langs):
    rows = [(i, f"t{i}", f"l{i % langs}", "s", i) for i in range(n)]
    got = M.verify(frame(spark, rows), F.crc32(F.col("doc_id").cast("string")) % 7 == 0)
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain(rows) if n else got.collect() == []


def test_untampered_rows_verify_and_nodes_are_linked(spark, rows):
    docs = frame(spark, rows)
    assert M.verify(docs).where("NOT verified").isEmpty()
    made = M.build(docs)
    for tier in [*made.tiers, *made.upper]:
        one = tier.alias("a").join(tier.alias("b"), F.col("a.parent") == F.col("b.node"))
        assert one.where("a.tree <> b.tree").isEmpty()
        assert tier.groupBy("node").count().where("count > 1").isEmpty()
        assert tier.groupBy("parent").count().where("count > 2").isEmpty()
