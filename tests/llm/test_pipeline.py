"""The pipeline's stages on small tables against brute force."""

from __future__ import annotations

import random
from collections import Counter

import corpus_pipeline as P
from test_operators import frame, sentence


def rows_of(df):
    return Counter((r["doc_id"], r["text"]) for r in df.collect())


def test_dedup_stages_judge_rows_not_ids(spark):
    rng = random.Random(31)
    a, b, c, d, e = (sentence(rng, 60) for _ in range(5))
    rows = [(5, a), (5, b), (10, a.replace("a", "A")), (None, c), (None, a), (None, d), (None, d), (7, "É"), (7, "é"), (3, None)]
    got = rows_of(P.exact(spark, frame(spark, rows), ""))
    assert got == Counter([(5, b), (10, a.replace("a", "A")), (None, c), (None, d), (7, "É"), (7, "é"), (3, None)])
    near = lambda t: t + " " + sentence(rng, 1)
    rows = [(5, a), (5, b), (10, near(a)), (None, c), (None, d), (None, near(d)), (12, near(c)), (None, e), (3, ""), (4, None)]
    got = rows_of(P.near(spark, frame(spark, rows), ""))
    assert got - Counter([(None, d), rows[5]]) == Counter([(5, a), (5, b), (None, c), (None, e), (3, ""), (4, None)])
    assert sum(got.values()) == 7


def test_packing_keeps_the_mix(spark):
    rng = random.Random(32)
    # Sources differ in their words, so the curve alone would lay them apart.
    words = {s: [sentence(rng, 1) for _ in range(12)] for s in "xyz"}
    size = {"x": 4800, "y": 1200, "z": 1200}
    rows = [(s, " ".join(rng.choices(words[s], k=12))) for s in size for _ in range(size[s])]
    rng.shuffle(rows)
    rows = [(i if i % 3 else None, f"{t} {i}", s) for i, (s, t) in enumerate(rows)]
    source = {d: s for d, _, s in rows if d is not None}
    docs = frame(spark, rows)
    mixed = P.mixing(spark, docs, "")
    assert rows_of(mixed) == rows_of(docs)
    packed = P.packing(spark, mixed, "").select("doc_id", "start", "sequence_id", "offset").collect()
    begun = sorted((r["sequence_id"], r["offset"], source.get(r["doc_id"])) for r in packed if r["start"] == 0)
    assert len(begun) == len(rows)
    weight, seen, known = {s: n**0.5 for s, n in size.items()}, Counter(), 0
    total, bound = sum(weight.values()), 3 * 32 * P.WINDOW // 4
    for _, _, s in begun[: 2 * sum(size.values()) // 5]:  # until the first source is used up
        if s:
            seen[s] += 1
            known += 1
        assert all(abs(seen[x] - known * w / total) < bound / 3 for x, w in weight.items())
