"""Fingerprints chosen again in plain Python; the discriminant from plain means and covariances."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import xxhash
from test_operators import frame, sentence

from tradewind.llm import quality as Q
from tradewind.llm.queries import QUERIES

MASK = 2**64 - 1


def signed(x):
    return x - 2**64 if x >> 63 else x


def hashed(*values):
    """The chained hash of words (text) and numbers: each value's seed is the hash so far."""
    seed = 42
    for v in values:
        data = v.encode() if isinstance(v, str) else (v & MASK).to_bytes(8, "little")
        seed = xxhash.xxh64(data, seed=seed & MASK).intdigest()
    return signed(seed)


def syncmers(text, k=5, s=2):
    """(hash, place) of the closed syncmers of a text's words."""
    words = [hashed(w) for w in text.lower().split()]
    out = []
    for at in range(len(words) - k + 1):
        inner = [hashed(*words[at + i : at + i + s]) for i in range(k - s + 1)]
        if min(inner) in (inner[0], inner[-1]):
            out.append(((hashed(*inner) & MASK) >> 32, at))
    if words and not out:
        out = [((hashed(*words) & MASK) >> 32, 0)]
    return out


def likeness(a, b):
    a, b = {h for h, _ in a}, {h for h, _ in b}
    return 1.0 if not a | b else len(a & b) / len(a | b)


def test_fingerprints_equal_plain_syncmers(spark, tmp_path):
    rng = random.Random(15)
    base = sentence(rng, 90)
    rows = [(i * 2, sentence(rng, rng.randint(0, 70)) if i % 4 else base + " " + sentence(rng, 5)) for i in range(40)]
    rows += [(101, None), (103, ""), (105, "one"), (107, "A b\tC\nd E f g"), (109, "the same words " * 30)]
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r for r in QUERIES["op5_syncmers"](spark, str(tmp_path)).collect()}
    text, order = {d: t or "" for d, t in rows}, sorted((d for d, _ in rows), reverse=True)
    as_text = lambda marks: " ".join(f"{h:08x}:{at}" for h, at in marks)
    assert len(got) == len(rows)
    for i, d in enumerate(order):
        own, other = text[d], text[order[(i + 1) % len(order)]]
        edited = own[: len(own) - len(own) // 3] + other[: len(own) // 3]
        r, a, b = got[d], syncmers(own), syncmers(edited)
        assert (r["n_chars"], r["edited_sha256"]) == (len(own), hashlib.sha256(edited.encode()).hexdigest())
        assert (r["fingerprint"], r["edited_fingerprint"]) == (as_text(a), as_text(b))
        assert abs(r["near_edited"] - likeness(a, b)) < 1e-12
        assert abs(r["near_next"] - likeness(a, syncmers(other))) < 1e-12


def test_scores_equal_a_plain_discriminant(spark, tmp_path):
    rng = random.Random(16)
    rows, labels = [], []
    for i in range(300):
        text = sentence(rng, rng.randint(3, 60))
        rows.append((i, text if i % 3 else text.replace("a", "%").replace(" ", " ## ")))
        if i % 2:
            labels.append((i, int(i % 3 > 0) if rng.random() < 0.9 else 0, 0))
    rows += [(900, None), (901, "")]
    docs, marks = frame(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    marks.write.parquet(f"{tmp_path}/labels.parquet")
    x = {r["doc_id"]: np.array(r["stats"]) for r in Q.document_statistics(docs).collect()}
    held = {d: zlib.crc32(str(d).encode()) % 3 == 1 for d, _ in rows}
    own = [np.stack([x[d] for d, q, _ in labels if q == k and not held[d]]) for k in (0, 1)]
    dims = own[0].shape[1]
    pooled = sum((len(o) - 1) * np.cov(o.T) for o in own) / (sum(map(len, own)) - 2)

    def log_density(k, v):
        cov = 0.9 * np.cov(own[k].T) + 0.1 * pooled
        cov = 0.99 * cov + 0.01 * np.eye(dims) * max(np.trace(cov) / dims, 1e-3)
        gap = v - own[k].mean(0)
        prior = np.log((len(own[k]) + 1) / (sum(map(len, own)) + 2))
        return prior - 0.5 * np.linalg.slogdet(cov)[1] - 0.5 * gap @ np.linalg.inv(cov) @ gap

    for r in QUERIES["op6_quality"](spark, str(tmp_path)).collect():
        gap = np.clip(log_density(1, x[r["doc_id"]]) - log_density(0, x[r["doc_id"]]), -600, 600)
        assert abs(r["score"] - 1 / (1 + np.exp(-gap))) < 1e-6
        assert (r["held_out"], r["predicted"]) == (held[r["doc_id"]], int(r["score"] >= 0.5))
