"""The weighted hash tree: its law, its shares, its slots."""

from __future__ import annotations

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import pytest

from tradewind.llm.queries import QUERIES
from tradewind.llm.sharding import assign_shards, topology

CLASH = ["shard", "slot", "size", "one", "draw0", "start", "first"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASH)


def frame(spark, rows):
    return spark.createDataFrame([(d, t, None, None, None, *CLASH) for d, t in rows], SCHEMA)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(2)
    out = [(i * 7, rng.choice(["", None, "é", "some text", "x" * rng.randint(1, 3000)])) for i in range(3000)]
    return out + [(None, "a"), (None, None), (14, "again"), (14, "again"), (99999, "y" * 300000)]


def plain_shard(doc_id, tree):
    """Descend level by level, each node's draw being the least below it."""

    def draw(path, shard, weight):
        name = "-" if doc_id is None else str(doc_id)
        h = int(hashlib.md5(f"{name}:{path}/{shard}".encode()).hexdigest()[:12], 16)
        return -math.log((h + 0.5) / 2**48) / weight if weight else math.inf

    drawn = [[[(draw(f"{i}/{j}", s, w), s) for s, w in rack] for j, rack in enumerate(racks)] for i, racks in enumerate(tree)]
    racks = min(drawn, key=lambda racks: min(min(r) for r in racks))
    return min(min(racks, key=min))[1]


def test_query_law_and_slots(spark, rows, tmp_path):
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op12_shards"](spark, str(tmp_path))
    assert got.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    got = got.collect()
    want = Counter((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in rows)
    assert Counter(tuple(r)[:3] for r in got) == want
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
        assert r["law"] == "key" and r["shard"] == plain_shard(r["doc_id"], topology(16))
        assert r["grown_shard"] == plain_shard(r["doc_id"], topology(17))
        assert r["grown_shard"] in (r["shard"], 16)
    assert sorted(slots) == list(range(16))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(abs(len(s) - 3000 / 16) < 60 for s in slots.values())
    assert 100 < sum(r["grown_shard"] == 16 for r in got) < 260


def by_id(df):
    return {r["doc_id"]: (r["shard"], r["grown_shard"]) for r in df.collect()}


@pytest.mark.parametrize("shards", [1, 4, 7, 8, 18])
def test_one_more_shard_takes_rows_only_into_itself(spark, rows, shards):
    for was, now in by_id(assign_shards(frame(spark, rows), topology(shards), topology(shards + 1))).values():
        assert now in (was, shards)


def test_weights_confine_movement(spark, rows):
    tree = topology(12, weights={3: 2.0})
    heavier, lighter, without = (topology(12, weights={3: 2.0, 5: w}) for w in (3.0, 0.25, 0.0))
    docs = frame(spark, rows)
    assert all(now == was or now == 5 for was, now in by_id(assign_shards(docs, tree, heavier)).values())
    assert all(now == was or was == 5 for was, now in by_id(assign_shards(docs, tree, lighter)).values())
    moved = by_id(assign_shards(docs, tree, without)).values()
    assert all(now == was or was == 5 for was, now in moved) and 5 not in {now for _, now in moved}
    share = Counter(was for was, _ in moved)
    assert 1.6 < share[3] / (sum(share.values()) / 13) < 2.4
    with pytest.raises(ValueError):
        assign_shards(docs, topology(2, weights={0: 0, 1: 0}))
    with pytest.raises(ValueError):
        assign_shards(docs, topology(2, weights={0: -1}))


def test_empty_table(spark):
    assert assign_shards(frame(spark, []), topology(16), topology(17)).collect() == []
    assert assign_shards(frame(spark, [(1, "a")]), topology(3)).first()["grown_shard"] is None
