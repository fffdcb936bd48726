"""Every operator on small tables against brute force, and on the odd cases."""

from __future__ import annotations

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import public_tokenizers
import pytest
from test_numpy_parts import numpy_values, plain_words
from tokenizers import Tokenizer

from tradewind.llm import context_tree as C
from tradewind.llm.common import components, running_starts
from tradewind.llm.exact_dedup import exact_duplicates
from tradewind.llm.fingerprints import K, S, fingerprints, with_anchors
from tradewind.llm.mixing import mix_sources
from tradewind.llm.near_dedup import near_duplicates
from tradewind.llm.packing import pack
from tradewind.llm.quality import keep_quality, score_quality
from tradewind.llm.secrets import find_secrets, find_spans
from tradewind.llm.token_files import read_token_files, write_token_files
from tradewind.llm.url_filter import judge_urls

BYTE = public_tokenizers.path("byte_bpe_50k.json")
WORD = public_tokenizers.path("word_bpe_49k.json")
# Names that the operators use inside, as other columns of the input.
CLASH = ["n", "kept", "score", "uid", "key", "band", "node", "start", "component", "fp", "sha", "h", "chunk", "_source", "sketch", "block"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASH)


def frame(spark, rows):
    """(doc_id, text[, source]) rows as documents with clashing extra columns."""
    full = [(r[0], r[1], None, r[2] if len(r) > 2 else "s", None, *CLASH) for r in rows]
    return spark.createDataFrame(full, SCHEMA)


def sentence(rng, n):
    return " ".join("".join(rng.choice("abcdeé") for _ in range(rng.randint(2, 5))) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    base = [sentence(rng, rng.randint(6, 60)) for _ in range(25)]
    out = [(i * 3, t) for i, t in enumerate(base)]
    for i in range(40):  # copies with a few words changed
        words = base[i % 5].split()
        for _ in range(rng.randint(0, 3)):
            words[rng.randrange(len(words))] = sentence(rng, 1)
        out.append((200 + i, " ".join(words)))
    out += [(300 + i, base[7].upper() if i % 2 else base[7]) for i in range(20)]
    out += [(400, None), (401, ""), (402, " \n\t"), (403, "one two"), (404, "one  TWO"), (405, "É"), (406, "é")]
    out += [(407, sentence(rng, 30000)), (None, "no id"), (408, "x" * 50000)]
    out += [(500, "the same row"), (500, "the same row")]
    return out


def collected(df, key="doc_id"):
    return sorted((r.asDict() for r in df.collect()), key=lambda r: (r[key] is not None, r[key]))


def ascii_lower(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")


def test_exact_duplicates(spark, rows):
    groups = defaultdict(list)
    for doc, text in rows:
        groups[ascii_lower(text)].append(doc)
    want = []
    for doc, text in rows:
        own = groups[ascii_lower(text)]
        keep = max((d for d in own if d is not None), default=None)
        want.append((doc, keep, len(own), doc == keep, hashlib.sha256(ascii_lower(text).encode()).hexdigest()))
    got = [tuple(r) for r in exact_duplicates(frame(spark, rows)).collect()]
    assert Counter(got) == Counter(want)


def near_by_force(rows):
    sets = {}
    for doc, text in rows:
        w = plain_words(text or "")
        sets.setdefault(doc, set()).update({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    root = {d: d for d in sets}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    low = lambda d: -1 if d is None else d
    ids = sorted(sets, key=low)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)), key=low)
                root[y] = x
    return {d: (len(sets[d]), find(d)) for d in sets}


def test_near_duplicates(spark, rows):
    want = near_by_force(rows)
    got = collected(near_duplicates(frame(spark, rows)))
    assert len(got) == len(rows)
    for r in got:
        n, component = want[r["doc_id"]]
        assert (r["n_shingles"], r["component_id"], r["kept"]) == (n, component, r["doc_id"] == component)
    assert len({r["component_id"] for r in got}) < len(rows) - 30


def test_near_duplicates_of_a_chain(spark):
    # Each text shares 80 % with the next only, so no single pivot links the chain.
    rng = random.Random(2)
    words = sentence(rng, 900).split()
    rows = [(i, " ".join(words[i * 12 : i * 12 + 130])) for i in range(60)]
    got = collected(near_duplicates(frame(spark, rows)))
    assert {r["component_id"] for r in got} == {0}


def test_closing_blocks_find_what_pivots_leave(spark, rows, monkeypatch):
    from tradewind.llm import near_dedup

    for name, value in (("PIVOT_ROUNDS", 0), ("BLOCK_OUTER", 2), ("BLOCK_MEMBERS", 3)):
        monkeypatch.setattr(near_dedup, name, value)
    rng = random.Random(21)
    base = sentence(rng, 80).split()
    copies = []
    for i in range(40):
        words = list(base)
        for at in rng.sample(range(80), i % 4):
            words[at] = sentence(rng, 1)
        copies.append((i, " ".join(words)))
    want = near_by_force(copies)
    got = {r["doc_id"]: r["component_id"] for r in near_duplicates(frame(spark, copies)).collect()}
    assert got == {d: c for d, (_, c) in want.items()}


def test_components(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(100, 160)] + [(rng.randrange(50), rng.randrange(50)) for _ in range(25)]
    edges += [(500, 700 + i) for i in range(40)] + [(9, 9)]
    root = {x: x for e in edges for x in e}
    for _ in root:
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long"), "t").collect()}
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: root[x] for x in linked}


def test_running_starts(spark):
    df = spark.createDataFrame([(i % 7, i, i % 5) for i in range(1000)], "a int, b int, n long")
    at, want = 0, {}
    for i in sorted(range(1000), key=lambda i: (i % 7, i)):
        want[i], at = at, at + i % 5
    assert {r["b"]: r["start"] for r in running_starts(df, ["a", "b"], "n", "t").collect()} == want


def test_pack(spark, rows):
    length = 64
    got = pack(frame(spark, rows), BYTE, 1, length).collect()
    tokenizer = Tokenizer.from_file(BYTE)
    tokenizer.encode_special_tokens = True
    ids = defaultdict(list)
    for doc, text in rows:
        ids[doc].append(tokenizer.encode(text or "", add_special_tokens=False).ids + [1])
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        own = np.frombuffer(bytes(r["ids"]), "<u4").tolist()
        assert len(own) == r["length"] > 0
        pieces[r["doc_id"]].append((r["start"], own, r["doc_tokens"]))
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for doc, texts in ids.items():
        assert sum(len(p[1]) for p in pieces[doc]) == sum(map(len, texts))
        if len(texts) == 1:
            assert [i for _, own, _ in sorted(pieces[doc]) for i in own] == texts[0]
            assert {p[2] for p in pieces[doc]} == {len(texts[0])}
    sizes = []
    for s in sorted(sequences):
        at = 0
        for offset, size in sorted(sequences[s]):
            assert offset == at
            at += size
        sizes.append(at)
    assert sizes[:-1] == [length] * (len(sizes) - 1) and 0 < sizes[-1] <= length


def test_token_files(spark, rows, tmp_path):
    write_token_files(frame(spark, rows), f"file://{tmp_path}/t", WORD)
    got = collected(read_token_files(spark, f"file://{tmp_path}/t"))
    tokenizer = Tokenizer.from_file(WORD)
    tokenizer.encode_special_tokens = True
    at = 0
    for r, (doc, text) in zip(got, sorted(rows, key=lambda r: -1 if r[0] is None else r[0]), strict=True):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        assert (r["doc_id"], r["start"], r["n_tokens"]) == (doc, at, len(ids))
        assert zlib.crc32(bytes(r["ids"])) == zlib.crc32(np.array(ids, "<u4").tobytes())
        at += len(ids)


def plain_runs(text):
    seen = bytes([C.START_BYTE] * C.DEPTH) + ascii_lower(text).encode() + bytes([C.END_BYTE])
    return [seen[j - C.DEPTH : j][::-1] + seen[j : j + 1] for j in range(C.DEPTH, len(seen))]


def test_scores_of_texts(spark, rows):
    got = score_by_id = defaultdict(list)
    for r in C.score_texts(frame(spark, rows)).collect():
        score_by_id[r["doc_id"]].append(r)
    held = {d: d is not None and zlib.crc32(str(d).encode()) % 7 == 2 for d, _ in rows}
    train = [t or "" for d, t in rows if not held[d]]
    counts = Counter(w for t in train for w in plain_words(t))
    counts["\0end"] = len(train)
    total, distinct = sum(counts.values()), len(counts)
    counted = Counter()
    for doc, text in rows:
        for run in plain_runs(text):
            counted[run] += not held[doc]
    logs = numpy_values(counted)
    for doc, text in rows:
        words = [*plain_words(text or ""), "\0end"]
        base = sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in words)
        r = got[doc][0]
        assert (r["held_out"], r["n_tokens"], r["train_tokens"]) == (held[doc], len(words), total)
        assert r["n_known"] == sum(counts[w] > 0 for w in words)
        assert r["base_score"] == pytest.approx(base, rel=1e-12)
        assert r["score"] == pytest.approx(sum(logs[run] for run in plain_runs(text)), rel=1e-5)
    assert len(got) == len({d for d, _ in rows})


def test_tree_learns_more_than_single_words(spark):
    """Words that follow from the last one: a choice of two, one bit a word, is the source's
    entropy. Single words cannot see it and cost near log2(16) bits each."""
    rng = random.Random(6)
    parts = rng.sample([a + b for a in "abcdefgh" for b in "ijklmnop"], 16)
    follow = {p: rng.sample(parts, 2) for p in parts}

    def make():
        out = [rng.choice(parts)]
        while len(out) < 60:
            out.append(rng.choice(follow[out[-1]]))
        return " ".join(out)

    out = C.score_texts(frame(spark, [(i, make()) for i in range(400)])).where("held_out").collect()
    entropy = -len(out) * (math.log10(16) + 59 * math.log10(2))
    score, base = (sum(r[c] for r in out) for c in ("score", "base_score"))
    assert base < 3 * entropy
    assert 1.6 * entropy < score < 0.95 * entropy


def test_fingerprints(spark, rows):
    got = collected(fingerprints(frame(spark, rows)))
    order = sorted({d for d, _ in rows}, key=lambda d: -1 if d is None else d, reverse=True)
    text = {d: t or "" for d, t in rows}
    for r in got:
        own, other = text[r["doc_id"]], text[order[(order.index(r["doc_id"]) + 1) % len(order)]]
        cut = len(own) // 3
        assert r["n_chars"] == len(own)
        assert r["edited_text"] == own[: len(own) - cut] + other[:cut]
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
    by_text = {}
    for r in got:
        assert by_text.setdefault(text[r["doc_id"]], r["sketch"]) == r["sketch"]
    long = [r for r in got if r["n_chars"] > 150]
    assert np.mean([r["near_edited"] for r in long]) > 0.3
    assert {r["doc_id"]: r["sketch"] for r in got}[401] == []


def test_anchors_do_not_depend_on_what_surrounds_them(spark):
    rng = random.Random(9)
    shared = sentence(rng, 60)
    a, b = f"{sentence(rng, 20)} {shared}", f"{sentence(rng, 33)} {shared} {sentence(rng, 9)}"
    rows = with_anchors(frame(spark, [(1, a), (2, b)]), "text", "anchors").orderBy("doc_id").collect()
    one, two = ({(x["hash"], x["at"]) for x in r["anchors"]} for r in rows)
    inside = {(h, at) for h, at in one if at >= 20}
    assert inside == {(h, at - 13) for h, at in two if 33 <= at <= 33 + 60 - K}
    assert 0.3 < len(inside) / (60 - K + 1) < 0.75  # 2 / (K - S + 1) expected
    assert K - S + 1 == 4


def test_quality(spark):
    rng = random.Random(1)
    rows, labels = [], []
    for i in range(600):
        good = i % 3 > 0
        text = sentence(rng, rng.randint(5, 80))
        rows.append((i, text if good else " | ".join(w + rng.choice(["%%%", "###", ""]) for w in text.split())))
        if i % 2:
            labels.append((i, int(good), 0))
    rows += [(900, None), (901, ""), (902, "a"), (None, "text")]
    labels += [(10_000, 1, 0), (3, None, 0), (None, 1, 0)]
    docs, marks = frame(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r for r in score_quality(docs, marks).collect()}
    assert len(got) == len(rows)
    for d, r in got.items():
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
        assert r["held_out"] == (d is not None and zlib.crc32(str(d).encode()) % 3 == 1)
    out = [r["predicted"] == int(d % 3 > 0) for d, r in got.items() if d is not None and d < 600 and r["held_out"]]
    assert np.mean(out) > 0.95
    kept = keep_quality(docs, marks)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {d for d, r in got.items() if r["predicted"]}
    # Labels of held-out rows change nothing.
    flipped = [(d, 1 - q if q is not None and d is not None and zlib.crc32(str(d).encode()) % 3 == 1 else q, t) for d, q, t in labels]
    again = score_quality(docs, spark.createDataFrame(flipped, "doc_id long, quality int, toxic int"))
    assert {r["doc_id"]: r["score"] for r in again.collect()} == {d: r["score"] for d, r in got.items()}
    none = score_quality(docs, marks.where("false")).collect()
    assert {r["score"] for r in none} == {0.5}


def test_secrets(spark, rows):
    texts = [*rows, (700, "my password = abcdefgh and 0123456789abcdef0123456789abcdef")]
    got = {r["doc_id"]: [(s["start"], s["end"], s["kind"]) for s in r["spans"]] for r in find_secrets(frame(spark, texts)).collect()}
    assert got == {d: find_spans(t or "") for d, t in texts}
    assert len(got[700]) == 2


def test_mix(spark):
    rng = random.Random(4)
    rows = [(i, "t", rng.choice(["big"] * 8 + ["small", None, "-", ""])) for i in range(1500)]
    weights = {"big": 1.0, "small": 2.0, None: 1.0}
    got = mix_sources(frame(spark, rows), weights, block_docs=4).collect()
    assert Counter((r["doc_id"], r["source"]) for r in got) == Counter((d, s) for d, _, s in rows)
    by_slot = defaultdict(set)
    for r in got:
        assert r["release"] <= r["slot"] < r["deadline"]
        by_slot[r["slot"]].add((r["source"], r["block"]))
    assert sorted(by_slot) == list(range(len(by_slot)))
    assert all(len(x) == 1 for x in by_slot.values())
    share, done = {k: Fraction(v) for k, v in {**weights, "-": 4 / 3, "": 4 / 3}.items()}, Counter()
    total = sum(share.values())
    left = Counter(s for s, _ in {b for x in by_slot.values() for b in x})
    for slot in range(int(min(left[s] * total / w for s, w in share.items()))):  # until one has flowed
        done[next(iter(by_slot[slot]))[0]] += 1
        assert all(abs(done[s] - (slot + 1) * w / total) < 1 for s, w in share.items())
    assert slot > 20
    got = mix_sources(frame(spark, rows), {"big": 0, "small": 1}, block_docs=4).collect()
    last = {s: max(r["slot"] for r in got if r["source"] == s) for s in ("small", None, "-", "")}
    assert min(r["slot"] for r in got if r["source"] == "big") > max(last.values())
    with pytest.raises(ValueError):
        mix_sources(frame(spark, rows), {"big": -1})


RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/")]


def test_url_filter(spark):
    link = '<html><LINK data-x=1 href="{}" rel=canonical></html>'
    refresh = "<meta content='0; URL={}' http-equiv=\"refresh\">"
    pages = [
        (1, "http://A.example.com/en/1?x#y", None),
        (2, "https://www.example.com/en/1", ""),
        (3, "http://xexample.com/en/1", "<p>"),
        (4, "http://b.net/es/1", "<p>"),
        (5, "http://b.net/es", "<p>"),
        (6, "http://one.org/1", link.format("http://b.net/es/9")),
        (7, "http://two.org/a/2", refresh.format("../x") + link.format("http://one.org/1#top")),
        (8, "http://two.org/a/../x", None),
        (9, "http://three.org/1", link.format("http://b.net/es/9") + link.format("http://www.example.com/en/z")),
        (10, None, None), (11, "no scheme", link.format("http://b.net/es/1")), (12, "http://", None),
        (13, "http://four.org/1", "<p>"), (13, "http://four.org/1", "<p>"),
        (14, "http://from.org/1", None),
        (15, "http://c.com/q", link.format("http://b.net/es/5")),
    ]
    df = spark.createDataFrame([(*p, "x", "y") for p in pages], "page_id long, url string, html string, node string, verdict string")
    rules = spark.createDataFrame(RULES, "action string, host string, path string")
    redirects = spark.createDataFrame([("http://from.org/1", "http://four.org/1"), ("http://four.org/1", "http://b.net/es/77"), (None, "http://x.y/")], "from_url string, to_url string")
    got = {r["page_id"]: r for r in judge_urls(df, rules, redirects).collect()}
    assert (got[1]["host"], got[1]["path"], got[1]["rule"]) == ("a.example.com", "/en/1", "example.com/en/")
    assert (got[12]["host"], got[12]["path"]) == ("", "") and got[10]["path"] == "" and got[11]["host"] == ""
    assert [got[i]["rule"] for i in (2, 3, 4, 5)] == ["www.example.com/en/", "com/", "net/es/", None]
    verdicts = {i: r["verdict"] for i, r in got.items()}
    # 9 joins the b.net aliases to an allowed url, which frees the unruled ones among them.
    assert verdicts == {1: "block", 2: "allow", 3: "allow", 4: "block", 5: "allow", 6: "allow", 7: "allow", 8: "allow",
                        9: "allow", 10: "allow", 11: "allow", 12: "allow", 13: "block", 14: "block", 15: "allow"}
    without = {r["page_id"]: r["verdict"] for r in judge_urls(df.where("page_id <> 9"), rules).collect()}
    assert [without[i] for i in (6, 7, 8, 13, 14)] == ["block", "block", "block", "allow", "allow"]


def test_empty_tables(spark, tmp_path):
    docs = frame(spark, [(1, "a")]).where("false")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    write_token_files(docs, f"file://{tmp_path}/e", WORD)
    for out in (
        exact_duplicates(docs), near_duplicates(docs), pack(docs, BYTE), C.score_texts(docs), fingerprints(docs),
        score_quality(docs, labels), find_secrets(docs), mix_sources(docs), read_token_files(spark, f"file://{tmp_path}/e"),
        judge_urls(spark.createDataFrame([], "page_id long, url string, html string"), spark.createDataFrame(RULES, "action string, host string, path string")),
    ):
        assert out.count() == 0 and len(out.columns) > 1


def test_near_duplicates_of_ids_with_several_texts(spark):
    rng = random.Random(41)
    base = [sentence(rng, 60) for _ in range(7)]
    near = [t + " " + sentence(rng, 1) for t in base]
    # (null: base 0 and 1) - 10, 11 and 12; 20: base 2 and 3, near to 21 and 22; 30 and 31 apart.
    rows = [(None, base[0]), (None, base[1]), (10, base[0]), (11, near[0]), (12, near[1]), (20, base[2]), (20, base[3])]
    rows += [(21, near[2]), (22, near[3]), (20, ""), (30, base[4]), (31, base[5]), (25, base[6]), (25, base[4]), (None, None)]
    got = [(r["doc_id"], r["component_id"]) for r in near_duplicates(frame(spark, rows)).collect()]
    want = {None: None, 10: None, 11: None, 12: None, 20: 20, 21: 20, 22: 20, 30: 25, 25: 25, 31: 31}
    assert sorted(got, key=str) == sorted(((d, want[d]) for d, _ in rows), key=str)


def test_mix_keeps_exact_weights(spark):
    sizes = {"a": 3000, "b": 2000, "c": 3000, "d": 900, "e": 40}
    weights = {"a": 1.0, "b": 0.7, "c": 2**0.5, "d": 1 / 3, "e": 1e-5}
    names = [s for s in sizes for _ in range(sizes[s])]
    rows = [(i, "t", s) for i, s in enumerate(names)]
    got = mix_sources(frame(spark, rows), weights, block_docs=1).select("slot", "source", "release", "deadline").collect()
    assert sorted(r["slot"] for r in got) == list(range(len(rows)))
    assert all(r["release"] <= r["slot"] < r["deadline"] for r in got)
    total, done = sum(weights.values()), Counter()
    for r in sorted(got):
        done[r["source"]] += 1
        assert all(abs(done[s] - (r["slot"] + 1) * w / total) < 1 for s, w in weights.items())
        if done[r["source"]] == sizes[r["source"]]:
            break
    assert r["slot"] > 5000
    many = [(i, "t", f"s{i % 4500}") for i in range(5000)]
    got = mix_sources(frame(spark, many), block_docs=1).collect()
    assert sorted(r["slot"] for r in got) == list(range(len(many)))


def test_fingerprints_hold_all_anchors_of_long_texts(spark):
    rng = random.Random(43)
    shared = sentence(rng, 60)
    a, b = (f"{sentence(rng, 3000)} {shared} {sentence(rng, 3000)}" for _ in range(2))
    docs = frame(spark, [(2, a), (1, b)])
    full = {r["doc_id"]: [(x["hash"] >> 32, x["at"]) for x in r["x"]] for r in with_anchors(docs, "text", "x").collect()}
    got = {r["doc_id"]: r for r in fingerprints(docs).collect()}
    for d in (1, 2):
        assert [(x["hash"], x["at"]) for x in got[d]["sketch"]] == full[d]
        assert len(full[d]) > 2000
    one, two = ({h for h, _ in full[d]} for d in (1, 2))
    edited = {x["hash"] for x in got[2]["edited_sketch"]}
    assert got[2]["near_next"] == len(one & two) / len(one | two) > 0
    assert got[2]["near_edited"] == len(two & edited) / len(two | edited)


def test_no_id_or_text_fills_a_chunk_of_the_tree(spark, monkeypatch):
    monkeypatch.setattr(C, "CHUNK_BYTES", 2000)
    counted = C._counted

    def watched(chunk):
        assert chunk.num_rows <= 150
        return counted(chunk)

    monkeypatch.setattr(C, "_counted", watched)
    rows = [(None, "one hot text of a null id")] * 400 + [(i, f"text {i} of its own") for i in range(50)]
    got = C.score_texts(frame(spark, rows)).collect()
    assert len(got) == 450 and len({r["score"] for r in got if r["doc_id"] is None}) == 1


def test_forms_of_private_keys():
    import base64

    rng = random.Random(44)

    def item(tag, body):
        size = len(body)
        head = bytes([size]) if size < 128 else bytes([0x82]) + size.to_bytes(2, "big")
        return bytes([tag]) + head + body

    def key(n, width=60):
        numbers = [item(2, bytes([1]) + rng.randbytes(width)) for _ in range(n)]
        return item(0x30, item(2, b"\0") + b"".join(numbers))

    def spans(text):
        return [(text[a:b]) for a, b, k in find_spans(text) if k == "key"]

    rsa, dsa = key(8), key(5)
    code = base64.b64encode(rsa).decode()
    lines = [code[i : i + 64] for i in range(0, len(code), 64)]
    for gap in ("\\n", "\\r\\n", "\\\\n"):
        pem = gap.join(["-----BEGIN RSA PRIVATE KEY-----", *lines, "-----END RSA PRIVATE KEY-----"])
        assert spans(f'{{"private_key": "{pem}{gap}"}}') == [pem]
        assert spans(f'é KEY="{gap}{gap.join(lines)}"') == [gap.join(lines)]
        assert spans(f'é KEY="{gap}{code}"') == [code]
    assert spans("key = 0x" + rsa.hex() + ";") == ["0x" + rsa.hex()]
    assert spans("key = " + base64.b64encode(dsa).decode()) == [base64.b64encode(dsa).decode()]
    for gap in ("\n", "\r\n", "\n    "):
        assert spans(f"a key:\n\n{gap.join(lines)}\nend of it") == [gap.join(lines)]
        assert spans(f"Aword{gap}{gap.join(lines)}{gap}{gap.join(lines)}") == [gap.join(lines)] * 2
    field = lambda x: len(x).to_bytes(4, "big") + x
    box = b"openssh-key-v1\0" + field(b"none") * 2 + field(b"") + b"\0\0\0\1" + field(rng.randbytes(51)) + field(rng.randbytes(136))
    code = base64.b64encode(box).decode()
    wrapped = "\n".join(code[i : i + 70] for i in range(0, len(code), 70))
    assert spans(f"ssh:\n{wrapped}\nend") == [wrapped]
    assert spans("\n".join(lines[:-1])) == [] and spans("x\n".join(lines)) == []
