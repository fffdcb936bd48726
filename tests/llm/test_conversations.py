"""Conversation repair against plain enumeration, and the odd cases."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from functools import lru_cache

import pytest

from tradewind.llm import conversations as C
from tradewind.llm.queries import QUERIES

GOOD = re.compile(r"(s?(ua)+)?\Z")
BLANK = " \t\n\x0b\x0c\r"
SCHEMA = "conv_id long, turn long, role string, text string, gone string, sha string, repeated string, conv string, copy string"


def cheapest(rows):
    """(cost, audit, repaired lines) over every series of edits: rows are (role, text, fault)."""

    @lru_cache(maxsize=None)
    def rest(i, initials, inserted):
        # initials: enough of what was put out to tell what may follow ("" or its last, "s" alone).
        out = []
        if i == len(rows) and GOOD.match({"": "", "s": "s", "u": "u", "a": "ua"}[initials]):
            out.append((0, "", ()))
        steps = []
        if inserted < 3:
            steps += [(3, "I", "user", "", i, inserted + 1), (3, "I", "assistant", "", i, inserted + 1)]
        if i < len(rows):
            role, text, fault = rows[i]
            steps.append((4, "D", None, None, i + 1, 0))
            if fault not in ("blank", "duplicate"):
                more = 3 if fault == "truncated" else 0
                steps.append((more, "K", role, text, i + 1, 0))
                steps += [(3 + more, "R", r, text, i + 1, 0) for r in ("user", "assistant")]
        for cost, letter, role, text, to, count in steps:
            after, line = initials, ()
            if role is not None:
                first = role[:1]
                if first + "|" + initials not in ("s|", "u|", "u|s", "u|a", "a|u"):
                    continue
                after, line = first, (f"{role}:{text}",)
            for c, a, lines in rest(to, after, count)[:1]:
                out.append((cost + c, letter + a, line + lines))
        return sorted(out)[:1]

    return rest(0, "", 0)[0]


def faults(rows):
    """(role, text, fault) in order, by the plain reading of the rule."""
    seen, out = set(), []
    for role, text in rows:
        solid = text.strip(BLANK)
        fault = "blank" if not solid else "duplicate" if (role, text) in seen else "" if solid[-1] in ".!?" else "truncated"
        seen.add((role, text))
        out.append((role, text, fault))
    return out


def test_digit_dp_equals_enumeration():
    rng = random.Random(3)
    for _ in range(1500):
        roles = ["user", "assistant", "system", "tool", " "]
        texts = ["a.", "b!", "c", "d ?", " ", "e"]
        rows = faults([(rng.choices(roles, [5, 5, 2, 1, 1])[0], rng.choice(texts)) for _ in range(rng.randint(0, 7))])
        width = rng.choice([1, 2, 3, 64])
        made = C.Repair(width)
        for role, text, fault in rows:
            made.row(role, text, fault in ("blank", "duplicate"), fault == "truncated")
        cost, audit, lines = cheapest(tuple(rows))
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        assert made.result() == (cost, audit, digest), rows


def test_long_conversation_keeps_little():
    made, wide = C.Repair(8), C.Repair(65536)
    rng = random.Random(5)
    for _ in range(6000):
        row = rng.choice(["user", "assistant", "system"]), str(rng.random()), rng.random() < 0.1, rng.random() < 0.2
        made.row(*row)
        wide.row(*row)
    assert made.result() == wide.result()
    assert made.width <= 512  # what all states share has moved out


def plain(rows):
    """The query's rows by plain Python over all rows of the table."""
    out = []
    for conv in {r[0] for r in rows}:
        own = []
        for c, turn, role, text in rows:
            if c != conv:
                continue
            key = ":".join(" " if x is None else str(x) for x in (c, turn))
            fate = zlib.crc32(key.encode()) % 20
            role, text = " " if role is None else role, " " if text is None else text
            if fate == 0:
                continue
            text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
            role = "user" if fate == 4 else role
            own += [(turn, role, text)] * (2 if fate == 3 else 1)
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest()))
        turns = [t for t, _, _ in own if t is not None]
        marked = faults([r[1:] for r in own])
        cost, audit, lines = cheapest(tuple(marked))
        initials = [r[0][:1] for r in marked]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        count = [sum(f == kind for _, _, f in marked) for kind in ("blank", "duplicate", "truncated")]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out.append((conv, gaps, *count, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=lambda r: (r[0] is not None, r[0]))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(8)
    out = []
    for conv in [*range(60), None]:
        for turn in range(rng.randint(1, 7)):
            role = rng.choices(["user", "assistant", "system", None, "", "Übung"], [8, 8, 3, 1, 1, 1])[0]
            text = rng.choice(["Hello there.", "what", "no!", None, "", " \n", "é?", "x" * 3000, "same."])
            out.append((conv, None if rng.random() < 0.1 else turn * rng.choice([1, 1, 2]), role, text))
    gone = [(1000 + i, t) for i in range(400) for t in [0] if zlib.crc32(f"{1000 + i}:0".encode()) % 20 == 0]
    return out + [(c, t, "user", "All of it goes.") for c, t in gone[:3]]


def frame(spark, rows):
    return spark.createDataFrame([(*r, *"abcde") for r in rows], SCHEMA)


def test_query_equals_plain_reading(spark, rows, tmp_path):
    frame(spark, rows).write.parquet(f"{tmp_path}/conversations.parquet")
    got = QUERIES["op11_conversations"](spark, str(tmp_path))
    assert got.dtypes[1:7] == [(c, "bigint") for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    got = sorted((tuple(r) for r in got.collect()), key=lambda r: (r[0] is not None, r[0]))
    assert got == plain(rows)
    assert any(r[-2:] == ("", hashlib.sha256(b"").hexdigest()) and r[0] and r[0] >= 1000 for r in got)


def test_empty_table_and_one_hot_conversation(spark):
    assert C.repair(C.damaged(frame(spark, []))).collect() == []
    rows = [(7, i // 2, ("user", "assistant")[i % 2], f"turn {i}.") for i in range(20000)]
    (got,) = C.repair(C.as_is(frame(spark, rows))).collect()
    assert (got["cost"], got["audit"], got["gaps"], got["illegal"]) != (None,) * 4
    assert len(got["audit"].replace("I", "")) == 20000
    rows = [(7, i, ("user", "assistant")[i % 2], f"turn {i}.") for i in range(20000)]
    (got,) = C.repair(C.as_is(frame(spark, rows))).collect()
    lines = "\n".join(f"{role}:{text}" for _, _, role, text in rows)
    assert tuple(got)[1:] == (0, 0, 0, 0, 0, 0, "K" * 20000, hashlib.sha256(lines.encode()).hexdigest())
