"""Language-model scoring by context-tree weighting over binary decisions.

A byte is coded as eight binary decisions, each in the context of the five bytes before it.
At every decision the tree of contexts mixes, over all depths from 0 to 5 bytes, the
Krichevsky-Trofimov estimates of its nodes with the weights of context-tree weighting: a
node's weighted probability is half its own estimate and half the product of its
children's. Where training never saw a deeper node, the mix ends above it. A text's code
length is the sum over its bytes and an end mark; texts are lower-cased (A-Z).

Neither the counts of the tree nor those of words are ever broadcast or gathered. Rows go
to chunks by a stored row number, so that no doc_id and no text, however often it occurs,
fills one: a chunk holds ``CHUNK_BYTES`` on average. A chunk reports the distinct words and six-byte runs of its
texts with their training counts; those are summed for the corpus; the tree is weighted in
parts that share the two nearest context bytes, of which only sums by the nearest byte
(65,536 rows at most) reach the driver to form the two levels above; and every chunk gets
back, by a join, the values of just the words and runs it holds.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.llm import words as W
from tradewind.llm.common import id_out, partitions, stored, texts

DEPTH = 5
END_BYTE, START_BYTE = 255, 10
#: Keys with this bit are word hashes, the others runs of DEPTH + 1 bytes, nearest first.
WORD_BIT = np.uint64(1 << 63)
END_WORD = np.uint64(1 << 63 | 1)
CHUNK_BYTES = 64_000_000
SLICE_BYTES = 1_000_000


def runs_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(runs, offsets): for every byte and every text's end, the nearest context byte first
    and the byte itself last, as one number."""
    n_texts, sizes = len(offsets) - 1, np.diff(offsets)
    step = DEPTH + 1
    laid = np.full(len(data) + n_texts * step, START_BYTE, np.uint8)
    text = np.repeat(np.arange(n_texts), sizes)
    laid[np.arange(len(data)) + step * text + DEPTH] = data
    laid[offsets[1:] + step * np.arange(1, n_texts + 1) - 1] = END_BYTE
    n = len(laid) - DEPTH
    run = np.zeros(n, np.uint64)
    for back in range(1, DEPTH + 1):
        run = (run << np.uint64(8)) | laid[DEPTH - back : DEPTH - back + n]
    run = (run << np.uint64(8)) | laid[DEPTH:]
    keep = np.ones(n, bool)
    begins = offsets[1:-1] + step * np.arange(1, n_texts)
    for i in range(DEPTH):  # places before a text's first byte
        keep[begins + i - DEPTH] = False
    return run[keep], offsets + np.arange(n_texts + 1)


def log_gamma(x: np.ndarray) -> np.ndarray:
    """For x > 0: Stirling's series at x + 8, stepped back."""
    y = x + 8
    series = (1 / 12 - (1 / 360 - 1 / (1260 * y * y)) / (y * y)) / y
    steps = x.copy()
    for i in range(1, 8):
        steps = steps * (x + i)
    return (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + series - np.log(steps)


def estimate(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Logarithm of the Krichevsky-Trofimov block probability."""
    half = 0.5 * math.log(math.pi)
    return log_gamma(zeros + 0.5) - half + log_gamma(ones + 0.5) - half - log_gamma(zeros + ones + 1)


def next_one(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    return (ones + 0.5) / (zeros + ones + 1)


def weigh(zeros: np.ndarray, ones: np.ndarray, below: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(log weighted probability, weight of the own estimate) of nodes whose children's log
    weighted probabilities have the sum ``below``."""
    own = estimate(zeros, ones) - math.log(2)
    weighted = np.logaddexp(own, below - math.log(2))
    return weighted, np.exp(own - weighted)


def mix(p: np.ndarray, zeros: np.ndarray, ones: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Next-one probabilities with one more level above; nan where nothing was seen."""
    one = next_one(zeros, ones)
    return np.where(zeros + ones > 0, np.where(np.isnan(p), one, weight * one + (1 - weight) * p), np.nan)


def decisions(runs: np.ndarray, bit: int) -> tuple[np.ndarray, np.ndarray]:
    """(node of the decision by the byte's leading bits, whether it is a one)."""
    byte = (runs & np.uint64(255)).astype(np.int64)
    return (1 << bit) | (byte >> (8 - bit)), (byte >> (7 - bit)) & 1


def subtree(runs: np.ndarray, n: np.ndarray, bit: int, least: int = 2) -> tuple[np.ndarray, tuple]:
    """The levels from DEPTH up to ``least`` of one of the eight decisions.

    Gives each run's next-one probability, and for the nodes of level ``least`` (context and
    decision, zeros, ones, log weighted probability).
    """
    node, one = decisions(runs, bit)
    context = runs >> np.uint64(8)
    p = np.full(len(runs), np.nan)
    weighted = first = None
    for level in range(DEPTH, least - 1, -1):
        names = ((context >> np.uint64(8 * (DEPTH - level))) << np.uint64(8)) | node.astype(np.uint64)
        names, here, of = np.unique(names, return_index=True, return_inverse=True)
        ones = np.bincount(of, n * one, len(names))
        zeros = np.bincount(of, n * (1 - one), len(names))
        if weighted is None:
            weighted, weight = estimate(zeros, ones), np.ones(len(names))
        else:
            weighted, weight = weigh(zeros, ones, np.bincount(of[first], weighted, len(names)))
        first = here
        p = mix(p, zeros[of], ones[of], weight[of])
    return p, (names, zeros, ones, weighted)


class Top:
    """The two uppermost levels: by the nearest byte, and without context."""

    def __init__(self, nearest: np.ndarray, node: np.ndarray, zeros: np.ndarray, ones: np.ndarray, below: np.ndarray):
        shape = (2, 256, 256)  # zeros and ones by nearest byte and decision
        self.seen = np.zeros(shape)
        self.seen[0, nearest, node], self.seen[1, nearest, node] = zeros, ones
        sums = np.zeros(shape[1:])
        sums[nearest, node] = below
        weighted, self.weight = weigh(*self.seen, sums)
        self.root = self.seen.sum(axis=1)
        _, self.root_weight = weigh(*self.root, weighted.sum(axis=0))

    def finish(self, p: np.ndarray, nearest: np.ndarray, node: np.ndarray) -> np.ndarray:
        p = mix(p, *self.seen[:, nearest, node], self.weight[nearest, node])
        p = mix(p, *self.root[:, node], self.root_weight[node])
        return np.where(np.isnan(p), 0.5, p)


def run_values(counts: DataFrame) -> DataFrame:
    """(key, value): log10 of the probability of the last byte of each run (key, n)."""
    # Runs that share their two nearest bytes stay together; a task takes several such sets.
    dealt = F.pmod(F.xxhash64(F.shiftright("key", 32)), F.lit(2 * partitions(counts.sparkSession)))
    parts = counts.groupBy(dealt.alias("part"))

    def sums(part: pa.Table) -> pa.Table:
        runs, n = part["key"].to_numpy().view(np.uint64), part["n"].to_numpy()
        rows = [subtree(runs, n, bit)[1] for bit in range(8)]
        names = np.concatenate([r[0] for r in rows])
        return pa.table(
            {
                "nearest": (names >> np.uint64(16)).astype(np.int32), "node": (names & np.uint64(255)).astype(np.int32),
                **{k: np.concatenate([r[i] for r in rows]) for i, k in ((1, "zeros"), (2, "ones"), (3, "below"))},
            }
        )

    level = (
        parts.applyInArrow(sums, "nearest int, node int, zeros double, ones double, below double")
        .groupBy("nearest", "node").agg(*(F.sum(c).alias(c) for c in ("zeros", "ones", "below")))
        .toPandas()
    )
    top = Top(*(level[c].to_numpy() for c in ("nearest", "node", "zeros", "ones", "below")))

    def values(part: pa.Table) -> pa.Table:
        runs, n = part["key"].to_numpy().view(np.uint64), part["n"].to_numpy()
        nearest = (runs >> np.uint64(40)).astype(np.int64)
        value = np.zeros(len(runs))
        for bit in range(8):
            node, one = decisions(runs, bit)
            p = top.finish(subtree(runs, n, bit)[0], nearest, node)
            value += np.log10(np.where(one == 1, p, 1 - p))
        return pa.table({"key": part["key"], "value": value})

    return parts.applyInArrow(values, "key long, value double")


def held_out(column: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(id_out(column).cast("string").cast("binary")) % 7 == 2, F.lit(False))


def _keys(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(word keys, first word of each text, runs, first run of each text)."""
    data, offsets = W.flat(batch.column(batch.schema.get_field_index("text")))
    data = W.lowered(data)
    starts, ends, first = W.word_spans(data, offsets)
    return W.spans_hash(data, starts, ends) | WORD_BIT, first, *runs_of(data, offsets)


def _counted(chunk: pa.Table) -> pa.Table:
    """The distinct keys of a chunk's texts, each with its number in training texts."""
    held: list[tuple[np.ndarray, np.ndarray]] = [(np.array([END_WORD]), np.array([0]))]

    def fold() -> None:
        keys, place = np.unique(np.concatenate([k for k, _ in held]), return_inverse=True)
        held[:] = [(keys, np.bincount(place, np.concatenate([c for _, c in held])).astype(np.int64))]

    for whole in chunk.to_batches():
        for batch in W.slices(whole, most=SLICE_BYTES):
            train = ~batch.column(batch.schema.get_field_index("held_out")).to_numpy(zero_copy_only=False)
            words, first, runs, run_first = _keys(batch)
            held.append((np.array([END_WORD]), np.array([train.sum()])))
            for keys, begin in ((words, first), (runs, run_first)):
                learned = np.repeat(train, np.diff(begin))
                held.append(np.unique(keys[learned], return_counts=True))
                other = np.unique(keys[~learned])
                held.append((other, np.zeros(len(other), np.int64)))
            if sum(len(k) for k, _ in held) > 4_000_000:
                fold()
    fold()
    keys, n = held[0]
    number = np.full(len(keys), chunk["chunk"][0].as_py(), np.int32)
    return pa.table({"chunk": number, "key": keys.view(np.int64), "n": n})


class Values:
    """Key to value, by an open-addressing table; 0 where the key is missing."""

    def __init__(self, keys: np.ndarray, values: np.ndarray, kind: type = np.float64):
        size = 1 << max(4, int(3 * len(keys)).bit_length())
        self.mask = size - 1
        self.keys = np.zeros(size, np.uint64)
        self.values = np.zeros(size, kind)
        slots = self._slots(keys)
        while len(keys):
            free = self.keys[slots] == 0
            self.keys[slots[free]] = keys[free]
            placed = self.keys[slots] == keys
            self.values[slots[placed]] = values[placed]
            keys, values, slots = keys[~placed], values[~placed], (slots[~placed] + 1) & self.mask

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * W.BASE) >> np.uint64(24)).astype(np.int64) & self.mask

    def __getitem__(self, keys: np.ndarray) -> np.ndarray:
        slots = self._slots(keys)
        found = self.keys[slots]
        out = self.values[slots].astype(float)
        left = np.flatnonzero(found != keys)
        out[left] = 0
        left = left[found[left] != 0]
        slots = (slots[left] + 1) & self.mask
        while len(left):
            found = self.keys[slots]
            hit = found == keys[left]
            out[left[hit]] = self.values[slots[hit]]
            going = ~hit & (found != 0)
            left, slots = left[going], (slots[going] + 1) & self.mask
        return out


SCORED = pa.schema(
    [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base", pa.float64()), ("score", pa.float64())]
)
SCORED_DDL = "doc_id long, n_tokens long, n_known long, base double, score double"


def _scorer(total: int, distinct: int):
    """Texts of a chunk and the values of its keys to scores."""
    log_all = math.log10(total + distinct + 1)

    def run(chunk: pa.Table, answers: pa.Table) -> pa.Table:
        keys, values = answers["key"].to_numpy().view(np.uint64), answers["value"].to_numpy()
        is_word = keys >= WORD_BIT
        of_word = Values(keys[is_word], values[is_word])  # the base score is exact to a double's digits
        of_run = Values(keys[~is_word], values[~is_word], np.float32)
        end = float(of_word[np.array([END_WORD])][0])
        out = []
        for whole in chunk.to_batches():
            for batch in W.slices(whole, most=SLICE_BYTES):
                words, first, runs, run_first = _keys(batch)
                logs = of_word[words]
                of = np.repeat(np.arange(batch.num_rows), np.diff(first))
                n_tokens = np.diff(first) + 1
                out.append(
                    pa.RecordBatch.from_arrays(
                        [
                            batch.column(batch.schema.get_field_index("doc_id")),
                            pa.array(n_tokens),
                            pa.array(np.bincount(of, logs > 0, batch.num_rows).astype(np.int64) + int(end > 0)),
                            pa.array(np.bincount(of, logs, batch.num_rows) + end - n_tokens * log_all),
                            pa.array(np.add.reduceat(of_run[runs], run_first[:-1])),
                        ],
                        schema=SCORED,
                    )
                )
        return pa.Table.from_batches(out, SCORED)

    return run


def score_texts(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row.

    Learns from all rows that are not held out, and scores all. ``score`` is log10 of the
    model's probability of the text and its end; ``base_score`` is the add-one unigram
    score of its words and an end token. A null or empty text has its end alone. Without
    training rows the base score is 0 and every decision has probability one half.
    Words are told apart by 63-bit hashes.
    """
    rows = texts(docs).withColumns({"held_out": held_out(), "uid": F.monotonically_increasing_id()})
    rows = stored(rows, "lm-rows")  # both passes must deal a row to the same chunk
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chunk = F.pmod(F.xxhash64("uid"), F.lit(-(-size // CHUNK_BYTES) + 1)).cast("int")
    chunked = rows.withColumn("chunk", chunk).drop("uid")
    held = stored(chunked.groupBy("chunk").applyInArrow(_counted, "chunk int, key long, n long"), "lm-held")
    counts = stored(held.groupBy("key").agg(F.sum("n").alias("n")), "lm-counts")
    known = counts.where("key < 0 AND n > 0")
    total, distinct = known.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    values = run_values(counts.where("key >= 0")).unionByName(
        known.select("key", F.log10(F.col("n") + 1.0).alias("value"))
    )
    answers = held.join(values, "key").select("chunk", "key", "value")
    scored = (
        chunked.select("doc_id", "text", "chunk").groupBy("chunk").cogroup(answers.groupBy("chunk"))
        .applyInArrow(_scorer(total, distinct), SCORED_DDL)
    )
    return scored.select(
        id_out("doc_id").alias("doc_id"),
        held_out().alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(total).cast("long").alias("train_tokens"),
        F.col("base").alias("base_score"),
        "score",
    )
