"""Packing along a space-filling curve.

Every document's token ids are counted into a short vector by hashing, scaled to unit
length and projected to three dimensions. The position of that point on a Hilbert curve is
a sort key under which similar documents are neighbours. Documents are laid end to end in
key order and cut every ``length`` ids, so all sequences but the last are full.

Ids are made once and stored; the sort moves only keys and counts, the running total is
kept by range partition, and the ids then meet their start in one join on a unique row
number, which no hot value can skew.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.llm import words as W
from tradewind.llm.common import id_out, running_starts
from tradewind.llm.tokens import ids_of, token_rows

HASHED, AXES, BITS = 64, 3, 10
PROJECTION = np.random.default_rng(9).normal(size=(HASHED, AXES))


def hilbert_key(axes: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of points (n, axes) with whole coordinates below 2**bits."""
    x = axes.astype(np.int64).copy()
    n = x.shape[1]
    for level in range(bits - 1, 0, -1):  # undo the turns of the cells, coarse to fine
        low = (1 << level) - 1
        for i in range(n):
            turned = (x[:, i] >> level) & 1 == 1
            swap = np.where(turned, 0, (x[:, 0] ^ x[:, i]) & low)
            x[:, 0] ^= np.where(turned, low, swap)
            if i:
                x[:, i] ^= swap
    for i in range(1, n):
        x[:, i] ^= x[:, i - 1]
    gray = np.zeros(len(x), np.int64)
    for level in range(bits - 1, 0, -1):
        gray ^= np.where((x[:, n - 1] >> level) & 1 == 1, (1 << level) - 1, 0)
    x ^= gray[:, None]
    key = np.zeros(len(x), np.int64)
    for level in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[:, i] >> level) & 1)
    return key


def curve_keys(ids: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Hilbert keys of documents given by their ids and offsets; no ids: the middle point."""
    n = len(first) - 1
    drawn = W.mixed(ids.astype(np.uint64) + np.uint64(1))
    place = np.repeat(np.arange(n), np.diff(first)) * HASHED + (drawn & np.uint64(HASHED - 1)).astype(np.int64)
    sign = np.where(drawn >> np.uint64(63), 1.0, -1.0)
    vector = np.bincount(place, sign, n * HASHED).reshape(n, HASHED)
    vector = np.sign(vector) * np.log1p(np.abs(vector))
    vector /= np.maximum(np.linalg.norm(vector, axis=1), 1e-9)[:, None]
    point = (np.tanh(vector @ PROJECTION) + 1) / 2
    return hilbert_key(np.minimum((point * 2**BITS).astype(np.int64), 2**BITS - 1), BITS)


PIECE = (
    "doc_id long, start long, length long, doc_tokens long, sequence_id long, "
    "`offset` long, ids binary"
)


def _cut(length: int):
    """Rows (doc_id, start in all, n, ids) to pieces that lie in one sequence each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in W.slices(whole, "ids", 4_000_000):
                doc, begin, n = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
                total = int(n.sum())
                ids = ids_of(W.flat(batch.column(3))[0], n, total)
                first = begin // length
                many = (begin + n - 1) // length - first + 1
                row = np.repeat(np.arange(len(n)), many)
                turn = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
                sequence = first[row] + turn
                left = np.maximum(sequence * length, begin[row])
                right = np.minimum((sequence + 1) * length, begin[row] + n[row])
                size = right - left
                column = pa.Array.from_buffers(
                    pa.large_binary(), len(row),
                    [None, pa.py_buffer(np.concatenate([[0], np.cumsum(size * 4)]).astype(np.int64)), pa.py_buffer(ids)],
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(doc[row]), pa.array(left - begin[row]), pa.array(size), pa.array(n[row]),
                        pa.array(sequence), pa.array(left - sequence * length), column.cast(pa.binary()),
                    ],
                    ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"],
                )

    return W.steady(run)


def pack(
    docs: DataFrame, tokenizer: str, end_id: int = 1, length: int = 2048, group: Column | None = None
) -> DataFrame:
    """Pieces (doc_id, start, length, doc_tokens, sequence_id, offset, ids) of all documents.

    ``ids`` are the piece's ids as little-endian 4-byte numbers, ``start`` its place in its
    document, ``offset`` its place in the sequence. A null or empty text has its end id
    alone. Documents of one key follow by doc_id; repeated rows are packed each. Only the
    last sequence can be short; its rest is padding. ``group``, a whole number of each row,
    leads the order: the curve is followed inside each group, and groups follow each other.
    """
    rows = token_rows(docs, tokenizer, end_id, "pack-ids", curve_keys, group)
    order = ["group", "key", "doc_id", "uid"]
    starts = running_starts(rows.select(*order, "n"), order, "n", "pack-order")
    return (
        rows.select("uid", "doc_id", "n", "ids")
        .join(starts.select("uid", "start"), "uid")
        .select("doc_id", "start", "n", "ids")
        .mapInArrow(_cut(length), PIECE)
        .withColumn("doc_id", id_out("doc_id"))
    )
