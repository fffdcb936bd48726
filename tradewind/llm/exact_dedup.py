"""Exact de-duplication through a Golomb-coded fingerprint exchange.

Texts are equal when their bytes are, after lower-casing A-Z. The steps:

1. Every document gets a 64-bit fingerprint that equal texts share, and the SHA-256 of its
   normalised text.
2. Every partition sorts its distinct fingerprints and sends each owner (a range of the
   fingerprint space) its share as one Golomb-coded list: the gaps between sorted values,
   quotients in unary and remainders in a fixed number of bits. A fingerprint that a
   partition holds a million times travels once.
3. An owner decodes its lists, finds the fingerprints that two lists share, and sends every
   list a bitmap with one bit for each of its values.
4. Partitions read their bitmaps; fingerprints that are marked, or that one partition holds
   twice, are suspects. Only suspects' texts are shuffled, grouped by their bytes.

An owner holds a bounded number of fingerprints (``OWNER_ROWS`` on average; the hash spreads
them evenly), a partition codes at most ``LIST_ROWS`` at a time. A hot text is combined on
the map side before its bytes travel, and the join of documents with their groups carries
only fingerprints and hashes; adaptive execution splits it where it is skewed.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import id_out, maybe_in, partitions, stored, texts

OWNER_ROWS = 2_000_000
LIST_ROWS = 4_000_000


def golomb_encode(values: np.ndarray, top: int) -> tuple[int, bytes, bytes]:
    """(remainder bits, unary bytes, remainder bytes) of sorted distinct values below top."""
    gaps = np.diff(values, prepend=np.uint64(0))
    bits = max(0, int(math.log2(max(1.0, 0.69 * top / max(1, len(values))))))
    quotients = (gaps >> np.uint64(bits)).astype(np.int64)
    stops = np.cumsum(quotients + 1) - 1
    unary = np.zeros(int(stops[-1]) + 1 if len(stops) else 0, np.uint8)
    unary[stops] = 1
    low = np.zeros((len(values), bits), np.uint8)
    for i in range(bits):
        low[:, i] = (gaps >> np.uint64(i)) & np.uint64(1)
    return bits, np.packbits(unary).tobytes(), np.packbits(low.ravel()).tobytes()


def golomb_decode(count: int, bits: int, unary: bytes, low: bytes) -> np.ndarray:
    stops = np.flatnonzero(np.unpackbits(np.frombuffer(unary, np.uint8)))[:count]
    gaps = np.diff(stops, prepend=-1).astype(np.uint64) - np.uint64(1)
    gaps = gaps << np.uint64(bits)
    digits = np.unpackbits(np.frombuffer(low, np.uint8))[: count * bits].reshape(count, bits)
    for i in range(bits):
        gaps |= digits[:, i].astype(np.uint64) << np.uint64(i)
    return np.cumsum(gaps, dtype=np.uint64)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, fingerprint, SHA-256 of the text with A-Z lower-cased."""
    for batch in batches:
        normal = pc.ascii_lower(batch.column(1))
        shas = [hashlib.sha256(t.as_buffer()).hexdigest() for t in normal]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(2), pa.array(shas, pa.string())],
            ["doc_id", "fp", "sha"],
        )


def _lists(owners: int):
    """Fingerprints of a partition to coded lists, one for each owner and flush."""
    top = 2**63 // owners + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, flush, held, size = TaskContext.get().partitionId(), 0, [], 0

        def coded() -> Iterator[pa.RecordBatch]:
            values, counts = np.unique(np.concatenate(held), return_counts=True)
            owner = (values // np.uint64(top)).astype(np.int64)
            begins = np.flatnonzero(np.diff(owner, prepend=-1))
            rows = []
            for begin, end in zip(begins, [*begins[1:], len(values)], strict=True):
                own = values[begin:end] - np.uint64(int(owner[begin]) * top)
                bits, unary, low = golomb_encode(own, top)
                twice = np.packbits(counts[begin:end] > 1).tobytes()
                rows.append((part, flush, int(owner[begin]), len(own), bits, unary, low, twice))
            yield pa.RecordBatch.from_pylist(
                [dict(zip(LIST.names, r, strict=True)) for r in rows], schema=LIST
            )

        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False).astype(np.uint64)
            held.append(values & np.uint64(2**63 - 1))
            size += len(values)
            if size >= LIST_ROWS:
                yield from coded()
                held, size, flush = [], 0, flush + 1
        if size:
            yield from coded()

    return run


LIST = pa.schema(
    [("part", pa.int32()), ("flush", pa.int32()), ("owner", pa.int64()), ("n", pa.int32()),
     ("bits", pa.int32()), ("unary", pa.binary()), ("low", pa.binary()), ("twice", pa.binary())]
)
LIST_DDL = "part int, flush int, owner long, n int, bits int, unary binary, low binary, twice binary"


def _bitmaps(lists: pa.Table) -> pa.Table:
    """One owner's lists to a bitmap for each: which values another list holds too."""
    rows = lists.to_pylist()
    decoded = [golomb_decode(r["n"], r["bits"], r["unary"], r["low"]) for r in rows]
    values, counts = np.unique(np.concatenate(decoded), return_counts=True)
    shared = values[counts > 1]
    out = [
        {"part": r["part"], "flush": r["flush"], "owner": r["owner"],
         "shared": np.packbits(np.isin(v, shared)).tobytes()}
        for r, v in zip(rows, decoded, strict=True)
    ]
    return pa.Table.from_pylist(out, schema=pa.schema(
        [("part", pa.int32()), ("flush", pa.int32()), ("owner", pa.int64()), ("shared", pa.binary())]
    ))


def _suspects(owners: int):
    top = 2**63 // owners + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for r in batch.to_pylist():
                marks = np.frombuffer(r["shared"], np.uint8) | np.frombuffer(r["twice"], np.uint8)
                if not marks.any():
                    continue
                values = golomb_decode(r["n"], r["bits"], r["unary"], r["low"])
                values = values[np.unpackbits(marks)[: r["n"]].astype(bool)]
                found.append((values + np.uint64(r["owner"] * top)).astype(np.int64))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found))], ["fp"])

    return run


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) for every row of docs.

    ``keep_id`` is the largest doc_id among equal texts. A null text equals the empty text.
    Repeated rows with one doc_id count each in ``group_size``; all of them are kept when
    their id is the one that stays. No row is lost; an empty table gives no rows.
    """
    spark = docs.sparkSession
    # Lower-casing in full merges all that lower-casing A-Z merges, so equal texts share it.
    fp = F.xxhash64(F.lower("text"))
    rows = texts(docs).withColumn("fp", fp)
    marks = stored(
        rows.mapInArrow(_hashed, "doc_id long, fp long, sha string"), "exact-marks"
    )
    owners = max(partitions(spark), math.ceil(marks.count() / OWNER_ROWS))
    lists = stored(marks.select("fp").mapInArrow(_lists(owners), LIST_DDL), "exact-lists")
    bitmaps = lists.drop("twice").groupBy("owner").applyInArrow(
        _bitmaps, "part int, flush int, owner long, shared binary"
    )
    suspects = lists.join(bitmaps, ["part", "flush", "owner"]).mapInArrow(
        _suspects(owners), "fp long"
    )
    key = F.col("fp").bitwiseAND(F.lit(2**63 - 1))
    bytes_equal = (
        maybe_in(rows, key, suspects, F.col("fp"))
        .mapInArrow(_normal, "doc_id long, fp long, normal string")
        .groupBy("fp", "normal")
        .agg(F.max("doc_id").alias("keep"), F.count("*").alias("size"))
        .where("size > 1")
        .select("fp", F.sha2("normal", 256).alias("sha"), "keep", "size")
    )
    groups = stored(bytes_equal, "exact-groups")
    return (
        marks.join(groups, ["fp", "sha"], "left")
        .withColumn("keep", F.coalesce("keep", "doc_id"))
        .select(
            id_out("doc_id").alias("doc_id"),
            id_out("keep").alias("keep_id"),
            F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
            (F.col("keep") == F.col("doc_id")).alias("kept"),
            F.col("sha").alias("text_sha256"),
        )
    )


def _normal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(2), pc.ascii_lower(batch.column(1))],
            ["doc_id", "fp", "normal"],
        )
