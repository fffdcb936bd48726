"""Token files: frequency-ranked ids in byte-aligned variable-length coding.

An id is replaced by its rank by frequency over the whole input, so common ids are small.
A number takes one to four bytes; its length less one is two bits of a control byte, kept
apart from the data bytes, so a reader looks the lengths of four numbers up in a table of
256 rows and needs no branches.

A token folder holds two Parquet tables (written by Spark, so a lost executor or a repeated
task leaves no half-written file and any store that Spark reaches will do):

- ``ranks``: rank, id, count; at most one row for each id of the vocabulary;
- ``segments``: part, number, base (ids before it in its part), total, doc_ids (8-byte
  numbers), counts (4-byte numbers), control, data. Parts and numbers ascend with doc_id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.llm import words as W
from tradewind.llm.common import id_out
from tradewind.llm.tokens import ids_of, token_rows

#: Lengths of the four numbers that a control byte describes.
LENGTHS = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3) + 1
SEGMENT = pa.schema(
    [("part", pa.int32()), ("number", pa.int32()), ("base", pa.int64()), ("total", pa.int64()),
     ("doc_ids", pa.binary()), ("counts", pa.binary()), ("control", pa.binary()), ("data", pa.binary())]
)
SEGMENT_DDL = (
    "part int, number int, base long, total long, "
    "doc_ids binary, counts binary, control binary, data binary"
)
SEGMENT_BYTES = 4_000_000


def encode_numbers(values: np.ndarray) -> tuple[bytes, bytes]:
    """(control bytes, data bytes) of numbers below 2**32."""
    values = values.astype("<u4")
    size = 1 + (values >= 1 << 8).astype(np.int64) + (values >= 1 << 16) + (values >= 1 << 24)
    quads = np.zeros(-(-len(values) // 4) * 4, np.int64)
    quads[: len(values)] = size - 1
    control = (quads.reshape(-1, 4) << np.array([0, 2, 4, 6])).sum(axis=1).astype(np.uint8)
    octets = values.view(np.uint8).reshape(-1, 4)
    return control.tobytes(), octets[np.arange(4) < size[:, None]].tobytes()


def decode_numbers(control: bytes, data: bytes, count: int) -> np.ndarray:
    size = LENGTHS[np.frombuffer(control, np.uint8)].ravel()[:count]
    octets = np.frombuffer(data + bytes(3), np.uint8).astype(np.uint32)
    at = np.cumsum(size) - size
    out = np.zeros(count, np.uint32)
    for i in range(4):
        longer = size > i
        out[longer] |= octets[at[longer] + i] << np.uint32(8 * i)
    return out


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (n, ids) to one row for each id of a partition."""
    total = np.zeros(0, np.int64)
    for batch in batches:
        n = batch.column(0).to_numpy(zero_copy_only=False)
        ids = ids_of(W.flat(batch.column(1))[0], n, int(n.sum()))
        own = np.bincount(ids, minlength=len(total))
        own[: len(total)] += total
        total = own
    seen = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["id", "count"])


def _segments(rank_of: np.ndarray):
    """Rows (doc_id, n, ids) of a sorted partition to segments."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, base = TaskContext.get().partitionId(), 0, 0
        for whole in batches:
            for batch in W.slices(whole, "ids", SEGMENT_BYTES):
                doc, n = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
                total = int(n.sum())
                control, data = encode_numbers(rank_of[ids_of(W.flat(batch.column(2))[0], n, total)])
                row = {
                    "part": part, "number": number, "base": base, "total": total,
                    "doc_ids": doc.astype("<i8").tobytes(), "counts": n.astype("<u4").tobytes(),
                    "control": control, "data": data,
                }
                yield pa.RecordBatch.from_pylist([row], schema=SEGMENT)
                number, base = number + 1, base + total

    return run


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int = 2) -> None:
    """Encode every whole text (null: empty), append ``end_id``, write in ascending doc_id.

    Rows of one doc_id are written each, in any order. An empty table gives empty folders.
    The rank table is bounded by the vocabulary, whatever the input.
    """
    spark = docs.sparkSession
    rows = token_rows(docs, tokenizer, end_id, "token-ids")
    counts = (
        rows.select("n", "ids").mapInArrow(_counted, "id long, count long")
        .groupBy("id").agg(F.sum("count").alias("count")).collect()
    )
    ranked = sorted(((-r["count"], r["id"]) for r in counts))
    rank_of = np.zeros(max([i for _, i in ranked], default=0) + 1, np.uint32)
    for rank, (_, i) in enumerate(ranked):
        rank_of[i] = rank
    spark.createDataFrame(
        [(rank, i, -c) for rank, (c, i) in enumerate(ranked)], "rank long, id long, count long"
    ).write.mode("overwrite").parquet(f"{path}/ranks")
    rows.select("doc_id", "n", "ids", "uid").orderBy("doc_id", "uid").select(
        "doc_id", "n", "ids"
    ).mapInArrow(_segments(rank_of), SEGMENT_DDL).write.mode("overwrite").parquet(f"{path}/segments")


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids): ``start`` counts the ids of all documents before it,
    ``ids`` are little-endian 4-byte numbers."""
    ranks = spark.read.parquet(f"{path}/ranks").orderBy("rank").collect()
    id_of = np.array([r["id"] for r in ranks] or [0], "<u4")
    segments = spark.read.schema(SEGMENT_DDL).parquet(f"{path}/segments")
    totals = sorted(segments.groupBy("part").agg(F.sum("total").alias("n")).collect())
    offsets, before = [], 0
    for row in totals:
        offsets.append((row["part"], before))
        before += row["n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                ids = id_of[decode_numbers(r["control"], r["data"], r["total"])]
                n = np.frombuffer(r["counts"], "<u4").astype(np.int64)
                stops = np.cumsum(n)
                column = pa.Array.from_buffers(
                    pa.large_binary(), len(n),
                    [None, pa.py_buffer(np.concatenate([[0], stops * 4]).astype(np.int64)), pa.py_buffer(ids)],
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.frombuffer(r["doc_ids"], "<i8")),
                        pa.array(stops - n + r["base"] + r["before"]), pa.array(n), column.cast(pa.binary()),
                    ],
                    ["doc_id", "start", "n_tokens", "ids"],
                )

    before_part = spark.createDataFrame(offsets, "part int, before long")
    return (
        segments.join(F.broadcast(before_part), "part")
        .select("base", "total", "doc_ids", "counts", "control", "data", "before")
        .mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")
        .withColumn("doc_id", id_out("doc_id"))
    )
