"""Numpy helpers over Arrow text columns: bytes, words, word and shingle hashes.

Work goes in slices of a bounded number of bytes (a longer text is a slice of its own).
A word is a run of bytes other than 0x20 and 0x09-0x0D, which no byte of a longer UTF-8
sequence equals, so bytes can be searched in place of characters.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1_000_000
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[32, *range(9, 14)]] = True

_RANDOM = np.random.default_rng(20240607)
BYTE_VALUE = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64)
BASE = np.uint64(int(_RANDOM.integers(2**61, 2**62)) * 2 + 1)
BASE_INVERSE = np.uint64(pow(int(BASE), -1, 2**64))
SHINGLE = _RANDOM.integers(1, 2**63, 16, dtype=np.uint64) | np.uint64(1)
_powers: list[np.ndarray] = []


Batches = Iterator[pa.RecordBatch]


def release() -> None:
    """Give memory that this worker has freed back to the machine.

    Workers live on between tasks and stages; what they keep stands beside the next ones.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def steady(fn: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """A function over batches that releases memory after each and at its end."""

    @wraps(fn)
    def run(batches: Batches) -> Batches:
        def fed() -> Batches:
            for batch in batches:
                yield batch
                del batch
                release()

        yield from fn(fed())
        release()

    return run


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(all bytes, offsets of len + 1) of a string column without nulls."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, column: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows with at most so many bytes of text (or one row)."""
    if not batch.num_rows:
        return
    _, offsets = flat(batch.column(batch.schema.get_field_index(column)))
    at = 0
    while at < batch.num_rows:
        end = int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1
        end = min(max(end, at + 1), batch.num_rows)
        yield batch.slice(at, end - at)
        at = end


def lowered(data: np.ndarray) -> np.ndarray:
    return np.frombuffer(data.tobytes().translate(LOWER), np.uint8)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (the splitmix64 finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i below n."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, SLICE_BYTES + 1024)
        grown = []
        for base in (BASE, BASE_INVERSE):
            row = np.full(size, base, np.uint64)
            row[0] = 1
            grown.append(np.multiply.accumulate(row))
        if size > 4 * SLICE_BYTES:  # one very long text: not kept
            return grown[0], grown[1]
        _powers[:] = grown
    return _powers[0], _powers[1]


def spans_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte span; equal spans have equal hashes wherever they lie."""
    up, down = powers(len(data) + 1)
    sums = np.empty(len(data) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(BYTE_VALUE[data] * up[: len(data)], out=sums[1:])
    value = (sums[ends] - sums[starts]) * down[starts]
    return mixed(value + (ends - starts).astype(np.uint64) * SHINGLE[15])


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first word of each text): ``first`` has one more entry than texts."""
    n = len(data)
    solid = ~IS_SPACE[data]
    begin = solid.copy()
    begin[1:] &= ~solid[:-1]
    finish = solid.copy()
    finish[:-1] &= ~solid[1:]
    inner = offsets[(offsets > 0) & (offsets < n)]
    begin[inner] = solid[inner]
    finish[inner - 1] = solid[inner - 1]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(finish) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def shingle_hashes(words: np.ndarray, first: np.ndarray, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, first shingle of each text); texts of fewer words have their sequence as one."""
    n = len(words)
    counts = np.diff(first)
    many = np.where(counts >= width, counts - width + 1, (counts > 0).astype(np.int64))
    total = np.zeros(n, np.uint64)
    for t in range(min(width, n)):
        total[: n - t] += words[t:] * SHINGLE[t]
    out_first = np.concatenate(([0], np.cumsum(many)))
    text = np.repeat(np.arange(len(counts)), many)
    at = first[:-1][text] + (np.arange(out_first[-1]) - out_first[:-1][text])
    out = total[at]
    for i in np.flatnonzero((counts > 0) & (counts < width)):
        own = words[first[i] : first[i + 1]]
        out[out_first[i]] = (own * SHINGLE[: len(own)]).sum(dtype=np.uint64) + np.uint64(len(own))
    return mixed(out), out_first
