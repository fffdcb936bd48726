"""Token ids of whole texts by the tokenizers library, each distinct word encoded once.

A BPE tokenizer first cuts a text into pieces (words with their space, digits, runs of
signs) and encodes every piece on its own. The pieces of a batch are found and hashed with
numpy, and only pieces this worker has not met lately are given to the library, many in
one text; the ids of a text are put together from the pieces' ids. Texts with characters
for which the cut is not this simple (beyond Latin letters and common signs, or that could
hold a special token) go to the library whole. Either way the ids are those of the library.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tradewind.llm import words as W
from tradewind.llm.common import stored, texts

LIMIT = 0x250
LETTER, NUMBER, SIGN, SPACE = range(4)
SIMPLE = np.zeros(LIMIT + 1, bool)
CLASS = np.full(LIMIT + 1, SIGN, np.uint8)
LOWER = np.arange(LIMIT + 1, dtype=np.uint32)
for _c in range(LIMIT):
    _kind = unicodedata.category(chr(_c))
    SIMPLE[_c] = _c in (9, 10, 13) or (_kind[0] != "C" and _c not in (0xA0, 0x130))
    if _c in (9, 10, 13, 32):
        CLASS[_c] = SPACE
    elif _kind[0] == "L":
        CLASS[_c] = LETTER
    elif _kind[0] == "N":
        CLASS[_c] = NUMBER
    if SIMPLE[_c] and ord(chr(_c).lower()[0]) < LIMIT:
        LOWER[_c] = ord(chr(_c).lower()[0])
    elif chr(_c).lower() != chr(_c):
        SIMPLE[_c] = False
#: Pieces given to the library at once.
ENCODE = 4096
#: The bytes 0x20 and 0x0A as tokens of byte-level files write them.
SPACE_BYTE, LINE_END = "\u0120", "\u010a"
VALUE = np.random.default_rng(7041).integers(1, 2**63, LIMIT + 1, dtype=np.uint64)


class PieceCache:
    """Piece hash to the piece's ids: an open-addressing table over numpy arrays.

    Starts small, doubles as pieces come, and starts afresh beyond ``most`` pieces (or the
    pieces of one slice, if they are more), so its memory follows the text and is bounded.
    """

    def __init__(self, most: int = 1 << 19, first: int = 1 << 14):
        self.most, self.first = most, first
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(4 * self.first, np.uint64)  # steps wrap by a mask
        self.slot_piece = np.zeros(4 * self.first, np.int32)
        self.begins = np.zeros(self.first, np.int64)
        self.counts = np.zeros(self.first, np.int32)
        self.ids = np.zeros(4 * self.first, np.uint32)
        self.n_pieces = self.n_ids = 0

    def _grow(self, pieces: int) -> None:
        """Room for so many pieces, with at most half of the table in use."""
        size = len(self.begins)
        while size < pieces:
            size *= 2
        if size == len(self.begins):
            return
        used = np.flatnonzero(self.keys)
        keys, own = self.keys[used], self.slot_piece[used]
        more = size - len(self.begins)
        self.begins = np.concatenate([self.begins, np.zeros(more, np.int64)])
        self.counts = np.concatenate([self.counts, np.zeros(more, np.int32)])
        self.keys = np.zeros(2 * size, np.uint64)
        self.slot_piece = np.zeros(2 * size, np.int32)
        self._place(keys, own)

    def _slots(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes >> np.uint64(20)).astype(np.int64) & (len(self.keys) - 1)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The piece numbers, or -1."""
        out = np.full(len(hashes), -1, np.int32)
        wanted, slots = np.arange(len(hashes)), self._slots(hashes)
        while len(wanted):
            keys = self.keys[slots]
            hit = keys == hashes[wanted]
            out[wanted[hit]] = self.slot_piece[slots[hit]]
            going = ~hit & (keys != 0)
            wanted, slots = wanted[going], (slots[going] + 1) & (len(self.keys) - 1)
        return out

    def add(self, hashes: np.ndarray, counts: np.ndarray, ids: np.ndarray) -> None:
        """New distinct pieces with their numbers of ids and these, end to end."""
        self._grow(self.n_pieces + len(counts))
        total = len(ids)
        while self.n_ids + total > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ids[self.n_ids : self.n_ids + total] = ids
        own = np.arange(self.n_pieces, self.n_pieces + len(counts))
        self.begins[own] = self.n_ids + np.cumsum(counts) - counts
        self.counts[own] = counts
        self.n_pieces += len(counts)
        self.n_ids += total
        self._place(hashes, own)

    def _place(self, hashes: np.ndarray, own: np.ndarray) -> None:
        slots = self._slots(hashes)
        while len(own):
            free = self.keys[slots] == 0
            self.keys[slots[free]] = hashes[free]
            placed = free & (self.keys[slots] == hashes)
            self.slot_piece[slots[placed]] = own[placed]
            left = ~placed
            own, hashes = own[left], hashes[left]
            slots = (slots[left] + 1) & (len(self.keys) - 1)


class PieceTokenizer:
    """A tokenizer file and the way it cuts texts into pieces.

    ``spaced``: byte-level pieces that keep one leading space. ``plain``: lower-cased words
    without white space, digits one by one. Other files are served by the library alone.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            config = json.load(file)
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.vocabulary = self.tokenizer.get_vocab_size()
        cut, normal = config["pre_tokenizer"] or {}, config["normalizer"] or {}
        steps = [x["type"] for x in normal.get("normalizers", [])]
        self.kind = ""
        if cut.get("type") == "ByteLevel" and cut["use_regex"] and not cut["add_prefix_space"] and not normal:
            self.kind = "spaced"
        elif cut.get("type") == "Sequence" and steps == ["NFC", "Replace", "Lowercase"]:
            first = cut["pretokenizers"][0]
            if first["type"] == "Split" and first["pattern"]["Regex"] == PLAIN_CUT and first["invert"]:
                self.kind = "plain"
        vocab, suffix = self.tokenizer.get_vocab(), config["model"].get("end_of_word_suffix")
        #: Whether an id opens (``spaced``) or closes (``plain``) a piece in joined pieces.
        self.edge = np.zeros(max(vocab.values(), default=0) + 1, bool)
        self.line_end = vocab.get(LINE_END, -1)
        if self.kind == "spaced":
            self.edge[[i for token, i in vocab.items() if token.startswith((SPACE_BYTE, LINE_END))]] = True
        elif suffix:
            self.edge[[i for token, i in vocab.items() if token.endswith(suffix)]] = True
        self.cache = PieceCache()

    def encode(self, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, offsets of len + 1) of the column ``text``."""
        data, offsets = W.flat(batch.column(batch.schema.get_field_index("text")))
        raw = data.tobytes()
        code = np.frombuffer(raw.decode("utf-8").encode("utf-32-le"), np.uint32)
        at = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets]
        code = np.minimum(code, LIMIT)
        odd = ~SIMPLE[code]
        odd[:-1] |= (code[:-1] == 60) & (code[1:] == 124)
        whole = np.full(len(at) - 1, not self.kind)
        if self.kind and odd.any():
            whole = np.diff(np.concatenate([[0], np.cumsum(odd)])[at]) > 0
        if not whole.any():
            return self._pieces(code, at)
        simple = np.flatnonzero(~whole)
        keep = np.repeat(~whole, np.diff(at))
        ids, first = self._pieces(code[keep], np.concatenate([[0], np.cumsum(np.diff(at)[simple])]))
        parts: list[np.ndarray] = [np.zeros(0, np.uint32)] * len(whole)
        for i, text in enumerate(simple):
            parts[text] = ids[first[i] : first[i + 1]]
        for i in np.flatnonzero(whole):
            text = raw[offsets[i] : offsets[i + 1]].decode("utf-8")
            parts[i] = np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)
        return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])

    def _pieces(self, code: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(code):
            return np.zeros(0, np.uint32), np.zeros(len(at), np.int64)
        if self.kind == "plain":
            code = LOWER[code]
        begins, ends = piece_spans(code, at, self.kind)
        hashes = _hash(code, begins, ends)
        found = self.cache.find(hashes)
        new = np.flatnonzero(found < 0)
        if len(new):
            fresh, first = np.unique(hashes[new], return_index=True)
            if self.cache.n_pieces + len(fresh) > self.cache.most:
                self.cache.clear()
                fresh, first = np.unique(hashes, return_index=True)
                new = np.arange(len(hashes))
            places = new[first]
            blank = CLASS[code[ends[places] - 1]] == SPACE
            for some, encoded in ((~blank, self._joined), (blank, self._single)):
                own = places[some]
                if len(own):
                    self.cache.add(fresh[some], *encoded(code, begins[own], ends[own]))
            found[new] = self.cache.find(hashes[new])
        counts = self.cache.counts[found].astype(np.int64)
        stops = np.cumsum(counts)
        shift = self.cache.begins[found] - (stops - counts)
        ids = self.cache.ids[np.repeat(shift, counts) + np.arange(int(stops[-1]) if len(stops) else 0)]
        return ids, np.concatenate([[0], stops])[np.searchsorted(begins, at)]

    def _single(self, code: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(numbers of ids, all ids end to end) of pieces, each a text for the library."""
        text = code.astype("<u4").tobytes().decode("utf-32-le")
        strings = [text[a:b] for a, b in zip(begins.tolist(), ends.tolist(), strict=True)]
        ids: list[list[int]] = []
        for at_once in range(0, len(strings), ENCODE):  # an encoding holds much besides its ids
            some = strings[at_once : at_once + ENCODE]
            ids += (e.ids for e in self.tokenizer.encode_batch_fast(some, add_special_tokens=False))
        counts = np.array([len(x) for x in ids], np.int64)
        return counts, np.concatenate([np.asarray(x, np.uint32) for x in ids])

    def _joined(self, code: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same as ``_single`` of pieces that do not end in white space, many in one text.

        The library cuts before a space and on both sides of a line end, so pieces may follow
        each other, those without a leading space after a line end. Their ids are told apart
        by the vocabulary; a text whose ids do not come out as its pieces is encoded piece by piece.
        """
        all_counts, all_ids = [], []
        for at_once in range(0, len(begins), ENCODE):
            begin, end = begins[at_once : at_once + ENCODE], ends[at_once : at_once + ENCODE]
            apart = code[begin] != 32
            size = end - begin + apart
            at = np.cumsum(size) - size
            line = code[np.repeat(begin - apart - at, size) + np.arange(int(size.sum()))]
            line[at[apart]] = 10
            text = line.astype("<u4").tobytes().decode("utf-32-le")
            ids = np.asarray(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)
            edges = np.flatnonzero(self.edge[ids])
            if self.kind == "spaced":
                whole = len(edges) == len(begin) and edges[0] == 0 and np.array_equal(ids[edges] == self.line_end, apart)
                if whole:
                    counts = np.diff(edges, append=len(ids)) - apart
                    ids = np.delete(ids, edges[apart])
            else:
                whole = len(edges) == len(begin) and edges[-1] == len(ids) - 1
                if whole:
                    counts = np.diff(edges, prepend=-1)
            if not whole:
                counts, ids = self._single(code, begin, end)
            all_counts.append(counts)
            all_ids.append(ids)
        return np.concatenate(all_counts), np.concatenate(all_ids)


#: Fixed value: the cut of the ``plain`` tokenizer files.
PLAIN_CUT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Endings that stand as pieces of their own after an apostrophe.
SHORT_ENDINGS, LONG_ENDINGS = "stmd", ("re", "ve", "ll")


def piece_spans(code: np.ndarray, at: np.ndarray, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of the pieces of texts laid end to end (``at``: their offsets)."""
    n = len(code)
    klass = CLASS[code]
    space = klass == SPACE
    edge = np.zeros(n + 1, bool)
    edge[at] = True
    text_start, text_end = edge[:n], edge[1:]
    before = np.concatenate([[SPACE], klass[:-1]])
    changes = (klass != before) | text_start
    if kind == "plain":
        begin = (changes | (klass == NUMBER)) & ~space
    else:
        after_space = np.concatenate([[False], space[:-1]]) & ~text_start
        joined = after_space & np.concatenate([[False], code[:-1] == 32])
        last_space = space & ~text_end & ~np.concatenate([space[1:], [True]])
        begin = np.where(space, changes | last_space, changes & ~joined)
    begin = begin.astype(bool)
    quotes = np.flatnonzero((code == 39) & begin & ~text_end)
    if len(quotes):
        next_code = code[quotes + 1]
        brief = quotes[np.isin(next_code, [ord(c) for c in SHORT_ENDINGS])]
        begin[brief + 1] = False
        begin[brief[brief + 2 < n] + 2] = True
        two = quotes[~text_end[quotes + 1]]
        two = two[two + 2 < n]
        for a, b in LONG_ENDINGS:
            pair = two[(code[two + 1] == ord(a)) & (code[two + 2] == ord(b))]
            begin[pair + 1] = False
            begin[pair[pair + 3 < n] + 3] = True
        if kind == "plain":
            begin &= ~space
    begins = np.flatnonzero(begin)
    if kind == "plain":
        stop = np.concatenate([space, [True]]) | edge
        stop[begins] = True
        stops = np.flatnonzero(stop)
        ends = stops[np.searchsorted(stops, begins, "right")]
    else:
        ends = np.append(begins[1:], n)
    return begins, ends


def _hash(code: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    up, down = W.powers(len(code) + 1)
    sums = np.empty(len(code) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(VALUE[code] * up[: len(code)], out=sums[1:])
    value = (sums[ends] - sums[begins]) * down[begins]
    return W.mixed(value + (ends - begins).astype(np.uint64) * W.SHINGLE[14]) | np.uint64(1)


@lru_cache(maxsize=4)
def piece_tokenizer(path: str) -> PieceTokenizer:
    """One for each file in a worker; it lives as long as the worker is used again."""
    return PieceTokenizer(path)


def token_rows(
    docs: DataFrame, path: str, end_id: int, purpose: str, vector=None, group: Column | None = None
) -> DataFrame:
    """Stored rows (uid, doc_id, n, ids, key, group): the ids of every whole text, then the end id.

    ``ids`` are little-endian numbers of 2 bytes where the vocabulary allows, else 4.
    ``vector`` maps (ids, offsets) to one long for each text, returned as ``key``; ``group``
    is a whole number of the row, passed on (0 where null or not given).
    """
    kind = "<u2" if Tokenizer.from_file(path).get_vocab_size() < 2**16 and end_id < 2**16 else "<u4"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = piece_tokenizer(path)
        for whole in batches:
            for batch in W.slices(whole):
                ids, first = tokenizer.encode(batch)
                keys = np.zeros(len(first) - 1, np.int64) if vector is None else vector(ids, first)
                coded = np.insert(ids, first[1:], end_id).astype(kind)
                first = first + np.arange(len(first))
                width = coded.itemsize
                column = pa.Array.from_buffers(
                    pa.large_binary(), len(first) - 1,
                    [None, pa.py_buffer((first * width).astype(np.int64)), pa.py_buffer(coded)],
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        pa.array(np.diff(first), pa.int64()),
                        column.cast(pa.binary()),
                        pa.array(keys, pa.int64()),
                        batch.column(2),
                    ],
                    ["doc_id", "n", "ids", "key", "group"],
                )

    group = F.lit(0) if group is None else F.coalesce(group, F.lit(0))
    rows = texts(docs, group.cast("long").alias("group")).mapInArrow(
        W.steady(run), "doc_id long, n long, ids binary, key long, group long"
    )
    return stored(rows.withColumn("uid", F.monotonically_increasing_id()), purpose)


def ids_of(blob: np.ndarray, n: np.ndarray, total: int) -> np.ndarray:
    """The numbers in the joined ``ids`` of rows with together ``n`` ids, as 4-byte numbers."""
    width = len(blob) // total if total else 2
    return blob.view(f"<u{width}").astype("<u4")
