"""Repair of damaged conversations by a cheapest series of edits.

Rows of a conversation are kept, given another role or deleted, and empty rows are put
between them, until the initials of the roles read ``(s?(ua)+)?``. The cheapest edits win; of
equally cheap ones those whose initials (K, R, D, I in order) come first as ASCII text.

- **Scalar weights**: a path through the DAG of (row, state) is one whole number. Its high
  digits carry the cost; its low digits, of fixed width, hold the letters by their place, the
  first letter highest, with zeros behind the last. The ordinary minimum of whole numbers
  thus decides cost and ties at once. An edge adds its cost and its letter's digit. Two paths
  to a node that cost the same never have letters of which one list begins the other (equal
  letters for the rows mean equal costs, and each further letter is a paid insertion), so the
  smaller number stays the smaller one whatever follows.
- **Bounded memory**: rows of a conversation come in order and are not held. Each of the
  four states keeps its number and the running hash of its repaired text. When the low
  digits are full, the letters that all states share are moved out to the audit (they are
  decided), or the digits are widened.
- A conversation is one pass of one task, as its digest is one sequential hash; nothing else
  is: faults are found by windows that stream over sorted rows, and sorting spills.

Odd cases: a null conv_id is a conversation of its own; a null role or text is one space, a
null turn sorts first; rows that tie in their turn are ordered by role and text hash (the
repeats of a row stay side by side); an empty or blank text must be deleted; texts may be
of any length; a conversation whose rows are all gone has zeros, an empty audit and the
hash of nothing; an empty table has no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SPACE = " \t\n\x0b\x0c\r"
ENDS = (".", "!", "?")
#: Digits of the letters in ASCII order; zero ends a list.
DIGIT = {"D": 1, "I": 2, "K": 3, "R": 4}
LETTERS = {digit: letter for letter, digit in DIGIT.items()}
BITS = 3
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: What the initials so far are: nothing, s, ending in u, ending in a.
START, SYSTEM, USER, ASSISTANT = range(4)
FINAL = (START, ASSISTANT)
NAMES = {USER: "user", ASSISTANT: "assistant"}
#: Where a row of an initial leads.
AFTER = {
    "s": {START: SYSTEM},
    "u": {START: USER, SYSTEM: USER, ASSISTANT: USER},
    "a": {USER: ASSISTANT},
}
LEGAL_PAIRS = ("su", "ua", "au")
WIDTH = 64


class Path:
    """The least path to a state: its number, how many letters it has, its text's hash."""

    __slots__ = ("number", "letters", "digest", "lines")

    def __init__(self, number: int, letters: int, digest, lines: int):
        self.number, self.letters, self.digest, self.lines = number, letters, digest, lines


class Repair:
    """One conversation's DP: ``row`` for each row in order, then ``result``."""

    def __init__(self, width: int = WIDTH):
        self.width = width
        self.audit: list[str] = []
        self.paths: dict[int, Path] = {START: Path(0, 0, hashlib.sha256(), 0)}
        self._insert()

    def _edge(self, path: Path, cost: int, letter: str) -> int:
        place = self.width - 1 - path.letters
        return path.number + (cost << BITS * self.width) + (DIGIT[letter] << BITS * place)

    def _insert(self) -> None:
        """Insertions before the next row: each round may add one row to the best paths."""
        changed = True
        while changed:
            changed = False
            for state in list(self.paths):
                for initial, name in (("u", "user"), ("a", "assistant")):
                    to = AFTER[initial].get(state)
                    if to is None:
                        continue
                    path = self.paths[state]
                    self._room(path)
                    number = self._edge(path, INSERT, "I")
                    if to not in self.paths or number < self.paths[to].number:
                        self.paths[to] = self._stepped(path, number, f"{name}:".encode())
                        changed = True

    @staticmethod
    def _stepped(path: Path, number: int, line: bytes | None) -> Path:
        if line is None:
            return Path(number, path.letters + 1, path.digest, path.lines)
        digest = path.digest.copy()
        if path.lines:
            digest.update(b"\n")
        digest.update(line)
        return Path(number, path.letters + 1, digest, path.lines + 1)

    def _room(self, path: Path) -> None:
        """Make place for one more letter after a path's."""
        if path.letters < self.width:
            return
        low = (1 << BITS * self.width) - 1
        paths = list(self.paths.values())
        first, apart = paths[0].number & low, 0
        for p in paths[1:]:
            apart |= first ^ (p.number & low)
        # Letters that all paths begin with are decided.
        shared = min(*(p.letters for p in paths), (BITS * self.width - apart.bit_length()) // BITS)
        if shared:
            for k in range(shared):
                self.audit.append(LETTERS[(first >> BITS * (self.width - 1 - k)) & (2**BITS - 1)])
            for p in paths:
                cost, digits = p.number >> BITS * self.width, p.number & low
                p.number = (cost << BITS * self.width) | ((digits << BITS * shared) & low)
                p.letters -= shared
        if 2 * shared < self.width:
            for p in paths:
                p.number <<= BITS * self.width
            self.width *= 2

    def row(self, role: str, text: str, must_go: bool, truncated: bool) -> None:
        extra = TRUNCATED if truncated else 0
        initial = role[:1]
        for path in list(self.paths.values()):
            self._room(path)
        best: dict[int, tuple[int, Path, bytes | None]] = {}

        def offer(state: int, number: int, path: Path, line: str | None) -> None:
            if state not in best or number < best[state][0]:
                best[state] = number, path, line

        for state, path in self.paths.items():
            offer(state, self._edge(path, DELETE, "D"), path, None)
            if must_go:
                continue
            kept = AFTER.get(initial, {}).get(state)
            if kept is not None:
                offer(kept, self._edge(path, extra, "K"), path, role)
            for new, to in (("u", USER), ("a", ASSISTANT)):
                if state in AFTER[new]:
                    offer(to, self._edge(path, REROLE + extra, "R"), path, NAMES[to])
        self.paths = {
            state: self._stepped(path, number, None if name is None else f"{name}:{text}".encode())
            for state, (number, path, name) in best.items()
        }
        self._insert()
        self._drop_hopeless()

    def _drop_hopeless(self) -> None:
        """Forget states that lose whatever follows, so that the others' letters can be decided.

        What may follow an s may follow an a at the same cost. What may follow nothing may
        follow an a, too, but for a leading s, which costs a deletion there.
        """
        a, one = self.paths[ASSISTANT].number, 1 << BITS * self.width
        if SYSTEM in self.paths and self.paths[SYSTEM].number > a:
            del self.paths[SYSTEM]
        if START in self.paths and self.paths[START].number >= a + (DELETE + 1) * one:
            del self.paths[START]

    def result(self) -> tuple[int, str, str]:
        """(cost, audit, hash of the repaired text)."""
        best = min((self.paths[s] for s in FINAL if s in self.paths), key=lambda p: p.number)
        digits = [(best.number >> BITS * (self.width - 1 - k)) & (2**BITS - 1) for k in range(best.letters)]
        audit = "".join(self.audit) + "".join(LETTERS[d] for d in digits)
        return best.number >> BITS * self.width, audit, best.digest.hexdigest()


def damaged(rows: DataFrame) -> DataFrame:
    """conv, turn, role, text after damage by crc32(conv_id:turn) modulo 20.

    0 drops a row, 1 empties its text, 2 takes its ``[.!?]`` out, 3 repeats it beside itself,
    4 sets its role to user. A dropped row is kept as a mark with ``gone`` set and no text.
    """
    space = F.lit(" ")
    conv, turn = F.col("conv_id").cast("long"), F.col("turn").cast("long")
    fate = F.crc32(F.concat_ws(":", F.coalesce(conv.cast("string"), space), F.coalesce(turn.cast("string"), space))) % 20
    role = F.coalesce(F.col("role").cast("string"), space)
    text = F.coalesce(F.col("text").cast("string"), space)
    copies = F.when(fate == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select(
        conv.alias("conv"), turn.alias("turn"), (fate == 0).alias("gone"),
        F.when(fate == 0, "").when(fate == 4, "user").otherwise(role).alias("role"),
        F.when(fate.isin(0, 1), "").when(fate == 2, F.translate(text, "".join(ENDS), "")).otherwise(text).alias("text"),
        F.explode(copies).alias("copy"),
    ).drop("copy")


def as_is(rows: DataFrame) -> DataFrame:
    """The rows undamaged, in the columns of :func:`damaged`."""
    space = F.lit(" ")
    return rows.select(
        F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"), F.lit(False).alias("gone"),
        F.coalesce(F.col("role").cast("string"), space).alias("role"),
        F.coalesce(F.col("text").cast("string"), space).alias("text"),
    )


REPAIRED = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, "
    "cost long, audit string, repaired_sha256 string"
)
_FIELDS = [f.split()[0] for f in REPAIRED.split(", ")]


class _Conversation:
    """Counts of one conversation's rows, and its repair."""

    def __init__(self, conv: int | None):
        self.conv, self.repair = conv, Repair()
        self.count = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
        self.first = self.last = self.initial = None
        self.turns = 0

    def add(self, turn: int | None, role: str, text: str, repeated: bool) -> None:
        if turn is not None:
            self.first = turn if self.first is None else self.first
            self.turns += turn != self.last
            self.last = turn
        if self.initial is not None and self.initial + role[:1] not in LEGAL_PAIRS:
            self.count["illegal"] += 1
        self.initial = role[:1]
        solid = text.rstrip(SPACE)
        fault = "blank" if not solid else "duplicate" if repeated else "" if solid.endswith(ENDS) else "truncated"
        if fault:
            self.count[fault] += 1
        self.repair.row(role, text, fault in ("blank", "duplicate"), fault == "truncated")

    def row(self) -> tuple:
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.turns
        cost, audit, digest = self.repair.result()
        return (self.conv, gaps, *self.count.values(), cost, audit, digest)


def _repaired(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by conversation and turn to one row a conversation; holds one at a time."""
    done, now = [], None

    def flush() -> pa.RecordBatch:
        columns = list(zip(*done, strict=True)) or [[]] * len(_FIELDS)
        strings = {"audit", "repaired_sha256"}
        arrays = [pa.array(c, pa.string() if f in strings else pa.int64()) for f, c in zip(_FIELDS, columns, strict=True)]
        done.clear()
        return pa.RecordBatch.from_arrays(arrays, _FIELDS)

    for batch in batches:
        columns = (batch.column(i) for i in range(6))
        for conv, turn, gone, role, text, repeated in zip(*columns, strict=True):
            conv = conv.as_py()
            if now is None or conv != now.conv:
                if now is not None:
                    done.append(now.row())
                now = _Conversation(conv)
            if not gone.as_py():
                now.add(turn.as_py(), role.as_py(), text.as_py(), repeated.as_py())
        if len(done) >= 1000:
            yield flush()
    if now is not None:
        done.append(now.row())
    yield flush()


def _in_turn() -> list[Column]:
    return [F.col("turn").asc_nulls_first(), F.col("role"), F.col("sha")]


def repair(rows: DataFrame) -> DataFrame:
    """One row a conversation from (conv, turn, gone, role, text): its faults and repair.

    The first fault of a row counts: blank, duplicate (role and text seen earlier),
    truncated. ``gaps``: turns missing between the least and the greatest.
    """
    rows = rows.withColumn("sha", F.sha2(F.col("text").cast("binary"), 256))
    alike = Window.partitionBy("conv", "gone", "role", "sha").orderBy(F.col("turn").asc_nulls_first())
    rows = rows.repartition("conv").withColumn("repeated", F.row_number().over(alike) > 1)
    # Null first: a conversation's rows stay together, in one task's order.
    rows = rows.sortWithinPartitions(F.col("conv").asc_nulls_first(), *_in_turn(), "repeated")
    return rows.select("conv", "turn", "gone", "role", "text", "repeated").mapInArrow(_repaired, REPAIRED)
