"""Near-duplicates by SuperMinHash, banding, verification on full sets and union-find.

A document's set holds its distinct five-word shingles. Documents whose sets have a Jaccard
similarity of at least 0.75 are linked; groups are the connected components.

- **Signature** (SuperMinHash): element e draws in round j a fraction r and a place among
  the slots that its own random permutation has not used; the slot takes the smallest
  j + r. Ranks of one element are thus correlated (each slot gets exactly one of them),
  which lowers the variance. A document stops after the first round in which all its slots
  are filled, since later rounds can only bring larger values.
- **Classes**: texts with one and the same set are one node from here on, whatever their
  number, so copies are never compared. Nodes are numbers of sets, not doc_ids: a doc_id
  with several texts belongs to several nodes, which only the last step ties together.
- **Banding**: 32 bands of 4 slots. A pair at 0.75 shares no band with a chance below 1e-5.
- **Candidates** without all pairs of a bucket: buckets of two are one pair; elsewhere every
  node first meets the smallest node of its buckets; then, in buckets whose members are not
  yet one component, one random pivot meets the members of the other components, for some
  rounds. What is still open is closed exactly: the nodes outside a bucket's largest
  component are compared with its other members in blocks of bounded size on both sides,
  which report one link to each component and no other pairs. A pair of one bucket thus ends
  up in one component or is compared.
- **Verification**: pairs whose signatures agree in under half of the slots are dropped
  (more than six standard deviations below 0.75), the others are confirmed on the full sets.
- **Grouping**: union-find inside each partition of links, then star steps between them;
  later rounds see only the components that new links join, not the links found before.

No step gathers a bucket, a class or a component in one task: minima are combined on the
map side and the joins split where one key holds much of the rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm import words as W
from tradewind.llm.common import components, id_out, maybe_in, stored, texts

SLOTS, ROWS, WIDTH = 128, 4, 5
PIVOT_ROUNDS = 1
#: Most outer nodes and members (on average) that a closing block compares.
BLOCK_OUTER, BLOCK_MEMBERS = 1024, 4096
AGREE = SLOTS // 2
#: Elements whose permutations are held at a time.
RUN = 1 << 16
EMPTY = np.uint64(2**64 - 1)
STEP = np.uint64(0x9E3779B97F4A7C15)


def superminhash(elements: np.ndarray, text: np.ndarray, n_texts: int, slots: int = SLOTS) -> np.ndarray:
    """Signatures (n_texts, slots) of distinct element hashes, each with the index of its text.

    Elements go in runs of a bounded number; the least value of a slot over the runs is its
    value over all elements.
    """
    out = np.full((n_texts, slots), EMPTY, np.uint64)
    for at in range(0, len(elements), RUN):
        some = slice(at, at + RUN)
        first, last = int(text[some][0]), int(text[some][-1]) + 1
        own = _superminhash(elements[some], text[some] - first, last - first, slots)
        np.minimum(out[first:last], own, out=out[first:last])
    return out


def _superminhash(elements: np.ndarray, text: np.ndarray, n_texts: int, slots: int) -> np.ndarray:
    out = np.full(n_texts * slots, EMPTY, np.uint64)
    free = np.tile(np.arange(slots, dtype=np.uint8), (len(elements), 1))
    for j in range(slots):
        if not len(elements):
            break
        draw = W.mixed(elements + np.uint64(int(STEP) * (j + 1) % 2**64))
        place = j + (((draw & np.uint64(0xFFFFFFFF)) * np.uint64(slots - j)) >> np.uint64(32)).astype(np.int64)
        rows = np.arange(len(elements))
        slot = free[rows, place].astype(np.int64)
        free[rows, place] = free[rows, j]
        value = np.uint64(j << 32) | (draw >> np.uint64(32))
        at = text * slots + slot
        unset = out[at] == EMPTY  # what an earlier round has set is smaller than j
        np.minimum.at(out, at[unset], value[unset])
        open_text = (out.reshape(n_texts, slots) == EMPTY).any(axis=1)
        going = open_text[text]
        if not going.all():
            elements, text, free = elements[going], text[going], free[going]
    return out.reshape(n_texts, slots)


def shingle_sets(batch: pa.RecordBatch) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text of a batch."""
    data, offsets = W.flat(batch.column(batch.schema.get_field_index("text")))
    data = W.lowered(data)
    starts, ends, first = W.word_spans(data, offsets)
    hashes, begin = W.shingle_hashes(W.spans_hash(data, starts, ends), first, WIDTH)
    return [np.unique(hashes[a:b]) for a, b in zip(begin[:-1], begin[1:], strict=True)]


def _keys(sets: list[np.ndarray]) -> pa.Array:
    """128-bit hashes of whole sets."""
    keys = [
        np.array([W.mixed(s).sum(dtype=np.uint64), W.mixed(s ^ STEP).sum(dtype=np.uint64)]).tobytes()
        for s in sets
    ]
    return pa.array(keys, pa.binary())


SIGNED = "doc_id long, h long, sha string, n int, key binary, bands array<long>, signature binary"


@W.steady
def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    salt = W.mixed(np.arange(1, SLOTS // ROWS + 1, dtype=np.uint64))
    for whole in batches:
        for batch in W.slices(whole):
            sets = shingle_sets(batch)
            sizes = np.array([len(s) for s in sets])
            elements = np.concatenate(sets)
            text = np.repeat(np.arange(len(sets)), sizes)
            signs = superminhash(elements, text, len(sets))
            bands = salt + np.zeros((len(sets), 1), np.uint64)
            for r in range(ROWS):
                bands = W.mixed(bands * STEP + signs[:, r::ROWS])
            shas = [hashlib.sha256(t.as_buffer()).hexdigest() for t in pc.ascii_lower(batch.column(1))]
            short = (W.mixed(signs) >> np.uint64(48)).astype("<u2")
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(2),
                    pa.array(shas, pa.string()),
                    pa.array(sizes, pa.int32()),
                    _keys(sets),
                    pa.array(list(bands.view(np.int64)), pa.list_(pa.int64())),
                    pa.array([s.tobytes() for s in short], pa.binary()),
                ],
                ["doc_id", "h", "sha", "n", "key", "bands", "signature"],
            )


@W.steady
def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in W.slices(whole):
            sets = shingle_sets(batch)
            yield pa.RecordBatch.from_arrays(
                [_keys(sets), pa.array([s.tobytes() for s in sets], pa.binary())], ["key", "elements"]
            )


@W.steady
def _agreeing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keep pairs (a, b, ca, cb, x, y) whose signatures x and y agree in enough slots."""
    for batch in batches:
        if batch.num_rows:
            x, y = (
                W.flat(batch.column(i))[0].reshape(batch.num_rows, 2 * SLOTS).view("<u2")
                for i in (4, 5)
            )
            mask = pa.array((x == y).sum(axis=1) >= AGREE)
            yield batch.select([0, 1, 2, 3]).filter(mask)


def _confirmed(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for x, y in zip(batch.column(4), batch.column(5), strict=True):
                x = np.frombuffer(x.as_buffer(), np.uint64)
                y = np.frombuffer(y.as_buffer(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                linked.append(100 * both >= percent * (len(x) + len(y) - both))
            links = batch.select([2, 3]).filter(pa.array(linked, pa.bool_()))
            yield links.rename_columns(["a", "b"])

    return W.steady(run)


#: Two nodes, and the components they are in.
PAIR = ["a", "b", "ca", "cb"]
PAIR_DDL = "a long, b long, ca long, cb long"


def _joined(pairs: DataFrame, values: DataFrame, value: str) -> DataFrame:
    """Pairs (a, b) of nodes with their components and each side's value: a, b, ca, cb, x, y."""
    left = values.select(F.col("node").alias("a"), F.col(value).alias("x"))
    right = values.select(F.col("node").alias("b"), F.col(value).alias("y"))
    # b is often one node of very many pairs: it is joined while the rows are narrow.
    return pairs.join(right, "b").join(left, "a").select(*PAIR, "x", "y")


@W.steady
def _forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Union-find over the links of one partition: one edge from each node to its root."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        top = x
        while root.setdefault(top, top) != top:
            top = root[top]
        while root[x] != top:
            root[x], x = top, root[x]
        return top

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    out = [(x, find(x)) for x in list(root)]
    yield pa.RecordBatch.from_arrays(
        [pa.array([x for x, _ in out], pa.int64()), pa.array([y for _, y in out], pa.int64())],
        ["a", "b"],
    )


def text_groups(docs: DataFrame, percent: int = 75) -> DataFrame:
    """Stored rows (doc_id, sha, n, group): the group of each row's text, null without words.

    Texts are grouped by what they hold alone, whatever their doc_id. ``sha`` is the SHA-256
    of the text with A-Z lower-cased, so (doc_id, sha) tells an id's texts apart.
    """
    rows = texts(docs, F.xxhash64("text").alias("h"))
    signed = stored(rows.mapInArrow(_signed, SIGNED), "near-signed")
    full = signed.where("n > 0")
    # Numbered once and stored, so a number stands for one set in all that follows.
    first_row = F.struct("doc_id", "h")
    heads = full.groupBy("key").agg(
        F.min(first_row).alias("row"), F.min_by(F.struct("n", "bands", "signature"), first_row).alias("of")
    )
    heads = heads.withColumn("node", F.monotonically_increasing_id()).select("node", "key", "row.*", "of.*")
    heads = stored(heads, "near-heads")
    bands = heads.select("node", "n", F.explode("bands").alias("band"))
    # Stored, so that the join has two plain shuffles and a hot bucket's members can be split.
    buckets = stored(
        bands.groupBy("band")
        .agg(F.min("node").alias("low"), F.max("node").alias("high"), F.count("*").alias("m"))
        .where("low < high"),
        "near-buckets",
    )
    members = stored(bands.join(buckets, "band").select("band", "node", "n", "low", "m"), "near-members")
    wanted = heads.select("key", "node", "doc_id", "h").join(members.select("node").distinct(), "node")
    sets = stored(
        maybe_in(rows, F.xxhash64("doc_id", "h"), wanted, F.xxhash64("doc_id", "h"))
        .mapInArrow(_sets, "key binary, elements binary")
        .join(wanted.select("key", "node"), "key")
        .select("node", "elements")
        .dropDuplicates(["node"]),
        "near-sets",
    )

    def joined(pairs: DataFrame) -> DataFrame:
        """(node, component) of the components that confirmed pairs join."""
        likely = _joined(pairs, heads, "signature").mapInArrow(_agreeing, PAIR_DDL)
        links = _joined(likely, sets, "elements").mapInArrow(_confirmed(percent), "a long, b long")
        links = stored(links, "near-links").mapInArrow(_forests, "a long, b long")
        return stored(components(links, "near"), "near-joined")

    twos = members.where("m = 2 AND node > low").select(F.col("node").alias("a"), F.col("low").alias("b"))
    left = members.where("m > 2").select("band", "node", "n", F.col("node").alias("c"))
    first = members.where("m > 2").groupBy("node").agg(F.min("low").alias("b")).where("b < node")
    pairs = first.select(F.col("node").alias("a"), "b").unionByName(twos).distinct()
    groups = joined(pairs.select("a", "b", F.col("a").alias("ca"), F.col("b").alias("cb")))
    moved = groups
    for turn in range(PIVOT_ROUNDS + 1):
        left = _open_members(left, moved)
        if left.isEmpty():
            break
        pairs = _pivot_pairs(left, turn, percent) if turn < PIVOT_ROUNDS else _closing_pairs(left, sets, percent)
        moved = joined(pairs)
        groups = _regrouped(groups, moved)

    named = heads.select("key", "node").join(groups, "node", "left").select(
        "key", F.coalesce("component", "node").alias("group")
    )
    own = signed.select("doc_id", "sha", "n", F.when(F.col("n") > 0, F.col("key")).alias("key"))
    return stored(own.join(named, "key", "left").select("doc_id", "sha", "n", "group"), "near-named")


def near_duplicates(docs: DataFrame, percent: int = 75) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of docs.

    A text of fewer than five words has its whole word sequence as its only shingle; a text
    without words (or null) has an empty set, is linked with nothing and is kept. Equal
    sets are one class; ``component_id`` is the smallest doc_id reachable. Rows that repeat
    a doc_id (null is one, too) are one node: all their texts' links count for it, and each
    row is returned.
    """
    rows = text_groups(docs, percent)
    ids = stored(rows.where("n > 0").select("doc_id", "group").distinct(), "near-ids")
    several = ids.groupBy("doc_id").agg(F.min("group").alias("low"), F.max("group").alias("high")).where("low < high")
    ties = stored(
        ids.join(several, "doc_id").where("group > low").select(F.col("group").alias("a"), F.col("low").alias("b")), "near-ties"
    )
    tied = ids.withColumnRenamed("group", "tied")
    if not ties.isEmpty():  # an id in two groups makes them one
        into = components(ties, "near-ties").select(F.col("node").alias("tied"), F.col("component").alias("into"))
        tied = tied.join(into, "tied", "left").select("doc_id", F.coalesce("into", "tied").alias("tied")).distinct()
    lows = tied.groupBy("tied").agg(F.min("doc_id").alias("component"))
    by_id = tied.join(lows, "tied").select("doc_id", "component")
    return (
        rows.join(by_id, "doc_id", "left")
        .withColumn("component", F.coalesce("component", "doc_id"))
        .select(
            id_out("doc_id").alias("doc_id"),
            F.col("n").cast("long").alias("n_shingles"),
            id_out("component").alias("component_id"),
            (F.col("doc_id") == F.col("component")).alias("kept"),
        )
    )


def _regrouped(groups: DataFrame, joined: DataFrame) -> DataFrame:
    """Groups (node, component) after their components were joined."""
    moved = joined.select(F.col("node").alias("component"), F.col("component").alias("into"))
    old = groups.join(moved, "component", "left").select("node", F.coalesce("into", "component").alias("component"))
    return stored(old.unionByName(joined.join(groups, "node", "left_anti")), "near-groups")


def _open_members(members: DataFrame, moved: DataFrame) -> DataFrame:
    """Members (band, node, n, c) of buckets that hold more than one component, after the
    components ``moved`` (node, component) were joined."""
    into = moved.select(F.col("node").alias("c"), F.col("component").alias("into"))
    labelled = members.join(into, "c", "left").select("band", "node", "n", F.coalesce("into", "c").alias("c"))
    several = labelled.groupBy("band").agg(F.min("c").alias("low"), F.max("c").alias("high"))
    several = stored(several.where("low < high").select("band"), "near-several")
    return stored(labelled.join(several, "band"), "near-open")


def _fits(left: str, right: str, percent: int) -> str:
    """Set sizes that allow the similarity."""
    return f"100 * least({left}, {right}) >= {percent} * greatest({left}, {right})"


def _pivot_pairs(members: DataFrame, turn: int, percent: int) -> DataFrame:
    pivots = members.groupBy("band").agg(
        F.min(F.struct(F.xxhash64(F.lit(turn), "node").alias("h"), "node", "n", "c")).alias("p")
    )
    pivots = stored(pivots, "near-pivots")
    return (
        members.join(pivots, "band")
        .where((F.col("c") != F.col("p.c")) & F.expr(_fits("n", "p.n", percent)))
        .select(F.col("node").alias("a"), F.col("p.node").alias("b"), F.col("c").alias("ca"), F.col("p.c").alias("cb"))
        .distinct()
    )


def _shortened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sets of the upper 32 bits of their elements: enough to find the likely links."""
    for batch in batches:
        short = [
            (np.frombuffer(x.as_buffer(), np.uint64) >> np.uint64(32)).astype(np.uint32).tobytes()
            for x in batch.column(1)
        ]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(short, pa.binary())], ["node", "short"])


def _closing_pairs(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """For the nodes outside a bucket's largest component: a likely link to each component
    of the bucket that they have one to."""
    shares = members.groupBy("band", "c").agg(F.count("*").alias("m"))
    bands = shares.groupBy("band").agg(F.max(F.struct("m", "c")).alias("most"), F.sum("m").alias("m")).select(
        "band", F.col("most.c").alias("main"),
        F.ceil((F.col("m") - F.col("most.m")) / BLOCK_OUTER).cast("int").alias("outer_blocks"),
        F.ceil(F.col("m") / BLOCK_MEMBERS).cast("int").alias("member_blocks"),
    )
    marked = members.join(bands, "band").withColumn("h", F.xxhash64("node"))
    here = F.pmod("h", F.col("outer_blocks")), F.pmod("h", F.col("member_blocks"))
    every = tuple(F.explode(F.sequence(F.lit(0), F.col(c) - 1)) for c in ("outer_blocks", "member_blocks"))
    outer = marked.where("c <> main").withColumn("i", here[0].cast("int")).withColumn("j", every[1])
    member = marked.withColumn("j", here[1].cast("int")).withColumn("i", every[0])
    rows = outer.select("band", "i", "j", "node", "n", "c", F.lit(True).alias("is_outer")).unionByName(
        member.select("band", "i", "j", "node", "n", "c", F.lit(False).alias("is_outer"))
    )
    short = sets.mapInArrow(_shortened, "node long, short binary")
    return (
        rows.join(short, "node").groupBy("band", "i", "j").applyInArrow(_block_links(percent), PAIR_DDL).distinct()
    )


def _block_links(percent: int, most: int = 4_000_000):
    """One block's outer nodes against its members, in slices of at most so many matches."""

    def run(block: pa.Table) -> pa.Table:
        is_outer = block["is_outer"].to_numpy()
        node, size, c = (block[k].to_numpy() for k in ("node", "n", "c"))
        held = [np.frombuffer(x.as_buffer(), np.uint32) for x in block["short"]]
        x, m = np.flatnonzero(is_outer), np.flatnonzero(~is_outer)
        pairs = []
        if len(x) and len(m):
            elements = np.concatenate([held[i] for i in x])
            owner = np.repeat(np.arange(len(x)), [len(held[i]) for i in x])
            order = np.argsort(elements, kind="stable")
            elements, owner = elements[order], owner[order]
            at = 0
            while at < len(m):
                end, matches, hits = at, 0, []
                while end < len(m) and (end == at or (matches < most and (end - at) * len(x) < most)):
                    low = np.searchsorted(elements, held[m[end]], "left")
                    many = np.searchsorted(elements, held[m[end]], "right") - low
                    total = int(many.sum())
                    place = np.repeat(low - (np.cumsum(many) - many), many) + np.arange(total)
                    hits.append(owner[place] + (end - at) * len(x))
                    matches, end = matches + total, end + 1
                own = m[at:end]
                both = np.bincount(np.concatenate(hits), minlength=len(own) * len(x)).reshape(len(own), len(x))
                union = size[own][:, None] + size[x][None, :] - both
                good = (100 * both >= percent * union) & (c[own][:, None] != c[x][None, :])
                i, j = np.nonzero(good)
                ratio = both[i, j] / union[i, j]
                best = np.lexsort((-ratio, c[own[i]], j))  # one for each outer node and component
                i, j = i[best], j[best]
                new = np.ones(len(i), bool)
                new[1:] = (j[1:] != j[:-1]) | (c[own[i[1:]]] != c[own[i[:-1]]])
                one, two = own[i[new]], x[j[new]]
                pairs.append(np.stack([node[one], node[two], c[one], c[two]]))
                at = end
        found = np.concatenate([np.zeros((4, 0), np.int64), *pairs], axis=1)
        return pa.table(dict(zip(PAIR, found, strict=True)))

    return run
