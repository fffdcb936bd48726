"""Document fingerprints from closed syncmers.

A text is a row of words (single characters in scripts that do not space words). Of every
k words in a row, all inner runs of s words are hashed; the k words are an anchor when the
smallest of these hashes belongs to the first or the last run. Whether k words are an
anchor depends on them alone, so an edit moves no anchor elsewhere: what two texts share
keeps its anchors in both.

A fingerprint holds all anchors of a text, each with its place; the likeness of two
fingerprints is the Jaccard similarity of their sets of distinct anchor hashes.

DataFrame operations only. A text is shuffled once (by doc_id); its neighbour receives the
part it needs and its distinct anchor hashes, not the whole text; anchors of the other two
texts are made after the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import id_out, stored, texts

K, S = 5, 2
#: Blocks of scripts that are written without spaces: Thai and Lao, Myanmar, Khmer, kana, Han.
UNSPACED = "\\u0E00-\\u0EFF\\u1000-\\u109F\\u1780-\\u17FF\\u3040-\\u30FF\\u3400-\\u9FFF\\uF900-\\uFAFF"


def word_hashes(text: str) -> Column:
    """Hashes of the lower-cased words, each character of an unspaced script being one."""
    spaced = F.when(
        F.col(text).rlike(f"[{UNSPACED}]"), F.regexp_replace(text, f"([{UNSPACED}])", " $1 ")
    ).otherwise(F.col(text))
    return F.transform(F.array_remove(F.split(F.lower(spaced), r"\s+"), ""), lambda w: F.xxhash64(w))


def _with_runs(df: DataFrame, text: str) -> DataFrame:
    """Add ``_w``, the word hashes, and ``_s``, the hashes of all runs of s words."""
    df = df.withColumn("_w", word_hashes(text))
    runs = F.zip_with("_w", F.slice("_w", F.lit(S), F.size("_w")), lambda a, b: F.xxhash64(a, b))
    return df.withColumn("_s", F.slice(runs, F.lit(1), F.greatest(F.size("_w") - (S - 1), F.lit(0))))


def _windows() -> tuple[Column, list[str]]:
    """All runs of k words as structs of their K - S + 1 inner hashes, and the field names."""
    wide = K - S + 1
    rest = [F.slice("_s", F.lit(i + 1), F.size("_s")) for i in range(1, wide)]
    return F.arrays_zip("_s", *rest), ["_s", *map(str, range(1, wide))]


def _is_anchor(x: Column, names: list[str]) -> Column:
    inner = F.least(*(x[n] for n in names[1:-1]))
    return x[names[-1]].isNotNull() & (F.least(x[names[0]], x[names[-1]]) <= inner)


def with_anchors(df: DataFrame, text: str, name: str) -> DataFrame:
    """Add the anchors of a text column: an array of (hash, at), ``at`` a word number from 0."""
    windows, names = _windows()
    marked = F.transform(
        windows,
        lambda x, i: F.when(
            _is_anchor(x, names), F.struct(F.xxhash64(*(x[n] for n in names)).alias("hash"), i.alias("at"))
        ),
    )
    return _with_runs(df, text).withColumn(name, F.filter(marked, lambda x: x.isNotNull())).drop("_w", "_s")


def with_fingerprint(df: DataFrame, text: str, name: str) -> DataFrame:
    """Add all anchors of a text column in order: an array of (hash, at), hashes of 32 bits.

    A text with words but without anchors has one hash of all its words; a text without
    words has none.
    """
    windows, names = _windows()
    marked = F.transform(
        windows,
        lambda x, i: F.when(
            _is_anchor(x, names), F.struct(_short(*(x[n] for n in names)).alias("hash"), i.alias("at"))
        ),
    )
    df = _with_runs(df, text).withColumn("_a", F.filter(marked, lambda x: x.isNotNull()))
    whole = F.array(F.struct(_short("_w").alias("hash"), F.lit(0).alias("at")))
    own = F.when((F.size("_a") == 0) & (F.size("_w") > 0), whole).otherwise(F.col("_a"))
    return df.withColumn(name, own).drop("_w", "_s", "_a")


def _short(*columns: Column | str) -> Column:
    """The upper 32 bits of the columns' hash."""
    return F.shiftright(F.xxhash64(*columns), 32).cast("int")


def hashes(sketch: str) -> Column:
    """The distinct anchor hashes of a fingerprint."""
    return F.array_distinct(F.col(f"{sketch}.hash"))


def likeness(a: Column, b: Column) -> Column:
    """Of two arrays of distinct hashes, from 0 to 1; two empty ones are alike, an empty and another are not."""
    shared = F.size(F.array_intersect(a, b))
    union = F.size(a) + F.size(b) - shared
    return F.when(union == 0, F.lit(1.0)).otherwise(shared / union)


def as_text(sketch: str) -> Column:
    """Every anchor as 8 hexadecimal digits, a colon and its place."""
    digits = F.transform(
        sketch,
        lambda x: F.concat(
            F.lpad(F.lower(F.hex(x["hash"].cast("long").bitwiseAND(F.lit(2**32 - 1)))), 8, "0"), F.lit(":"), x["at"].cast("string")
        ),
    )
    return F.array_join(digits, " ")


def _ring(docs: DataFrame) -> DataFrame:
    """(doc_id, before_id, need, chosen): each id with the id that comes before it in
    descending order (the first comes after the last), and the characters that one needs.

    Only ids are sorted. A row's successor is the next in its range partition; where a
    partition ends it is the head of the next one, of which the driver holds one pair a
    partition.
    """
    spark = docs.sparkSession
    ids = docs.groupBy("doc_id").agg(
        F.max(F.expr("length(text) div 3")).alias("need"), F.max(F.xxhash64("text")).alias("chosen")
    )
    ordered = stored(
        ids.orderBy(F.desc("doc_id")).withColumn("m", F.monotonically_increasing_id()), "print-order"
    )
    parts = ordered.groupBy(F.shiftright("m", 33)).agg(F.min("m").alias("head"), F.max("m").alias("tail"))
    parts = sorted((r["head"], r["tail"]) for r in parts.select("head", "tail").collect())
    jumps = [(tail, parts[(i + 1) % len(parts)][0]) for i, (_, tail) in enumerate(parts)]
    jump = spark.createDataFrame(jumps, "m long, to long")
    after = ordered.join(F.broadcast(jump), "m", "left").select(
        F.col("doc_id").alias("before_id"), "need", F.coalesce("to", F.col("m") + 1).alias("m")
    )
    return stored(ordered.select("m", "doc_id", "chosen").join(after, "m").drop("m"), "print-ring")


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited_text, sketch, edited_sketch, near_edited, near_next) of every row.

    The edited text replaces the last floor(n_chars / 3) characters by the first as many (or
    all) of the next document, in descending doc_id, the first following the last. A null
    text counts as empty. Rows that repeat a doc_id have one and the same next document; as
    a next document the id stands for one of its texts. A lone document follows itself.
    """
    rows = texts(docs)
    ring = _ring(texts(docs))
    # No equality of two sides: as a join key it would keep the texts from being shared.
    chosen = rows.join(ring, "doc_id").where(F.xxhash64("text").bitwiseXOR(F.col("chosen")) == 0)
    parcels = (
        with_fingerprint(chosen, "text", "sketch")
        .select(
            F.col("before_id").alias("doc_id"),
            F.substring("text", F.lit(1), F.col("need")).alias("head"),
            hashes("sketch").alias("next_hashes"),
        )
        .dropDuplicates(["doc_id"])
    )
    moved = F.expr("length(text) div 3")
    edited = F.concat(
        F.substring("text", F.lit(1), F.length("text") - moved), F.substring("head", F.lit(1), moved)
    )
    out = rows.join(parcels, "doc_id").withColumn("edited_text", edited)
    out = with_fingerprint(with_fingerprint(out, "text", "sketch"), "edited_text", "edited_sketch")
    out = out.withColumns({"_own": hashes("sketch"), "_edited": hashes("edited_sketch")})
    return out.select(
        id_out("doc_id").alias("doc_id"),
        F.length("text").cast("long").alias("n_chars"),
        "edited_text",
        "sketch",
        "edited_sketch",
        likeness(F.col("_own"), F.col("_edited")).alias("near_edited"),
        likeness(F.col("_own"), F.col("next_hashes")).alias("near_next"),
    )
