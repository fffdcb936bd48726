"""The training-corpus pipeline: five stages over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet
and read again as the next stage's documents. All but the last return the columns of docs;
the mixing stage adds ``mix_slot``, by which the last stage packs, and the last returns the
packed pieces. A document with a null or empty text passes every stage
on the same terms as the others. The dedup stages judge every text for itself: rows that
share a doc_id (or have none) stay or go one by one, and of equal texts one row stays.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.llm.common import id_in, maybe_in, maybe_marked, stored, table
from tradewind.llm.exact_dedup import exact_duplicates
from tradewind.llm.mixing import mix_sources
from tradewind.llm.near_dedup import text_groups
from tradewind.llm.packing import pack
from tradewind.llm.quality import keep_quality

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Slots of the mix (of 32 documents each) that are packed together.
WINDOW = 32


def _text_hash() -> Column:
    """SHA-256 of the text with A-Z lower-cased."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    ascii_only = F.length(text) == F.octet_length(text)  # for these the quicker full lower-casing is the same
    return F.sha2(F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower())), 256)


def _judged(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """docs without the texts that rows (_id, _sha, kept) drop; a repeated (_id, _sha) stays once."""
    keys = ["_id", "_sha"]
    fates = rows.groupBy(*keys).agg(F.min("kept").alias("kept"), F.count("*").alias("m"))
    fates = stored(fates.where("NOT kept OR m > 1"), "pipeline-fates")
    keyed = docs.withColumns({"_id": id_in(), "_sha": _text_hash()})
    repeated = fates.where("kept").select(*keys)
    # Only texts that may be among those with a fate are shuffled.
    marked = maybe_marked(keyed, F.xxhash64(*keys), fates, F.xxhash64(*keys))
    some = marked.where("_maybe").drop("_maybe")
    several = maybe_in(keyed, F.xxhash64(*keys), repeated, F.xxhash64(*keys)).join(repeated, keys)
    return (
        marked.where("NOT _maybe").select(*docs.columns)
        .unionByName(some.join(fates.select(*keys), keys, "left_anti").select(*docs.columns))
        .unionByName(several.dropDuplicates(keys).select(*docs.columns))
    )


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return keep_quality(docs, table(spark, sf_dir, "labels"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the one with the largest doc_id stays."""
    rows = exact_duplicates(docs).where("group_size > 1")
    return _judged(docs, rows.select(id_in().alias("_id"), F.col("text_sha256").alias("_sha"), "kept"))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates, the one with the smallest doc_id stays."""
    rows = text_groups(docs)
    best = rows.where("n > 0").groupBy("group").agg(F.min(F.struct("doc_id", "sha")).alias("best"))
    kept = F.coalesce(F.struct("doc_id", "sha") == F.col("best"), F.lit(True))  # no group: nothing is near
    rows = rows.join(best, "group", "left").withColumn("kept", kept)
    return _judged(docs, rows.select(F.col("doc_id").alias("_id"), F.col("sha").alias("_sha"), "kept"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each with its slot in the mix as ``mix_slot``, by which packing sorts."""
    slots = mix_sources(docs, row=_text_hash())
    slots = slots.groupBy(id_in().alias("_id"), F.col("row").alias("_sha"), F.col("source").alias("_from")).agg(
        F.min(F.struct("slot", "place")).alias("_slot")
    )
    keyed = docs.withColumns({"_id": id_in(), "_sha": _text_hash()})
    placed = keyed.join(
        slots.withColumnsRenamed({"_id": "_id2", "_sha": "_sha2"}),
        (F.col("_id") == F.col("_id2")) & (F.col("_sha") == F.col("_sha2"))
        & F.col("source").cast("string").eqNullSafe(F.col("_from")),
    )
    return placed.select(*docs.columns, F.col("_slot.slot").alias("mix_slot"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 2048 ids: windows of ``WINDOW`` slots of the mix in their order,
    inside a window along the space-filling curve. Unmixed documents are one window."""
    window = F.floor(F.col("mix_slot") / WINDOW) if "mix_slot" in docs.columns else None
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"), group=window)


STAGES = [
    ("quality classifier", quality),
    ("exact dedup", exact),
    ("near dedup", near),
    ("mixing", mixing),
    ("packing", packing),
]

#: A trained classifier, hashed vectors and a tokenizer are not SQL; tested by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
