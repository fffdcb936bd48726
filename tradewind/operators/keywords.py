"""Keyword counts with a vocabulary table of any size."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind.config import Settings
from tradewind.functions.text import keyword_tokens
from tradewind.operators.windows import tumbling, watermarked

#: Least length of the blocks that a long piece is laid in.
BLOCK = 64


def piece_counts(phrases: DataFrame, settings: Settings, pieces: str) -> DataFrame:
    """How often each unbroken piece of text occurs per window.

    ``pieces`` is the pattern of a piece. Repeated phrases fold here, before any piece
    is cut into words.
    """
    found = (
        watermarked(phrases, "rowtime", settings.keyword_delay)
        .select(tumbling("rowtime", settings.window), "fullword")
        .select("window", F.explode(keyword_tokens(F.col("fullword"), pieces)).alias("piece"))
    )
    return found.groupBy("window", "piece").agg(F.count("*").alias("n"))


@F.pandas_udf(T.ArrayType(T.StringType()))
def _cut(piece: pd.Series, places: pd.Series, sizes: pd.Series) -> pd.Series:
    """Walk each piece from place to place; a place that is not named takes one character."""

    def walk(text, at, size):
        known = {} if at is None else dict(zip(at.tolist(), size.tolist(), strict=True))
        words, here = [], 1
        while here <= len(text):
            taken = known.get(here, 1)
            words.append(text[here - 1 : here - 1 + taken])
            here += taken
        return words

    return pd.Series([walk(*row) for row in zip(piece, places, sizes, strict=True)])


def cut_pieces(pieces: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Cut each distinct ``piece`` into ``words`` by forward maximum matching.

    From each place the longest vocabulary word is taken, or a single character where
    none fits. Candidate substrings, of the lengths that vocabulary words have, meet the
    vocabulary (column ``word``) in a join, so neither side has to fit in memory.

    The work grows with the length of a piece, not with its square: a piece is first laid in
    blocks that overlap by the longest word, each place carries its block only, and pieces
    are named by their SHA-256. What is gathered per piece is at most one length per
    character of it, over which one walk goes.
    """
    words = vocabulary.select(F.lower("word").alias("_word")).filter("_word <> ''").distinct()
    lengths = words.agg(F.collect_set(F.length("_word"))).scalar()
    longest = words.agg(F.max(F.length("_word"))).scalar()
    width = F.greatest(F.coalesce(longest, F.lit(1)), F.lit(BLOCK))
    distinct = pieces.select("piece").distinct().withColumn("_id", F.unhex(F.sha2("piece", 256)))
    laid = distinct.select("_id", width.alias("_width"), "piece").select(
        "_id", "_width",
        F.regexp_extract_all("piece", F.concat(F.lit("(?s).{1,"), F.col("_width"), F.lit("}")), F.lit(0)).alias("_blocks"),
    )
    block = F.transform(
        "_blocks",
        lambda text, i: F.struct(
            (i * F.col("_width")).alias("start"), F.length(text).alias("own"),
            F.concat(text, F.coalesce(F.get("_blocks", i + 1), F.lit(""))).alias("text"),
        ),
    )
    places = laid.select("_id", F.inline(block)).select(
        "_id", "start", "text", F.explode(F.sequence(F.lit(1), F.col("own"))).alias("at")
    )
    candidates = places.select(
        "_id", "start", "text", "at", F.explode(lengths).alias("size")
    ).filter(F.col("at") + F.col("size") - 1 <= F.length("text"))
    candidates = candidates.select(
        "_id", (F.col("start") + F.col("at")).alias("place"), "size",
        F.col("text").substr(F.col("at"), F.col("size")).alias("_word"),
    )
    best = candidates.join(words, "_word", "left_semi").groupBy("_id", "place").agg(F.max("size").alias("size"))
    sizes = best.groupBy("_id").agg(F.collect_list(F.struct("place", "size")).alias("_sizes"))
    found = distinct.join(sizes, "_id", "left")
    return found.select("piece", _cut("piece", F.col("_sizes.place"), F.col("_sizes.size")).alias("words"))


def word_counts(
    counted: DataFrame, vocabulary: DataFrame, keys: Sequence[str] = ("window",)
) -> DataFrame:
    """Piece counts -> keyword counts (``ct``) per window, through the vocabulary."""
    cut = cut_pieces(counted, vocabulary)
    return (
        counted.join(cut, "piece")
        .select(*keys, "n", F.explode("words").alias("keyword"))
        .groupBy(*keys, "keyword")
        .agg(F.sum("n").alias("ct"))
    )
