"""Blank tests and keyword tokens."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def is_blank(text: Column) -> Column:
    """Null, empty or whitespace only."""
    return F.coalesce(text.rlike(r"^\s*$"), F.lit(True))


def keyword_tokens(text: Column, pattern: str) -> Column:
    """The keywords of a phrase, in order, repeats kept."""
    return F.regexp_extract_all(F.lower(text), F.lit(pattern), F.lit(0))


def register_keyword_split(
    spark: SparkSession,
    pattern: str,
    names: tuple[str, ...] = ("keyword_split", "ik_analyze"),
) -> None:
    """Make ``LATERAL keyword_split(text) AS T(word)`` available to SQL users.

    A SQL table function is inlined by Catalyst: rows never leave the JVM.
    """
    literal = pattern.replace("\\", "\\\\").replace("'", "\\'")
    for name in names:
        spark.sql(f"""
            CREATE OR REPLACE TEMPORARY FUNCTION {name}(phrase STRING)
            RETURNS TABLE (word STRING)
            RETURN SELECT explode(regexp_extract_all(lower(phrase), '{literal}', 0))
        """)
