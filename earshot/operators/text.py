"""Word and country frequencies, artist to country."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earshot.functions.columns import words

STOP_WORDS = (
    "a", "an", "and", "are", "as", "at", "be", "by", "for", "from", "in", "is", "it",
    "of", "on", "or", "that", "the", "this", "to", "was", "with",
)


def term_frequency(
    df: DataFrame, column: str, stop_words: Sequence[str] = STOP_WORDS, n: int | None = None
) -> DataFrame:
    """How often each word occurs in ``column``, without stop words; the ``n`` most frequent if given."""
    terms = df.select(F.explode(words(F.col(column))).alias("term")).where(F.col("term") != "")
    if stop_words:
        terms = terms.where(~F.col("term").isin(*stop_words))
    counts = terms.groupBy("term").agg(F.count("*").alias("n"))
    return counts if n is None else counts.orderBy(F.desc("n"), "term").limit(n)


def artist_country(artists: DataFrame, lookup: DataFrame) -> DataFrame:
    """Artists with their country from a stored mapping; unknown artists are left out."""
    return artists.join(lookup.select("artist_id", "country"), "artist_id")


def artists_by_country(countries: DataFrame) -> DataFrame:
    return countries.groupBy("country").agg(F.count("*").alias("artists"))
