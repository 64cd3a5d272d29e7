"""Term statistics of the text index."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodlens.functions.stem import stem
from moodlens.functions.text import index_terms

# The English stop words of the text index.
STOP_WORDS = (
    "a", "an", "and", "are", "as", "at", "be", "but", "by", "for", "if", "in", "into", "is", "it", "no", "not", "of",
    "on", "or", "such", "that", "the", "their", "then", "there", "these", "they", "this", "to", "was", "will", "with",
)


def term_counts(tweets: DataFrame, text: str = "tweet") -> DataFrame:
    """How often each index term occurs, stop words left out.

    Counts are combined on the map side, so a term that makes up a third of all tokens costs one row per task.
    """
    return (
        tweets.select(F.explode(index_terms(text)).alias("term"))
        .where(~F.col("term").isin(*STOP_WORDS))
        .groupBy("term")
        .agg(F.count("*").alias("count"))
    )


def stemmed_term_counts(tweets: DataFrame, text: str = "tweet") -> DataFrame:
    """How often each stem occurs. As in the text index, stop words are looked for after stemming, so ``this`` stays as ``thi``.

    Terms are counted before they are stemmed: each distinct term is stemmed once, however often it occurs.
    """
    terms = tweets.select(F.explode(index_terms(text)).alias("term")).groupBy("term").agg(F.count("*").alias("count"))
    # exploded, as the filter below would otherwise be pushed down with a second copy of the stemming
    stems = terms.select(F.explode(F.array(stem("term"))).alias("term"), "count").groupBy("term").agg(F.sum("count").alias("count"))
    return stems.where(~F.col("term").isin(*STOP_WORDS))
