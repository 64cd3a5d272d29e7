"""Sentiment score per text."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from moodlens.functions.polarity import MAX_TABLE_BYTES, check_lexicon, polarity, slot_table, usable_terms
from moodlens.functions.text import split_tokens
from moodlens.session import checkpointed, discard, free_exchanges, salted_join, scratch_path

#: Bytes of terms and polarities that a task of the join with the lexicon may hold; a lexicon of fewer than the least is small
#: enough for Spark to broadcast.
LEAST_HASHED_BYTES, MAX_HASHED_BYTES = 16 << 20, 64 << 20
TERM_SALTS = 16
#: Rows of which the different texts are scored at once without counting their bytes, and bytes of different texts that are scored
#: at once otherwise; pairs of text and term take some three times as much in an exchange.
ROUND_ROWS, ROUND_BYTES = 1_000_000, 2 << 30
# folders that the different texts are kept in until their turn
TEXT_GROUPS = 32


class LexiconTooLarge(ValueError):
    """A stream's lexicon that takes more bytes than its slot table may."""


def add_sentiment(
    tweets: DataFrame,
    lexicon: DataFrame,
    text: str = "tweet",
    output: str = "tweet_sentiment",
    max_table_bytes: int = MAX_TABLE_BYTES,
) -> DataFrame:
    """Add the mean polarity of each text's known terms as a double; 0.0 for none and for a null text.

    The lexicon becomes a slot table that goes along with the plan: no shuffle, and the same for batches and streams. Only one
    whose table takes more than ``max_table_bytes`` is joined (batch only). Both ways refuse the same lexicon rows.
    """
    checked = check_lexicon(lexicon)
    table = slot_table(lexicon, max_table_bytes, checked)
    if table is not None:
        # a scalar subquery is read once and goes to the executors with the plan; the score is the one place that refers to
        # it, so both projections become one and no row carries the table
        with_table = tweets.withColumn("_slot_table", table.row.scalar())
        return with_table.withColumn(output, polarity(text, "_slot_table", table.slots)).drop("_slot_table")
    if tweets.isStreaming:
        raise LexiconTooLarge(f"the table of a stream's lexicon may take {max_table_bytes} bytes")
    return score_by_join(tweets, lexicon, text, output, checked)


def score_by_join(
    tweets: DataFrame,
    lexicon: DataFrame,
    text: str = "tweet",
    output: str = "tweet_sentiment",
    checked: tuple[int, int] | None = None,
) -> DataFrame:
    """The same score through a join with a lexicon of any size.

    Every different text is exchanged once and split once; its terms are shuffled with its digest for the join with the lexicon, in
    which a frequent term is spread over salted partitions. Where the different texts take more than ``ROUND_BYTES``, they are scored in
    rounds, so that the pairs of text and term of one round are all that lies in exchanges. The scores come back by digest: there the
    rows of ``tweets``, texts included, are shuffled once. ``checked`` is what ``check_lexicon`` found if it has been called. Pairs are
    sorted only for a lexicon whose copies a task cannot hold.
    """
    spark = tweets.sparkSession
    size, _ = checked or check_lexicon(lexicon)
    terms_in_task = size * TERM_SALTS // int(spark.conf.get("spark.sql.shuffle.partitions"))
    polarities = usable_terms(lexicon)
    # 128 bits as bytes: a quarter of what 64 digits take in every pair, and Spark's small map for texts, which pairs overflow, stays out
    keyed = tweets.withColumn("_digest", F.substring(F.unhex(F.sha2(F.col(text).cast("binary"), 256)), 1, 16))
    texts = keyed.where("_digest is not null").groupBy("_digest").agg(F.first(text).alias("_text"))

    def scored(texts: DataFrame) -> DataFrame:
        """Scores of texts that are dealt by digest, so that their pairs are counted where they are."""
        hashed = size >= LEAST_HASHED_BYTES and terms_in_task <= MAX_HASHED_BYTES
        # empty tokens are left out after they are exploded, which spares a copy of each array
        terms = texts.select("_digest", F.explode(split_tokens("_text")).alias("term")).where("term != ''")
        counted = terms.groupBy("_digest", "term").agg(F.count("*").alias("n"))
        return checkpointed(
            salted_join(counted, polarities.hint("shuffle_hash") if hashed else polarities, ["term"], TERM_SALTS)
            .groupBy("_digest")
            .agg((F.sum(F.col("polarity") * F.col("n")) / F.sum("n")).alias("_score"))
        )

    if tweets.count() <= ROUND_ROWS:
        scores = scored(texts)
    else:
        polarities, staged, seen = checkpointed(polarities), scratch_path(spark, "texts"), Observation()
        groups = texts.withColumn("_group", F.pmod(F.hash("_digest"), F.lit(TEXT_GROUPS)))
        groups.observe(seen, F.sum(F.octet_length("_text")).alias("bytes")).write.partitionBy("_group").parquet(staged)
        rounds = min(TEXT_GROUPS, (seen.get["bytes"] or 0) // ROUND_BYTES + 1)
        kept = spark.read.schema(groups.schema).parquet(staged)
        parts = []
        for part in range(rounds):
            free_exchanges(spark)
            parts.append(scored(kept.where(F.col("_group") % rounds == part).drop("_group").repartition("_digest")))
        # rows with their texts are not sorted for a side that is far smaller
        scores = reduce(DataFrame.unionByName, parts).hint("shuffle_hash")
        discard(spark, staged)
        free_exchanges(spark)
    return (
        salted_join(keyed, scores, ["_digest"], salts=4, how="left")
        .withColumn(output, F.coalesce("_score", F.lit(0.0)))
        .select(*tweets.columns, output)
    )
