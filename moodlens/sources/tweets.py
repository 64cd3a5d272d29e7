"""Tweets and users from tables and delimited files.

Files are read line by line, so they split into tasks; a field holds no line break.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moodlens.schemas import TWEET, TWEET_TEXT

REJECTED = "rejected_because"
RAW_FIELDS = ("user_id", "tweet_id", "tweet", "timestamp")

# Fixed value: the first gap ends the user id, a comma parts the coordinates.
USER_LINE = r"^(.*?)\s*UT:\s([^,]*),(.*)$"

REPLAY_SIZE = 100


def read_tweets(spark: SparkSession, path: str, fmt: str = "parquet", **options: str) -> DataFrame:
    """The tweet store. ``fmt`` may be any installed connector, such as a document store's."""
    return spark.read.format(fmt).schema(TWEET).options(**options).load(path)


def tweets_of_user(tweets: DataFrame, user_id: str) -> DataFrame:
    """One user's tweets; the filter reaches the scan."""
    return tweets.where(F.col("user_id") == user_id)


def read_tweets_tsv(spark: SparkSession, path: str) -> DataFrame:
    """A tab-separated file with header; every row is kept and ``rejected_because`` says what is wrong with it.

    The timestamp stays text next to its parsed form, so that a rejected row can be looked at.
    """
    corrupt = "_line"
    lines = (
        spark.read.schema(T.StructType([*TWEET_TEXT.fields, T.StructField(corrupt, T.StringType())]))
        .option("sep", "\t")
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .option("escape", '"')
        .option("columnNameOfCorruptRecord", corrupt)
        .csv(path)
    )
    parsed = F.try_to_timestamp("timestamp")
    reason = F.when(F.col(corrupt).isNotNull(), "field count").when(parsed.isNull(), "timestamp")
    return lines.select(
        "user_id",
        "tweet_id",
        "tweet",
        F.col("timestamp").alias("timestamp_text"),
        parsed.alias("timestamp"),
        "location",
        F.col(corrupt).alias("line"),
        reason.alias(REJECTED),
    )


def valid_tweets(ingested: DataFrame) -> DataFrame:
    """The rows that fit the typed schema."""
    return ingested.where(F.col(REJECTED).isNull()).select(*TWEET.names)


def rejected_rows(ingested: DataFrame) -> DataFrame:
    """The rows that do not, with the reason."""
    return ingested.where(F.col(REJECTED).isNotNull()).drop("timestamp")


def read_raw_tweets(spark: SparkSession, path: str) -> DataFrame:
    """A headerless tab-separated file of user, tweet id, text and time; see ``split_raw_tweets``."""
    return split_raw_tweets(spark.read.text(path))


def split_raw_tweets(lines: DataFrame) -> DataFrame:
    """Split ``value`` at tabs. Quotes mean nothing; missing fields are null; too many fields are a reason to reject.

    The time gets its ISO form with a ``T`` between date and hour.
    """
    fields = F.split("value", "\t", -1)
    parts = [F.get("fields", F.lit(i)).alias(name) for i, name in enumerate(RAW_FIELDS)]
    reason = F.when(F.size("fields") > len(RAW_FIELDS), "field count")
    return lines.select(fields.alias("fields")).select(*parts, reason.alias(REJECTED)).withColumn(
        "timestamp", F.replace("timestamp", F.lit(" "), F.lit("T"))
    )


def read_users(spark: SparkSession, path: str) -> DataFrame:
    """The users file; see ``parse_users``."""
    return parse_users(spark.read.text(path))


def parse_users(lines: DataFrame) -> DataFrame:
    """``<user> UT: <lat>,<lon>`` lines in ``value`` as a user table; a line of another form gives nulls."""
    # one pass of the pattern; its groups come back joined by a sign that no part holds
    parts = F.split(F.regexp_replace("value", USER_LINE, "$1\n$2\n$3"), "\n")
    known = lines.select(F.when(F.size(parts) == 3, parts).alias("parts"))
    part = lambda group: F.get("parts", F.lit(group))
    return known.select(
        part(0).alias("user_id"),
        part(1).try_cast("double").alias("latitude"),
        part(2).try_cast("double").alias("longitude"),
    )


def sample_for_replay(tweets: DataFrame, n: int = REPLAY_SIZE) -> DataFrame:
    """The first ``n`` tweets by id, the same ones on every call.

    The rows are in one partition anyway. Saying so keeps what is made of them above the limit; expressions that the optimizer moves
    between limit and order would turn the top-k into an exchange and sort of all tweets.
    """
    return tweets.orderBy("tweet_id").limit(n).coalesce(1)


def read_tweets_if_present(spark: SparkSession, path: str, fmt: str = "parquet", **options: str) -> DataFrame:
    """Like ``read_tweets``, but a store that does not exist yet is empty."""
    try:
        return read_tweets(spark, path, fmt, **options)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], TWEET)
