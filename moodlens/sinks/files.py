"""Exports and the bulk load."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from moodlens.sources.tweets import REJECTED, read_tweets_tsv, rejected_rows, valid_tweets

OUTCOME = "outcome"
TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
#: Rows of a file that one task has to read as a whole.
ROWS_PER_FILE = 50_000


# What stands for a sign that would break a line or a field.
ESCAPES = (("\\", "\\\\"), ("\t", "\\t"), ("\n", "\\n"), ("\r", "\\r"))


def escaped(column: Column) -> Column:
    """A text without tabs and line breaks, from which ``unescaped`` makes the text again."""
    for sign, stands in ESCAPES:
        column = F.replace(column, F.lit(sign), F.lit(stands))
    return column


def unescaped(column: Column) -> Column:
    """The text that ``escaped`` was given."""

    def part(piece: Column) -> Column:
        for sign, stands in ESCAPES[1:]:
            piece = F.replace(piece, F.lit(stands), F.lit(sign))
        return piece

    # between two backslashes that stand for one, the others belong to the sign after them
    return F.array_join(F.transform(F.split(column, r"\\\\", -1), part), "\\")


def write_tsv(df: DataFrame, path: str, mode: str = "errorifexists", compression: str = "none") -> None:
    """Tab-separated with header. Tabs, line breaks and backslashes in a text are escaped, so a row stays one line and nothing is lost.

    ``compression="gzip"`` writes compressed files. These cannot be split, so each of them holds at most ``ROWS_PER_FILE`` rows.
    """
    flat = [escaped(F.col(name)).alias(name) if kind == "string" else F.col(name) for name, kind in df.dtypes]
    writer = df.select(*flat).write.mode(mode).option("sep", "\t").option("header", True).option("escape", '"')
    if compression != "none":
        writer.option("compression", compression).option("zlib.compress.level", "BEST_SPEED").option("maxRecordsPerFile", ROWS_PER_FILE)
    # the writer trims texts unless told otherwise
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


def to_json_values(df: DataFrame, ingest_time: Column | None = None, without: tuple[str, ...] = ()) -> DataFrame:
    """Each row as a JSON text in ``value``, stamped with its ingest time in epoch milliseconds.

    ``ingest_time`` replaces the clock; columns named in ``without`` stay out of the text.
    """
    stamp = F.unix_millis(F.current_timestamp() if ingest_time is None else ingest_time)
    stamped = F.struct(*[F.col(name) for name in df.columns if name not in without], stamp.alias("timestamp_logger"))
    return df.select(F.to_json(stamped, {"timestampFormat": TIME_FORMAT}).alias("value"))


def publish_json(
    df: DataFrame, fmt: str, ingest_time: Column | None = None, path: str | None = None, **options: str
) -> None:
    """Send rows as JSON messages: ``fmt="kafka"`` with the topic in ``options``, or ``"text"`` or ``"parquet"`` with a path."""
    to_json_values(df, ingest_time).write.format(fmt).mode("append").options(**options).save(path)


def bulk_load(spark: SparkSession, tsv_path: str, table_path: str, mode: str = "append", escapes: bool = False) -> None:
    """Load a tab-separated file; rows that do not fit are kept beside the good ones. ``escapes`` undoes those of ``write_tsv``.

    The file is read once. ``read_loaded`` gives back either part, and reads only that part.
    """
    ingested = read_tweets_tsv(spark, tsv_path)
    if escapes:
        texts = ("user_id", "tweet_id", "tweet", "timestamp_text", "location")
        ingested = ingested.withColumns({name: unescaped(F.col(name)) for name in texts})
    outcome = F.when(F.col(REJECTED).isNull(), "valid").otherwise("rejected")
    ingested.withColumn(OUTCOME, outcome).write.mode(mode).partitionBy(OUTCOME).parquet(table_path)


def read_loaded(spark: SparkSession, table_path: str) -> tuple[DataFrame, DataFrame]:
    """Valid tweets and rejected rows of a bulk load."""
    loaded = spark.read.parquet(table_path)
    valid = valid_tweets(loaded.where(F.col(OUTCOME) == "valid"))
    return valid, rejected_rows(loaded.where(F.col(OUTCOME) == "rejected")).drop(OUTCOME)
