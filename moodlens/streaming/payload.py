"""Messages of the live stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from moodlens.schemas import STREAM_PAYLOAD


def read_value_stream(spark: SparkSession, fmt: str, path: str | None = None, **options: str) -> DataFrame:
    """A stream with the message text in ``value``.

    ``fmt="kafka"`` takes the servers and the topic (``subscribe``) in ``options``; ``"text"`` reads a folder, and ``"parquet"`` one of
    compressed tables.
    """
    reader = spark.readStream.format(fmt).options(**options)
    if fmt == "parquet":
        reader = reader.schema("value string")
    return reader.load(path).select(F.col("value").cast("string").alias("value"))


def decode_payload(messages: DataFrame) -> DataFrame:
    """The JSON fields of each message as strings; all null for malformed JSON."""
    return messages.select(F.from_json("value", STREAM_PAYLOAD).alias("data")).select("data.*")


def malformed(messages: DataFrame) -> DataFrame:
    """The messages that ``decode_payload`` cannot read, as they came, to be kept in a quarantine."""
    data = F.from_json("value", STREAM_PAYLOAD)
    empty = F.forall(F.array(*[data[name] for name in STREAM_PAYLOAD.names]), lambda field: field.isNull())
    return messages.where(F.col("value").isNull() | empty)


def event_time(source: str = "timestamp_logger") -> Column:
    """Event time from the ingest stamp in epoch milliseconds, or from the tweet's own ``timestamp``."""
    if source == "timestamp_logger":
        return F.timestamp_millis(F.col(source).try_cast("bigint"))
    return F.try_to_timestamp(source)
