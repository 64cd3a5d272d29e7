"""Feed preparation: raw files to one joined table, and replay of a sample into the stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from moodlens.operators.joins import MAX_BROADCAST_BYTES, join_users_tweets
from moodlens.session import checkpointed
from moodlens.sinks.files import publish_json, to_json_values, write_tsv
from moodlens.sources.tweets import RAW_FIELDS, REJECTED, read_raw_tweets, read_users, sample_for_replay
from moodlens.streaming.sink import write_stream

# Fixed value: milliseconds between two sends of the replay sample.
PAUSE_MS = 10_000


def prepare_feed(
    spark: SparkSession, users_path: str, tweets_path: str, out_path: str, rejects_path: str | None = None, compression: str = "none"
) -> None:
    """Join the users file with the tweets file and export the result as tab-separated rows.

    Tweets that do not fit are written to ``rejects_path``, by default beside the export. ``compression`` is that of ``write_tsv``.
    """
    raw = read_raw_tweets(spark, tweets_path)
    raw.where(F.col(REJECTED).isNotNull()).write.parquet(rejects_path or f"{out_path.rstrip('/')}_rejects")
    tweets = raw.where(F.col(REJECTED).isNull()).select(*RAW_FIELDS)
    write_tsv(join_users_tweets(read_users(spark, users_path), tweets, max_broadcast_bytes=MAX_BROADCAST_BYTES), out_path, compression=compression)


def replay_once(
    tweets: DataFrame, fmt: str, n: int = 100, ingest_time: Column | None = None, path: str | None = None, **options: str
) -> None:
    """Send the replay sample once; ``replay_stream`` goes on sending it."""
    publish_json(sample_for_replay(tweets, n), fmt, ingest_time, path, **options)


def replay_stream(
    tweets: DataFrame,
    fmt: str,
    checkpoint: str,
    n: int = 100,
    start_ms: int = 0,
    pause_ms: int = PAUSE_MS,
    path: str | None = None,
    trigger: dict | None = None,
    **options: str,
) -> StreamingQuery:
    """Send the replay sample again and again, once per micro-batch, every ``pause_ms`` unless ``trigger`` says otherwise.

    The clock of the sends is a stream of its own: send number k is stamped ``start_ms`` plus k pauses, and a restart goes on with the
    send after the last one that was committed. ``{"availableNow": True}`` makes one send per start.
    """
    spark = tweets.sparkSession
    # the sample is n rows, so one task numbers them
    numbered = sample_for_replay(tweets, n).withColumn("_place", F.row_number().over(Window.orderBy("tweet_id")) - 1)
    sample = checkpointed(numbered)
    rows = max(1, sample.count())
    clock = (
        spark.readStream.format("rate-micro-batch")
        .options(rowsPerBatch=rows, numPartitions=1, startTimestamp=start_ms, advanceMillisPerBatch=pause_ms)
        .load()
        .select((F.col("value") % rows).cast("int").alias("_place"), F.col("timestamp").alias("_sent"))
    )
    sent = clock.join(F.broadcast(sample), "_place")
    messages = to_json_values(sent, F.col("_sent"), without=("_place", "_sent"))
    return write_stream(messages, fmt, checkpoint, path, trigger or {"processingTime": f"{pause_ms} milliseconds"}, **options)
