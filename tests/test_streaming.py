"""Messages, windows, watermarks and sinks."""

import json

import pytest
from pyspark.sql import functions as F

from moodlens.catalog import fixtures
from moodlens.operators import add_sentiment, region_index
from moodlens.plans import run_live
from moodlens.sinks import publish_json
from moodlens.streaming import decode_payload, enrich, event_time, read_value_stream, window_sentiment, write_stream

SENTIMENTS = "date_time timestamp, state string, sentiment double"


def seconds(column):
    return F.unix_timestamp(column).alias(column.replace(".", "_"))


def test_decode(spark):
    good = json.dumps({"tweet": "x", "location": "1,2", "timestamp_logger": 1617000000123})
    rows = decode_payload(spark.createDataFrame([(good,), ("bad",)], "value string")).collect()
    assert rows[0].asDict() == {
        "user_id": None, "tweet_id": None, "tweet": "x", "timestamp": None, "location": "1,2",
        "timestamp_logger": "1617000000123",
    }
    assert set(rows[1]) == {None}


def test_event_time(spark):
    df = spark.createDataFrame([("1617000000123", "2021-03-29T06:40:00"), ("x", "y")], "timestamp_logger string, timestamp string")
    rows = df.select(event_time().cast("string"), event_time("timestamp").cast("string")).collect()
    assert list(map(tuple, rows)) == [("2021-03-29 06:40:00.123", "2021-03-29 06:40:00"), (None, None)]


def test_measures_are_numeric(spark):
    values = [-0.8, -0.1, 0.0001, 0.5, 0.0]
    df = spark.createDataFrame([("s", v) for v in values], "state string, sentiment double").withColumn(
        "date_time", F.timestamp_seconds(F.lit(1))
    )
    names = ("mean_sentiment", "max_sentiment", "min_sentiment", "total_sentiment", "absolute_sentiment")
    result = window_sentiment(df, names).collect()
    assert len(result) == 4
    for row in result:
        assert row["max_sentiment"] == 0.5 and row["min_sentiment"] == -0.8
        assert row["absolute_sentiment"] == pytest.approx(1.4001)


def message(second, tweet="x"):
    return json.dumps({"tweet": tweet, "location": "0.5,0.5", "timestamp_logger": second * 1000})


@pytest.fixture(scope="module")
def dimensions(spark, sf_dir):
    return fixtures.lexicon(spark), region_index(fixtures.regions(spark, sf_dir))


def run_batches(spark, tmp_path, dimensions, batches, **arguments):
    """Feed one file per batch through the live job, restarting it from its checkpoint each time."""
    topic = tmp_path / "topic"
    topic.mkdir()
    for number, batch in enumerate(batches):
        (topic / f"{number}.txt").write_text("\n".join(batch))
        query = run_live(
            read_value_stream(spark, "text", str(topic)), *dimensions, "parquet", str(tmp_path / "checkpoint"),
            str(tmp_path / "out"), {"availableNow": True}, **arguments,
        )
        query.awaitTermination()
    return spark.read.parquet(str(tmp_path / "out"))


def test_windows_close_with_the_watermark(spark, tmp_path, dimensions):
    batches = [[message(0), message(3), message(7)], [message(12), message(31)], [message(33)]]
    out = run_batches(spark, tmp_path, dimensions, batches)
    ends = sorted(row[0] for row in out.select(seconds("window.end")).collect())
    # the watermark stands at 28 s in the end; each window came out once
    assert ends == [5, 10, 15, 20, 25]
    assert {row[0] for row in out.select("state").collect()} == {"Unknown"}


def test_late_rows_are_dropped(spark, tmp_path, dimensions):
    batches = [[message(0)], [message(100)], [message(1, "the")], [message(200)]]
    out = run_batches(spark, tmp_path, dimensions, batches, measures=("total_sentiment",))
    starts = sorted(row[0] for row in out.select(seconds("window.start")).collect())
    assert starts == [-15, -10, -5, 0, 85, 90, 95, 100]
    assert out.agg(F.sum("total_sentiment")).first()[0] == 0.0


def test_raw_stream(spark, tmp_path, dimensions):
    out = run_batches(spark, tmp_path, dimensions, [[message(0, "the"), "bad"], [message(1)]], measures=None)
    assert out.columns == ["location", "state", "tweet", "sentiment", "date_time"]
    assert sorted(row["sentiment"] for row in out.collect()) == [0.0, 0.0, 0.125]


def test_stream_equals_batch(spark, tmp_path, dimensions, sf_dir):
    messages = fixtures.messages(spark, sf_dir).where("value like '%timestamp_logger%'")
    messages.write.text(str(tmp_path / "topic"))
    query = run_live(
        read_value_stream(spark, "text", str(tmp_path / "topic")), *dimensions, "parquet", str(tmp_path / "c"),
        str(tmp_path / "out"), {"availableNow": True},
    )
    query.awaitTermination()
    streamed = spark.read.parquet(str(tmp_path / "out"))
    batch = window_sentiment(enrich(decode_payload(messages), *dimensions))
    last = decode_payload(messages).agg(F.max(event_time())).first()[0]
    closed = batch.where(F.col("window.end") <= F.lit(last) - F.expr("interval 5 seconds"))
    assert streamed.count() == closed.count() > 0

    def rounded(df):
        return df.select("state", "window", *[F.round(c, 9) for c in ("mean_sentiment", "max_sentiment", "min_sentiment")])

    assert rounded(streamed).exceptAll(rounded(closed)).count() == 0


def test_memory_and_console_sinks(spark, tmp_path, dimensions):
    topic = tmp_path / "topic"
    topic.mkdir()
    (topic / "0.txt").write_text(message(0, "the"))
    enriched = enrich(decode_payload(read_value_stream(spark, "text", str(topic))), *dimensions)
    query = write_stream(enriched, "memory", query_name="enriched_messages", trigger={"availableNow": True})
    query.awaitTermination()
    assert spark.table("enriched_messages").first()["sentiment"] == 0.125
    console = write_stream(enriched, "console", trigger={"availableNow": True})
    console.awaitTermination()
    assert sum(progress["numInputRows"] for progress in console.recentProgress) == 1


def test_durable_sinks_need_a_checkpoint(spark, tmp_path):
    stream = spark.readStream.format("rate").load()
    with pytest.raises(ValueError):
        write_stream(stream, "parquet", path=str(tmp_path / "out"))


def test_large_index_on_a_stream(spark, tmp_path, sf_dir, dimensions):
    lexicon, _ = dimensions
    index = region_index(fixtures.regions(spark, sf_dir), max_broadcast_bytes=0)
    batch = [json.dumps({"tweet": "x", "location": f"{24 + i / 4},-119.0", "timestamp_logger": i}) for i in range(60)]
    out = run_batches(spark, tmp_path, (lexicon, index), [batch], measures=None)
    expected = enrich(decode_payload(spark.createDataFrame([(m,) for m in batch], "value string")), *dimensions)
    assert expected.select("state").distinct().count() > 2
    assert out.count() == 60 and out.exceptAll(expected).count() == 0


def test_lexicon_beyond_the_inline_bound_is_refused_on_a_stream(spark, tmp_path, dimensions):
    (tmp_path / "topic").mkdir()
    stream = decode_payload(read_value_stream(spark, "text", str(tmp_path / "topic")))
    with pytest.raises(ValueError):
        add_sentiment(stream, dimensions[0], max_table_bytes=3)


def test_large_lexicon_on_a_stream(spark, tmp_path, dimensions):
    """Far more terms than a plan usually holds stay one expression on a stream too."""
    letters = F.translate(F.col("id").cast("string"), "0123456789", "abcdefghij")
    lexicon = spark.range(60_000).select(F.concat(F.lit("w"), letters).alias("term"), ((F.col("id") % 9 - 4) / 4).alias("polarity"))
    batch = [json.dumps({"tweet": "wf wbccdd none", "location": "1,2", "timestamp_logger": 1})]
    out = run_batches(spark, tmp_path, (lexicon, dimensions[1]), [batch], measures=None).collect()
    assert [row["sentiment"] for row in out] == [((5 % 9 - 4) / 4 + (12233 % 9 - 4) / 4) / 2]


def test_lexicon_beyond_the_inline_bound_is_joined_batch_by_batch(spark, tmp_path, dimensions):
    """Rows written as they are were refused too, though they need no state."""
    lexicon, index = dimensions
    topic, checkpoint, out = (str(tmp_path / name) for name in ("topic", "c", "out"))
    sent = []
    for batch in range(2):
        rows = [(json.dumps({"tweet": f"the best day of {k}" if k % 3 else "", "location": f"{24 + k},-119.0", "timestamp_logger": 1000 * k}),) for k in range(batch, 9)]
        sent += rows
        spark.createDataFrame(rows, "value string").write.mode("append").text(topic)
        messages = read_value_stream(spark, "text", topic)
        run_live(messages, lexicon, index, "parquet", checkpoint, out, {"availableNow": True}, measures=None, max_table_bytes=3).awaitTermination()
    expected = enrich(decode_payload(spark.createDataFrame(sent, "value string")), *dimensions)
    got = spark.read.parquet(out)
    assert got.select("batch").distinct().count() == 2 and expected.select("sentiment").distinct().count() > 1
    rows = got.drop("batch").select(expected.columns)
    assert rows.count() == len(sent) and rows.exceptAll(expected).count() == 0 and expected.exceptAll(rows).count() == 0
    with pytest.raises(ValueError):
        run_live(messages, lexicon, index, "parquet", checkpoint, out, {"availableNow": True}, max_table_bytes=3)


def test_messages_kept_in_tables_are_those_of_a_text_topic(spark, tmp_path):
    tweets = spark.range(30).select(F.col("id").cast("string").alias("tweet_id"), F.repeat(F.lit("two\nlines, "), 200).alias("tweet"))
    read = {}
    for fmt in ("text", "parquet"):
        publish_json(tweets, fmt, F.lit("2024-01-01").cast("timestamp"), str(tmp_path / fmt))
        stream = read_value_stream(spark, fmt, str(tmp_path / fmt))
        write_stream(stream, "memory", query_name=f"kept_{fmt}", trigger={"availableNow": True}).awaitTermination()
        read[fmt] = sorted(row["value"] for row in spark.table(f"kept_{fmt}").collect())
    assert read["parquet"] == read["text"] and len(read["text"]) == 30
    size = {fmt: sum(f.stat().st_size for f in (tmp_path / fmt).glob("part-*")) for fmt in read}
    assert size["parquet"] < size["text"] / 2


def test_compressed_tables_are_read_in_small_parts(spark):
    """Compressed messages gave too few tasks to fill the cores evenly."""
    assert int(spark.conf.get("spark.sql.files.maxPartitionBytes")) <= 32 << 20
