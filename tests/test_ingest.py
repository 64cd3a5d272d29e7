"""Files in, files out, and the users join."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from moodlens.operators import join_users_tweets
from moodlens.plans import prepare_feed, replay_once
from moodlens.sinks import bulk_load, publish_json, read_loaded, to_json_values, write_tsv
from moodlens.sinks.files import unescaped
from moodlens.sources import (
    parse_users,
    read_raw_tweets,
    read_tweets,
    read_tweets_if_present,
    read_tweets_tsv,
    rejected_rows,
    sample_for_replay,
    split_raw_tweets,
    tweets_of_user,
    valid_tweets,
)
from moodlens.streaming import decode_payload

TSV = "\n".join(
    [
        "user_id\ttweet_id\ttweet\ttimestamp\tlocation",
        "1\t10\tall fine\t2010-03-03T04:15:26\t37.2,-115.8",
        "1\t11\tbad time\tnan\t37.2,-115.8",
        "2\t12\ttoo\tmany\t2010-03-03T04:15:26\t37.2,-115.8",
        "2\t13\ttoo few",
        '3\t14\t"a ""quoted"" text"\t2010-03-04 04:15:26\t1,2',
    ]
)


def lines(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def rows(df):
    return sorted((tuple(row) for row in df.collect()), key=str)


def test_tsv_valid_and_rejected(spark, tmp_path):
    (tmp_path / "tweets.tsv").write_text(TSV)
    ingested = read_tweets_tsv(spark, str(tmp_path / "tweets.tsv"))
    assert rows(valid_tweets(ingested)) == [
        ("1", "10", "all fine", datetime(2010, 3, 3, 4, 15, 26), "37.2,-115.8"),
        ("3", "14", 'a "quoted" text', datetime(2010, 3, 4, 4, 15, 26), "1,2"),
    ]
    rejected = {row["tweet_id"]: row["rejected_because"] for row in rejected_rows(ingested).collect()}
    assert rejected == {"11": "timestamp", "12": "field count", "13": "field count"}


def test_bulk_load_keeps_every_row_and_reads_parts(spark, tmp_path):
    (tmp_path / "tweets.tsv").write_text(TSV)
    bulk_load(spark, str(tmp_path / "tweets.tsv"), str(tmp_path / "table"))
    valid, rejected = read_loaded(spark, str(tmp_path / "table"))
    assert valid.count() == 2 and rejected.count() == 3
    assert rejected.where("tweet_id = '12'").first()["line"].startswith("2\t12\ttoo\tmany")
    plan = valid._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(outcome" in plan


def test_raw_tweets(spark, tmp_path):
    (tmp_path / "raw.txt").write_text('1\t10\t"hi\t2010-03-03 04:15:26\n1\t11\ta\tb\tc\n1\t12\n')
    split = read_raw_tweets(spark, str(tmp_path / "raw.txt"))
    assert rows(split) == [
        ("1", "10", '"hi', "2010-03-03T04:15:26", None),
        ("1", "11", "a", "b", "field count"),
        ("1", "12", None, None, None),
    ]
    assert rows(split_raw_tweets(lines(spark, "1\t10\tx\t2010-03-03 04:15:26\t"))) == [
        ("1", "10", "x", "2010-03-03T04:15:26", "field count")
    ]


def test_users(spark):
    parsed = parse_users(lines(spark, "7\tUT: 37.24,-115.8", "8 UT: 1,x", "nonsense"))
    assert rows(parsed) == [("7", 37.24, -115.8), ("8", 1.0, None), (None, None, None)]


@pytest.mark.parametrize("salts", [None, 4])
def test_users_join(spark, salts):
    users = spark.createDataFrame(
        [("1", 1.5, -2.0), ("1", 3.0, 4.0), ("2", None, 1.0), (None, 0.0, 0.0)],
        "user_id string, latitude double, longitude double",
    )
    tweets = spark.createDataFrame(
        [("1", "10", "a", "t"), ("2", "11", "b", "t"), ("3", "12", "c", "t"), (None, "13", "d", "t")],
        "user_id string, tweet_id string, tweet string, timestamp string",
    )
    joined = join_users_tweets(users, tweets, salts)
    assert joined.columns == ["user_id", "latitude", "longitude", "tweet_id", "tweet", "timestamp", "location"]
    assert rows(joined) == [
        ("1", 1.5, -2.0, "10", "a", "t", "1.5,-2.0"),
        ("1", 3.0, 4.0, "10", "a", "t", "3.0,4.0"),
        ("2", None, 1.0, "11", "b", "t", None),
    ]


def test_feed_job_feeds_the_bulk_load(spark, tmp_path):
    (tmp_path / "users.txt").write_text("7\tUT: 37.24,-115.8\n8\tUT: 1.5,2.5\n")
    (tmp_path / "tweets.txt").write_text(
        "7\t70\t  two  spaces \t2010-03-03 04:15:26\n8\t80\tx\tnot a time\n7\t71\ta\tb\tc\td\n9\t90\tx\t2010-03-03 04:15:26\n"
    )
    prepare_feed(spark, str(tmp_path / "users.txt"), str(tmp_path / "tweets.txt"), str(tmp_path / "feed"))
    exported = spark.read.option("sep", "\t").option("header", True).csv(str(tmp_path / "feed"))
    assert exported.columns == ["user_id", "latitude", "longitude", "tweet_id", "tweet", "timestamp", "location"]
    assert rows(exported.select("tweet_id", "tweet", "timestamp", "location")) == [
        ("70", "  two  spaces ", "2010-03-03T04:15:26", "37.24,-115.8"),
        ("80", "x", "notTaTtime", "1.5,2.5"),
    ]
    assert rows(spark.read.parquet(str(tmp_path / "feed_rejects")).select("tweet_id", "rejected_because")) == [("71", "field count")]


def test_store_filter_reaches_the_scan(spark, tmp_path):
    tweets = spark.createDataFrame(
        [("1", "10", "a", datetime(2020, 1, 1), "1,2"), ("2", "11", "b", datetime(2020, 1, 1), "1,2")],
        "user_id string, tweet_id string, tweet string, timestamp timestamp, location string",
    )
    tweets.write.parquet(str(tmp_path / "tweets"))
    found = tweets_of_user(read_tweets(spark, str(tmp_path / "tweets")), "1").select("tweet_id")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(user_id,1)" in plan and "ReadSchema: struct<user_id:string,tweet_id:string>" in plan
    assert rows(found) == [("10",)]


def test_missing_store_is_empty(spark, tmp_path):
    assert read_tweets_if_present(spark, str(tmp_path / "none")).count() == 0


def test_sample_is_the_same_every_time(spark):
    tweets = spark.range(500).select(F.col("id").cast("string").alias("tweet_id")).repartition(7)
    ids = [row[0] for row in sample_for_replay(tweets).collect()]
    assert ids == sorted(map(str, range(500)))[:100]
    assert "TakeOrderedAndProject" in sample_for_replay(tweets)._jdf.queryExecution().executedPlan().toString()


def test_sample_stays_a_top_k_below_expressions(spark):
    tweets = spark.range(500).select(F.col("id").cast("string").alias("tweet_id"), F.lit("text").alias("tweet")).repartition(7)
    decoded = decode_payload(to_json_values(sample_for_replay(tweets), F.timestamp_millis(F.lit(5))))
    plan = decoded.select("tweet_id", "timestamp_logger")._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan
    assert sorted(row["tweet_id"] for row in decoded.collect()) == sorted(map(str, range(500)))[:100]


def test_replay_stamps_and_sends(spark, tmp_path):
    tweets = spark.createDataFrame([("1", "10", 'say "hi"\n')], "user_id string, tweet_id string, tweet string")
    replay_once(tweets, "text", ingest_time=F.timestamp_millis(F.lit(1617000000123)), path=str(tmp_path / "topic"))
    replay_once(tweets, "text", path=str(tmp_path / "topic"))
    sent = [json.loads(row["value"]) for row in spark.read.text(str(tmp_path / "topic")).collect()]
    assert len(sent) == 2
    assert {"user_id": "1", "tweet_id": "10", "tweet": 'say "hi"\n', "timestamp_logger": 1617000000123} in sent
    assert all(isinstance(message["timestamp_logger"], int) for message in sent)


def test_publish_passes_the_format_on(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        publish_json(spark.range(1), "kafka", topic="stream")


def test_tsv_round_trip(spark, tmp_path):
    texts = [("a\tb\nc\r",), ("\\t \\\\n \\\t\\",), ('"q" x',), (" pad ",), ("",), (None,), ("back\\slash",)]
    write_tsv(spark.createDataFrame(texts, "tweet string").withColumn("k", F.lit("k")), str(tmp_path / "out"))
    back = spark.read.option("sep", "\t").option("header", True).option("escape", '"').csv(str(tmp_path / "out"))
    # an empty text and a missing one look the same in the file
    want = {text or None for text, in texts}
    assert {row["t"] for row in back.select(unescaped(F.col("tweet")).alias("t")).collect()} == want
    assert all("\t" not in line["value"].removesuffix("\tk").removesuffix("\tk") for line in spark.read.text(str(tmp_path / "out")).collect() if line["value"] != "tweet\tk")


def test_compressed_export_is_small_and_loads_whole(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("moodlens.sinks.files.ROWS_PER_FILE", 20)
    text = F.concat(F.repeat(F.lit("many words\tand a\\line\n"), 50), F.col("id").cast("string"))
    rows = spark.range(0, 70, 1, 1).select(
        F.lit("u").alias("user_id"), F.col("id").cast("string").alias("tweet_id"), text.alias("tweet"),
        F.when(F.col("id") % 7 == 0, "no time").otherwise("2024-01-01T00:00:00").alias("timestamp"), F.lit("1,2").alias("location"),
    )
    write_tsv(rows, str(tmp_path / "out"), compression="gzip")
    files = list((tmp_path / "out").glob("*.gz"))
    assert len(files) == 4 and sum(f.stat().st_size for f in files) < 70 * 1000 / 2
    bulk_load(spark, str(tmp_path / "out"), str(tmp_path / "table"), escapes=True)
    valid, rejected = read_loaded(spark, str(tmp_path / "table"))
    back = valid.select("tweet_id", "tweet").union(rejected.select("tweet_id", "tweet")).collect()
    assert sorted(back) == sorted(rows.select("tweet_id", "tweet").collect()) and rejected.count() == 10
