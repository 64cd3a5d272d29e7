"""One query per operator; each takes a session and the folder of the tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from moodlens.catalog import fixtures
from moodlens.functions import clean_text, day_name
from moodlens.operators import (
    RegionIndex,
    add_sentiment,
    add_time,
    assign_region,
    facet_summary,
    join_users_tweets,
    read_index,
    region_index,
    sentiment_by_day_of_week,
    sentiment_by_hour,
    sentiment_by_length,
    sentiment_by_location,
    sentiment_by_state,
    stemmed_term_counts,
    term_counts,
    write_index,
)
from moodlens.operators.joins import MAX_BROADCAST_BYTES
from moodlens.plans import (
    prepare_feed,
    previews,
    process_tweets,
    replay_once,
    replay_stream,
    run_historical,
    run_incremental,
    run_live,
    run_live_store,
)
from moodlens.schemas import RESULT_KEYS
from moodlens.session import discard, pin_session, scratch_path
from moodlens.sinks import (
    ClusteredStore,
    buckets_for,
    bulk_load,
    conform,
    join_users_clustered,
    publish_json,
    read_loaded,
    read_store,
    to_json_values,
    upsert_parquet,
    write_clustered,
    write_tsv,
)
from moodlens.sinks.files import unescaped
from moodlens.sources import across_antimeridian, load_regions, parse_users, read_tweets, sample_for_replay, split_raw_tweets, tweets_of_user
from moodlens.sources.tweets import REJECTED
from moodlens.streaming import (
    WindowStore,
    decode_payload,
    enrich,
    event_time,
    malformed,
    read_value_stream,
    window_sentiment,
    write_stream,
)

Query = Callable[[SparkSession, str], DataFrame]

USER = "7"
# degrees that bring the middle of the regions to the 180th meridian
MOVED_EAST = 275
# of a small table; a larger one has a bucket for every 128 MB
STORE_BUCKETS = 16
# messages with whole texts are kept compressed, in files that can be split
TOPIC = "parquet"


def _naive(column: Column | str) -> Column:
    """A timestamp as the UTC wall clock, which reads the same in any client."""
    return (F.col(column) if isinstance(column, str) else column).cast("timestamp_ntz")


def _rounded(df: DataFrame) -> DataFrame:
    """Results rounded to six places, as the last digits of a sum depend on the order of its terms.

    The offset keeps a value that ends in half a unit of the sixth place from going either way.
    """
    return df.select(
        *[F.round(F.col(name) + 1e-8, 6).alias(name) if kind == "double" else F.col(name) for name, kind in df.dtypes]
    )


def _tweets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.tweets(pin_session(spark), sf_dir)


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return add_sentiment(_tweets(spark, sf_dir), fixtures.lexicon(spark))


def _index(spark: SparkSession, sf_dir: str) -> RegionIndex:
    return region_index(fixtures.regions(spark, sf_dir))


def tweets_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tweets(spark, sf_dir).withColumn("timestamp", _naive("timestamp"))


def tweet_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tweets(spark, sf_dir).agg(F.count("*").alias("tweets"))


def tweets_of_one_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tweets_of_user(_tweets(spark, sf_dir), USER).withColumn("timestamp", _naive("timestamp"))


def tweets_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tweets(spark, sf_dir).select("tweet_id", clean_text("tweet").alias("clean_tweet"))


def tweet_sentiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(spark, sf_dir).select("tweet_id", "tweet_sentiment")


def tweet_time_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    timed = add_time(_tweets(spark, sf_dir)).withColumn("day_name", day_name("timestamp_day_of_week"))
    return timed.drop("user_id", "tweet", "timestamp", "location")


def by_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(sentiment_by_location(_scored(spark, sf_dir)))


def by_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(sentiment_by_hour(add_time(_scored(spark, sf_dir))))


def by_day_of_week(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(sentiment_by_day_of_week(add_time(_scored(spark, sf_dir))))


def by_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(sentiment_by_length(_scored(spark, sf_dir)))


def by_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(sentiment_by_state(_scored(spark, sf_dir), _index(spark, sf_dir)))


def by_state_two_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(sentiment_by_state(_scored(spark, sf_dir), _index(spark, sf_dir), by_location_first=True))


def region_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign_region(_tweets(spark, sf_dir).select("location").distinct(), _index(spark, sf_dir))


def region_of_tweet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lookup for indexes too large to be broadcast."""
    index = region_index(fixtures.regions(spark, sf_dir), max_broadcast_bytes=0)
    located = assign_region(_tweets(spark, sf_dir).select("tweet_id", "location"), index)
    return located.select("tweet_id", "region_name", "region_code")


def region_lookup_crowded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lookup where one region has so many edges in a few cells that these are cut up."""
    regions = fixtures.regions(pin_session(spark), sf_dir).unionByName(fixtures.ridge(spark, sf_dir))
    return assign_region(_tweets(spark, sf_dir).select("location").distinct(), region_index(regions, max_cell_entries=16))


def region_lookup_antimeridian(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lookup with regions and locations moved to both sides of the 180th meridian."""
    regions = across_antimeridian(fixtures.moved_regions(pin_session(spark), sf_dir, MOVED_EAST))
    return assign_region(fixtures.moved_locations(spark, sf_dir, MOVED_EAST), region_index(regions))


def summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(facet_summary(_scored(spark, sf_dir), _index(spark, sf_dir)))


def facet_previews(spark: SparkSession, sf_dir: str) -> DataFrame:
    results = process_tweets(_tweets(spark, sf_dir), fixtures.lexicon(spark), _index(spark, sf_dir))
    shown = [preview.select(F.lit(name).alias("facet"), "*") for name, preview in previews(results).items()]
    return _rounded(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), shown))


def large_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = add_sentiment(_tweets(spark, sf_dir), fixtures.document_lexicon(spark, sf_dir))
    return scored.select("tweet_id", "tweet_sentiment")


def sentiment_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scores with a lexicon too large for a slot table, which is joined."""
    scored = add_sentiment(_tweets(spark, sf_dir), fixtures.document_lexicon(spark, sf_dir), max_table_bytes=0)
    return scored.select("tweet_id", "tweet_sentiment")


def tweet_count_observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The number of tweets, taken from the pass that computes the facets."""
    observation = Observation("tweets")
    process_tweets(_tweets(spark, sf_dir), fixtures.lexicon(spark), _index(spark, sf_dir), observation)
    return spark.createDataFrame([(observation.get["tweets"],)], "tweets bigint")


def _stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "tweets")
    _tweets(spark, sf_dir).write.parquet(path)
    return read_tweets(spark, path)


def stored_tweets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(spark, sf_dir).withColumn("timestamp", _naive("timestamp"))


def stored_tweets_of_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tweets_of_user(_stored(spark, sf_dir), USER).withColumn("timestamp", _naive("timestamp"))


def _loaded_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(pin_session(spark), "regions")
    fixtures.write_region_files(spark, sf_dir, path)
    return load_regions(spark, path, "geojson")


def regions_loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The vertices with the rank of their region; regions are few, so one task ranks them."""
    loaded = _loaded_regions(spark, sf_dir)
    rank = Window.partitionBy(F.lit(0)).orderBy("ordinal")
    ranks = loaded.select("ordinal").distinct().select("ordinal", (F.row_number().over(rank) - 1).cast("bigint").alias("rank"))
    return loaded.join(ranks, "ordinal").drop("ordinal")


def region_lookup_geojson(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lookup with an index made from GeoJSON files, kept as a table and read back."""
    path = scratch_path(spark, "index")
    write_index(region_index(_loaded_regions(spark, sf_dir)), path)
    return assign_region(_tweets(spark, sf_dir).select("location").distinct(), read_index(spark, path))


def historical_stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stores and the tables of unkeyed groups after the historical job has run twice."""
    path = scratch_path(spark, "results")
    for _ in range(2):
        run_historical(spark, _tweets(spark, sf_dir), fixtures.lexicon(spark), _index(spark, sf_dir), path)
    return _stores(spark, path)


def historical_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same stores filled part by part; the second part runs twice, as after a failure."""
    path, states = scratch_path(spark, "results"), scratch_path(spark, "states")
    tweets, lexicon, index = _tweets(spark, sf_dir), fixtures.lexicon(spark), _index(spark, sf_dir)
    odd = F.col("tweet_id").cast("bigint") % 2 == 1
    for part, rows in (("a", ~odd), ("b", odd), ("b", odd)):
        run_incremental(spark, tweets.where(rows), lexicon, index, states, part, path)
    discard(spark, states)
    return _stores(spark, path)


def _stores(spark: SparkSession, path: str) -> DataFrame:
    parts = []
    for target, key in RESULT_KEYS.items():
        kept = read_store(spark, f"{path}/{target}").unionByName(spark.read.parquet(f"{path}/{target}_unkeyed"))
        measures = [F.round(F.col(m), 3).alias(m) for m in ("total_sentiment", "absolute_sentiment", "mean_sentiment")]
        parts.append(kept.select(F.lit(target).alias("store"), F.col(key).cast("string").alias("key"), "count", *measures))
    return reduce(DataFrame.unionByName, parts)


def _feed(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """Folders of the export and the rejects of the feed job."""
    users, raw, feed = (scratch_path(pin_session(spark), name) for name in ("users", "raw", "feed"))
    fixtures.user_lines(spark, sf_dir).write.text(users)
    fixtures.tweet_lines(spark, sf_dir).write.options(**{"zlib.compress.level": "BEST_SPEED"}).text(raw, compression="gzip")
    prepare_feed(spark, users, raw, feed, f"{feed}_rejects", compression="gzip")
    discard(spark, users, raw)
    return feed, f"{feed}_rejects"


def feed_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    exported = spark.read.option("sep", "\t").option("header", True).option("escape", '"').csv(_feed(spark, sf_dir)[0])
    typed = {"latitude": F.col("latitude").cast("double"), "longitude": F.col("longitude").cast("double")}
    return exported.withColumns({**typed, "tweet": unescaped(F.col("tweet")), "timestamp": F.coalesce("timestamp", F.lit(""))})


def feed_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(_feed(spark, sf_dir)[1])


def user_tweet_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    tweets = _tweets(spark, sf_dir).drop("location").withColumn("timestamp", _naive("timestamp"))
    return join_users_tweets(parse_users(fixtures.user_lines(spark, sf_dir)), tweets, max_broadcast_bytes=MAX_BROADCAST_BYTES)


def users_parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_users(fixtures.user_lines(spark, sf_dir))


def _raw_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_raw_tweets(fixtures.tweet_lines(pin_session(spark), sf_dir))


def raw_tweets_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _raw_split(spark, sf_dir).where(F.col(REJECTED).isNull()).drop(REJECTED)


def raw_tweets_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _raw_split(spark, sf_dir).where(F.col(REJECTED).isNotNull())


def _bulk_loaded(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    exported, loaded = scratch_path(spark, "tsv"), scratch_path(spark, "loaded")
    stamp = F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    write_tsv(_tweets(spark, sf_dir).withColumn("timestamp", F.coalesce(stamp, F.lit("no time"))), exported, compression="gzip")
    bulk_load(spark, exported, loaded, escapes=True)
    discard(spark, exported)
    return read_loaded(spark, loaded)


def tsv_ingest_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid, _ = _bulk_loaded(spark, sf_dir)
    return valid.withColumn("timestamp", _naive("timestamp"))


def tsv_ingest_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, rejected = _bulk_loaded(spark, sf_dir)
    return rejected.drop("line")


def facet_store_conform(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform(by_state(spark, sf_dir), "state_reduced")


def facet_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The length facet of the conversations, then that of the documents laid over it."""
    path = scratch_path(pin_session(spark), "store")
    for name in ("conversations", "documents"):
        texts = fixtures.table(spark, sf_dir, name).select(F.col("text").alias("tweet"))
        facet = sentiment_by_length(add_sentiment(texts, fixtures.lexicon(spark)))
        upsert_parquet(conform(_rounded(facet), "length_reduced"), path, "tweet_length")
    return read_store(spark, path)


def json_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = decode_payload(fixtures.messages(pin_session(spark), sf_dir))
    return decoded.select(
        "user_id",
        "tweet_id",
        "tweet",
        _naive(event_time("timestamp")).alias("timestamp"),
        "location",
        _naive(event_time()).alias("date_time"),
    )


def replay_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    sample = to_json_values(sample_for_replay(_tweets(spark, sf_dir)), F.lit("2024-02-01 00:00:00").cast("timestamp"))
    return decode_payload(sample).select("user_id", "tweet_id", "tweet", "location", "timestamp_logger")


def replay_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    topic = scratch_path(pin_session(spark), "topic")
    replay_once(fixtures.tweets(spark, sf_dir), "text", ingest_time=F.lit("2024-02-01 00:00:00").cast("timestamp"), path=topic)
    decoded = decode_payload(spark.read.text(topic))
    return decoded.select("user_id", "tweet_id", "tweet", "location", "timestamp_logger")


def replay_streamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sample after three sends, each by a run of the stream that goes on where the last one ended."""
    topic, checkpoint = scratch_path(pin_session(spark), "topic"), scratch_path(spark, "stream")
    for _ in range(3):
        query = replay_stream(
            fixtures.tweets(spark, sf_dir), "text", checkpoint, start_ms=1_706_745_600_000, path=topic, trigger={"availableNow": True}
        )
        query.awaitTermination()
    discard(spark, checkpoint)
    return decode_payload(spark.read.text(topic)).select("user_id", "tweet_id", "tweet", "location", "timestamp_logger")


def _windows(df: DataFrame) -> DataFrame:
    bounds = {"window_start": _naive("window.start"), "window_end": _naive("window.end")}
    return _rounded(df.withColumns(bounds).drop("window"))


def window_sentiment_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    tweets = _tweets(spark, sf_dir)
    enriched = enrich(tweets, fixtures.lexicon(spark), _index(spark, sf_dir), event_time="timestamp")
    return _windows(window_sentiment(enriched))


def _streamed(
    spark: SparkSession, sf_dir: str, measures: Sequence[str] | None, panes: bool = False, lexicon: DataFrame | None = None
) -> DataFrame:
    topic, out, checkpoint = (scratch_path(pin_session(spark), name) for name in ("topic", "out", "stream"))
    publish_json(fixtures.tweets(spark, sf_dir), TOPIC, F.col("timestamp"), topic)
    query = run_live(
        read_value_stream(spark, TOPIC, topic),
        fixtures.lexicon(spark) if lexicon is None else lexicon,
        _index(spark, sf_dir),
        "parquet",
        checkpoint,
        out,
        {"availableNow": True},
        measures,
        panes=panes,
    )
    query.awaitTermination()
    discard(spark, topic, checkpoint)
    return spark.read.parquet(out)


def stream_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The messages nobody can read: those of tweets without a readable location are broken on purpose."""
    topic, out, checkpoint = (scratch_path(pin_session(spark), name) for name in ("topic", "out", "stream"))
    tweets = fixtures.tweets(spark, sf_dir)
    broken = F.when(F.col("location") == "n/a", F.concat(F.lit("{broken "), F.col("tweet_id")))
    whole = F.to_json(F.struct("user_id", "tweet_id", "tweet", "location"))
    tweets.select(F.coalesce(broken, whole).alias("value")).write.format(TOPIC).save(topic)
    unread = malformed(read_value_stream(spark, TOPIC, topic))
    write_stream(unread, "parquet", checkpoint, out, {"availableNow": True}).awaitTermination()
    discard(spark, topic, checkpoint)
    return spark.read.parquet(out)


def stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The later half of the tweets comes first; the earlier half, which is late, after the stream has been stopped and resumed."""
    topic, out, checkpoint = (scratch_path(pin_session(spark), name) for name in ("topic", "out", "stream"))
    tweets, index = fixtures.tweets(spark, sf_dir), _index(spark, sf_dir)
    millis = F.unix_millis("timestamp")
    bounds = tweets.agg(F.min(millis).alias("a"), F.max(millis).alias("b")).first()
    if bounds["a"] is not None:
        middle = (bounds["a"] + bounds["b"]) // 2
        for half in (millis >= middle, millis < middle):
            publish_json(tweets.where(half), TOPIC, F.col("timestamp"), topic)
            messages = read_value_stream(spark, TOPIC, topic)
            live = run_live(messages, fixtures.lexicon(spark), index, "parquet", checkpoint, out, {"availableNow": True})
            live.awaitTermination()
    discard(spark, topic, checkpoint)
    return _windows(spark.read.parquet(out))


def stream_window_sentiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _windows(_streamed(spark, sf_dir, ("mean_sentiment", "max_sentiment", "min_sentiment")))


def stream_window_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _windows(_streamed(spark, sf_dir, ("total_sentiment", "absolute_sentiment")))


def stream_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _streamed(spark, sf_dir, None).withColumn("date_time", _naive("date_time"))


def stream_pane_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _windows(_streamed(spark, sf_dir, ("mean_sentiment", "max_sentiment", "min_sentiment"), panes=True))


def stream_large_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream scored with every word of the documents as a term."""
    scored = _streamed(spark, sf_dir, None, lexicon=fixtures.document_lexicon(pin_session(spark), sf_dir))
    return scored.select("location", "sentiment", _naive("date_time").alias("date_time"))


def _live_store(spark: SparkSession, sf_dir: str) -> WindowStore:
    """A store fed with the later half of the tweets, then with the earlier half and those without a time, then with nothing."""
    topic, checkpoint = scratch_path(pin_session(spark), "topic"), scratch_path(spark, "stream")
    store = WindowStore(scratch_path(spark, "store"))
    tweets, index = fixtures.tweets(spark, sf_dir), _index(spark, sf_dir)
    millis = F.unix_millis("timestamp")
    middle = tweets.agg(F.floor((F.min(millis) + F.max(millis)) / 2)).first()[0]
    later = F.coalesce(millis >= F.lit(middle), F.lit(False))
    for rows in (later, ~later, F.lit(False)):
        publish_json(tweets.where(rows), TOPIC, F.col("timestamp"), topic)
        messages = read_value_stream(spark, TOPIC, topic)
        run_live_store(messages, fixtures.lexicon(spark), index, store, checkpoint, {"availableNow": True}).awaitTermination()
    discard(spark, topic, checkpoint)
    return store


def stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = _live_store(spark, sf_dir).windows(spark)
    bounds = {name: _naive(name) for name in ("window_start", "window_end")}
    return _rounded(stored.withColumns(bounds))


def stream_late_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    late = _live_store(spark, sf_dir).late(spark)
    return late.select("location", "state", "sentiment", _naive("date_time").alias("date_time"), "missed")


def index_term_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return term_counts(_tweets(spark, sf_dir))


def index_stem_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stemmed_term_counts(_tweets(spark, sf_dir))


def _clustered(spark: SparkSession, sf_dir: str) -> ClusteredStore:
    """A store of the tweets by user; those of every third event are given to one user, and those of an error to none."""
    event = F.col("tweet_id").cast("bigint")
    user = F.when(event % 3 == 0, F.lit(USER)).when(F.col("location") != "n/a", F.col("user_id"))
    tweets = _tweets(spark, sf_dir).withColumn("user_id", user)
    return write_clustered(tweets, scratch_path(spark, "clustered"), buckets_for(tweets, STORE_BUCKETS))


def clustered_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _clustered(spark, sf_dir).all_rows().withColumn("timestamp", _naive("timestamp"))


def clustered_tweets_of_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _clustered(spark, sf_dir).of_key(USER).withColumn("timestamp", _naive("timestamp"))


def clustered_user_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = join_users_clustered(parse_users(fixtures.user_lines(spark, sf_dir)), _clustered(spark, sf_dir))
    return joined.withColumn("timestamp", _naive("timestamp"))


QUERIES: dict[str, Query] = {
    "sentiment_by_state": by_state,
    "sentiment_by_state_two_level": by_state_two_level,
    "tweets_scan": tweets_scan,
    "tweet_count": tweet_count,
    "tweets_of_user": tweets_of_one_user,
    "tweets_clean": tweets_clean,
    "tweet_sentiment": tweet_sentiment,
    "tweet_time_parts": tweet_time_parts,
    "sentiment_by_location": by_location,
    "sentiment_by_hour": by_hour,
    "sentiment_by_day_of_week": by_day_of_week,
    "sentiment_by_length": by_length,
    "region_lookup": region_lookup,
    "region_lookup_shuffled": region_of_tweet,
    "region_lookup_crowded": region_lookup_crowded,
    "region_lookup_antimeridian": region_lookup_antimeridian,
    "facet_summary": summary,
    "facet_previews": facet_previews,
    "user_tweet_join": user_tweet_join,
    "parse_users": users_parsed,
    "raw_tweets_valid": raw_tweets_valid,
    "raw_tweets_rejected": raw_tweets_rejected,
    "tsv_ingest_valid": tsv_ingest_valid,
    "tsv_ingest_rejected": tsv_ingest_rejected,
    "facet_store_conform": facet_store_conform,
    "facet_upsert": facet_upsert,
    "json_round_trip": json_round_trip,
    "replay_sample": replay_sample,
    "window_sentiment_batch": window_sentiment_batch,
    "stream_window_sentiment": stream_window_sentiment,
    "stream_window_total": stream_window_total,
    "stream_raw": stream_raw,
    "term_counts": index_term_counts,
    "tweet_sentiment_large_lexicon": large_lexicon,
    "stored_tweets": stored_tweets,
    "stored_tweets_of_user": stored_tweets_of_user,
    "regions_loaded": regions_loaded,
    "region_lookup_geojson": region_lookup_geojson,
    "historical_stores": historical_stores,
    "feed_export": feed_export,
    "feed_rejects": feed_rejects,
    "replay_topic": replay_topic,
    "stream_malformed": stream_malformed,
    "stream_late_rows": stream_late_rows,
    "tweet_sentiment_joined": sentiment_joined,
    "tweet_count_observed": tweet_count_observed,
    "historical_incremental": historical_incremental,
    "replay_stream": replay_streamed,
    "stream_pane_windows": stream_pane_windows,
    "stream_large_lexicon": stream_large_lexicon,
    "stream_upsert": stream_upsert,
    "stream_late_quarantine": stream_late_quarantine,
    "stemmed_term_counts": index_stem_counts,
    "clustered_store": clustered_store,
    "clustered_tweets_of_user": clustered_tweets_of_user,
    "clustered_user_join": clustered_user_join,
}
