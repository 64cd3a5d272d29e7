"""The store laid out by user: rows kept, exchanges, files read."""

import uuid

import pytest
from pyspark.sql import functions as F

from moodlens.schemas import TWEET
from moodlens.session import scratch_path
from moodlens.sinks import buckets_for, clustered, join_users_clustered, open_clustered, write_clustered

BUCKETS = 8


@pytest.fixture(scope="module")
def tweets(spark):
    """A hot user with a third of the rows, a ninth without user, the rest with some forty users."""
    n = F.col("id")
    user = F.when(n % 3 == 0, F.lit("hot")).when(n % 9 != 1, F.concat(F.lit("u"), n % 41))
    return spark.range(0, 3000, 1, 6).select(
        user.alias("user_id"),
        (n % 2000).cast("string").alias("tweet_id"),
        F.concat(F.lit("text "), n % 7).alias("tweet"),
        F.timestamp_seconds(n).alias("timestamp"),
        F.lit("1,2").alias("location"),
    )


@pytest.fixture(scope="module")
def users(spark):
    rows = [(f"u{i}", float(i), 1.0) for i in range(30)] + [("hot", 5.0, None), ("hot", 6.0, 7.0), (None, 1.0, 1.0), ("none", 0.0, 0.0)]
    return spark.createDataFrame(rows, "user_id string, latitude double, longitude double")


@pytest.fixture(scope="module")
def store(spark, tweets):
    return write_clustered(tweets, scratch_path(spark, "clustered"), BUCKETS)


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _same(a, b):
    return a.exceptAll(b.select(a.columns)).count() == 0 and b.select(a.columns).exceptAll(a).count() == 0


def _expected(users, tweets):
    joined = users.join(tweets.drop("location"), "user_id")
    place = F.concat_ws(",", F.col("latitude").cast("string"), F.col("longitude").cast("string"))
    return joined.withColumn("location", F.when(F.col("longitude").isNotNull(), place))


def test_rows_are_kept(store, tweets):
    assert _same(store.all_rows(), tweets)
    assert [r["user_id"] for r in store.hot.collect()] == ["hot"]


def test_one_user(store, tweets):
    for user in ("u7", "hot", "nobody"):
        assert _same(store.of_key(user), tweets.where(F.col("user_id") == user))


def test_join(users, store, tweets):
    assert _same(join_users_clustered(users, store), _expected(users, tweets))


def test_join_with_too_many_hot_users(users, store, tweets):
    joined = join_users_clustered(users, store, max_hot_users=0)
    assert _same(joined, _expected(users, tweets))


def test_tweets_are_not_exchanged(users, store, no_broadcast):
    plan = _plan(join_users_clustered(users, store))
    assert "SortMergeJoin" in plan and "Bucketed: true" in plan
    # the users' exchange into buckets and the hot users' broadcast
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("BroadcastExchange") == 1


def test_one_bucket_is_read(spark, store):
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", str(1 << 30))
    try:
        cold = store.rows.where(~F.col("spread"))
        # a file is a task of its own here
        assert cold.where("user_id = 'u7'").rdd.getNumPartitions() == 1
        assert cold.rdd.getNumPartitions() == BUCKETS
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", before)


def test_hot_rows_take_several_files_and_few(store):
    files = store.rows.where("spread").groupBy(F.input_file_name().alias("f"), "user_id").count().collect()
    hot = [r["count"] for r in files if r["user_id"] == "hot"]
    assert len(hot) == 3 and max(hot) < 2 * min(hot)
    assert len({r["f"] for r in files}) <= BUCKETS


def _scanned(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().collectLeaves().head().metrics().apply("numOutputRows").value()


def test_row_groups_without_the_user_are_skipped(spark):
    """Each user comes once, so that no dictionary holds them and the Bloom filter has to tell."""
    user = F.sha2((F.col("id") * 2).cast("string"), 256)
    text = F.lit(None).cast("string")
    many = spark.range(100_000).select(user.alias("user_id"), text.alias("tweet_id"))
    store = write_clustered(many, scratch_path(spark, "clustered"), 2)
    absent, present = (spark.range(1).select(F.sha2(F.lit(n), 256)).first()[0] for n in ("77", "78"))
    assert _scanned(store.of_key(absent)) == 0
    found = store.of_key(present)
    assert 0 < _scanned(found) <= 51_000 and found.count() == 1


def test_another_session_opens_it(spark, tweets):
    path = scratch_path(spark, "clustered")
    written = write_clustered(tweets, path, BUCKETS)
    name = written.rows.limit(0)._jdf.queryExecution().analyzed().toString()
    table = next(t.name for t in spark.catalog.listTables() if t.name in name)
    spark.sql(f"DROP TABLE {table}")
    reopened = open_clustered(spark, path)
    assert _same(reopened.all_rows(), tweets) and reopened.buckets == BUCKETS
    assert [r["user_id"] for r in reopened.hot.collect()] == ["hot"]


def test_an_empty_table_and_one_without_users(spark, users):
    empty = spark.createDataFrame([], TWEET)
    store = write_clustered(empty, scratch_path(spark, "clustered"), BUCKETS)
    assert store.all_rows().count() == 0 and join_users_clustered(users, store).count() == 0
    nobody = spark.createDataFrame([(None, str(i), None, None, None) for i in range(50)], TWEET)
    store = write_clustered(nobody, scratch_path(spark, "clustered"), BUCKETS)
    assert _same(store.all_rows(), nobody) and join_users_clustered(users, store).count() == 0


def test_own_columns_and_existing_stores_are_refused(spark, tweets):
    with pytest.raises(ValueError, match="own columns"):
        write_clustered(tweets.withColumn("Spread", F.lit(1)), f"/tmp/{uuid.uuid4().hex}", BUCKETS)
    path = scratch_path(spark, "clustered")
    write_clustered(tweets.limit(5), path, BUCKETS)
    with pytest.raises(Exception, match="already exists"):
        write_clustered(tweets.limit(5), path, BUCKETS)


def test_a_larger_table_has_more_buckets(tweets):
    assert buckets_for(tweets, 8) == 8
    some, twice = (buckets_for(df, 8, bucket_bytes=4096) for df in (tweets, tweets.unionByName(tweets)))
    assert some > 8 and twice in (2 * some - 1, 2 * some)


def test_a_large_store_is_written_by_groups(spark, tweets, users, monkeypatch):
    """Three groups of three buckets at most, each exchanged alone; the store is the one that a single exchange gives."""
    counts = []
    write = clustered._write_buckets
    monkeypatch.setattr(clustered, "_write_buckets", lambda rows, *more: (counts.append(rows.count()), write(rows, *more)))
    store = write_clustered(tweets, scratch_path(spark, "clustered"), BUCKETS, group_buckets=3)
    assert len(counts) == 3 and sum(counts) == 3000 and max(counts) < 2000
    assert _same(store.all_rows(), tweets) and _same(store.of_key("hot"), tweets.where("user_id = 'hot'"))
    assert _same(join_users_clustered(users, store), _expected(users, tweets))
    files = store.rows.where("spread").groupBy(F.input_file_name(), "user_id").count().collect()
    assert len([r for r in files if r["user_id"] == "hot"]) == 3
    cold = store.rows.where(~F.col("spread")).select("user_id", F.input_file_name().alias("f")).distinct()
    assert cold.groupBy("user_id").count().where("count > 1").isEmpty()
    empty = write_clustered(tweets.limit(0), scratch_path(spark, "clustered"), BUCKETS, group_buckets=3)
    assert empty.all_rows().count() == 0


def test_neighbours_among_hot_rows_stay_together(spark, tweets, store):
    """Rows of a hot user that come together lie together, so that those alike are compressed as one."""
    ids = [[int(r["tweet_id"]) for r in rows] for rows in _files_of(store, "hot")]
    near = sum(abs(b - a) == 3 for part in ids for a, b in zip(part, part[1:]))
    assert near > sum(map(len, ids)) // 2


def _files_of(store, user):
    rows = store.rows.where(F.col("spread") & (F.col("user_id") == user)).select("tweet_id", F.input_file_name().alias("f")).collect()
    return [[r for r in rows if r["f"] == f] for f in sorted({r["f"] for r in rows})]
