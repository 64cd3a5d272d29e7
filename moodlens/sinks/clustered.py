"""A tweet store laid out by user, so that joins on the user need no exchange of the tweets and one user's tweets are few files.

The store is one Parquet table, bucketed and sorted by the key. A row group holds a dictionary of the key or, with too many keys for
one, a Bloom filter, so one without a wanted key is skipped. A bucket is read by one task, so rows of hot keys and of no key would crowd one; these rows are dealt over as many files as they fill, in a partition
of their own, ``spread = true``, which is read in splits of even size.
"""

from __future__ import annotations

import hashlib
import json
import math
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moodlens.operators.joins import join_users_tweets
from moodlens.session import checkpointed, discard, free_exchanges, scratch_path

SPREAD = "spread"
# A row's bucket takes the place of its key's number of files, its group that of its hot key.
_BUCKET, _GROUP = "_files", "_hot"
# A hot user is joined by broadcast while the users of hot ids are no more than this.
MAX_HOT_USERS = 100_000


# What a bucket holds of the rows as they come; a task reads one bucket.
BUCKET_BYTES = 128 << 20
# A store of more buckets is written by groups of at most so many, so that the exchange of one group is all that lies beside the rows.
GROUP_BUCKETS = 128
# Neighbouring rows that a hot key's files get together, which leaves rows alike beside each other.
RUN_ROWS = 64


@dataclass(frozen=True)
class ClusteredStore:
    """``rows`` of the store with the column ``spread``, and the hot keys, fewer than there are buckets."""

    rows: DataFrame
    hot: DataFrame
    key: str
    buckets: int

    def all_rows(self) -> DataFrame:
        return self.rows.drop(SPREAD)

    def of_key(self, value: str) -> DataFrame:
        """The rows of one key: one bucket and the spread files; row groups without the key are skipped."""
        return self.rows.where(F.col(self.key) == value).drop(SPREAD)


def buckets_for(df: DataFrame, at_least: int, bucket_bytes: int = BUCKET_BYTES) -> int:
    """How many buckets a store of ``df`` needs for ``bucket_bytes`` a bucket, ``at_least`` for a small one; reads the rows once."""
    texts = [F.coalesce(F.octet_length(name), F.lit(0)) for name, kind in df.dtypes if kind in ("string", "binary")]
    row = sum(texts, F.lit(8 * len(df.columns)).cast("bigint"))
    return max(at_least, math.ceil((df.agg(F.sum(row)).first()[0] or 0) / bucket_bytes))


def write_clustered(df: DataFrame, path: str, buckets: int, key: str = "user_id", group_buckets: int = GROUP_BUCKETS) -> ClusteredStore:
    """Write ``df`` as a new store at ``path``; a store that is there already is an error.

    A key is hot if it holds more than a bucket's even share of the rows. The rows are read twice, the first time for their keys
    alone, and exchanged once. With more than ``group_buckets`` buckets they are first kept, compressed, in a folder for each group of
    buckets; a group is exchanged from its folder, which is then deleted. The layout is written last, so a store whose writer failed
    cannot be opened.
    """
    spark = df.sparkSession
    taken = {SPREAD, "_files", "_hot"} & {name.lower() for name in df.columns}
    if taken:
        raise ValueError(f"{sorted(taken)} are the store's own columns")
    total = df.agg(F.count(F.lit(1)).alias("n"))
    share = F.ceil(F.col("n") * buckets / total.scalar()).cast("int").alias("_files")
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).select(key, share)
    hot = checkpointed(counts.where((F.col("_files") > 1) | F.col(key).isNull()))
    own, other = df.alias("own"), F.broadcast(hot.withColumnRenamed(key, "_hot")).alias("other")
    marked = own.join(other, F.col(f"own.`{key}`").eqNullSafe(F.col("other._hot")), "left").select(
        "own.*", F.col("_files").isNotNull().alias(SPREAD), "_files"
    )
    # the hash of a bucketed table, so that a task writes one bucket; rows of a hot key go to as many tasks as it fills, by a hash
    # of the row number, as hot rows may come at regular distances
    run = F.floor(F.monotonically_increasing_id() / RUN_ROWS)
    turn = F.pmod(F.xxhash64(run), F.coalesce("_files", F.lit(1))).cast("int")
    bucket = F.pmod(F.pmod(F.hash(key), F.lit(buckets)) + turn, F.lit(buckets))
    placed = marked.withColumn(_BUCKET, bucket)
    if buckets <= group_buckets:
        _write_buckets(placed, path, buckets, key, 0, buckets)
    else:
        _write_groups(placed, path, buckets, key, group_buckets)
    hot.where(F.col(key).isNotNull()).select(key).write.parquet(f"{path}/hot")
    layout = [(key, buckets, df.schema.json())]
    spark.createDataFrame(layout, "key string, buckets int, columns string").write.parquet(f"{path}/layout")
    return open_clustered(spark, path)


def _write_groups(placed: DataFrame, path: str, buckets: int, key: str, group_buckets: int) -> None:
    """Write the buckets group by group; the rows are computed once, so that a row's turn is drawn once."""
    spark, staged = placed.sparkSession, scratch_path(placed.sparkSession, "groups")
    schema = T.StructType([*placed.schema.fields, T.StructField(_GROUP, T.IntegerType())])
    try:
        free_exchanges(spark)
        placed.withColumn(_GROUP, F.floor(F.col(_BUCKET) / group_buckets).cast("int")).write.partitionBy(_GROUP).parquet(staged)
        for group, first in enumerate(range(0, buckets, group_buckets)):
            free_exchanges(spark)
            rows = spark.read.schema(schema).parquet(staged).where(F.col(_GROUP) == group).drop(_GROUP)
            _write_buckets(rows, path, buckets, key, first, min(group_buckets, buckets - first), "append" if group else "errorifexists")
            discard(spark, f"{staged}/{_GROUP}={group}")
    finally:
        discard(spark, staged)
    free_exchanges(spark)


def _write_buckets(rows: DataFrame, path: str, buckets: int, key: str, first: int, count: int, mode: str = "errorifexists") -> None:
    """Exchange rows of ``count`` buckets from ``first`` on, numbered in ``_files``, and write each bucket by a task."""
    dealt = rows.repartitionById(count, F.col(_BUCKET) - first).drop(_BUCKET)
    (
        dealt.write.mode(mode)
        .partitionBy(SPREAD)
        .bucketBy(buckets, key)
        .sortBy(key)
        .option("path", f"{path}/rows")
        .option(f"parquet.bloom.filter.enabled#{key}", "true")
        .saveAsTable(_table_name(path))
    )


def open_clustered(spark: SparkSession, path: str) -> ClusteredStore:
    """The store at ``path``, also one that another session wrote: its table is made known to this session's catalog."""
    layout = spark.read.parquet(f"{path}/layout").first()
    schema = T.StructType.fromJson(json.loads(layout["columns"]))
    name = _table_name(path)
    if not spark.catalog.tableExists(name):
        quoted = f"`{layout['key']}`"
        spark.sql(
            f"CREATE TABLE {name} ({schema.toDDL()}, {SPREAD} boolean) USING parquet PARTITIONED BY ({SPREAD}) "
            f"CLUSTERED BY ({quoted}) SORTED BY ({quoted}) INTO {layout['buckets']} BUCKETS LOCATION '{path}/rows'"
        )
        spark.catalog.recoverPartitions(name)
    return ClusteredStore(spark.table(name), spark.read.parquet(f"{path}/hot"), layout["key"], layout["buckets"])


def join_users_clustered(users: DataFrame, store: ClusteredStore, max_hot_users: int = MAX_HOT_USERS) -> DataFrame:
    """``join_users_tweets`` over a store clustered by ``user_id``.

    The location is the user's, as there; one that the tweets hold is left out. Users are exchanged to the store's buckets, the tweets stay where they are. Hot users' tweets meet their users by broadcast;
    the users with a hot id are counted first, and where there are too many of them the tweets are salted instead.
    """
    narrow = users.select("user_id", "latitude", "longitude")
    hot_users = checkpointed(narrow.join(F.broadcast(store.hot), "user_id", "left_semi"))
    crowd = join_users_tweets(narrow, store.rows.where(~F.col(SPREAD)).drop(SPREAD, "location"))
    hot_rows = store.rows.where(F.col(SPREAD) & F.col("user_id").isNotNull()).drop(SPREAD, "location")
    if hot_users.count() <= max_hot_users:
        joined = join_users_tweets(F.broadcast(hot_users), hot_rows)
    else:
        joined = join_users_tweets(hot_users, hot_rows, salts=store.buckets)
    return crowd.unionByName(joined)


def _table_name(path: str) -> str:
    return "clustered_" + hashlib.sha256(path.encode()).hexdigest()[:24]

