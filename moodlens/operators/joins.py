"""Equi-joins of the feed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodlens.session import checkpointed, salted_join

#: Bytes of users that go to every task instead of having the tweets exchanged.
MAX_BROADCAST_BYTES = 64 << 20
# what a user takes besides the id
_USER_BYTES = 64


def join_users_tweets(users: DataFrame, tweets: DataFrame, salts: int | None = None, max_broadcast_bytes: int = 0) -> DataFrame:
    """Inner join on ``user_id``, user columns first, plus the ``location`` later stages want.

    Duplicate ids multiply; null ids match nothing. The join strategy follows from the sizes, and a hot user's
    partition is split at run time; ``salts`` spreads every user up front instead, for clusters without that. Users that take at most ``max_broadcast_bytes`` are computed
    first and broadcast, so the tweets are not exchanged at all.
    """
    if max_broadcast_bytes:
        users = checkpointed(users)
        size = users.agg(F.sum(F.coalesce(F.octet_length("user_id"), F.lit(0)) + _USER_BYTES)).first()[0] or 0
        if size <= max_broadcast_bytes:
            users, salts = F.broadcast(users), None
    if salts:
        joined = salted_join(tweets, users, ["user_id"], salts=salts)
    else:
        joined = users.join(tweets, "user_id")
    tweet_columns = [name for name in tweets.columns if name != "user_id"]
    location = F.concat_ws(",", F.col("latitude").cast("string"), F.col("longitude").cast("string"))
    return joined.select(
        "user_id",
        "latitude",
        "longitude",
        *tweet_columns,
        F.when(F.col("latitude").isNotNull() & F.col("longitude").isNotNull(), location).alias("location"),
    )
