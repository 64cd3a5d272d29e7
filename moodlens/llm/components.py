"""Connected components of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodlens.session import checkpointed


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected(links: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node of its component, for every node of ``links`` (u, v; longs) but the roots.

    A round links the larger neighbours of each node to its smallest one, then the smaller neighbours, until nothing changes; each round
    is written to the shared folder. Minima are aggregated before they are joined, so a node with many links is no single task's work.
    """
    pairs = links.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    pairs = checkpointed(pairs)
    last = _state(pairs)
    while last[0]:
        both = pairs.union(pairs.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        pairs = checkpointed(small.union(least.select("u", F.col("m").alias("v"))).distinct())
        now = _state(pairs)
        if now == last:
            break
        last = now
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("root"))
