"""Sentiment statistics by state, hour, weekday and text length."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, GroupedData
from pyspark.sql import functions as F

from moodlens.functions.text import length_bucket
from moodlens.functions.timeparts import day_name, day_of_week
from moodlens.operators.regions import RegionIndex, assign_region

SENTIMENT = "tweet_sentiment"
MEASURES = ["count", "total_sentiment", "absolute_sentiment", "mean_sentiment"]
FACETS = ("state", "hour", "day", "length")


class FacetResults(NamedTuple):
    by_state: DataFrame
    by_hour: DataFrame
    by_day_of_week: DataFrame
    by_length: DataFrame


def add_time(tweets: DataFrame, timestamp: str = "timestamp") -> DataFrame:
    """Add year, month, day of month, hour and weekday (Monday is 0) of the timestamp."""
    return tweets.withColumns(
        {
            "timestamp_year": F.year(timestamp),
            "timestamp_month": F.month(timestamp),
            "timestamp_day": F.dayofmonth(timestamp),
            "timestamp_hour": F.hour(timestamp),
            "timestamp_day_of_week": day_of_week(timestamp),
        }
    )


def facet_stats(grouped: GroupedData, count_column: str) -> DataFrame:
    """Count, total, absolute and mean sentiment per group.

    The count is of ``count_column``, so the group of a null key counts 0 while its sums stay.
    """
    return grouped.agg(
        F.count(count_column).alias("count"),
        F.sum(SENTIMENT).alias("total_sentiment"),
        F.sum(F.abs(SENTIMENT)).alias("absolute_sentiment"),
        F.avg(SENTIMENT).alias("mean_sentiment"),
    )


def sentiment_by_location(scored: DataFrame) -> DataFrame:
    """Statistics per raw location."""
    return facet_stats(scored.groupBy("location"), "location")


def sentiment_by_state(scored: DataFrame, index: RegionIndex, by_location_first: bool = False) -> DataFrame:
    """Statistics per region.

    The lookup is a map-side join, so the tweets are aggregated straight to regions and only a row per region and
    task is shuffled. ``by_location_first`` groups equal locations before the lookup; it pays when the index is too
    large to be broadcast and locations repeat a lot.
    """
    if by_location_first:
        located = assign_region(sentiment_by_location(scored), index)
        sums = located.groupBy("region_name", "region_code").agg(
            F.sum("count").alias("count"),
            F.sum("total_sentiment").alias("total_sentiment"),
            F.sum("absolute_sentiment").alias("absolute_sentiment"),
        )
    else:
        sums = facet_stats(assign_region(scored, index).groupBy("region_name", "region_code"), "location")
    return sums.select(
        F.col("region_name").alias("state_name"),
        F.col("region_code").alias("state_code"),
        "count",
        "total_sentiment",
        "absolute_sentiment",
        F.try_divide("total_sentiment", "count").alias("mean_sentiment"),
    )


def sentiment_by_hour(timed: DataFrame) -> DataFrame:
    """Statistics per hour of day, ascending; needs the columns of ``add_time``."""
    stats = facet_stats(timed.groupBy("timestamp_hour"), "timestamp_hour")
    return stats.select(F.col("timestamp_hour").alias("hour"), *MEASURES).orderBy("hour")


def sentiment_by_day_of_week(timed: DataFrame) -> DataFrame:
    """Statistics per weekday, Monday first; needs the columns of ``add_time``."""
    stats = facet_stats(timed.groupBy("timestamp_day_of_week"), "timestamp_day_of_week")
    return stats.select(
        day_name("timestamp_day_of_week").alias("day_name"),
        F.col("timestamp_day_of_week").alias("day_number"),
        *MEASURES,
    ).orderBy("day_number")


def sentiment_by_length(scored: DataFrame, text: str = "tweet") -> DataFrame:
    """Statistics per length bucket, ascending."""
    bucketed = scored.withColumn("tweet_length", length_bucket(text))
    stats = facet_stats(bucketed.groupBy("tweet_length"), "tweet_length")
    return stats.select("tweet_length", *MEASURES).orderBy("tweet_length")


#: The columns that tell the group of a row of a summary.
FACET_KEYS = ["facet", "state_name", "state_code", "hour", "day_number", "tweet_length"]
#: What is kept of a group so that it can be added to another part of the tweets.
FACET_STATES = ["count", "total_sentiment", "absolute_sentiment", "scored"]


def facet_summary(scored: DataFrame, index: RegionIndex, text: str = "tweet", timestamp: str = "timestamp") -> DataFrame:
    """All four facets in one pass over the scored tweets, in long form.

    A row names its ``facet`` and fills that facet's key columns. The tweets are read and scored once, and what is
    shuffled is a row per group and task.
    """
    return summary_of(facet_states(scored, index, text, timestamp))


def merge_states(states: DataFrame) -> DataFrame:
    """States of several parts of the tweets added up by group."""
    return states.groupBy(*FACET_KEYS).agg(*[F.sum(name).alias(name) for name in FACET_STATES])


def summary_of(states: DataFrame) -> DataFrame:
    """The summary that the states of all groups stand for."""
    mean = F.when(F.col("facet") == "state", F.try_divide("total_sentiment", "count")).otherwise(F.try_divide("total_sentiment", "scored"))
    return states.select(
        "facet",
        "state_name",
        "state_code",
        "hour",
        day_name("day_number").alias("day_name"),
        "day_number",
        "tweet_length",
        "count",
        "total_sentiment",
        "absolute_sentiment",
        mean.alias("mean_sentiment"),
    )


def facet_states(scored: DataFrame, index: RegionIndex, text: str = "tweet", timestamp: str = "timestamp") -> DataFrame:
    """Count, sums and number of scored tweets of every group of all four facets, from one pass."""
    keyed = assign_region(scored, index).select(
        F.col("region_name").alias("state_name"),
        F.col("region_code").alias("state_code"),
        F.hour(timestamp).alias("hour"),
        day_of_week(timestamp).alias("day_number"),
        length_bucket(text).alias("tweet_length"),
        F.col("location").isNotNull().cast("int").alias("has_location"),
        SENTIMENT,
    )
    keys = ["state_name", "state_code", "hour", "day_number", "tweet_length"]
    sets = [["state_name", "state_code"], ["hour"], ["day_number"], ["tweet_length"]]
    # grouping() is 0 for the columns a row is grouped by
    facet = (
        F.when(F.grouping("state_name") == 0, "state")
        .when(F.grouping("hour") == 0, "hour")
        .when(F.grouping("day_number") == 0, "day")
        .otherwise("length")
    )
    counted = (
        F.when(F.grouping("state_name") == 0, F.sum("has_location"))
        .when(F.grouping("hour") == 0, F.count("hour"))
        .when(F.grouping("day_number") == 0, F.count("day_number"))
        .otherwise(F.count("tweet_length"))
    )
    return keyed.groupingSets([[F.col(name) for name in group] for group in sets], *keys).agg(
        facet.alias("facet"),
        counted.alias("count"),
        F.sum(SENTIMENT).alias("total_sentiment"),
        F.sum(F.abs(SENTIMENT)).alias("absolute_sentiment"),
        F.count(SENTIMENT).alias("scored"),
    )


def split_summary(summary: DataFrame) -> FacetResults:
    """The four results a summary holds, each in its own columns and order."""

    def facet(name: str, *columns: str) -> DataFrame:
        return summary.where(F.col("facet") == name).select(*columns, *MEASURES)

    return FacetResults(
        facet("state", "state_name", "state_code"),
        facet("hour", "hour").orderBy("hour"),
        facet("day", "day_name", "day_number").orderBy("day_number"),
        facet("length", "tweet_length").orderBy("tweet_length"),
    )
