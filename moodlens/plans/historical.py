"""Historical job: tweet store to four keyed facet stores."""

from __future__ import annotations

import math
import re

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from moodlens.functions.text import LENGTH_BUCKET_SIZE, MAX_TWEET_CHARS
from moodlens.operators.facets import FacetResults, facet_states, merge_states, split_summary, summary_of
from moodlens.operators.regions import RegionIndex
from moodlens.operators.sentiment import add_sentiment
from moodlens.schemas import RESULT_KEYS
from moodlens.session import checkpointed
from moodlens.sinks.store import conform, upsert_parquet

# Rows shown of each facet.
PREVIEW_ROWS = {"state": 51, "hour": 24, "day": 20, "length": math.ceil(MAX_TWEET_CHARS / LENGTH_BUCKET_SIZE)}


def process_tweets(
    tweets: DataFrame, lexicon: DataFrame, index: RegionIndex, observation: Observation | None = None
) -> FacetResults:
    """Score the tweets and aggregate all four facets.

    The tweets are read once. Their summary has a row per group, is checkpointed, and feeds the four results, so
    using all of them costs no second pass and an executor loss afterwards costs none either. ``observation`` takes the
    number of ``tweets`` from the same pass.
    """
    return split_summary(summary_of(checkpointed(_states(tweets, lexicon, index, observation))))


def _states(tweets: DataFrame, lexicon: DataFrame, index: RegionIndex, observation: Observation | None = None) -> DataFrame:
    scored = add_sentiment(tweets, lexicon)
    if observation:
        scored = scored.observe(observation, F.count(F.lit(1)).alias("tweets"))
    return facet_states(scored, index)


def add_part(
    tweets: DataFrame, lexicon: DataFrame, index: RegionIndex, states_path: str, part: str, observation: Observation | None = None
) -> None:
    """Keep the facet states of one part of the tweets, such as a day, below ``states_path``.

    A part has a row per group. One that is added again replaces itself, so a job that runs twice counts nothing twice.
    """
    if not re.fullmatch(r"[A-Za-z0-9_-]+", part):
        raise ValueError(f"a part is named by letters, digits, - and _, not {part!r}")
    _states(tweets, lexicon, index, observation).write.mode("overwrite").parquet(f"{states_path}/part={part}")


def results_of_parts(spark: SparkSession, states_path: str) -> FacetResults:
    """The facets of all parts together; the tweets are not read again."""
    return split_summary(summary_of(checkpointed(merge_states(spark.read.parquet(states_path)))))


def run_incremental(
    spark: SparkSession, tweets: DataFrame, lexicon: DataFrame, index: RegionIndex, states_path: str, part: str, base_path: str
) -> FacetResults:
    """Add one part of the tweets to those kept before and store the results of all of them."""
    add_part(tweets, lexicon, index, states_path, part)
    results = results_of_parts(spark, states_path)
    store_results(results, base_path)
    return results


def previews(results: FacetResults) -> dict[str, DataFrame]:
    """The first rows of each facet, for a look at them."""
    return {name: result.limit(rows) for result, (name, rows) in zip(results, PREVIEW_ROWS.items())}


def store_results(results: FacetResults, base_path: str) -> None:
    """Upsert each result into its store. The group of a null key has no id; it replaces the table ``<target>_unkeyed`` beside it."""
    targets = ("state_reduced", "hour_reduced", "day_reduced", "length_reduced")
    for target, result in zip(targets, results):
        key = RESULT_KEYS[target]
        upsert_parquet(conform(result.where(F.col(key).isNotNull()), target), f"{base_path}/{target}", key)
        conform(result.where(F.col(key).isNull()), target).write.mode("overwrite").parquet(f"{base_path}/{target}_unkeyed")


def run_historical(
    spark: SparkSession, tweets: DataFrame, lexicon: DataFrame, index: RegionIndex, base_path: str, debug: bool = False
) -> FacetResults:
    """Process the tweets and store the results; ``debug`` also prints previews."""
    results = process_tweets(tweets, lexicon, index)
    if debug:
        for name, preview in previews(results).items():
            print(f"first {PREVIEW_ROWS[name]} rows by {name}")
            preview.show(PREVIEW_ROWS[name], truncate=False)
    store_results(results, base_path)
    return results
