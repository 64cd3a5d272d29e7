"""DataFrame operators."""

from moodlens.operators.facets import (
    FACETS,
    add_time,
    facet_stats,
    facet_summary,
    sentiment_by_day_of_week,
    sentiment_by_hour,
    sentiment_by_length,
    sentiment_by_location,
    sentiment_by_state,
    split_summary,
)
from moodlens.operators.joins import join_users_tweets
from moodlens.operators.regions import RegionIndex, assign_region, read_index, region_index, write_index
from moodlens.operators.sentiment import add_sentiment
from moodlens.operators.terms import stemmed_term_counts, term_counts

__all__ = [
    "FACETS",
    "RegionIndex",
    "add_sentiment",
    "add_time",
    "assign_region",
    "facet_stats",
    "facet_summary",
    "join_users_tweets",
    "read_index",
    "region_index",
    "sentiment_by_day_of_week",
    "sentiment_by_hour",
    "sentiment_by_length",
    "sentiment_by_location",
    "sentiment_by_state",
    "split_summary",
    "stemmed_term_counts",
    "term_counts",
    "write_index",
]
