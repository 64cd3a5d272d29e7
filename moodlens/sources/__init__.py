"""Readers of tweets, users, regions, lexicons and streams."""

from moodlens.sources.lexicon import load_lexicon
from moodlens.sources.regions import across_antimeridian, load_regions
from moodlens.sources.tweets import (
    parse_users,
    read_raw_tweets,
    read_tweets,
    read_tweets_if_present,
    read_tweets_tsv,
    read_users,
    rejected_rows,
    sample_for_replay,
    split_raw_tweets,
    tweets_of_user,
    valid_tweets,
)

__all__ = [
    "across_antimeridian",
    "load_lexicon",
    "load_regions",
    "parse_users",
    "read_raw_tweets",
    "read_tweets",
    "read_tweets_if_present",
    "read_tweets_tsv",
    "read_users",
    "rejected_rows",
    "sample_for_replay",
    "split_raw_tweets",
    "tweets_of_user",
    "valid_tweets",
]
