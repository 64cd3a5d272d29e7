"""The three jobs: historical facets, feed preparation, live windows."""

from moodlens.plans.feed import prepare_feed, replay_once, replay_stream
from moodlens.plans.historical import add_part, previews, process_tweets, results_of_parts, run_historical, run_incremental, store_results
from moodlens.plans.live import run_live, run_live_store

__all__ = [
    "add_part",
    "prepare_feed",
    "previews",
    "process_tweets",
    "replay_once",
    "replay_stream",
    "results_of_parts",
    "run_historical",
    "run_incremental",
    "run_live",
    "run_live_store",
    "store_results",
]
