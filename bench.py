"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` is the folder of the tables, ``BENCH_CPUS`` the number of local cores, ``BENCH_RUNS`` the timed runs per
query after one warm-up.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import time

from moodlens.catalog import fixtures
from moodlens.catalog.queries import QUERIES
from moodlens.operators import assign_region, region_index
from moodlens.session import build_session

HEADLINE = (
    "sentiment_by_state",
    "sentiment_by_hour",
    "sentiment_by_day_of_week",
    "sentiment_by_length",
    "sentiment_by_location",
    "facet_summary",
    "tweet_sentiment",
    "tweets_clean",
    "tweet_time_parts",
    "region_lookup",
    "user_tweet_join",
    "tsv_ingest_valid",
    "facet_upsert",
    "json_round_trip",
    "window_sentiment_batch",
    "stream_window_sentiment",
    "term_counts",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    spark = build_session(
        "moodlens-bench",
        f"local[{cpus}]",
        {"spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "12g"},
    )
    spark.sparkContext.setLogLevel("ERROR")

    def once(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    for name in ("facet_summary", "region_lookup"):
        once(name)  # warms up the JVM
    seconds = {name: round(statistics.median(once(name) for _ in range(runs)), 3) for name in HEADLINE}
    start = time.perf_counter()
    index = region_index(fixtures.regions(spark, sf_dir))
    build = time.perf_counter() - start
    places = fixtures.tweets(spark, sf_dir).select("location").distinct()
    locations = places.count()
    start = time.perf_counter()
    assign_region(places, index).write.format("noop").mode("overwrite").save()
    lookup = time.perf_counter() - start
    found = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "headline queries, total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(found.group(1)) if found else None,
                "region_index_build": round(build, 3),
                "region_lookup_alone": round(lookup, 3),
                "locations_per_sec": round(locations / lookup),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
