"""Sentiment per region over sliding windows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodlens.functions.polarity import MAX_TABLE_BYTES
from moodlens.operators.regions import RegionIndex, assign_region
from moodlens.operators.sentiment import add_sentiment
from moodlens.streaming.payload import event_time as event_time_of

# Window, slide and watermark of the live view.
WINDOW = "20 seconds"
SLIDE = "5 seconds"
WATERMARK = "5 seconds"

MEASURES = {
    "mean_sentiment": F.avg,
    "max_sentiment": F.max,
    "min_sentiment": F.min,
    "total_sentiment": F.sum,
    "absolute_sentiment": lambda column: F.sum(F.abs(column)),
}


def enrich(
    tweets: DataFrame,
    lexicon: DataFrame,
    index: RegionIndex,
    event_time: str = "timestamp_logger",
    max_table_bytes: int = MAX_TABLE_BYTES,
) -> DataFrame:
    """Location, state, text, sentiment and event time of decoded messages; stateless."""
    located = assign_region(tweets, index).withColumnRenamed("region_name", "state")
    scored = add_sentiment(located, lexicon, output="sentiment", max_table_bytes=max_table_bytes)
    return scored.select("location", "state", "tweet", "sentiment", event_time_of(event_time).alias("date_time"))


def window_sentiment(
    enriched: DataFrame,
    measures: Sequence[str] = ("mean_sentiment", "max_sentiment", "min_sentiment"),
    window: str = WINDOW,
    slide: str = SLIDE,
    watermark: str = WATERMARK,
) -> DataFrame:
    """Measures per state and sliding window.

    On a stream a window comes out once, after the watermark has passed its end, and later rows are dropped. On a
    batch all windows come out.
    """
    return (
        enriched.withWatermark("date_time", watermark)
        .groupBy("state", F.window("date_time", window, slide).alias("window"))
        .agg(*[MEASURES[name]("sentiment").alias(name) for name in measures])
    )


#: What a pane keeps for each measure of a window, and how panes are put together.
_PANE = {
    "n": (F.count, F.sum),
    "total": (F.sum, F.sum),
    "absolute": (lambda column: F.sum(F.abs(column)), F.sum),
    "largest": (F.max, F.max),
    "smallest": (F.min, F.min),
}
_FROM_PANES = {
    "mean_sentiment": (("total", "n"), F.try_divide),
    "max_sentiment": (("largest",), F.col),
    "min_sentiment": (("smallest",), F.col),
    "total_sentiment": (("total",), F.col),
    "absolute_sentiment": (("absolute",), F.col),
}


def pane_window_sentiment(
    enriched: DataFrame,
    measures: Sequence[str] = ("mean_sentiment", "max_sentiment", "min_sentiment"),
    window: str = WINDOW,
    slide: str = SLIDE,
    watermark: str = WATERMARK,
) -> DataFrame:
    """The windows of ``window_sentiment`` put together from panes, so that a row enters the state once.

    A pane is as long as the slide, which divides the window. The first aggregation has a row per state and pane; a pane that
    is complete enters the second one, which adds it to each of its windows. Both work in append mode under one watermark. A late
    row counts for all windows of its pane or for none: it is dropped once its pane is complete, while ``window_sentiment`` still
    takes it for the windows that are not.
    """
    kept = list(dict.fromkeys(part for name in measures for part in _FROM_PANES[name][0]))
    panes = (
        enriched.withWatermark("date_time", watermark)
        .groupBy("state", F.window("date_time", slide).alias("pane"))
        .agg(*[_PANE[part][0]("sentiment").alias(part) for part in kept])
    )
    whole = panes.groupBy("state", F.window(F.window_time("pane"), window, slide).alias("window")).agg(
        *[_PANE[part][1](part).alias(part) for part in kept]
    )
    results = [_FROM_PANES[name][1](*_FROM_PANES[name][0]).alias(name) for name in measures]
    return whole.select("state", "window", *results)
