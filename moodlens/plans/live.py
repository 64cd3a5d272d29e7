"""Live job: message stream to windowed sentiment per state."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from moodlens.functions.polarity import MAX_TABLE_BYTES
from moodlens.operators.regions import RegionIndex
from moodlens.operators.sentiment import LexiconTooLarge
from moodlens.session import checkpointed
from moodlens.streaming.payload import decode_payload
from moodlens.streaming.sink import write_stream
from moodlens.streaming.store import WindowStore
from moodlens.streaming.windows import enrich, pane_window_sentiment, window_sentiment


def run_live(
    messages: DataFrame,
    lexicon: DataFrame,
    index: RegionIndex,
    fmt: str = "console",
    checkpoint: str | None = None,
    path: str | None = None,
    trigger: dict | None = None,
    measures: Sequence[str] | None = ("mean_sentiment", "max_sentiment", "min_sentiment"),
    event_time: str = "timestamp_logger",
    panes: bool = False,
    max_table_bytes: int = MAX_TABLE_BYTES,
    **options: str,
) -> StreamingQuery:
    """Decode, enrich and aggregate a message stream; ``measures=None`` writes the enriched rows themselves.

    With ``panes`` the windows are put together from panes, which keeps the state a fourth as busy. A lexicon whose slot table would
    take more than ``max_table_bytes`` is joined with each micro-batch where the rows themselves are written, and refused for windows.
    """
    decoded = decode_payload(messages)
    try:
        enriched = enrich(decoded, lexicon, index, event_time, max_table_bytes)
    except LexiconTooLarge:
        if measures is not None or checkpoint is None:
            raise
        return _by_batch(decoded, checkpointed(lexicon), index, fmt, checkpoint, path, trigger, event_time, max_table_bytes, options)
    windows = pane_window_sentiment if panes else window_sentiment
    out = enriched if measures is None else windows(enriched, measures)
    return write_stream(out, fmt, checkpoint, path, trigger, **options)


def _by_batch(
    decoded: DataFrame,
    lexicon: DataFrame,
    index: RegionIndex,
    fmt: str,
    checkpoint: str,
    path: str | None,
    trigger: dict | None,
    event_time: str,
    max_table_bytes: int,
    options: dict,
) -> StreamingQuery:
    """Write the enriched rows of each micro-batch, those of a path to a folder of the batch, so that one that runs again replaces its own."""

    def write(rows: DataFrame, batch: int) -> None:
        writer = enrich(rows, lexicon, index, event_time, max_table_bytes).write.format(fmt).options(**options)
        if path:
            writer.mode("overwrite").save(f"{path}/batch={batch}")
        else:
            writer.mode("append").save()

    options = dict(options)
    query_name = options.pop("query_name", None)
    writer = decoded.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    if query_name:
        writer = writer.queryName(query_name)
    return (writer.trigger(**trigger) if trigger else writer).start()


def run_live_store(
    messages: DataFrame,
    lexicon: DataFrame,
    index: RegionIndex,
    store: WindowStore,
    checkpoint: str,
    trigger: dict | None = None,
    event_time: str = "timestamp_logger",
) -> StreamingQuery:
    """Decode and enrich a message stream and keep its windows, open ones too, and its late rows in ``store``."""
    enriched = enrich(decode_payload(messages), lexicon, index, event_time)
    writer = enriched.writeStream.foreachBatch(store.apply).option("checkpointLocation", checkpoint)
    return (writer.trigger(**trigger) if trigger else writer).start()
