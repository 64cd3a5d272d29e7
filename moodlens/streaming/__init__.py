"""The live side: message decoding, enrichment, windows and sinks."""

from moodlens.streaming.payload import decode_payload, event_time, malformed, read_value_stream
from moodlens.streaming.sink import write_stream
from moodlens.streaming.store import WindowStore
from moodlens.streaming.windows import MEASURES, enrich, pane_window_sentiment, window_sentiment

__all__ = [
    "MEASURES",
    "WindowStore",
    "decode_payload",
    "enrich",
    "event_time",
    "malformed",
    "pane_window_sentiment",
    "read_value_stream",
    "window_sentiment",
    "write_stream",
]
