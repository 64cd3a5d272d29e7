"""Column expressions; all of them run inside the JVM."""

from moodlens.functions.location import latitude, longitude
from moodlens.functions.polarity import SlotTable, polarity, slot_table
from moodlens.functions.stem import stem
from moodlens.functions.text import clean_text, index_terms, length_bucket, sentiment_tokens
from moodlens.functions.timeparts import day_name, day_of_week

__all__ = [
    "SlotTable",
    "clean_text",
    "day_name",
    "day_of_week",
    "index_terms",
    "latitude",
    "length_bucket",
    "longitude",
    "polarity",
    "sentiment_tokens",
    "slot_table",
    "stem",
]
