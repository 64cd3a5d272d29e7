"""Schemas of the inputs, the stream payload and the stored results."""

from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(),
    "timestamp": T.TimestampType(),
    "double": T.DoubleType(),
    "float": T.FloatType(),
    "bigint": T.LongType(),
    "int": T.IntegerType(),
}


def _struct(columns: str) -> T.StructType:
    """A schema from ``name type`` pairs; unlike DDL it needs no running session."""
    pairs = (column.split() for column in columns.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


TWEET = _struct("user_id string, tweet_id string, tweet string, timestamp timestamp, location string")

# Delimited and JSON inputs arrive as text and are typed after parsing.
TWEET_TEXT = _struct("user_id string, tweet_id string, tweet string, timestamp string, location string")
STREAM_PAYLOAD = _struct(
    "user_id string, tweet_id string, tweet string, timestamp string, location string, timestamp_logger string"
)

USERS = _struct("user_id string, latitude double, longitude double")
LEXICON = _struct("term string, polarity double")
REGION = _struct(
    "ordinal bigint, region_name string, region_code string, ring_id int, seq int, lon double, lat double"
)

_MEASURES = "count bigint, total_sentiment float, absolute_sentiment float, mean_sentiment float"

# Stored results are narrower than computed ones: int keys, 32-bit measures. The count stays wide, as a group of a large
# table passes 2^31 rows.
RESULT_TARGETS = {
    "state_reduced": _struct(f"state_name string, state_code string, {_MEASURES}"),
    "length_reduced": _struct(f"tweet_length int, {_MEASURES}"),
    "day_reduced": _struct(f"day_name string, day_number int, {_MEASURES}"),
    "hour_reduced": _struct(f"hour int, {_MEASURES}"),
}

# The column that identifies a row of each stored result.
RESULT_KEYS = {
    "state_reduced": "state_name",
    "length_reduced": "tweet_length",
    "day_reduced": "day_name",
    "hour_reduced": "hour",
}
