"""Coordinates in a ``"lat,lon"`` text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _coordinate(location: Column | str, part: int) -> Column:
    column = F.col(location) if isinstance(location, str) else location
    number = F.get(F.split(column, ",", -1), F.lit(part)).try_cast("double")
    # a NaN coordinate compares greater than everything, so it must not reach the polygon test
    return F.when(~F.isnan(number), number)


def latitude(location: Column | str) -> Column:
    """First part as a double, null when it is no number."""
    return _coordinate(location, 0)


def longitude(location: Column | str) -> Column:
    """Second part as a double, null when it is no number."""
    return _coordinate(location, 1)
