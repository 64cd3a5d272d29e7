"""Parts of a timestamp."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The weekdays in English, Monday first.
DAY_NAMES = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")


def day_of_week(timestamp: Column | str) -> Column:
    """Weekday number with Monday as 0."""
    return F.weekday(timestamp)


def day_name(number: Column | str) -> Column:
    """Name of a weekday number; null stays null."""
    column = F.col(number) if isinstance(number, str) else number
    return F.get(F.array(*[F.lit(name) for name in DAY_NAMES]), column)
