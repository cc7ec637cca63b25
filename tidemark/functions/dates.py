"""Calendar expressions of the star schema."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_key(moment: Column) -> Column:
    """Date or timestamp -> integer yyyymmdd."""
    day = F.to_date(moment)
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def day_of_week(day: Column) -> Column:
    """Weekday number with Sunday = 0."""
    return (F.dayofweek(day) - 1).cast("int")
