"""Unit conversions and durations. Null in, null out."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Conversion factors.
FEET_PER_METRE = 3.28084
KNOTS_PER_METRE_SECOND = 1.94384
FEET_PER_MINUTE_PER_METRE_SECOND = 196.85


def altitude_ft(metres: Column) -> Column:
    return metres * F.lit(FEET_PER_METRE)


def velocity_kts(metres_per_second: Column) -> Column:
    return metres_per_second * F.lit(KNOTS_PER_METRE_SECOND)


def vertical_rate_ftpm(metres_per_second: Column) -> Column:
    return metres_per_second * F.lit(FEET_PER_MINUTE_PER_METRE_SECOND)


def duration_seconds(start: Column, end: Column) -> Column:
    """Fractions of a second are kept."""
    return (F.unix_micros(end) - F.unix_micros(start)) / F.lit(1e6)


def duration_hours(start: Column, end: Column) -> Column:
    return duration_seconds(start, end) / F.lit(3600.0)
