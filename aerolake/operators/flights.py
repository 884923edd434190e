"""Arrivals and departures of a flights table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolake.functions.units import duration_hours, duration_seconds

_COLUMNS = ["icao24", "first_seen", "last_seen", "callsign", "departure_airport", "arrival_airport"]


def with_duration(flights: DataFrame) -> DataFrame:
    span = (F.col("first_seen"), F.col("last_seen"))
    return flights.withColumns(
        {"duration_seconds": duration_seconds(*span), "duration_hours": duration_hours(*span)}
    )


def arrivals(flights: DataFrame) -> DataFrame:
    """Flights whose arrival airport is known."""
    return flights.where(F.col("arrival_airport").isNotNull()).select(*_COLUMNS)


def departures(flights: DataFrame) -> DataFrame:
    """Flights whose departure airport is known."""
    return flights.where(F.col("departure_airport").isNotNull()).select(*_COLUMNS)
