"""The country dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _dimension(countries: DataFrame) -> DataFrame:
    return countries.select(
        F.col("name").alias("_name"), F.col("code").alias("country_code"), "continent"
    )


def enrich_country(states: DataFrame, countries: DataFrame) -> DataFrame:
    """Adds country_code and continent by name; states without a match keep nulls.

    There is no broadcast hint: Spark broadcasts the list when its size is below
    ``spark.sql.autoBroadcastJoinThreshold``, and otherwise joins by shuffle, where
    adaptive execution splits a country that holds many rows. Names must be unique in
    the list, which ``repeated_countries`` checks.
    """
    dimension = _dimension(countries)
    return states.join(dimension, states["origin_country"] == dimension["_name"], "left").drop("_name")


def unmatched_countries(states: DataFrame, countries: DataFrame) -> DataFrame:
    """Country names of states that the list lacks, with their number of rows.

    States are counted per name before the join, so only distinct names meet the list.
    """
    counted = states.groupBy("origin_country").agg(F.count("*").alias("states"))
    dimension = _dimension(countries)
    return counted.join(dimension, counted["origin_country"] == dimension["_name"], "left_anti")


def repeated_countries(countries: DataFrame) -> DataFrame:
    """Names that occur more than once and would multiply joined rows."""
    return countries.groupBy("name").agg(F.count("*").alias("entries")).where("entries > 1")
