"""The country list: quoted CSV with a header."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from aerolake.schemas import COUNTRY_SCHEMA


def read_countries(spark: SparkSession, path: str) -> DataFrame:
    """Blank fields are null; the code and continent ``NA`` stay text."""
    return (
        spark.read.schema(COUNTRY_SCHEMA)
        .option("header", True)
        .option("encoding", "UTF-8")
        .option("escape", '"')
        .csv(path)
    )
