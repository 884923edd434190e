"""Dropping records without a position and reshaping the rest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolake.functions import text
from aerolake.schemas import ENRICHED_FIELDS, ENRICHED_PASS_THROUGH
from aerolake.sources.envelopes import decode_envelope, field

OK, DROPPED, FAILED = "Ok", "Dropped", "ProcessingFailed"


def drop_missing_position(states: DataFrame) -> DataFrame:
    """0.0 and NaN are positions."""
    return states.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())


def filter_country(states: DataFrame, country: str | None = None) -> DataFrame:
    """Off by default. A null country never matches."""
    return states if country is None else states.where(F.col("origin_country") == F.lit(country))


def processing_time(processed_at: Column | None) -> Column:
    return F.current_timestamp() if processed_at is None else processed_at


def enrich_projection(states: DataFrame, processed_at: Column | None = None) -> DataFrame:
    """The enriched record. ``last_contact`` may be a timestamp or already ISO text."""
    columns = []
    for name in ENRICHED_PASS_THROUGH:
        value = F.col(name) if name in states.columns else F.lit(None)
        if name in states.columns and dict(states.dtypes)[name] == "timestamp":
            value = text.ts_to_iso(value)
        columns.append(value.alias(name))
    return states.select(
        *columns,
        text.event_time_text(processing_time(processed_at)).alias("event_time"),
        text.location(F.col("latitude"), F.col("longitude")).alias("location"),
    )


_COORDINATES = ("latitude", "longitude")


def _with_coordinates(decoded: DataFrame) -> DataFrame:
    """Adds JSON text, number and type of both coordinates, each read once per record."""
    record, columns = F.col("record"), {}
    for name in _COORDINATES:
        value = field(record, name)
        columns[f"_{name}_json"] = F.nullif(F.to_json(value), F.lit("null"))
        columns[f"_{name}_number"] = field(record, name, "double")
        columns[f"_{name}_type"] = F.schema_of_variant(value)
    return decoded.withColumns(columns)


def _coordinate_text(name: str) -> Column:
    """Text of a coordinate as the record has it: whole number, fraction or text."""
    json, number = F.col(f"_{name}_json"), F.col(f"_{name}_number")
    is_constant = F.coalesce(F.isnan(number) | (F.abs(number) == float("inf")), F.lit(False))
    return (
        F.when(json.startswith('"') & ~is_constant, field(F.col("record"), name, "string"))
        .when(F.col(f"_{name}_type") == "BIGINT", json)
        .otherwise(F.coalesce(text.float_text(number), json))
    )


def enrich_outcome(envelopes: DataFrame, processed_at: Column | None = None) -> DataFrame:
    """One row (recordId, data, result, value) per envelope.

    ``value`` is the enriched record as JSON text for Ok rows, else null; its fields have
    whatever type they came with. ``data`` is the input, kept for the error sink.
    """
    record = F.col("record")
    missing = F.col("_latitude_json").isNull() | F.col("_longitude_json").isNull()
    result = F.when(record.isNull(), FAILED).when(missing, DROPPED).otherwise(OK)
    enriched = {name: field(record, name) for name in ENRICHED_PASS_THROUGH}
    enriched["event_time"] = text.event_time_text(processing_time(processed_at))
    enriched["location"] = F.concat_ws(",", *[_coordinate_text(name) for name in _COORDINATES])
    value = text.json_with_nulls(F.struct(*[enriched[n].alias(n) for n in ENRICHED_FIELDS]))
    return (
        _with_coordinates(decode_envelope(envelopes))
        .withColumn("result", result)
        .select("recordId", "data", "result", F.when(F.col("result") == OK, value).alias("value"))
    )


def transform_outcome(envelopes: DataFrame, processed_at: Column | None = None) -> DataFrame:
    """The answer envelope (recordId, result, data); ``data`` is null unless Ok."""
    outcome = enrich_outcome(envelopes, processed_at)
    return outcome.select("recordId", "result", text.encode_envelope(F.col("value")).alias("data"))
