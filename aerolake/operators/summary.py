"""Counts over snapshots and transform results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerolake.functions.text import ts_to_iso
from aerolake.operators.decode import decoded_slot, reject_reason
from aerolake.operators.enrich import processing_time
from aerolake.schemas import STATE_FIELDS, STATE_SCHEMA
from aerolake.sources.snapshots import explode_states, state_arrays


def snapshot_summary(
    snapshots: DataFrame, country: str | None = None, processed_at: Column | None = None
) -> DataFrame:
    """Per snapshot the number of states that survive decoding and the country filter.

    The outer explode keeps empty snapshots in the same aggregate, so no join brings
    them back. Counts are combined before the shuffle.
    """
    raw = F.col("raw")
    counted = F.col("pos").isNotNull() & reject_reason(raw).isNull()
    if country is not None:
        counted = counted & (decoded_slot(raw, "origin_country") == F.lit(country))
    return (
        explode_states(snapshots, keep_empty=True)
        .groupBy("snapshot_id")
        .agg(F.count_if(counted).alias("total_states"))
        .select("snapshot_id", ts_to_iso(processing_time(processed_at)).alias("timestamp"), "total_states")
    )


def snapshot_document(
    snapshots: DataFrame, country: str | None = None, processed_at: Column | None = None
) -> DataFrame:
    """One row (snapshot_id, timestamp, total_states, states) per snapshot.

    The array is decoded and filtered where it lies, inside the row of its body, so
    nothing is grouped. Analytics should use the exploded rows instead.
    """

    def decode(raw: Column) -> Column:
        fields = [decoded_slot(raw, name).alias(name) for name in STATE_FIELDS]
        return F.struct(F.struct(*fields).alias("state"), reject_reason(raw).alias("reject_reason"))

    def keep(entry: Column) -> Column:
        wanted = F.lit(True) if country is None else entry["state"]["origin_country"] == F.lit(country)
        return entry["reject_reason"].isNull() & F.coalesce(wanted, F.lit(False))

    states = F.transform(
        F.filter(F.transform(state_arrays(F.col("body")), decode), keep), lambda entry: entry["state"]
    )
    return snapshots.select(
        "snapshot_id",
        ts_to_iso(processing_time(processed_at)).alias("timestamp"),
        F.coalesce(states, F.array().cast(T.ArrayType(STATE_SCHEMA))).alias("states"),
    ).select("snapshot_id", "timestamp", F.size("states").cast("bigint").alias("total_states"), "states")


ALL = "all"


def transform_summary(outcomes: DataFrame, total: bool = False) -> DataFrame:
    """Rows per result; with ``total`` also those of all results, 0 if there are none."""
    counts = outcomes.groupBy("result").agg(F.count("*").alias("records"))
    if not total:
        return counts
    whole = counts.agg(F.coalesce(F.sum("records"), F.lit(0)).alias("records"))
    return counts.unionByName(whole.select(F.lit(ALL).alias("result"), "records"))
