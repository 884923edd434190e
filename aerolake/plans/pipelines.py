"""The pipelines as compositions of operators."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame

from aerolake.operators.decode import decode_state_vector, sequenced_states, split_malformed
from aerolake.operators.enrich import drop_missing_position, enrich_projection, filter_country
from aerolake.operators.publish import CHUNK_SIZE, delivery_ledger, delivery_outcome, published_records
from aerolake.operators.summary import snapshot_summary
from aerolake.sources.snapshots import explode_states, quarantined_bodies


@dataclass(frozen=True)
class Ingest:
    """Results of the ingest pipeline, all lazy."""

    states: DataFrame
    quarantine: DataFrame
    records: DataFrame
    summary: DataFrame
    ledger: DataFrame
    outcome: DataFrame


def decode_snapshots(snapshots: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Bodies to (good states, quarantine of rows and of whole bodies)."""
    good, rows = split_malformed(decode_state_vector(explode_states(snapshots)))
    return good, rows.unionByName(quarantined_bodies(snapshots))


def ingest(
    snapshots: DataFrame,
    country: str | None = None,
    chunk_size: int = CHUNK_SIZE,
    processed_at: Column | None = None,
) -> Ingest:
    """Landed bodies to publishable records with their summaries.

    With ``country`` it is the one-shot job that publishes a single country.
    """
    good, quarantine = decode_snapshots(snapshots)
    states = filter_country(good, country)
    ledger = delivery_ledger(sequenced_states(snapshots, country), chunk_size)
    return Ingest(
        states=states,
        quarantine=quarantine,
        records=published_records(states, keep=("snapshot_id", "pos")),
        summary=snapshot_summary(snapshots, country, processed_at),
        ledger=ledger,
        outcome=delivery_outcome(snapshots, ledger),
    )


def enrich(snapshots: DataFrame, processed_at: Column | None = None) -> DataFrame:
    """Landed bodies to enriched records."""
    good, _ = decode_snapshots(snapshots)
    return enrich_projection(drop_missing_position(good), processed_at)
