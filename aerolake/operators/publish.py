"""Key/value records, their partitioning and the delivery ledger."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerolake.functions import text
from aerolake.schemas import LEDGER_SCHEMA
from aerolake.sources.snapshots import body_reason

# Records per request.
CHUNK_SIZE = 500

# Positions numbered together in one window group; see number_in_order.
_BLOCK = 4096


def published_records(states: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """(key, value) rows: the aircraft and its state as JSON text."""
    return states.select(
        *keep, text.publish_key(F.col("icao24")).alias("key"), text.state_to_json().alias("value")
    )


def partition_by_key(records: DataFrame, partitions: int, spread_seconds: int | None = None) -> DataFrame:
    """Rows of one aircraft go to one partition.

    The placeholder key stands for no aircraft at all and may hold many rows; it is
    spread by row content. With ``spread_seconds`` an aircraft stays together per time
    slice of that length only (on ``last_contact``), which splits hot real keys too.
    """
    key = text.publish_key(F.col("icao24"))
    spread = F.when(key == text.UNKNOWN_KEY, F.xxhash64(*records.columns))
    if spread_seconds is not None:
        slice_no = F.floor(F.unix_micros("last_contact") / F.lit(spread_seconds * 1_000_000))
        spread = F.coalesce(spread, slice_no)
    return records.repartition(partitions, key, spread)


def number_in_order(rows: DataFrame) -> DataFrame:
    """Adds ``seq``: 0, 1, 2, .. within each snapshot by ``pos``, without gaps.

    For tables of records; states that still lie in their bodies are numbered without a
    shuffle by ``sequenced_states``.

    Rows are numbered inside blocks of positions, and each block is shifted by the rows
    before it, a running sum over block counts. So no task ever sorts a whole snapshot. There are as many shifts as
    snapshots at least, so they are not broadcast.
    """
    blocked = rows.withColumn("_block", F.floor(F.col("pos") / _BLOCK))
    in_block = Window.partitionBy("snapshot_id", "_block").orderBy("pos")
    earlier = Window.partitionBy("snapshot_id").orderBy("_block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = (
        blocked.groupBy("snapshot_id", "_block")
        .agg(F.count("*").alias("_rows"))
        .select("snapshot_id", "_block", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    )
    return (
        blocked.withColumn("_rank", F.row_number().over(in_block) - 1)
        .join(offsets.hint("merge"), ["snapshot_id", "_block"])
        .withColumn("seq", F.col("_before") + F.col("_rank"))
        .drop("_block", "_before", "_rank")
    )


def _place(records: DataFrame) -> str:
    return "seq" if "seq" in records.columns else "pos"


def _numbered(records: DataFrame) -> DataFrame:
    return records if "seq" in records.columns else number_in_order(records)


def delivery_ledger(
    records: DataFrame, chunk_size: int = CHUNK_SIZE, failed: Column | None = None
) -> DataFrame:
    """Per snapshot and chunk: how many records were sent and how many failed.

    ``records`` has snapshot_id and seq, or else pos, of the published rows; ``failed`` is a
    boolean of a row, by default false.
    """
    failed = F.lit(False) if failed is None else F.coalesce(failed, F.lit(False))
    return (
        _numbered(records.select("snapshot_id", _place(records), failed.alias("_failed")))
        .groupBy("snapshot_id", F.floor(F.col("seq") / chunk_size).alias("batch_no"))
        .agg(F.count("*").alias("records"), F.count_if("_failed").alias("failed"))
        .select(
            "snapshot_id",
            "batch_no",
            "records",
            (F.col("records") - F.col("failed")).alias("sent"),
            "failed",
            (F.col("failed") == 0).alias("ok"),
        )
    )


def delivery_outcome(snapshots: DataFrame, ledger: DataFrame, has_target: bool = True) -> DataFrame:
    """Per snapshot: did everything arrive. Nothing to send is fine; no target and an unreadable body are not."""
    read = body_reason(F.col("body")).isNull() if "body" in snapshots.columns else F.lit(True)
    chunks = ledger.groupBy("snapshot_id").agg(
        F.count("*").alias("batches"), F.sum("sent").alias("sent"), F.bool_and("ok").alias("ok")
    )
    return (
        snapshots.select("snapshot_id", read.alias("_read"))
        .join(chunks, "snapshot_id", "left")
        .select(
            "snapshot_id",
            F.coalesce("batches", F.lit(0)).alias("batches"),
            F.coalesce("sent", F.lit(0)).alias("sent"),
            (F.lit(has_target) & F.col("_read") & F.coalesce("ok", F.lit(True))).alias("ok"),
        )
    )


def deliver(
    records: DataFrame, send: Callable[[list[tuple[str, str]]], int], chunk_size: int = CHUNK_SIZE
) -> DataFrame:
    """Hands (key, value) rows to a client in chunks and returns the ledger.

    ``records`` has snapshot_id, seq or else pos, key and value. ``send`` takes one chunk and
    returns how many of its records failed; an exception fails the chunk and the others
    go on. A task holds one chunk at a time. Write the result once: every evaluation
    sends again, and so does a lost executor, hence receivers drop repeats by (icao24,
    last_contact).
    """
    import pandas as pd

    names = ["snapshot_id", "batch_no", "records", "sent", "failed", "ok"]

    def outcome(chunk_id, chunk):
        try:
            failed = int(send(chunk))
        except Exception:
            failed = len(chunk)
        return (*chunk_id, len(chunk), len(chunk) - failed, failed, failed == 0)

    def send_sorted(batches):
        current, chunk = None, []
        for batch in batches:
            done = []
            columns = [batch[c] for c in ("snapshot_id", "batch_no", "key", "value")]
            for snapshot_id, batch_no, key, value in zip(*columns):
                if (snapshot_id, batch_no) != current:
                    if chunk:
                        done.append(outcome(current, chunk))
                    current, chunk = (snapshot_id, batch_no), []
                chunk.append((key, value))
            yield pd.DataFrame(done, columns=names)
        if chunk:
            yield pd.DataFrame([outcome(current, chunk)], columns=names)

    chunks = _numbered(records).select(
        F.col("snapshot_id").cast("string").alias("snapshot_id"),
        F.floor(F.col("seq") / chunk_size).alias("batch_no"),
        "seq", "key", "value",
    )
    # One chunk lies in one task, next to each other and in order.
    placed = chunks.repartition("snapshot_id", "batch_no").sortWithinPartitions(
        "snapshot_id", "batch_no", "seq"
    )
    return placed.mapInPandas(send_sorted, LEDGER_SCHEMA)


def publish_key_counts(states: DataFrame) -> DataFrame:
    return states.groupBy(text.publish_key(F.col("icao24")).alias("key")).agg(
        F.count("*").alias("records")
    )
