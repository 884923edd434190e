"""Latest row per key, and retention by age."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolake.functions.text import publish_key

# Hours a retention period may have, and its default.
MIN_HOURS, MAX_HOURS, DEFAULT_HOURS = 24, 8760, 24


def latest_state(
    states: DataFrame, order: tuple[str, ...] = ("last_contact", "snapshot_id", "pos")
) -> DataFrame:
    """One row per publish key: the newest ``last_contact``, ties by snapshot and position.

    A null ``last_contact`` loses to any other. The newest time of each key is a number that map tasks reduce by
    hash; only rows that reach it are compared further. Rows meet the newest times by key and time, so those of a hot
    key are spread by their times, and neither side is collected on the driver, however many keys there are.
    ``states`` is read twice: pass a stored or persisted table.
    """
    first = order[0]
    columns = [c for c in states.columns if c != "key"]
    keyed = states.select(publish_key(F.col("icao24")).alias("key"), *columns)
    newest = keyed.groupBy("key").agg(F.max(first).alias("_newest")).withColumnRenamed("key", "_key")
    reached = keyed.join(newest.hint("merge"), (F.col("key") == F.col("_key")) & F.col(first).eqNullSafe(F.col("_newest")))
    best = reached.groupBy("key").agg(F.max_by(F.struct(*columns), F.struct(*order)).alias("_row"))
    return best.select("key", "_row.*")


def apply_retention(
    rows: DataFrame, now: datetime | Column, hours: int = DEFAULT_HOURS, ts: str = "last_contact"
) -> DataFrame:
    """Rows not older than ``hours``; rows without a time are outside."""
    if not MIN_HOURS <= hours <= MAX_HOURS:
        raise ValueError(f"retention must be {MIN_HOURS} to {MAX_HOURS} hours, not {hours}")
    now = now if isinstance(now, Column) else F.lit(now)
    return rows.where(F.col(ts) >= now - F.make_dt_interval(hours=F.lit(hours)))
