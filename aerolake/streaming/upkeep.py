"""Upkeep of tables in folders by day: expiry and compaction.

Both write what a day shall hold to a folder that readers do not see and then change places: the day moves aside,
the new folder moves in, the old one goes. Whatever step a run stops after, the next one finds what to do, so
nothing is lost and nothing is there twice.
"""

from __future__ import annotations

import math
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolake.operators.latest import DEFAULT_HOURS, MAX_HOURS, MIN_HOURS, apply_retention
from aerolake.session import deleted, listed, stored_at
from aerolake.streaming.sinks import RAW_FLUSH_BYTES

NEW, OLD = "_new", "_old"


def write_by_day(rows: DataFrame, path: str, ts: str = "last_contact", mode: str = "append") -> None:
    """Rows in folders ``day=<date>`` of their time; rows without a time lie in one of their own."""
    rows.withColumn("day", F.to_date(ts)).write.mode(mode).partitionBy("day").parquet(path)


def _move(spark: SparkSession, source: str, target: str) -> None:
    files, origin = stored_at(spark, source)
    _, goal = stored_at(spark, target)
    files.mkdirs(goal.getParent())
    if not files.rename(origin, goal):
        raise OSError(f"{source} cannot be moved to {target}")


def _complete(spark: SparkSession, folder: str) -> bool:
    return "_SUCCESS" in listed(spark, folder)


def recover(spark: SparkSession, path: str) -> None:
    """Ends what an earlier run began: a day that moved aside gets its new folder, all else is thrown away."""
    path = path.rstrip("/")
    days = set(listed(spark, path))
    for name in listed(spark, f"{path}/{OLD}"):
        if name not in days:
            new = f"{path}/{NEW}/{name}"
            _move(spark, new if _complete(spark, new) else f"{path}/{OLD}/{name}", f"{path}/{name}")
    for folder in (NEW, OLD):
        deleted(spark, f"{path}/{folder}")


def _swap(spark: SparkSession, path: str, name: str) -> None:
    _move(spark, f"{path}/{name}", f"{path}/{OLD}/{name}")
    _move(spark, f"{path}/{NEW}/{name}", f"{path}/{name}")
    deleted(spark, f"{path}/{OLD}/{name}")


def boundary_rows(spark: SparkSession, path: str, now: datetime, hours: int, ts: str = "last_contact") -> DataFrame:
    """What stays of the day that the limit cuts: of the whole table, only that day's folder is read."""
    day = (now - timedelta(hours=hours)).date()
    return apply_retention(spark.read.parquet(f"{path}/day={day}"), F.lit(now), hours, ts)


def expire_days(spark: SparkSession, path: str, now: datetime, hours: int = DEFAULT_HOURS, ts: str = "last_contact") -> None:
    """Removes rows older than ``hours`` from a table of ``write_by_day``, and rows without a time.

    ``now`` is in UTC. Days before the limit lose their folders, the day of the limit is written anew, others are not
    touched. It can be repeated at any time.
    """
    if not MIN_HOURS <= hours <= MAX_HOURS:
        raise ValueError(f"retention must be {MIN_HOURS} to {MAX_HOURS} hours, not {hours}")
    path = path.rstrip("/")
    recover(spark, path)
    limit = f"day={(now - timedelta(hours=hours)).date()}"
    for name in listed(spark, path):
        if name.startswith("day=") and (name < limit or name == "day=__HIVE_DEFAULT_PARTITION__"):
            deleted(spark, f"{path}/{name}")
    if limit in listed(spark, path):
        boundary_rows(spark, path, now, hours, ts).write.parquet(f"{path}/{NEW}/{limit}")
        _swap(spark, path, limit)


def compact_days(spark: SparkSession, path: str, before: str, flush_bytes: int = RAW_FLUSH_BYTES) -> None:
    """Makes the small files of the days before ``before`` (a date as text) into files of about the flush size.

    ``path`` has folders ingest_date=<date>/batch_id=<n> of text or JSON lines, as the sinks write them. Their lines stay as they are,
    in one folder batch_id=-1 of the day. A day is compacted when no batch of that date can come any more; one that was is left alone.
    """
    path = path.rstrip("/")
    recover(spark, path)
    files, _ = stored_at(spark, path)
    for name in listed(spark, path):
        batches = [b for b in listed(spark, f"{path}/{name}") if b.startswith("batch_id=")] if name.startswith("ingest_date=") else []
        if not name < f"ingest_date={before}" or not batches or batches == ["batch_id=-1"]:
            continue
        size = files.getContentSummary(stored_at(spark, f"{path}/{name}")[1]).getLength()
        lines = spark.read.text([f"{path}/{name}/{b}" for b in batches])
        count = max(1, math.ceil(size / flush_bytes))
        lines.select("value").coalesce(count).write.option("compression", "none").text(f"{path}/{NEW}/{name}/batch_id=-1")
        files.create(stored_at(spark, f"{path}/{NEW}/{name}/_SUCCESS")[1]).close()
        _swap(spark, path, name)
