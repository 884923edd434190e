"""What one micro-batch writes.

A batch owns the folders ``batch_id=<n>`` of its sink and overwrites them, so a repeated
batch leaves the same rows as a single one. Folders of the enriched and error sinks are named by
ingest date first. The date is that of the batch, which the stream's log keeps, so a repeated
batch has the same.
"""

from __future__ import annotations

import time
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerolake.operators.decode import decode_state_vector, split_malformed
from aerolake.operators.enrich import FAILED, OK, filter_country
from aerolake.operators.latest import latest_state
from aerolake.operators.publish import CHUNK_SIZE, delivery_ledger, number_in_order, published_records
from aerolake.schemas import STATE_SCHEMA
from aerolake.session import deleted, listed, stored_at
from aerolake.sources.snapshots import explode_states, quarantined_bodies

# Flush sizes of the raw sink, from 128 MB and about 1 KB per record.
RAW_FLUSH_BYTES = 128 * 1024 * 1024
RECORD_BYTES = 1024
RAW_RECORDS_PER_FILE = RAW_FLUSH_BYTES // RECORD_BYTES

# Buckets that a keyed table begins with, and for how many seconds a replaced version can still be read.
BUCKETS = 16
GRACE_SECONDS = 3600


def _folder(path: str, batch_id: int) -> str:
    return f"{path.rstrip('/')}/batch_id={batch_id}"


def _by_date(rows: DataFrame, batch_id: int) -> DataFrameWriter:
    placed = rows.withColumns({"ingest_date": F.to_date("ingested_at"), "batch_id": F.lit(batch_id)}).drop("ingested_at")
    writer = placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    return writer.partitionBy("ingest_date", "batch_id")


def write_enriched(outcome: DataFrame, batch_id: int, path: str) -> None:
    """Enriched records as JSON lines, in folders by ingest date and batch."""
    good = outcome.where(F.col("result") == OK)
    _by_date(good.select("value", "ingested_at"), batch_id).text(path)


def write_errors(outcome: DataFrame, batch_id: int, path: str) -> None:
    """Unreadable records as they came, with the reason, in folders by ingest date and batch."""
    failed = outcome.where(F.col("result") == FAILED)
    rows = failed.select("recordId", "data", F.col("result").alias("reason"), "ingested_at")
    _by_date(rows, batch_id).option("ignoreNullFields", "false").json(path)


def write_outcome(outcome: DataFrame, batch_id: int, enriched_path: str, errors_path: str) -> None:
    """Both sinks of a batch, decoded once."""
    outcome.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        write_enriched(outcome, batch_id, enriched_path)
        write_errors(outcome, batch_id, errors_path)
    finally:
        outcome.unpersist()


def write_ingest(
    snapshots: DataFrame, batch_id: int, path: str, country: str | None = None, chunk_size: int = CHUNK_SIZE
) -> None:
    """Records, quarantine and ledger of a batch of bodies, below ``path``, from one decode."""
    decoded = decode_state_vector(explode_states(snapshots)).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        good, rejected = split_malformed(decoded)
        records = number_in_order(published_records(filter_country(good, country), keep=("snapshot_id", "pos")))
        sinks = {
            "records": records.drop("pos"),
            "quarantine": rejected.unionByName(quarantined_bodies(snapshots)),
            "ledger": delivery_ledger(records, chunk_size),
        }
        for name, rows in sinks.items():
            rows.write.mode("overwrite").parquet(_folder(f"{path}/{name}", batch_id))
    finally:
        decoded.unpersist()


def publish_states(
    records: DataFrame, batch_id: int, path: str | None = None,
    sink_format: str = "parquet", options: dict[str, str] | None = None,
) -> None:
    """(key, value) rows, to a folder or to any installed key/value sink by its options."""
    writer = records.select("key", "value").write.format(sink_format).options(**(options or {}))
    if path is None:
        writer.mode("append").save()
    else:
        writer.mode("overwrite").save(_folder(path, batch_id))


def _latest_schema() -> T.StructType:
    return T.StructType([
        T.StructField("key", T.StringType()),
        T.StructField("snapshot_id", T.StringType()),
        T.StructField("pos", T.IntegerType()),
        *STATE_SCHEMA,
        T.StructField("version", T.StringType()),
        T.StructField("bucket", T.LongType()),
    ])


def _manifests(spark: SparkSession, path: str) -> list[int]:
    """Versions whose manifest is complete, ascending."""
    return sorted(int(name) for name in listed(spark, f"{path}/manifest") if "_SUCCESS" in listed(spark, f"{path}/manifest/{name}"))


def _manifest(spark: SparkSession, path: str, version: int) -> dict[int, str | None]:
    """The folder of each bucket, none where a bucket has no rows yet."""
    rows = spark.read.schema("bucket INT, version STRING").json(f"{path}/manifest/{version}").collect()
    return {r["bucket"]: r["version"] for r in rows}


def _rows_of(spark: SparkSession, path: str, buckets: dict[int, str | None]) -> DataFrame:
    """The rows of these buckets in these versions, by their folders alone."""
    folders = [f"{path}/version={v}/bucket={b}" for b, v in buckets.items() if v]
    if not folders:
        return spark.createDataFrame([], _latest_schema())
    return spark.read.schema(_latest_schema()).option("basePath", path).parquet(*folders)


def upsert_latest(states: DataFrame, batch_id: int, path: str, buckets: int | None = None, grace_seconds: int = GRACE_SECONDS) -> None:
    """Merges the newest rows of a batch into the keyed table.

    Keys lie in buckets by their hash. A batch writes the buckets that it touches to a new folder, merged
    with what they held, then a manifest that names the folder of every bucket. Readers take the newest
    manifest; what it names is deleted ``grace_seconds`` after a newer one replaced it at the earliest. A repeated batch starts from
    the manifest before its own and replaces its own; numbers of batches must rise, their rows may come late, since the
    newest ``last_contact`` wins. The manifest knows the number of buckets. Another number than that
    makes the batch write the whole table anew, in so many buckets.
    """
    spark, path = states.sparkSession, path.rstrip("/")
    before = [v for v in _manifests(spark, path) if v < batch_id]
    held = _manifest(spark, path, before[-1]) if before else {}
    count = buckets or len(held) or BUCKETS
    bucket = F.pmod(F.xxhash64("key"), F.lit(count))
    states = states.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        fresh = latest_state(states).withColumn("bucket", bucket).persist(StorageLevel.MEMORY_AND_DISK)
        # As many scalars as there are buckets go through the driver.
        touched = {r["bucket"] for r in fresh.select("bucket").distinct().collect()}
        if held and len(held) != count:
            touched, merging = set(range(count)), held
        else:
            merging = {b: v for b, v in held.items() if b in touched}
        rows = fresh.unionByName(_rows_of(spark, path, merging).drop("version").withColumn("bucket", bucket))
        merged = latest_state(rows.drop("key", "bucket")).withColumn("bucket", bucket)
        version = f"{batch_id}-{uuid.uuid4().hex[:12]}"
        merged.repartition(count, "bucket").write.partitionBy("bucket").parquet(f"{path}/version={version}")
        fresh.unpersist()
    finally:
        states.unpersist()
    written = {int(name.split("=")[1]) for name in listed(spark, f"{path}/version={version}") if name.startswith("bucket=")}
    now = {b: version if b in written else held.get(b) if len(held) == count else None for b in range(count)}
    spark.createDataFrame(list(now.items()), "bucket INT, version STRING").coalesce(1).write.mode("overwrite").json(f"{path}/manifest/{batch_id}")
    _forget(spark, path, batch_id, grace_seconds)


def _forget(spark: SparkSession, path: str, batch_id: int, grace_seconds: int) -> None:
    """Deletes manifests that were replaced more than the grace time ago, and folders as old that no manifest left names.

    The manifest before ``batch_id`` stays, too, so that this batch can be repeated.
    """
    versions, limit = _manifests(spark, path), time.time() - grace_seconds
    files, _ = stored_at(spark, path)

    def written(name: str) -> float:
        return files.getFileStatus(stored_at(spark, f"{path}/{name}/_SUCCESS")[1]).getModificationTime() / 1000

    previous = max((v for v in versions if v < batch_id), default=None)
    replaced = [v for v, after in zip(versions, versions[1:]) if v != previous and written(f"manifest/{after}") < limit]
    for version in replaced:
        deleted(spark, f"{path}/manifest/{version}")
    wanted = {folder for v in versions if v not in replaced for folder in _manifest(spark, path, v).values()}
    for name in listed(spark, path):
        if name.startswith("version=") and name.split("=")[1] not in wanted and "_SUCCESS" in listed(spark, f"{path}/{name}") and written(name) < limit:
            deleted(spark, f"{path}/{name}")


def read_latest(spark: SparkSession, path: str) -> DataFrame:
    """The keyed table: one row per key, as of the newest manifest. It can be read for the grace time, whatever batches follow."""
    path = path.rstrip("/")
    versions = _manifests(spark, path)
    rows = _rows_of(spark, path, _manifest(spark, path, versions[-1])) if versions else spark.createDataFrame([], _latest_schema())
    return rows.drop("version", "bucket")
