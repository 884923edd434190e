"""Landed files as streams: four batches, whose rows are read and decoded by many tasks."""

import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from aerolake.plans import catalog, feed

ROWS = 20_000


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    """Events of four weeks, one every two minutes."""
    folder = str(tmp_path_factory.mktemp("events"))
    at = F.timestamp_seconds(F.lit(catalog.START) + F.col("id") * 120).cast("timestamp_ntz")
    rows = spark.range(ROWS).select(
        F.col("id").alias("event_id"), at.alias("ts"), (F.col("id") % 7).alias("user_id"),
        F.lit("view").alias("event_type"), F.lit(1.5).alias("value"), F.lit('{"k": 1}').alias("props"),
    )
    rows.coalesce(1).write.parquet(f"{folder}/events.parquet")
    return folder


def batches(stream, root):
    """(partitions, ids, seconds of the first and the last) of each batch."""
    found = []

    def look(batch, batch_id):
        seconds = F.unix_seconds(F.col("ts").cast("timestamp"))
        ids = [r[0] for r in batch.select("event_id").collect()]
        found.append((batch.rdd.getNumPartitions(), ids, *batch.agg(F.min(seconds), F.max(seconds)).first()))

    stream.writeStream.foreachBatch(look).option("checkpointLocation", f"{root}/seen").trigger(availableNow=True).start().awaitTermination()
    return found


def test_landed_rows_are_dealt_to_all_cores(spark, sf_dir, tmp_path):
    found = batches(catalog._landed(spark, sf_dir, str(tmp_path)), tmp_path)
    assert len(found) == 4 and min(n for n, *_ in found) >= spark.sparkContext.defaultParallelism
    assert sorted(i for _, ids, *_ in found for i in ids) == list(range(ROWS))


def test_rows_landed_by_time_are_dealt_to_all_cores(spark, sf_dir, tmp_path):
    found = batches(catalog._landed_by_time(spark, sf_dir, str(tmp_path)), tmp_path)
    assert len(found) == 4 and min(n for n, *_ in found) >= spark.sparkContext.defaultParallelism
    assert sorted(i for _, ids, *_ in found for i in ids) == list(range(ROWS))
    assert all(before[3] < after[2] for before, after in zip(found, found[1:]))


@pytest.mark.parametrize("land", [catalog._landed, catalog._landed_by_time])
def test_landed_files_can_be_read_by_many_tasks(spark, sf_dir, tmp_path, monkeypatch, land):
    monkeypatch.setattr(catalog, "ROW_GROUP_BYTES", 16_384)
    land(spark, sf_dir, str(tmp_path))
    files = glob.glob(f"{tmp_path}/landed/*.parquet")
    assert len(files) == 4 and all(pq.ParquetFile(f).metadata.num_row_groups > 1 for f in files)
