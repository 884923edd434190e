"""Delivery with retries, the receiver, and upkeep of tables by day."""

import glob
import json
import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from aerolake.streaming import delivery, jobs, upkeep


def settings(tmp_path, name):
    return jobs.StreamSettings(str(tmp_path / f"checkpoint-{name}"), available_now=True)


def run(query):
    query.awaitTermination()
    return query


def records(spark, first, count):
    return spark.range(first, first + count).select(F.concat(F.lit("ac"), F.col("id").cast("string")).alias("key"), F.concat(F.lit("v"), F.col("id").cast("string")).alias("value"))


def test_a_client_that_refuses_a_tenth_of_the_chunks_twice(spark, tmp_path):
    path, asked = str(tmp_path / "sent"), str(tmp_path / "asked")
    os.mkdir(asked)

    def send(chunk):
        with open(f"{asked}/{chunk[0][1]}-{chunk[0][2]}", "a") as log:
            log.write(f"{len(chunk)}\n")
        hard = int(chunk[0][1][1:]) % 100 == 0
        if hard and chunk[0][2] == 1:
            raise ConnectionError("no answer")
        return [not (hard and attempt < 3) for _, _, attempt in chunk]

    for batch_id in range(3):
        delivery.send_records(records(spark, 1000 * batch_id, 1000).coalesce(1), batch_id, path, send, chunk_size=10)
    delivery.send_records(records(spark, 2000, 1000).coalesce(1), 2, path, send, chunk_size=10)  # the batch is repeated
    delivery.drain_records(spark, path, send, chunk_size=10)
    tried = spark.read.schema(delivery.ATTEMPT_SCHEMA).parquet(f"{path}/attempts")
    accepted = tried.where("accepted")
    assert accepted.count() == accepted.select("value").distinct().count() == 3000
    ledger = {r["step"]: tuple(r)[1:] for r in delivery.delivery_steps(spark, path).collect()}
    assert ledger["000000000000-000000"] == (1000, 0, 900, 100, 0)
    assert ledger["000000000001-000000"][:2] == (1100, 100) and sum(x[2] for x in ledger.values()) == 3000
    assert sum(x[4] for x in ledger.values()) == 0 == delivery.given_up(spark, path).count()
    before = tried.count()
    delivery.drain_records(spark, path, send, chunk_size=10)
    assert spark.read.schema(delivery.ATTEMPT_SCHEMA).parquet(f"{path}/attempts").count() == before


def test_records_are_given_up(spark, tmp_path):
    path = str(tmp_path / "sent")
    delivery.send_records(records(spark, 0, 20), 0, path, lambda chunk: [key != "ac7" for key, _, _ in chunk], attempts=3)
    delivery.drain_records(spark, path, lambda chunk: [key != "ac7" for key, _, _ in chunk], attempts=3)
    assert [tuple(r)[:3] for r in delivery.given_up(spark, path, 3).collect()] == [("ac7", "v7", 3)]
    # An answer that doesn't fit the chunk takes nothing.
    delivery.send_records(records(spark, 100, 5), 1, path, lambda chunk: [])
    assert [tuple(r)[1:4] for r in delivery.delivery_steps(spark, path).where("step like '%1-000000' and step like '000000000001%'").collect()] == [(6, 1, 0)]


def test_the_receiver_keeps_the_first_and_forgets(spark, tmp_path):
    """Twenty batches, each sent twice: no row is there twice, and state does not grow."""
    folder = tmp_path / "published"
    sizes = []
    for n in range(20):
        rows = [(f"ac{a}", json.dumps({"icao24": f"ac{a}" if a else None, "last_contact": (datetime(2024, 1, 1) + timedelta(minutes=10 * n + a)).isoformat()})) for a in range(8)]
        for again in (0, 1):
            if again and n % 3 == 0:
                rows = rows[::2]
            untimed = [("unknown", "{}"), ("unknown", "no json")] if n == 0 else []
            spark.createDataFrame(rows + untimed, "key string, value string").coalesce(1).write.mode("append").parquet(str(folder))
            stream = jobs.read_records_stream(spark, str(folder), "key STRING, value STRING", "parquet", max_files=1)
            if n % 5 == 4 or n < 1:
                query = run(delivery.run_receive_stream(stream, str(tmp_path / "table"), settings(tmp_path, "receive"), "30 minutes"))
                sizes.append(query.lastProgress["stateOperators"][0]["numRowsTotal"])
    kept = spark.read.parquet(str(tmp_path / "table")).where("last_contact is not null")
    assert spark.read.parquet(str(tmp_path / "table")).count() == 160 + 4  # records without a time pass
    assert kept.count() == kept.select("icao24", "last_contact").distinct().count() == 160
    # Half an hour of eight aircraft every ten minutes, and the batches by which the watermark lags: as much after 20 batches as after 10.
    assert max(sizes) <= 6 * 8 and max(sizes[-4:]) <= max(sizes[4:6])


def day_rows(spark):
    start = datetime(2024, 1, 1)
    rows = [(i, start + timedelta(hours=i)) for i in range(24 * 6)] + [(999, None)]
    return spark.createDataFrame(rows, "n long, last_contact timestamp")


NOW = datetime(2024, 1, 6, 23, 0)
STAY = list(range(24 * 6 - 1 - 30, 24 * 6))


def left(spark, path):
    return sorted(r["n"] for r in spark.read.parquet(path).collect())


def test_expiry_writes_one_day(spark, tmp_path):
    path = str(tmp_path / "table")
    upkeep.write_by_day(day_rows(spark), path)
    last = glob.glob(f"{path}/day=2024-01-06/*.parquet")
    plan = upkeep.boundary_rows(spark, path, NOW, 30)
    assert {os.path.basename(os.path.dirname(f)) for f in plan.inputFiles()} == {"day=2024-01-05"}
    for _ in range(2):
        upkeep.expire_days(spark, path, NOW, 30)
        assert left(spark, path) == STAY
    assert glob.glob(f"{path}/day=2024-01-06/*.parquet") == last and len(glob.glob(f"{path}/day=*")) == 2
    with pytest.raises(ValueError):
        upkeep.expire_days(spark, path, NOW, 1)


@pytest.mark.parametrize("step", [0, 1, 2])
def test_expiry_that_stops_loses_nothing(spark, tmp_path, monkeypatch, step):
    path = str(tmp_path / "table")
    upkeep.write_by_day(day_rows(spark), path)
    moves = []

    def stopping(*args, real=upkeep._move):
        if len(moves) == step:
            raise KeyboardInterrupt
        moves.append(args)
        real(*args)

    with monkeypatch.context() as patched:
        patched.setattr(upkeep, "_move", stopping)
        if step == 2:
            patched.setattr(upkeep, "deleted", lambda spark, path, real=upkeep.deleted: real(spark, path) if "_old/" not in path else (_ for _ in ()).throw(KeyboardInterrupt()))
        with pytest.raises(KeyboardInterrupt):
            upkeep.expire_days(spark, path, NOW, 30)
    upkeep.expire_days(spark, path, NOW, 30)
    assert left(spark, path) == STAY


@pytest.mark.parametrize("stop", [None, 0, 1])
def test_compaction_of_closed_days(spark, tmp_path, monkeypatch, stop):
    path = str(tmp_path / "enriched")
    for batch in range(50):
        rows = spark.range(20).select(F.concat(F.lit(f"line {batch} "), F.col("id").cast("string")).alias("value")).repartition(2)
        rows.write.text(f"{path}/ingest_date=2024-01-0{1 + batch // 20}/batch_id={batch}")

    def lines():
        return sorted(r["value"] for r in spark.read.text(f"{path}/ingest_date=*/batch_id=*").collect())

    before = lines()
    if stop is not None:
        moves = []

        def stopping(*args, real=upkeep._move):
            if len(moves) == stop:
                raise KeyboardInterrupt
            moves.append(args)
            real(*args)

        with monkeypatch.context() as patched:
            patched.setattr(upkeep, "_move", stopping)
            with pytest.raises(KeyboardInterrupt):
                upkeep.compact_days(spark, path, "2024-01-03", flush_bytes=4000)
    for _ in range(2):
        upkeep.compact_days(spark, path, "2024-01-03", flush_bytes=4000)
        assert lines() == before
    files = [len(glob.glob(f"{path}/ingest_date=2024-01-0{d}/*/*.txt")) for d in (1, 2, 3)]
    assert 1 <= files[0] <= 2 and 1 <= files[1] <= 2 and files[2] >= 10


def test_chunks_are_whole_across_batches_of_rows(spark):
    """Chunks of ten go out whole where rows come by seven; only the last one of the task is shorter."""
    rows = spark.range(25).coalesce(1).select(F.col("id").cast("string").alias("key"), F.lit("v").alias("value"), F.lit(1).alias("attempt"))
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)
    spark.conf.set(setting, 7)
    try:
        tried = delivery.attempted(rows, lambda chunk: [len(chunk) == 10] * len(chunk), 10).collect()
    finally:
        spark.conf.set(setting, before)
    assert sorted((int(r["key"]), r["accepted"]) for r in tried) == [(n, n < 20) for n in range(25)]
