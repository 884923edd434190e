"""Streams give what the batch operators give, also when batches repeat."""

import json
import time
from datetime import datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from aerolake.functions.text import encode_envelope, state_to_json
from aerolake.operators import alarms, tracks
from aerolake.operators.decode import decode_state_vector, good_states
from aerolake.operators.enrich import enrich_outcome
from aerolake.operators.latest import latest_state
from aerolake.operators.publish import published_records
from aerolake.plans.pipelines import ingest
from aerolake.schemas import ENVELOPE_SCHEMA
from aerolake.session import work_dir
from aerolake.sources.snapshots import explode_states, read_snapshots, read_snapshots_stream
from aerolake.streaming import alarming, jobs, sinks

START = 1_704_067_200


def snapshot(n):
    """A body of eight aircraft, 40 seconds apart from the next; some rows are broken."""
    states = []
    for a in range(8):
        row = [f"ac{a}" if a else None, f"CS{a % 2} ", "Q", 0, START + 40 * n + a, float(a), float(n % 60),
               100.0 * n, False, 200.0, 90.0, 0.0, None, None, "0001", False, a % 6 if (n + a) % 7 else 9]
        if a == 3:
            row[5] = None
        states.append(row)
    return json.dumps({"time": START + 40 * n, "states": states})


@pytest.fixture
def landing(tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()
    for n in range(12):
        (folder / f"{n:04d}.json").write_text(snapshot(n))
    return folder


def settings(tmp_path, name):
    return jobs.StreamSettings(str(tmp_path / f"checkpoint-{name}"), available_now=True)


def good(snapshots):
    return good_states(decode_state_vector(explode_states(snapshots)))


def run(query):
    query.awaitTermination()
    return query


def ids(df, *columns):
    return sorted(map(repr, df.select(*columns).collect()))


def envelopes(states):
    damaged = F.col("latitude") == 5.0
    data = F.when(damaged, "%%%").otherwise(encode_envelope(state_to_json()))
    return states.select(F.concat_ws("-", "snapshot_id", "pos").alias("recordId"), data.alias("data"))


def test_enrichment(spark, landing, tmp_path):
    paths = jobs.LakePaths(str(tmp_path / "lake"), "dev")
    config = settings(tmp_path, "enrich")

    def once():
        stream = envelopes(good(read_snapshots_stream(spark, str(landing), max_files=5)))
        return run(jobs.run_enrichment_stream(stream, paths, config))

    once()
    expected = enrich_outcome(envelopes(good(read_snapshots(spark, str(landing)))))
    failed = expected.where("result = 'ProcessingFailed'")
    fields = ["icao24", "latitude", "longitude", "location", "last_contact"]

    def enriched():
        return spark.read.json(f"{paths.enriched}/ingest_date=*/batch_id=*")

    batch = expected.where("result = 'Ok'").select(F.from_json("value", enriched().schema).alias("v")).select("v.*")
    assert ids(enriched(), *fields) == ids(batch, *fields)
    assert ids(spark.read.json(paths.errors), "recordId", "data") == ids(failed, "recordId", "data")
    assert failed.count() > 0 and expected.where("result = 'Dropped'").count() > 0

    before = enriched().count()
    once()
    assert enriched().count() == before
    (landing / "9999.json").write_text(snapshot(20))
    once()
    assert enriched().count() == before + good(read_snapshots(spark, str(landing / "9999.json"))).where("longitude is not null").count()


def test_user_transform(spark, landing, tmp_path):
    def mark(batches):
        for pdf in batches:
            yield pd.DataFrame({
                "recordId": pdf["recordId"], "data": pdf["data"], "result": "Ok",
                "value": '{"n": ' + pdf["data"].str.len().astype(str) + "}",
            })

    schema = "recordId STRING, data STRING, result STRING, value STRING"
    paths = jobs.LakePaths(str(tmp_path / "lake"))
    stream = envelopes(good(read_snapshots_stream(spark, str(landing))))
    run(jobs.run_enrichment_stream(stream, paths, settings(tmp_path, "user"), lambda df: df.mapInPandas(mark, schema)))
    assert spark.read.json(f"{paths.enriched}/ingest_date=*/batch_id=*").count() == good(read_snapshots(spark, str(landing))).count()


def test_repeated_batch_overwrites_itself(spark, landing, tmp_path):
    states = good(read_snapshots(spark, str(landing)))
    outcome = enrich_outcome(envelopes(states)).withColumn("ingested_at", F.current_timestamp())
    out, err, keyed, records = (str(tmp_path / n) for n in ("out", "err", "keyed", "records"))
    for _ in range(2):
        sinks.write_outcome(outcome, 4, out, err)
        sinks.upsert_latest(states, 4, keyed)
        sinks.publish_states(published_records(states), 4, records)
    counts = {r.result: r["count"] for r in outcome.groupBy("result").count().collect()}
    assert spark.read.json(f"{out}/ingest_date=*/batch_id=*").count() == counts["Ok"]
    assert spark.read.json(err).count() == counts["ProcessingFailed"]
    assert spark.read.parquet(records).count() == states.count()
    assert sinks.read_latest(spark, keyed).count() == latest_state(states).count()


def test_latest(spark, landing, tmp_path):
    table = str(tmp_path / "latest")
    for name in ("one", "two"):  # a second run from scratch delivers everything again
        stream = good(read_snapshots_stream(spark, str(landing), max_files=5))
        run(jobs.run_latest_stream(stream, table if name == "one" else table + "2", settings(tmp_path, name)))
    expected = latest_state(good(read_snapshots(spark, str(landing))))
    columns = ["key", "snapshot_id", "pos", "last_contact", "altitude"]
    assert ids(sinks.read_latest(spark, table), *columns) == ids(expected, *columns)
    newer = good(spark.createDataFrame([("z", snapshot(50))], "snapshot_id STRING, body STRING"))
    sinks.upsert_latest(newer, 3, table)
    merged = sinks.read_latest(spark, table)
    assert merged.count() == expected.count() and merged.where("snapshot_id = 'z'").count() == newer.count()


def test_upsert_is_flat_and_takes_late_and_repeated_batches(spark, tmp_path):
    table, order, files = str(tmp_path / "table"), [5, 2, 9, 1, 7, 3, 8, 4, 6, 0], []
    bodies = {n: good(spark.createDataFrame([(f"s{n}", snapshot(n))], "snapshot_id STRING, body STRING")) for n in order}
    for batch_id, n in enumerate(order):
        sinks.upsert_latest(bodies[n], batch_id, table, buckets=2, grace_seconds=0)
        if batch_id % 4 == 3:  # a repeat of a batch that failed after writing
            sinks.upsert_latest(bodies[n], batch_id, table, buckets=2, grace_seconds=0)
        files.append(len(sinks.read_latest(spark, table).inputFiles()))
    everything = bodies[0]
    for n in order[:-1]:
        everything = everything.unionByName(bodies[n])
    columns = ["key", "snapshot_id", "pos", "last_contact", "altitude"]
    assert ids(sinks.read_latest(spark, table), *columns) == ids(latest_state(everything), *columns)
    assert max(files) <= 2 * 3 and len(list((tmp_path / "table").glob("version=*"))) <= 4


def test_ingest(spark, landing, tmp_path):
    (landing / "bad1.json").write_text("garbage")
    (landing / "bad2.json").write_text(snapshot(3)[:-2])
    paths, config = jobs.LakePaths(str(tmp_path / "lake")), settings(tmp_path, "ingest")
    for _ in range(2):
        run(jobs.run_ingest_stream(read_snapshots_stream(spark, str(landing), max_files=4), paths, config, chunk_size=3))
    whole = ingest(read_snapshots(spark, str(landing)), chunk_size=3)
    records = spark.read.parquet(f"{paths.ingest}/records")
    quarantine = spark.read.parquet(f"{paths.ingest}/quarantine")
    assert records.select("batch_id").distinct().count() >= 3
    assert ids(records, "snapshot_id", "key", "value") == ids(whole.records, "snapshot_id", "key", "value")
    assert ids(quarantine, "snapshot_id", "pos", "reject_reason", "raw") == ids(whole.quarantine, "snapshot_id", "pos", "reject_reason", "raw")
    assert quarantine.where("pos is null").count() == 2 and records.count() + quarantine.count() == 12 * 8 + 2
    ledger = spark.read.parquet(f"{paths.ingest}/ledger")
    assert ids(ledger, "snapshot_id", "batch_no", "records", "sent") == ids(whole.ledger, "snapshot_id", "batch_no", "records", "sent")


def test_publish_and_raw(spark, landing, tmp_path):
    records, raw = str(tmp_path / "records"), str(tmp_path / "raw")
    run(jobs.run_publish_stream(good(read_snapshots_stream(spark, str(landing))), settings(tmp_path, "publish"), records))
    expected = published_records(good(read_snapshots(spark, str(landing))))
    assert ids(spark.read.parquet(records), "key", "value") == ids(expected, "key", "value")
    for _ in range(2):
        stream = jobs.read_records_stream(spark, records, "key STRING, value STRING", "parquet")
        run(jobs.run_raw_stream(stream, raw, settings(tmp_path, "raw")))
    assert ids(spark.read.text(raw), "value") == ids(expected, "value")


def test_envelope_files_as_source(spark, tmp_path):
    folder = tmp_path / "envelopes"
    folder.mkdir()
    (folder / "a.json").write_text('{"recordId": "1", "data": "%%%"}\n')
    stream = jobs.read_records_stream(spark, str(folder), ENVELOPE_SCHEMA, max_files=1)
    paths = jobs.LakePaths(str(tmp_path / "lake"))
    run(jobs.run_enrichment_stream(stream, paths, settings(tmp_path, "files")))
    (row,) = spark.read.json(f"{paths.errors}/ingest_date=*/batch_id=*").collect()
    assert (row.recordId, row.data, row.reason) == ("1", "%%%", "ProcessingFailed")


def write_slices(spark, rows, schema, column, folder, slices):
    """One append per slice, oldest first, as a landing zone would grow."""
    rows = sorted(rows, key=lambda r: r[column])
    size = -(-len(rows) // slices)
    for i in range(0, len(rows), size):
        spark.createDataFrame(rows[i:i + size], schema).coalesce(1).write.mode("append").parquet(folder)


def test_rollup_closed_periods(spark, tmp_path):
    start = datetime(2024, 1, 1)
    rows = [("m", "s", start + timedelta(seconds=97 * n), float(n)) for n in range(300) if n % 11]
    schema = "metric STRING, source STRING, ts TIMESTAMP, value DOUBLE"
    folder, table = str(tmp_path / "metrics"), str(tmp_path / "rollup")
    write_slices(spark, rows, schema, 2, folder, 6)
    late = jobs.LateRows()
    spark.streams.addListener(late)
    for _ in range(2):
        stream = jobs.read_records_stream(spark, folder, schema, "parquet", max_files=1)
        query = run(jobs.run_rollup_stream(stream, 600, "Sum", table, settings(tmp_path, "rollup"), "20 minutes"))
    # The engine judges lateness by the watermark of the batch before, so the late row comes third.
    for slice_ in (rows[:200], rows[200:], [("m", "s", start, 1.0)]):
        spark.createDataFrame(slice_, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "both"))
        time.sleep(0.05)
    stream = jobs.read_records_stream(spark, str(tmp_path / "both"), schema, "parquet", max_files=1)
    other = run(jobs.run_rollup_stream(stream, 600, "Sum", table + "2", settings(tmp_path, "late"), "20 minutes"))
    for _ in range(100):
        if late.dropped.get(str(other.id)):
            break
        time.sleep(0.1)
    spark.streams.removeListener(late)
    assert late.dropped[str(query.id)] == 0 and late.dropped[str(other.id)] == 1
    closed_until = rows[-1][2] - timedelta(minutes=20)
    batch = alarms.metric_rollup(spark.read.parquet(folder), 600, "Sum")
    closed = batch.where(F.col("period_start") + F.expr("INTERVAL 600 SECONDS") <= F.lit(closed_until))
    assert ids(spark.read.parquet(table), "period_start", "value") == ids(closed, "period_start", "value")
    assert closed.count() > 10


def test_sessions_match_segments(spark, tmp_path):
    start = datetime(2024, 1, 1)
    rows, at = [], start
    for n in range(200):
        at += timedelta(seconds=[30, 60, 61, 10, 500][n % 5 if n % 3 else 0])
        rows.append((f"a{n % 2}", None if n % 4 else "C", at, 1.0, 2.0))
    schema = "icao24 STRING, callsign STRING, timestamp TIMESTAMP, latitude DOUBLE, longitude DOUBLE"
    folder, table = str(tmp_path / "points"), str(tmp_path / "sessions")
    write_slices(spark, rows, schema, 2, folder, 5)
    stream = jobs.read_records_stream(spark, folder, schema, "parquet", max_files=1)
    run(jobs.run_sessions_stream(stream, 180, table, settings(tmp_path, "sessions"), "10 minutes"))
    columns = ["icao24", "callsign", "start_time", "end_time", "points", "duration_seconds"]
    batch = tracks.track_segments(spark.read.parquet(folder), 180)
    ended = batch.where(F.col("end_time") < F.lit(rows[-1][2] - timedelta(seconds=180 + 600)))
    assert ids(spark.read.parquet(table), *columns) == ids(ended, *columns)
    assert ended.count() > 5
    exact = [("x", "y", start, 1.0, 1.0), ("x", "y", start + timedelta(seconds=180), 1.0, 1.0)]
    pair = spark.createDataFrame(exact, schema)
    assert jobs.track_sessions(pair, 180).count() == tracks.track_segments(pair, 180).count() == 1


def test_work_dir(spark):
    first, second = work_dir(spark, "x"), work_dir(spark, "x")
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    assert first != second and first.startswith(base)


def test_alarms_fire_while_the_stream_runs(spark, tmp_path):
    """The job stops and goes on between batches; what it says is what the alarm table changes from minute to minute."""
    specs = [
        alarms.AlarmSpec("idle", "records", "Sum", 120, 2, 2, "<", 1),
        alarms.AlarmSpec("burst", "records", "Sum", 60, 2, 3, ">", 2),
        alarms.AlarmSpec("lag", "age", "Max", 60, 1, 1, ">", 5.0),
    ]
    rows = [("records", "a", m, 1.0) for m in [0, 1, 1, 1, 2, 2, 2, 9, 9, 9, 10, 10, 10, 11, 30, 31, 50]]
    rows += [("records", "b", m, 1.0) for m in range(0, 12)] + [("age", "a", m, float(m % 9)) for m in range(3, 55)]
    minute = lambda m: datetime(2024, 1, 1) + timedelta(minutes=m, seconds=m % 50)
    watched = spark.createDataFrame([("records", "a"), ("records", "b"), ("records", "never"), ("age", "a"), ("age", "never")], "metric string, source string")
    first = F.lit("2024-01-01 00:00:00").cast("timestamp")
    schema = "metric string, source string, ts timestamp, value double"
    for low, high in ((0, 20), (20, 40), (40, 60)):
        part = [(a, b, minute(m), v) for a, b, m, v in rows if low <= m < high]
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "metrics"))
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "metrics"))
        run(alarming.run_partials_stream(stream, str(tmp_path / "minutes"), settings(tmp_path, "minutes"), "2 minutes"))
        run(alarming.run_alarm_stream(spark, str(tmp_path / "minutes"), watched, first, str(tmp_path / "changes"), settings(tmp_path, "alarms"), specs))
    got = sorted(tuple(r) for r in spark.read.parquet(str(tmp_path / "changes")).select("alarm", "source", F.unix_seconds("period_start"), "in_alarm").collect())

    closed = max(60 * m + 60 for _, _, m, _ in rows if 60 * m + 60 <= 54 * 60 + 54 % 50 - 120)
    want = []
    for spec in specs:
        for source in ("a", "b", "never"):
            if spec.metric == "age" and source == "b":
                continue
            verdicts, before = [], False
            for start in range(0, closed - spec.period_seconds + 1, spec.period_seconds):
                own = [v for metric, s, m, v in rows if (metric, s) == (spec.metric, source) and start <= 60 * m < start + spec.period_seconds]
                value = sum(own) if spec.statistic == "Sum" else max(own, default=None)
                verdicts.append(value is not None and (value > spec.threshold if spec.comparison == ">" else value < spec.threshold))
                state = sum(verdicts[-spec.periods :]) >= spec.breaching
                if state != before:
                    want.append((spec.name, source, START + start, state))
                before = state
    assert got == sorted(want) and {a for a, s, _, _ in got if s == "never"} == {"idle"}


def test_keyed_table_of_any_number_of_buckets(spark, landing, tmp_path):
    """Another number of buckets deals the table anew: no key is there twice."""
    table = str(tmp_path / "table")
    states = good(read_snapshots(spark, str(landing))).cache()
    halves = [states.where(F.crc32("snapshot_id") % 2 == n) for n in (0, 1)]
    for batch_id, (rows, buckets) in enumerate([(halves[0], 16), (halves[1], 8), (halves[0], None), (states, 5)]):
        sinks.upsert_latest(rows, batch_id, table, buckets)
    found = sinks.read_latest(spark, table)
    assert ids(found, "key", "last_contact", "snapshot_id") == ids(latest_state(states), "key", "last_contact", "snapshot_id")
    assert found.count() == found.select("key").distinct().count()


def test_readers_of_the_keyed_table_are_not_disturbed(spark, landing, tmp_path):
    table = str(tmp_path / "table")
    states = good(read_snapshots(spark, str(landing))).cache()
    sinks.upsert_latest(states.where("pos < 4"), 0, table)
    early = sinks.read_latest(spark, table)
    want = ids(early, "key", "last_contact")
    for batch_id in (1, 2, 3, 3):
        sinks.upsert_latest(states.where(F.col("pos") >= batch_id), batch_id, table)
    assert ids(early, "key", "last_contact") == want
    # A folder without a manifest, as a stopped batch leaves it, is no part of the table.
    now = ids(sinks.read_latest(spark, table), "key", "last_contact")
    states.limit(1).withColumn("bucket", F.lit(0)).write.partitionBy("bucket").parquet(f"{table}/version=9-stopped")
    assert ids(sinks.read_latest(spark, table), "key", "last_contact") == now


def test_latest_state_sorts_no_rows_before_its_exchange(spark, landing):
    states = good(read_snapshots(spark, str(landing))).cache()
    plan = latest_state(states)._jdf.queryExecution().sparkPlan().toString()
    below = plan[plan.index("Join"):]
    assert "SortAggregate" not in below and "HashAggregate" in below


def test_latest_state_joins_without_the_driver(spark, landing):
    """There is a newest time for each key, so these may not go to the driver to be broadcast."""
    plan = latest_state(good(read_snapshots(spark, str(landing))).cache())._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
