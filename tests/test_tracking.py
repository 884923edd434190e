"""Tracks with their points as a stream, and replays of the error sink."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from aerolake.operators import tracks
from aerolake.operators.decode import decode_state_vector, good_states
from aerolake.operators.enrich import FAILED, OK
from aerolake.sources.snapshots import explode_states
from aerolake.streaming import jobs, replay, tracking

POINTS = (
    "icao24 STRING, callsign STRING, timestamp TIMESTAMP, latitude DOUBLE, longitude DOUBLE, altitude DOUBLE, heading DOUBLE,"
    " on_ground BOOLEAN, snapshot_id STRING, pos INT"
)
START = datetime(2024, 1, 1)


def settings(tmp_path, name):
    return jobs.StreamSettings(str(tmp_path / f"checkpoint-{name}"), available_now=True)


def point(n, key, at, altitude=None):
    return (*key, START + timedelta(microseconds=at), 0.1 + n, -n / 3, altitude, None, n % 2 == 0, f"{n:06d}", 0)


def lines(parts):
    """{(icao24, callsign, start): (end, the joined path)}, checking that each part begins where the one before ended."""
    found = {}
    for row in sorted(parts.collect(), key=lambda r: (str(r["icao24"]), str(r["callsign"]), r["start_time"], r["part"])):
        key = (row["icao24"], row["callsign"], row["start_time"])
        path = [tuple(p) for p in row["path"]]
        if row["part"]:
            assert path[0] == found[key][1][-1]
            path = path[1:]
        assert len(path) == row["points"]
        found[key] = (row["end_time"], found.get(key, (None, []))[1] + path)
    return found


def stream_parts(spark, tmp_path, batches, slice_seconds, gap, watermark, stops=False):
    """The two jobs; with ``stops`` both end after each batch and go on from their checkpoints."""
    folder, slices, parts = (str(tmp_path / name) for name in ("points", "slices", "parts"))

    def run():
        stream = jobs.read_records_stream(spark, folder, POINTS, "parquet", max_files=1)
        tracking.run_slices_stream(stream, slices, settings(tmp_path, "slices"), slice_seconds, watermark).awaitTermination()
        tracking.run_tracks_stream(spark, slices, gap, parts, settings(tmp_path, "parts")).awaitTermination()

    for rows in batches:
        spark.createDataFrame(rows, POINTS).coalesce(1).write.mode("append").parquet(folder)
        if stops:
            run()
    if not stops:
        run()
    return spark.read.schema(tracking.PARTS_SCHEMA).parquet(parts)


def test_streamed_tracks_are_the_batch_tracks(spark, tmp_path):
    """Four keys, nulls among them, points out of order by minutes, ties, and gaps that are just as long as the limit or a microsecond longer."""
    gap, second = 180, 1_000_000
    keys, rows, at = [("a", "X"), ("a", None), (None, None), ("b", "")], [], 0
    for n in range(400):
        at += [0, 1, 30 * second, 47 * second + 7, 180 * second, 180 * second + 1, 400 * second][(n * n + n // 7) % 7]
        rows.append(point(n, keys[n % 4], at, None if n % 3 else n / 7))
    swapped = [rows[i + 1 - 2 * (i % 2)] for i in range(400)]
    batches = [swapped[:200], swapped[200:]]
    # The second of these closes the slice of the first, which moves the watermark of the slices beyond all tracks.
    ends = [point(400 + day, ("z", "z"), at + day * 86_400 * second) for day in (1, 2)]
    parts = stream_parts(spark, tmp_path, [*batches, ends], 60, gap, "30 minutes", stops=True)
    streamed = lines(tracking.closed_tracks(parts))
    batch = lines(tracks.assemble_tracks(spark.createDataFrame(rows, POINTS), gap, max_points=7))
    assert len(batch) > 40 and streamed == batch
    several = tracking.closed_tracks(parts)
    assert several.agg(F.max("parts")).first()[0] > 2
    assert tracks.track_geojson(several).where("geojson IS NULL").count() == 0


def test_open_tracks_and_late_points(spark, tmp_path):
    """Parts come out before a track has ended; a point behind the watermark is dropped."""
    second = 1_000_000
    steady = [point(n, ("a", "X"), n * 60 * second) for n in range(100)]
    late = point(500, ("a", "X"), 30 * second)
    parts = stream_parts(spark, tmp_path, [steady[:50], steady[50:], [late, point(900, ("z", "z"), 101 * 60 * second)]], 600, 300, "10 minutes")
    assert tracking.closed_tracks(parts).count() == 0
    found = lines(parts)
    assert list(found) == [("a", "X", START)]
    path = found["a", "X", START][1]
    # The watermark is 91 minutes in, the slices up to 90 are out.
    assert [p[0] for p in path] == [START + timedelta(minutes=n) for n in range(90)]


def test_replays(spark, tmp_path):
    """A record is read at the attempt that corrects it, or given up after three; a repeated batch leaves the same rows."""
    path = str(tmp_path / "replays")

    def correct(rows):
        n = F.col("recordId").cast("int") % 5
        good = F.base64(F.encode(F.lit('{"icao24": "a", "latitude": 1, "longitude": 2}'), "UTF-8"))
        bare = F.base64(F.encode(F.lit('{"icao24": "a"}'), "UTF-8"))
        return rows.withColumn("data", F.when((n < 3) & (n < F.col("attempt")), good).when(n == 3, bare).otherwise(F.col("data")))

    def errors(first):
        return spark.range(first, first + 100).select(F.col("id").cast("string").alias("recordId"), F.lit("%%%").alias("data"))

    for batch_id in (0, 1, 1, 2):
        replay.replay_errors(errors(100 * batch_id), batch_id, path, correct)
    for _ in range(2):
        replay.drain_replays(spark, path, correct)
    ends = replay.replayed(spark, path)
    counts = {(r["result"], r["attempt"]): r["count"] for r in ends.groupBy("result", "attempt").count().collect()}
    assert counts == {(OK, 1): 60, (OK, 2): 60, (OK, 3): 60, ("Dropped", 1): 60}
    lost = replay.replays_given_up(spark, path)
    assert {int(r["recordId"]) for r in lost.collect()} == {n for n in range(300) if n % 5 == 4}
    assert {(r["result"], r["attempt"]) for r in lost.collect()} == {(FAILED, 3)}
    replay.write_replayed(spark, path, str(tmp_path / "again"))
    replay.write_replayed(spark, path, str(tmp_path / "again"))
    assert spark.read.json(str(tmp_path / "again")).count() == 180


def test_replays_of_nothing(spark, tmp_path):
    path = str(tmp_path / "replays")
    replay.drain_replays(spark, path, lambda rows: rows)
    replay.replay_errors(spark.createDataFrame([], "recordId STRING, data STRING"), 0, path, lambda rows: rows)
    replay.drain_replays(spark, path, lambda rows: rows)
    assert replay.replayed(spark, path).count() == replay.replays_given_up(spark, path).count() == 0


def test_paths_of_decoded_points_join_without_the_driver(spark):
    """Bodies of 50 states look small to Spark, so it would broadcast the points."""
    state = '["a",null,"q",null,1704067200,1.5,2.5,null,false,null,null,null,null,null,null,false,0]'
    bodies = spark.range(100).select(F.col("id").cast("string").alias("snapshot_id"), F.lit(f'{{"states": [{",".join([state] * 50)}]}}').alias("body"))
    points = tracks.track_points(good_states(decode_state_vector(explode_states(bodies))))
    assembled = tracks.assemble_tracks(points, 60, max_points=1000)
    plan = assembled._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("SortMergeJoin") == 2 and "BroadcastHashJoin" not in plan
    assert sorted((r["part"], r["points"], len(r["path"])) for r in assembled.collect()) == [(n, 1000, 1000 + (n > 0)) for n in range(5)]
