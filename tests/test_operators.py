"""Operators against brute force on small fixtures, with one key holding a third of the rows."""

import random
from collections import defaultdict
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from aerolake.functions.text import publish_key
from aerolake.operators import alarms, countries, flights, latest, publish, tracks
from aerolake.operators import publish as publish_module
from aerolake.plans import catalog
from aerolake.schemas import FLIGHT_SCHEMA, STATE_SCHEMA
from aerolake.sources.countries import read_countries

EPOCH = datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def rows():
    """State tuples with a hot null key, repeated times and exact copies."""
    random.seed(3)
    out = []
    for n in range(1500):
        hot = n % 3 == 0
        key = None if hot else random.choice(["", "a1", "a2", "a3", "b4"])
        seconds = random.choice([100, 100, 100, 7000]) if n % 9 == 0 else random.randrange(0, 200_000)
        out.append({
            "icao24": key, "callsign": random.choice(["X", None]), "origin_country": random.choice(["NA", "Q", None]),
            "last_contact": None if n % 50 == 1 else EPOCH + timedelta(seconds=seconds),
            "latitude": None if n % 40 == 2 else float(n % 90), "longitude": float(-(n % 170)),
            "altitude": None if n % 5 == 0 else float(n), "heading": 1.0, "on_ground": False,
            "snapshot_id": "s1" if n % 3 else f"s{n % 4}", "pos": n,
        })
    return out


@pytest.fixture(scope="module")
def states(spark, rows):
    schema = "snapshot_id STRING, pos INT, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in STATE_SCHEMA)
    names = ["snapshot_id", "pos", *STATE_SCHEMA.names]
    df = spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)
    return df.repartition(6).persist()


def test_numbering_is_dense_across_blocks(states, rows, monkeypatch):
    monkeypatch.setattr(publish_module, "_BLOCK", 64)
    got = {(r.snapshot_id, r.pos): r.seq for r in publish.number_in_order(states.select("snapshot_id", "pos")).collect()}
    expected = {}
    by_snapshot = defaultdict(list)
    for r in rows:
        by_snapshot[r["snapshot_id"]].append(r["pos"])
    for snapshot, positions in by_snapshot.items():
        expected.update({(snapshot, p): i for i, p in enumerate(sorted(positions))})
    assert got == expected


def test_numbering_joins_without_the_driver(spark):
    """There is a shift for each snapshot and block, so these may not go to the driver to be broadcast."""
    rows = spark.range(100).select(F.col("id").cast("string").alias("snapshot_id"), F.lit(0).alias("pos"))
    plan = publish.number_in_order(rows)._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_ledger_and_outcome(spark, states, rows):
    ledger = publish.delivery_ledger(states, 100, F.col("pos") == 7)
    got = {(r.snapshot_id, r.batch_no): r for r in ledger.collect()}
    hot = sorted(r["pos"] for r in rows if r["snapshot_id"] == "s1")
    assert got[("s1", 0)].records == 100 and sum(r.records for k, r in got.items() if k[0] == "s1") == len(hot)
    broken = ("s1", hot.index(7) // 100)
    assert got[broken].failed == 1 and got[broken].sent == 99 and not got[broken].ok
    assert all(r.ok for k, r in got.items() if k != broken)
    snapshots = spark.createDataFrame([("s1",), ("s2",), ("none",)], "snapshot_id STRING")
    outcome = {r.snapshot_id: r for r in publish.delivery_outcome(snapshots, ledger).collect()}
    assert (outcome["s1"].ok, outcome["s2"].ok, outcome["none"].ok) == (False, True, True)
    assert outcome["none"].batches == 0
    missing = publish.delivery_outcome(snapshots, ledger, has_target=False).collect()
    assert not any(r.ok for r in missing)


def test_deliver_in_chunks(states, rows):
    records = publish.published_records(states, keep=("snapshot_id", "pos"))

    def send(chunk):
        assert len(chunk) <= 200
        if any('"latitude":3.0' in value for _, value in chunk) and len(chunk) < 200:
            raise ConnectionError("gone")
        return sum(key == "unknown" for key, _ in chunk)

    ledger = publish.deliver(records, send, 200).collect()
    assert sum(r.records for r in ledger) == len(rows)
    assert all(r.sent + r.failed == r.records and r.ok == (r.failed == 0) for r in ledger)


def test_partition_by_key(states):
    placed = publish.partition_by_key(states, 8).select(
        publish_key(F.col("icao24")).alias("key"), F.spark_partition_id().alias("p")
    )
    parts = {r.key: r.n for r in placed.groupBy("key").agg(F.countDistinct("p").alias("n")).collect()}
    assert parts.pop("unknown") > 4 and set(parts.values()) == {1}
    assert placed.count() == states.count()
    sliced = publish.partition_by_key(states.where("icao24 = 'a1'"), 8, spread_seconds=3600)
    by_slice = sliced.select(
        F.floor(F.unix_seconds("last_contact") / 3600).alias("slice"), F.spark_partition_id().alias("p")
    ).groupBy("slice").agg(F.countDistinct("p").alias("n"))
    assert {r.n for r in by_slice.collect()} == {1}
    assert sliced.select(F.spark_partition_id()).distinct().count() > 2


def test_latest_state(states, rows):
    expected = {}
    for r in rows:
        key = r["icao24"] or "unknown"
        rank = (r["last_contact"] is not None, r["last_contact"] or EPOCH, r["snapshot_id"], r["pos"])
        if key not in expected or rank > expected[key][0]:
            expected[key] = (rank, r["pos"])
    got = {r.key: r.pos for r in latest.latest_state(states).collect()}
    assert got == {k: v[1] for k, v in expected.items()}


def test_retention(states):
    now = EPOCH + timedelta(seconds=200_000)
    kept = latest.apply_retention(states, now, 24)
    assert kept.where("last_contact is null").count() == 0
    assert kept.agg(F.min("last_contact")).first()[0] >= now - timedelta(hours=24)
    assert latest.apply_retention(states, now, 8760).count() == states.where("last_contact is not null").count()
    for hours in (23, 8761, 0):
        with pytest.raises(ValueError):
            latest.apply_retention(states, now, hours)


def brute_segments(rows, gap):
    groups = defaultdict(list)
    for r in rows:
        if r["last_contact"] is not None and r["latitude"] is not None and r["longitude"] is not None:
            groups[(r["icao24"], r["callsign"])].append((r["last_contact"], r["snapshot_id"], r["pos"]))
    out = {}
    for key, points in groups.items():
        segment, previous = 0, None
        for p in sorted(points):
            if gap is not None and previous is not None and (p[0] - previous).total_seconds() > gap:
                segment += 1
            out.setdefault((*key, segment), []).append(p)
            previous = p[0]
    return out


@pytest.mark.parametrize("gap", [None, 60, 900, 7200])
def test_tracks_match_brute_force(states, rows, gap):
    points = tracks.track_points(states)
    expected = brute_segments(rows, gap)
    summary = tracks.track_summary(points).withColumn("segment", F.lit(0)) if gap is None else tracks.track_segments(points, gap)
    got = {(r.icao24, r.callsign, r.segment): (r.start_time, r.end_time, r.points) for r in summary.collect()}
    assert got == {k: (v[0][0], v[-1][0], len(v)) for k, v in expected.items()}
    for limit in (10_000, 7):
        paths, last = defaultdict(list), {}
        assembled = tracks.assemble_tracks(points, gap, limit).collect()
        for r in sorted(assembled, key=lambda r: r.part):
            joint = int(r.part > 0)
            assert r.points + joint == len(r.path) and [p.timestamp for p in r.path] == sorted(p.timestamp for p in r.path)
            key = (r.icao24, r.callsign, r.segment)
            assert r.points == limit or r.part == r.parts - 1
            assert (r.start_time, r.end_time) == (expected[key][0][0], expected[key][-1][0])
            if joint:
                assert last[key] == r.path[0]
            last[key] = r.path[-1]
            paths[key].append([p.timestamp for p in r.path[joint:]])
        assert paths.keys() == expected.keys()
        for key, parts in paths.items():
            assert sum(parts, []) == [p[0] for p in expected[key]]
        if limit == 10_000:
            assert all(len(parts) == 1 for parts in paths.values())
    many_at_once = max(len(r.path) for r in assembled)
    assert many_at_once == 8


def test_geojson(spark, states):
    import json

    track = tracks.assemble_tracks(tracks.track_points(states.where("icao24 = 'a1' and callsign is null")))
    (row,) = tracks.track_geojson(track).collect()
    feature = json.loads(row.geojson)
    assert feature["type"] == "Feature" and feature["geometry"]["type"] == "LineString"
    assert feature["properties"]["callsign"] is None and feature["properties"]["duration_seconds"] == row.duration_seconds
    coordinates = feature["geometry"]["coordinates"]
    assert len(coordinates) == row.points
    for point, coordinate in zip(row.path, coordinates):
        expected = [point.longitude, point.latitude] + ([] if point.altitude is None else [point.altitude])
        assert coordinate == expected
    assert tracks.points_in_feet(tracks.track_points(states)).where("altitude is null and altitude_ft is not null").count() == 0


def test_countries(spark, tmp_path, states):
    path = tmp_path / "countries.csv"
    path.write_text(
        '"id","code","name","continent","wikipedia_link","keywords"\n'
        '1,"NA","NA","NA","http://x","a, ""b"" é"\n'
        '2,"QQ","Q","EU",,\n',
        encoding="utf-8",
    )
    listed = read_countries(spark, str(path))
    first, second = listed.orderBy("id").collect()
    assert (first.code, first.continent, first.keywords) == ("NA", "NA", 'a, "b" é')
    assert second.wikipedia_link is None and second.keywords is None
    joined = countries.enrich_country(states, listed)
    assert joined.count() == states.count()
    assert {(r.origin_country, r.country_code) for r in joined.select("origin_country", "country_code").distinct().collect()} == {
        ("NA", "NA"), ("Q", "QQ"), (None, None)
    }
    unmatched = countries.unmatched_countries(states, listed.where("name = 'Q'"))
    assert {r.origin_country for r in unmatched.collect()} == {"NA", None}
    assert countries.repeated_countries(listed.union(listed)).count() == 2


def test_flights(spark):
    start = datetime(2024, 1, 1)
    rows = [("a", start, start + timedelta(hours=2, milliseconds=500), None, "X", None), ("b", start, start, "c", None, "Y")]
    table = spark.createDataFrame(rows, FLIGHT_SCHEMA)
    assert [r.icao24 for r in flights.arrivals(table).collect()] == ["b"]
    (departed,) = flights.with_duration(flights.departures(table)).collect()
    assert departed.icao24 == "a" and departed.duration_seconds == 7200.5


def utc(seconds):
    return datetime.fromtimestamp(seconds, timezone.utc)


def brute_alarm(values, spec, first, last):
    """Verdicts per period from a dict of period to value."""
    out = {}
    for second in range(first, last + 1, spec.period_seconds):
        breaches = 0
        for back in range(spec.periods):
            t = second - back * spec.period_seconds
            if t < first:
                continue
            value = values.get(t, 0.0 if spec.statistic == "Sum" else None)
            if value is not None and (value > spec.threshold if spec.comparison == ">" else value < spec.threshold):
                breaches += 1
        out[second] = (breaches, breaches >= spec.breaching)
    return out


@pytest.mark.parametrize("name", sorted(alarms.ALARMS))
def test_alarms_match_brute_force(spark, name):
    spec = alarms.ALARMS[name]
    random.seed(name)
    period = spec.period_seconds
    start = 1_704_067_200
    span = 2000 if period == 60 else 300
    events, values = [], defaultdict(dict)
    for source, share in (("hot", 0.6), ("cold", 0.2)):
        for n in range(span):
            if random.random() > share:
                continue
            t = start + n * period
            value = random.choice([0.5, 0.5, 2.0]) * spec.threshold
            events += [(spec.metric, source, utc(t + 1), value / 2), (spec.metric, source, utc(t + period - 1), value / 2)]
            values[source][t] = value if spec.statistic == "Sum" else value / 2
    rows = spark.createDataFrame(events, "metric STRING, source STRING, ts TIMESTAMP, value DOUBLE")
    rollup = alarms.metric_rollup(rows, period, spec.statistic)
    assert {(r.source, r.s): r.value for r in rollup.select("source", F.unix_seconds("period_start").alias("s"), "value").collect()} == {
        (source, t): v for source in values for t, v in values[source].items()
    }
    judged = alarms.evaluate_alarm(rollup, spec).withColumn("s", F.unix_seconds("period_start"))
    got = defaultdict(dict)
    for r in judged.collect():
        got[r.source][r.s] = (r.breaches, r.in_alarm)
        assert r.value == values[r.source].get(r.s, 0.0 if spec.statistic == "Sum" else None)
    for source in values:
        assert got[source] == brute_alarm(values[source], spec, min(values[source]), max(values[source]))


def test_silent_source_is_judged(spark):
    spec = alarms.ALARMS["stream-idle"]
    rows = spark.createDataFrame([(spec.metric, "s", utc(1_704_067_200), 1.0)], "metric STRING, source STRING, ts TIMESTAMP, value DOUBLE")
    rollup = alarms.metric_rollup(rows, 600, "Sum")
    watched = alarms.watched_range(rollup, end=F.timestamp_seconds(F.lit(1_704_067_200 + 1800)))
    fired = alarms.firing(alarms.evaluate_alarm(rollup, spec, watched))
    assert {r.s for r in fired.select(F.unix_seconds("period_start").alias("s")).collect()} == {1_704_067_200 + 1200, 1_704_067_200 + 1800}
    message = alarms.format_alert(fired, spec).orderBy("period_start").first().message
    assert message.splitlines()[:2] == ["[ALERTA] stream-idle", "Status: 2024-01-01T00:20:00Z"]
    assert "Métrica: incoming_records = 0 (Limite: 1)" in message


def test_alarm_table_judges_metrics_beyond_its_month(spark, tmp_path):
    rows = spark.range(2_240_000, 2_240_500).selectExpr(
        "id AS event_id", "CAST(timestamp_seconds(1704067200 + 31 - 1704067200 % 31) AS TIMESTAMP_NTZ) AS ts", "id % 40 AS user_id",
        "'click' AS event_type", "CAST(200 AS DOUBLE) AS value", "'{\"k\": 5}' AS props",
    )
    rows.write.parquet(f"{tmp_path}/events.parquet")
    fired = catalog.alarm_table(spark, str(tmp_path)).collect()
    assert {r["metric"] for r in fired if r["source"] == "ledger"} == {"throttled_records", "throttled_requests"}


def test_partials_give_the_rollups_of_all_periods(spark):
    start = datetime(2024, 1, 1)
    rows = [("m" if n % 5 else "k", f"s{n % 3}", start + timedelta(seconds=37 * n), float(n % 17)) for n in range(400)]
    metrics = spark.createDataFrame(rows, "metric string, source string, ts timestamp, value double")
    partials = alarms.metric_partials(metrics)
    for seconds in (60, 300, 600):
        for statistic in ("Sum", "Max"):
            whole = alarms.metric_rollup(metrics, seconds, statistic)
            assert sorted(map(tuple, alarms.rollup_of(partials, seconds, statistic).collect())) == sorted(map(tuple, whole.collect()))
    with pytest.raises(ValueError):
        alarms.rollup_of(partials, 90, "Sum")
