"""Decode rules, slot by slot, with hand-written arrays."""

import json
from collections import Counter
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from aerolake.functions.text import event_time_text
from aerolake.operators.decode import decode_state_vector, quarantined, split_malformed
from aerolake.operators.summary import snapshot_document, snapshot_summary
from aerolake.plans.pipelines import decode_snapshots, enrich, ingest
from aerolake.schemas import STATE_FIELDS
from aerolake.sources.snapshots import explode_states, quarantined_bodies, read_snapshots

FULL = [
    "4b1801", "SWR12   ", "Switzerland", 1700000000, 1700000001, 8.5, 47.25, 1000, False, 200.5,
    90, -3.5, [1, 2], 1010.0, "0012", False, 2,
]


def array(**changes):
    row = list(FULL)
    for name, value in changes.items():
        row[STATE_FIELDS.index(name)] = value
    return row


def decode(spark, *elements):
    """Decoded rows of one body, in order; elements are values or raw JSON text."""
    texts = [e if isinstance(e, str) else json.dumps(e) for e in elements]
    body = '{"time": 1, "states": [' + ",".join(texts) + "]}"
    snapshots = spark.createDataFrame([("s", body)], "snapshot_id STRING, body STRING")
    return decode_state_vector(explode_states(snapshots)).drop("raw").orderBy("pos").collect()


def test_full_row(spark):
    (row,) = decode(spark, FULL)
    assert row.reject_reason is None and row.pos == 0
    assert row.callsign == "SWR12" and row.squawk == "0012"
    assert row.altitude == 1000.0 and row.heading == 90.0
    assert row.on_ground is False and row.spi is False
    assert row.sensors == [1, 2] and row.position_source == 2
    assert row.time_position == datetime.fromtimestamp(1700000000)
    assert row.last_contact == datetime.fromtimestamp(1700000001)


def test_all_nulls_is_a_good_row(spark):
    (row,) = decode(spark, [None] * 17)
    assert row.reject_reason is None
    assert all(row[name] is None for name in STATE_FIELDS)


GOOD = [
    ("icao24", 123, "123"),
    ("callsign", "   ", ""),
    ("callsign", "\t AB 1\n ", "AB 1"),
    ("callsign", " \x1fX　", "X"),
    ("time_position", 0, None),
    ("time_position", "", None),
    ("time_position", False, None),
    ("time_position", [], None),
    ("time_position", True, datetime.fromtimestamp(1)),
    ("time_position", -1.5, datetime.fromtimestamp(-1.5)),
    ("last_contact", 1700000000.123456, datetime.fromtimestamp(1700000000.123456)),
    ("last_contact", 1.7e9, datetime.fromtimestamp(1700000000)),
    ("last_contact", 200000000000, datetime.fromtimestamp(200000000000)),
    ("longitude", 0, 0.0),
    ("longitude", -0.0005, -0.0005),
    ("latitude", 1e4, 10000.0),
    ("latitude", "12.5", 12.5),
    ("latitude", " 7 ", 7.0),
    ("altitude", True, 1.0),
    ("on_ground", 0, False),
    ("on_ground", 0.0, False),
    ("on_ground", 2, True),
    ("on_ground", "", False),
    ("on_ground", "false", True),
    ("on_ground", [0], True),
    ("on_ground", {}, False),
    ("sensors", [], None),
    ("sensors", 0, None),
    ("sensors", "", None),
    ("sensors", [7], [7]),
    ("sensors", [3000000000], [3000000000]),
    ("sensors", [2.7, "3", True], [2, 3, 1]),
    ("squawk", 7700, "7700"),
    ("spi", True, True),
    ("position_source", 0, 0),
    ("position_source", 4, 4),
    ("position_source", 1.0, 1),
    ("position_source", True, 1),
]


def test_accepted_values(spark):
    rows = decode(spark, *[array(**{name: value}) for name, value, _ in GOOD])
    for row, (name, value, expected) in zip(rows, GOOD, strict=True):
        assert row.reject_reason is None, (name, value, row.reject_reason)
        assert row[name] == expected and type(row[name]) is type(expected), (name, value, row[name])


BAD = [
    ("time_position", "abc"),
    ("time_position", "1700000000"),
    ("last_contact", 1e300),
    ("last_contact", 253402300800),
    ("longitude", "x"),
    ("latitude", ""),
    ("altitude", [1]),
    ("velocity", "n/a"),
    ("heading", {}),
    ("vertical_rate", "1,5"),
    ("geo_altitude", "abc"),
    ("sensors", ["a"]),
    ("sensors", [None]),
    ("sensors", ["2.7"]),
    ("sensors", [1, [2]]),
    ("sensors", 5),
    ("position_source", 5),
    ("position_source", 9),
    ("position_source", -1),
    ("position_source", 0.5),
    ("position_source", "0"),
    ("position_source", ""),
]


def test_rejected_values(spark):
    rows = decode(spark, *[array(**{name: value}) for name, value in BAD])
    for row, (name, value) in zip(rows, BAD, strict=True):
        assert row.reject_reason == f"bad_{name}", (name, value, row.reject_reason)


def test_shapes(spark):
    rows = decode(spark, FULL[:16], FULL + ["more"], [], "null", "5", '"text"', '{"a": 1}', FULL)
    assert [r.reject_reason for r in rows] == [
        "short_row", None, "short_row", *["not_an_array"] * 4, None,
    ]
    assert [r.pos for r in rows] == list(range(8))


def test_bare_nan_is_a_number(spark):
    text = json.dumps(array(latitude=float("nan"), altitude=float("-inf")))
    assert "NaN" in text and "-Infinity" in text
    row, other = decode(spark, text, FULL)
    assert row.reject_reason is None and row.latitude != row.latitude
    assert row.altitude == float("-inf") and other.reject_reason is None


@pytest.fixture(scope="module")
def bodies(spark):
    rows = [
        ("a", json.dumps({"time": 1, "states": [FULL, FULL[:3], array(origin_country="Brazil")]})),
        ("b", json.dumps({"time": 2, "states": None})),
        ("c", json.dumps({"time": 3})),
        ("d", json.dumps({"time": 4, "states": []})),
        ("e", "not json"),
        ("f", "[1, 2]"),
        ("g", ""),
        ("h", json.dumps({"time": "x", "states": [array(latitude=None), array(position_source=7)]})),
    ]
    return spark.createDataFrame(rows, "snapshot_id STRING, body STRING")


def test_split_loses_nothing(spark, bodies):
    decoded = decode_state_vector(explode_states(bodies))
    good, bad = split_malformed(decoded)
    assert (good.count(), bad.count(), decoded.count()) == (3, 2, 5)
    reasons = {(r.snapshot_id, r.pos): (r.reject_reason, r.raw) for r in quarantined(decoded).collect()}
    assert reasons[("a", 1)] == ("short_row", json.dumps(FULL[:3], separators=(",", ":")))
    assert reasons[("h", 1)][0] == "bad_position_source"


def test_every_body_is_accounted_for(spark, bodies):
    more = spark.createDataFrame([
        ("i", None), ("j", '{"time": 1, "states": [[1]'), ("k", '{"states": 7}'), ("l", '"text"'),
        ("m", '{"time": 1, "time": 2, "states": [' + json.dumps(FULL) + ', null, "x", {"a": 1}]}'),
        ("n", '{"states": [' + json.dumps(FULL)[:-1] + ", NaN]]}"),
    ], "snapshot_id STRING, body STRING")
    every = bodies.unionByName(more)
    reasons = {r.snapshot_id: r.reject_reason for r in quarantined_bodies(every).collect()}
    unreadable = dict.fromkeys("egij", "body_unreadable")
    assert reasons == {**unreadable, "f": "body_not_an_object", "l": "body_not_an_object", "k": "states_not_a_list"}
    good, bad = decode_snapshots(every)
    counts = Counter(r.snapshot_id for r in good.collect())
    assert counts["m"] == 1 and counts["n"] == 1
    assert sorted(r.reject_reason for r in bad.where("snapshot_id = 'm'").collect()) == ["not_an_array"] * 3


def test_a_body_of_any_size(spark):
    element = json.dumps(FULL)
    n = 134_217_728 // len(element) + 2000
    elements = F.array_join(F.transform(F.sequence(F.lit(1), F.col("n")), lambda _: F.lit(element)), ",")
    body = F.concat(F.lit('{"time": 1, "states": ['), elements, F.lit("]}"))
    big = spark.createDataFrame([("big", n)], "snapshot_id STRING, n INT").select("snapshot_id", body.alias("body"))
    good, bad = decode_snapshots(big)
    assert big.select(F.octet_length("body")).first()[0] > 128 * 1024 * 1024
    assert good.agg(F.count("icao24")).first()[0] == n and bad.isEmpty()


def test_texts_are_utc_in_any_session(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
        times = spark.createDataFrame([(0,), (1_700_000_000_123_450,), (-1,), (None,)], "m BIGINT").select(F.timestamp_micros("m").alias("t"))
        got = [r[0] for r in times.select(event_time_text(F.col("t"))).collect()]
        assert got == ["1970-01-01T00:00:00+00:00", "2023-11-14T22:13:20.123450+00:00", "1969-12-31T23:59:59.999999+00:00", None]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_summary_keeps_empty_snapshots(bodies):
    at = F.lit("2024-02-01 00:00:00").cast("timestamp")
    totals = {r.snapshot_id: r.total_states for r in snapshot_summary(bodies, processed_at=at).collect()}
    assert totals == {"a": 2, "b": 0, "c": 0, "d": 0, "e": 0, "f": 0, "g": 0, "h": 1}
    brazil = {r.snapshot_id: r.total_states for r in snapshot_summary(bodies, "Brazil", at).collect()}
    assert brazil["a"] == 1 and brazil["h"] == 0
    documents = {r.snapshot_id: r for r in snapshot_document(bodies, "Brazil", at).collect()}
    assert documents["a"].total_states == 1 and documents["a"].states[0].origin_country == "Brazil"
    assert documents["b"].states == [] and documents["a"].timestamp == "2024-02-01T00:00:00"


def test_landed_files_end_to_end(spark, tmp_path):
    (tmp_path / "one.json").write_text(json.dumps({"time": 1, "states": [FULL, array(latitude=None)]}, indent=1))
    (tmp_path / "two.json").write_text("garbage")
    snapshots = read_snapshots(spark, str(tmp_path))
    result = ingest(snapshots, chunk_size=1)
    assert result.states.count() == 2
    (lost,) = result.quarantine.collect()
    assert (lost.pos, lost.reject_reason, lost.raw) == (None, "body_unreadable", "garbage")
    assert {r.total_states for r in result.summary.collect()} == {0, 2}
    assert [r.batch_no for r in result.ledger.orderBy("batch_no").collect()] == [0, 1]
    outcome = {r.batches: r.ok for r in result.outcome.collect()}
    assert outcome == {2: True, 0: False}
    assert ingest(snapshots, "Brazil").records.count() == 0
    (row,) = enrich(snapshots, F.lit("2024-02-01 00:00:00.5").cast("timestamp")).collect()
    assert row.event_time == "2024-02-01T00:00:00.500000+00:00" and row.location == "47.25,8.5"
    assert row.last_contact == "2023-11-14T22:13:21"
