"""Text forms: floats, times, JSON records, envelopes."""

import base64
import json
import random

import pytest
from pyspark.sql import functions as F

from aerolake.functions import codes, text, units
from aerolake.operators.enrich import enrich_outcome, transform_outcome
from aerolake.operators.summary import transform_summary
from aerolake.schemas import ENRICHED_FIELDS, STATE_FIELDS, STATE_SCHEMA

AT = "2024-02-01 00:00:00"


def test_float_text(spark):
    random.seed(7)
    values = [
        0.0, -0.0, 0.5, 0.0005, -0.00012345, 0.0001, 0.00005, 1.5e-5, -2e-7, 1e-10, 1e7, 12345678.25, 1e15,
        -9999999.5, 1e16, 1.5e22, 1e100, float("nan"), float("inf"), float("-inf"), 0.001, 123.0, 9007199254740993.0,
    ]
    values += [random.uniform(-180, 180) for _ in range(3000)]
    values += [random.choice([-1, 1]) * random.uniform(1, 10) * 10 ** random.randint(-9, 14) for _ in range(3000)]
    rows = spark.createDataFrame([(v,) for v in values], "x DOUBLE")
    for row in rows.select("x", text.float_text(F.col("x")).alias("t")).collect():
        assert row.t == repr(row.x)


def test_times(spark):
    rows = spark.createDataFrame(
        [("2024-02-01 10:20:30",), ("2024-02-01 10:20:30.000001",), (None,)], "t STRING"
    ).select(F.col("t").cast("timestamp").alias("t"))
    got = rows.select(text.ts_to_iso(F.col("t")), text.event_time_text(F.col("t"))).collect()
    assert [tuple(r) for r in got] == [
        ("2024-02-01T10:20:30", "2024-02-01T10:20:30+00:00"),
        ("2024-02-01T10:20:30.000001", "2024-02-01T10:20:30.000001+00:00"),
        (None, None),
    ]


def test_state_json_writes_nulls(spark):
    rows = spark.createDataFrame([tuple([None] * len(STATE_FIELDS))], STATE_SCHEMA)
    (row,) = rows.select(text.state_to_json().alias("j"), text.publish_key(F.col("icao24")).alias("k")).collect()
    assert json.loads(row.j) == dict.fromkeys(STATE_FIELDS) and list(json.loads(row.j)) == STATE_FIELDS
    assert row.k == "unknown"


def test_units_and_codes(spark):
    row = spark.range(1).select(
        units.altitude_ft(F.lit(100.0)), units.velocity_kts(F.lit(None).cast("double")),
        units.vertical_rate_ftpm(F.lit(-2.0)),
        units.duration_seconds(F.lit("2024-01-01 00:00:00").cast("timestamp"), F.lit("2024-01-01 01:30:00.25").cast("timestamp")),
        units.duration_hours(F.lit("2024-01-01").cast("timestamp"), F.lit("2024-01-02").cast("timestamp")),
        codes.position_source_name(F.lit(3)), codes.position_source_code(F.lit("MLAT")),
        codes.position_source_name(F.lit(9)), codes.aircraft_category_name(F.lit(14)),
        codes.aircraft_category_name(F.lit(None).cast("int")),
    ).first()
    assert tuple(row) == (100.0 * 3.28084, None, -2.0 * 196.85, 5400.25, 24.0, "FLARM", 2, None, "UAV", None)


def encoded(value) -> str:
    raw = value if isinstance(value, bytes) else value.encode() if isinstance(value, str) else json.dumps(value).encode()
    return base64.b64encode(raw).decode()


RECORD = {
    "icao24": "abc", "callsign": "é", "origin_country": None, "latitude": 10.0, "longitude": -0.00005,
    "altitude": 1000.5, "velocity": None, "heading": 7, "last_contact": "2024-01-01T00:00:00", "squawk": "1",
}
LONG = encoded({**RECORD, "callsign": "x" * 300})

ENVELOPES = [
    ("ok", encoded(RECORD), "Ok"),
    ("zero", encoded({"latitude": 0.0, "longitude": 0}), "Ok"),
    ("no_lat", encoded({**RECORD, "latitude": None}), "Dropped"),
    ("no_lon", encoded({**RECORD, "longitude": None}), "Dropped"),
    ("absent", encoded({}), "Dropped"),
    ("bad64", "%%%", "ProcessingFailed"),
    ("padding", encoded('{"latitude":1,"longitude":2}').rstrip("="), "ProcessingFailed"),
    ("not_json", encoded("hello"), "ProcessingFailed"),
    ("list", encoded([1]), "ProcessingFailed"),
    ("number", encoded(5), "ProcessingFailed"),
    ("trailing", encoded('{"latitude": 1, "longitude": 2} x'), "ProcessingFailed"),
    ("bad_utf8", encoded(b'{"latitude": 1, "longitude": 2, "icao24": "\xff"}'), "ProcessingFailed"),
    ("null", None, "ProcessingFailed"),
    ("empty", "", "ProcessingFailed"),
    ("noise", "\n ".join(LONG[i:i + 60] for i in range(0, len(LONG), 60)), "Ok"),
    ("nan", encoded('{"latitude": NaN, "longitude": 2.0}'), "Ok"),
    ("text", encoded({"latitude": "12.5", "longitude": 2.0}), "Ok"),
]


@pytest.fixture(scope="module")
def outcome(spark):
    rows = spark.createDataFrame([(i, d) for i, d, _ in ENVELOPES], "recordId STRING, data STRING")
    return transform_outcome(rows, F.lit(AT).cast("timestamp"))


def test_envelopes(outcome):
    got = {r.recordId: r for r in outcome.collect()}
    assert {k: v.result for k, v in got.items()} == {i: result for i, _, result in ENVELOPES}
    assert all((r.data is None) == (r.result != "Ok") for r in got.values())
    value = json.loads(base64.b64decode(got["ok"].data, validate=True))
    assert list(value) == ENRICHED_FIELDS
    assert value == {
        **{k: RECORD[k] for k in RECORD if k != "squawk"},
        "event_time": "2024-02-01T00:00:00+00:00", "location": "10.0,-5e-05",
    }
    assert len(json.loads(base64.b64decode(got["noise"].data, validate=True))["callsign"]) == 300
    assert json.loads(base64.b64decode(got["zero"].data))["velocity"] is None
    assert json.loads(base64.b64decode(got["nan"].data))["location"] == "nan,2.0"
    assert json.loads(base64.b64decode(got["text"].data))["location"] == "12.5,2.0"
    assert json.loads(base64.b64decode(got["zero"].data))["location"] == "0.0,0"


def test_outcome_counts(outcome):
    counts = {r.result: r.records for r in transform_summary(outcome).collect()}
    assert counts == {"Ok": 5, "Dropped": 3, "ProcessingFailed": 9}


def test_empty_batch(spark):
    assert enrich_outcome(spark.createDataFrame([], "recordId STRING, data STRING")).count() == 0
