"""Record layouts, as Spark schemas."""

from __future__ import annotations

from pyspark.sql import types as T

# The slots of a positional state array, in slot order.
STATE_SCHEMA = T.StructType([
    T.StructField("icao24", T.StringType()),
    T.StructField("callsign", T.StringType()),
    T.StructField("origin_country", T.StringType()),
    T.StructField("time_position", T.TimestampType()),
    T.StructField("last_contact", T.TimestampType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("altitude", T.DoubleType()),
    T.StructField("on_ground", T.BooleanType()),
    T.StructField("velocity", T.DoubleType()),
    T.StructField("heading", T.DoubleType()),
    T.StructField("vertical_rate", T.DoubleType()),
    T.StructField("sensors", T.ArrayType(T.LongType())),
    T.StructField("geo_altitude", T.DoubleType()),
    T.StructField("squawk", T.StringType()),
    T.StructField("spi", T.BooleanType()),
    T.StructField("position_source", T.IntegerType()),
])
STATE_FIELDS = STATE_SCHEMA.names
STATE_SLOTS = len(STATE_FIELDS)

# The same record as JSON text: times travel as ISO text.
STATE_JSON_SCHEMA = T.StructType([
    T.StructField(f.name, T.StringType() if f.dataType == T.TimestampType() else f.dataType)
    for f in STATE_SCHEMA
])

# The fields of an enriched record, in output order.
ENRICHED_PASS_THROUGH = [
    "icao24", "callsign", "origin_country", "latitude", "longitude",
    "altitude", "velocity", "heading", "last_contact",
]
ENRICHED_FIELDS = [*ENRICHED_PASS_THROUGH, "event_time", "location"]

ENVELOPE_SCHEMA = "recordId STRING, data STRING"

COUNTRY_SCHEMA = (
    "id INT, code STRING, name STRING, continent STRING, wikipedia_link STRING, keywords STRING"
)

FLIGHT_SCHEMA = (
    "icao24 STRING, first_seen TIMESTAMP, last_seen TIMESTAMP, callsign STRING, "
    "departure_airport STRING, arrival_airport STRING"
)

LEDGER_SCHEMA = (
    "snapshot_id STRING, batch_no BIGINT, records BIGINT, sent BIGINT, failed BIGINT, ok BOOLEAN"
)
