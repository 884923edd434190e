"""State-vector feed derived from the events and orders tables.

The tables hold no aircraft. Each event is turned into one positional state array, as
JSON text in the shape the operators read, with all the irregularities they have to
handle. The rules are deterministic, so plain SQL over the same tables can check them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolake.functions.text import encode_envelope, state_to_json
from aerolake.operators.decode import decode_state_vector, good_states
from aerolake.sources.snapshots import explode_states

EVENTS_SCHEMA = (
    "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
)

# States in one grouped snapshot body.
SNAPSHOT_STATES = 50


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS_SCHEMA).parquet(f"{sf_dir}/events.parquet")


def events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table as a file stream. The pattern matches a single file as well as a folder."""
    return spark.readStream.schema(EVENTS_SCHEMA).parquet(f"{sf_dir}/events.parque[t]")


def _id() -> Column:
    return F.col("event_id")


def _unless(condition: Column, value: Column) -> Column:
    return F.when(~condition, value)


def icao24(user_id: Column) -> Column:
    return F.lpad(F.lower(F.hex(user_id)), 6, "0")


def _literal(value: Column) -> Column:
    """JSON text of a number or boolean."""
    return F.coalesce(value.cast("string"), F.lit("null"))


def _quoted(value: Column) -> Column:
    """JSON text of a string without special characters."""
    return F.concat(F.lit('"'), value, F.lit('"'))


def state_array() -> Column:
    """JSON text of the array of one event.

    One event in 997 is no array, one in 83 lacks the last slot, one in 71 has text in a
    numeric slot and one in 6 an unknown position source.
    """
    e, value = _id(), F.col("value")
    seconds = F.unix_timestamp("ts").cast("string")
    k = F.get_json_object("props", "$.k").cast("double")
    aircraft = F.when(e % 89 == 0, "null").when(e % 97 == 0, '""').otherwise(_quoted(icao24(F.col("user_id"))))
    sensors = F.slice(F.array("user_id", e % 7, F.lit(1).cast("bigint")), F.lit(1), (e % 4).cast("int"))
    slots = [
        aircraft,
        _quoted(F.concat("event_type", F.lit("  "))),
        _quoted(F.concat(F.lit("NATION_"), (F.col("user_id") % 30).cast("string"))),
        F.when(e % 53 == 0, "0").otherwise(seconds),
        seconds,
        _literal(_unless(e % 10 == 0, value - 180)),
        _literal(_unless(e % 15 == 0, value * 0.5 - 80)),
        _literal(k * 100),
        _literal(F.col("event_type") == "error"),
        F.when(e % 71 == 0, '"n/a"').otherwise(_literal(value)),
        _literal((e % 360).cast("double")),
        _literal(k - 50),
        F.concat(F.lit("["), F.array_join(sensors.cast("array<string>"), ","), F.lit("]")),
        _literal(k * 100 + 10),
        _quoted(F.lpad((e % 7777).cast("string"), 4, "0")),
        F.lit("false"),
    ]
    last = F.when(e % 83 == 0, "").otherwise(F.concat(F.lit(","), (e % 6).cast("string")))
    array = F.concat(F.lit("["), F.concat_ws(",", *slots), last, F.lit("]"))
    return F.when(e % 997 == 0, '"no array"').otherwise(array)


def _text_id(number: Column) -> Column:
    """Ids as text that sorts like the numbers."""
    return F.lpad(number.cast("string"), 18, "0")


def single_bodies(rows: DataFrame) -> DataFrame:
    """One body per event; needs no shuffle and works on streams."""
    body = F.concat(
        F.lit('{"time":'), F.unix_timestamp("ts").cast("string"), F.lit(',"states":['), state_array(), F.lit("]}")
    )
    return rows.select(_text_id(_id()).alias("snapshot_id"), body.alias("body"))


def grouped_bodies(rows: DataFrame) -> DataFrame:
    """Bodies of 50 consecutive events each, in the order of their ids."""
    grouped = (
        rows.select(
            F.floor(_id() / SNAPSHOT_STATES).alias("n"),
            F.unix_timestamp("ts").alias("seconds"),
            F.struct(_id().alias("event_id"), state_array().alias("state")).alias("entry"),
        )
        .groupBy("n")
        .agg(F.max("seconds").alias("time"), F.array_sort(F.collect_list("entry")).alias("entries"))
    )
    states = F.concat_ws(",", F.transform("entries", lambda x: x["state"]))
    body = F.concat(F.lit('{"time":'), F.col("time").cast("string"), F.lit(',"states":['), states, F.lit("]}"))
    return grouped.select(_text_id(F.col("n")).alias("snapshot_id"), body.alias("body"))


def damaged_bodies(rows: DataFrame) -> DataFrame:
    """Bodies of one event each, of which one in 101 is truncated, one in 103 repeats a name,
    one in 107 is no JSON, one in 109 a list, and one in 113 has a number for its states."""
    e, body = _id(), F.col("body")
    damaged = (
        F.when(e % 101 == 0, F.left(body, F.length(body) - 2))
        .when(e % 103 == 0, F.concat(F.lit('{"time":0,'), F.substring(body, F.lit(2), F.length(body))))
        .when(e % 107 == 0, F.lit("service unavailable"))
        .when(e % 109 == 0, F.lit("[1, 2]"))
        .when(e % 113 == 0, F.lit('{"states": 5}'))
        .otherwise(body)
    )
    bodies = single_bodies(rows).withColumn("event_id", F.col("snapshot_id").cast("bigint"))
    return bodies.select("snapshot_id", damaged.alias("body"))


def decoded(rows: DataFrame) -> DataFrame:
    return decode_state_vector(explode_states(single_bodies(rows)))


def states(rows: DataFrame) -> DataFrame:
    return good_states(decoded(rows))


def envelopes(good: DataFrame) -> DataFrame:
    """State records in envelopes; the data of one in 61 is damaged."""
    damaged = F.col("snapshot_id").cast("bigint") % 61 == 0
    data = F.when(damaged, F.lit("%%%")).otherwise(encode_envelope(state_to_json()))
    return good.select(F.col("snapshot_id").alias("recordId"), data.alias("data"))


def flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    key, customer = F.col("o_orderkey"), F.col("o_custkey")
    first_seen = F.col("o_orderdate").cast("timestamp")
    flown = F.make_dt_interval(hours=(key % 12 + 1).cast("int"))

    def airport(number: Column) -> Column:
        return F.concat(F.lit("NATION_"), (number % 25).cast("string"))

    return orders.select(
        icao24(customer).alias("icao24"),
        first_seen.alias("first_seen"),
        (first_seen + flown).alias("last_seen"),
        F.col("o_orderpriority").alias("callsign"),
        _unless(key % 7 == 0, airport(customer)).alias("departure_airport"),
        _unless(key % 5 == 0, airport(customer + key)).alias("arrival_airport"),
    )


def countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nation and region as a country list."""
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet")
    region = spark.read.parquet(f"{sf_dir}/region.parquet")
    return nation.join(region, nation["n_regionkey"] == region["r_regionkey"]).select(
        F.col("n_nationkey").cast("string").alias("code"),
        F.col("n_name").alias("name"),
        F.col("r_name").alias("continent"),
    )
