"""The registered queries: name to function of (spark, sf_dir).

Times leave as ISO text or epoch seconds. Each function reads its tables whole.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolake.functions import codes, text, units
from aerolake.operators import alarms, countries, flights, latest, publish, summary, tracks
from aerolake.operators.decode import decode_state_vector, good_states, quarantined, sequenced_states
from aerolake.operators.enrich import (
    drop_missing_position, enrich_projection, filter_country, transform_outcome,
)
from aerolake.plans import feed, pipelines
from aerolake.schemas import STATE_FIELDS, STATE_JSON_SCHEMA
from aerolake.session import use_utc, work_dir
from aerolake.sources.countries import read_countries
from aerolake.sources.envelopes import decoded_text
from aerolake.sources.snapshots import explode_states
from aerolake.streaming import alarming, delivery, jobs, replay, sinks, tracking, upkeep

PROCESSED_AT = "2024-02-01 00:00:00"
CHUNK = 10
GAP_SECONDS = 6 * 3600
SLICE_SECONDS = 4 * 3600
PART_POINTS = 5

# A batch of the streams is one file, and Spark reads a file by no more tasks than it has row groups.
ROW_GROUP_BYTES = 4 * 1024 * 1024
START, MIDDLE, END = 1_704_067_200, 1_705_406_400, 1_706_745_599
HOURS = 48

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def _query(build: Callable[[SparkSession, str], DataFrame]):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(use_utc(spark), sf_dir)

    _QUERIES[build.__name__] = run
    return build


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def _processed_at() -> Column:
    return F.lit(PROCESSED_AT).cast("timestamp")


def _event_id() -> Column:
    return F.col("snapshot_id").cast("bigint").alias("event_id")


def _snapshot_no() -> Column:
    return F.col("snapshot_id").cast("bigint").alias("snapshot_id")


def _seconds(ts: str, name: str) -> Column:
    return F.unix_seconds(ts).alias(name)


def _states(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feed.states(feed.events(spark, sf_dir))


def _grouped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feed.grouped_bodies(feed.events(spark, sf_dir))


@_query
def enrich_states(spark, sf_dir):
    positioned = drop_missing_position(_states(spark, sf_dir))
    return enrich_projection(positioned, _processed_at())


@_query
def decode_states(spark, sf_dir):
    good = good_states(decode_state_vector(explode_states(_grouped(spark, sf_dir))))
    iso = {name: text.ts_to_iso(F.col(name)) for name in ("time_position", "last_contact")}
    sensors = F.to_json("sensors")
    return good.withColumns({**iso, "sensors": sensors, "snapshot_id": _snapshot_no()})


@_query
def malformed_counts(spark, sf_dir):
    decoded = feed.decoded(feed.events(spark, sf_dir))
    reason = F.coalesce("reject_reason", F.lit("good")).alias("reason")
    return decoded.groupBy(reason).agg(F.count("*").alias("rows"))


@_query
def quarantine_rows(spark, sf_dir):
    bad = quarantined(feed.decoded(feed.events(spark, sf_dir)))
    return bad.select(
        _event_id(), "reject_reason", F.get(F.from_json("raw", "array<string>"), 0).alias("icao24"),
        F.json_array_length("raw").alias("slots"),
    )


@_query
def quarantine_bodies(spark, sf_dir):
    """Whole bodies: truncated ones, texts and lists are rejected, repeated names are not."""
    bodies = feed.damaged_bodies(feed.events(spark, sf_dir))
    good, bad = pipelines.decode_snapshots(bodies)
    rows = good.select("snapshot_id", F.lit("good").alias("outcome")).unionByName(
        bad.select("snapshot_id", F.when(F.col("pos").isNull(), F.col("reject_reason")).otherwise("row").alias("outcome"))
    )
    return rows.select(_event_id(), "outcome")


@_query
def country_file(spark, sf_dir):
    """The country list, written as CSV and read back."""
    path = work_dir(spark, "countries")
    listed = feed.countries(spark, sf_dir)
    rows = listed.select(
        F.regexp_extract("name", r"(\d+)", 1).cast("int").alias("id"), "code", "name", "continent",
        F.lit(None).cast("string").alias("wikipedia_link"), F.concat_ws(", ", "name", "continent").alias("keywords"),
    )
    rows.write.option("header", True).csv(path)
    return read_countries(spark, path)


def _lengths():
    """User code: the size of each record's data."""

    def lengths(frames):
        # Not ``.str.len()``: a column and its ``str`` hold each other, so columns would pile up until a full collection.
        for frame in frames:
            yield frame[["recordId"]].assign(size=frame["data"].map(len).astype("int64"))

    return lengths


@_query
def user_transform(spark, sf_dir):
    """User code for each record of a batch of envelopes."""
    sizes = feed.envelopes(_states(spark, sf_dir)).mapInPandas(_lengths(), "recordId STRING, size BIGINT")
    return sizes.select(F.col("recordId").cast("bigint").alias("event_id"), (F.col("size") % 4 == 0).alias("whole"), (F.col("size") > 3).alias("filled"))


@_query
def transform_outcomes(spark, sf_dir):
    outcomes = transform_outcome(feed.envelopes(_states(spark, sf_dir)), _processed_at())
    return summary.transform_summary(outcomes, total=True)


@_query
def transform_records(spark, sf_dir):
    outcomes = transform_outcome(feed.envelopes(_states(spark, sf_dir)), _processed_at())
    value = F.from_json(
        decoded_text(F.col("data")),
        "icao24 STRING, callsign STRING, origin_country STRING, latitude DOUBLE, longitude DOUBLE, altitude DOUBLE,"
        " velocity DOUBLE, heading DOUBLE, last_contact STRING, event_time STRING, location STRING",
    )
    return outcomes.withColumn("value", value).select(
        F.col("recordId").cast("bigint").alias("event_id"), "result", "value.*"
    )


@_query
def filter_country_states(spark, sf_dir):
    return filter_country(_states(spark, sf_dir), "NATION_3").select(
        _event_id(), "icao24", "callsign", "origin_country"
    )


@_query
def unit_conversions(spark, sf_dir):
    return _states(spark, sf_dir).select(
        _event_id(),
        units.altitude_ft(F.col("altitude")).alias("altitude_ft"),
        units.velocity_kts(F.col("velocity")).alias("velocity_kts"),
        units.vertical_rate_ftpm(F.col("vertical_rate")).alias("vertical_rate_ftpm"),
    )


@_query
def position_source_names(spark, sf_dir):
    named = _states(spark, sf_dir).withColumn("name", codes.position_source_name(F.col("position_source")))
    return named.groupBy("position_source", "name").agg(F.count("*").alias("states"))


@_query
def category_names(spark, sf_dir):
    category = (F.col("event_id") % 21).cast("int")
    rows = feed.events(spark, sf_dir).select(
        category.alias("category"), codes.aircraft_category_name(category).alias("name")
    )
    return rows.groupBy("category", "name").agg(F.count("*").alias("states"))


@_query
def sensor_ids(spark, sf_dir):
    return _states(spark, sf_dir).select(
        _event_id(),
        F.size("sensors").alias("sensors"),
        F.aggregate("sensors", F.lit(0).cast("bigint"), lambda total, s: total + s).alias("id_sum"),
    ).where("sensors > 0")


@_query
def snapshot_summary(spark, sf_dir):
    counted = summary.snapshot_summary(_grouped(spark, sf_dir), processed_at=_processed_at())
    return counted.withColumn("snapshot_id", _snapshot_no())


@_query
def snapshot_summary_country(spark, sf_dir):
    counted = summary.snapshot_summary(_grouped(spark, sf_dir), "NATION_3", _processed_at())
    return counted.withColumn("snapshot_id", _snapshot_no())


@_query
def snapshot_documents(spark, sf_dir):
    documents = summary.snapshot_document(_grouped(spark, sf_dir), processed_at=_processed_at())
    each = documents.select("snapshot_id", "timestamp", "total_states", F.posexplode_outer("states").alias("n", "state"))
    return each.select(
        _snapshot_no(), "timestamp", "total_states", "n", "state.icao24", "state.squawk",
        "state.longitude", _seconds("state.last_contact", "last_contact"),
    )


def _ledger(snapshots: DataFrame, chunk: int = CHUNK) -> DataFrame:
    return publish.delivery_ledger(sequenced_states(snapshots), chunk, F.unix_seconds("last_contact") % 31 == 0)


@_query
def delivery_ledger(spark, sf_dir):
    return _ledger(_grouped(spark, sf_dir)).withColumn("snapshot_id", _snapshot_no())


@_query
def delivery_outcome(spark, sf_dir):
    snapshots = _grouped(spark, sf_dir)
    outcome = publish.delivery_outcome(snapshots, _ledger(snapshots))
    return outcome.withColumn("snapshot_id", _snapshot_no())


@_query
def delivered_chunks(spark, sf_dir):
    records = publish.published_records(sequenced_states(_grouped(spark, sf_dir)), keep=("snapshot_id", "seq"))

    def refuse_unknown(chunk):
        return sum(key == "unknown" for key, _ in chunk)

    return publish.deliver(records, refuse_unknown, CHUNK).withColumn("snapshot_id", _snapshot_no())


@_query
def publish_key_counts(spark, sf_dir):
    return publish.publish_key_counts(_states(spark, sf_dir))


@_query
def key_partitions(spark, sf_dir):
    keyed = publish.partition_by_key(_states(spark, sf_dir), 16).select(
        text.publish_key(F.col("icao24")).alias("key"), F.spark_partition_id().alias("part")
    )
    spread = keyed.groupBy("key", "part").agg(F.count("*").alias("rows"))
    return spread.groupBy("key").agg(
        F.sum("rows").alias("records"),
        (F.count("*") == 1).alias("together"),
    )


@_query
def state_json(spark, sf_dir):
    good = _states(spark, sf_dir)
    parsed = good.select(
        _event_id(), F.from_json(text.state_to_json(), STATE_JSON_SCHEMA).alias("s")
    ).select("event_id", "s.*")
    return parsed.select("event_id", *[F.to_json(c).alias(c) if c == "sensors" else c for c in STATE_FIELDS])


@_query
def latest_state(spark, sf_dir):
    newest = latest.latest_state(_stored(_states(spark, sf_dir), "states"))
    return newest.select(
        "key", _event_id(), "callsign", _seconds("last_contact", "last_contact"),
        "longitude", "latitude", "squawk",
    )


@_query
def country_enrichment(spark, sf_dir):
    joined = countries.enrich_country(_states(spark, sf_dir), feed.countries(spark, sf_dir))
    return joined.select(_event_id(), "origin_country", "country_code", "continent")


@_query
def country_unmatched(spark, sf_dir):
    return countries.unmatched_countries(_states(spark, sf_dir), feed.countries(spark, sf_dir))


def _points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tracks.track_points(_states(spark, sf_dir))


@_query
def flight_tracks(spark, sf_dir):
    return tracks.track_summary(_points(spark, sf_dir)).withColumns({
        "start_time": text.ts_to_iso(F.col("start_time")), "end_time": text.ts_to_iso(F.col("end_time")),
    })


@_query
def flight_track_segments(spark, sf_dir):
    return tracks.track_segments(_points(spark, sf_dir), GAP_SECONDS).withColumns({
        "start_time": text.ts_to_iso(F.col("start_time")), "end_time": text.ts_to_iso(F.col("end_time")),
    }).drop("duration_hours")


@_query
def track_paths(spark, sf_dir):
    assembled = tracks.assemble_tracks(_points(spark, sf_dir), GAP_SECONDS)
    first, last = F.element_at("path", 1), F.element_at("path", -1)
    in_order = F.forall(
        F.sequence(F.lit(1), F.greatest(F.size("path") - 1, F.lit(1))),
        lambda i: F.get("path", i - 1)["timestamp"] <= F.coalesce(F.get("path", i)["timestamp"], F.col("end_time")),
    )
    return assembled.select(
        "icao24", "callsign", "segment", "part", "points",
        F.size("path").alias("path_length"),
        F.unix_seconds(first["timestamp"]).alias("first_seen"),
        F.unix_seconds(last["timestamp"]).alias("last_seen"),
        first["latitude"].alias("first_latitude"),
        last["longitude"].alias("last_longitude"),
        in_order.alias("in_order"),
    )


@_query
def track_geojson(spark, sf_dir):
    """All coordinates of tracks in parts of a few points."""
    features = tracks.track_geojson(tracks.assemble_tracks(_points(spark, sf_dir), GAP_SECONDS, PART_POINTS))
    parsed = F.from_json(
        "geojson",
        "type STRING, properties STRUCT<icao24 STRING, callsign STRING, start_time STRING, end_time STRING,"
        " duration_seconds DOUBLE>, geometry STRUCT<type STRING, coordinates ARRAY<ARRAY<DOUBLE>>>",
    )
    each = features.select(parsed.alias("f"), "segment", "part", "parts").select(
        "segment", "part", "parts", "f.properties.*",
        F.col("f.type").alias("feature"),
        F.col("f.geometry.type").alias("geometry"),
        F.posexplode("f.geometry.coordinates").alias("n", "coordinate"),
    )
    axes = {name: F.get("coordinate", F.lit(i)) for i, name in enumerate(("longitude", "latitude", "altitude"))}
    return each.withColumns(axes).drop("coordinate")


def _flight_view(found: DataFrame) -> DataFrame:
    return flights.with_duration(found).withColumns(
        {name: F.unix_seconds(name) for name in ("first_seen", "last_seen")}
    )


@_query
def arrivals(spark, sf_dir):
    return _flight_view(flights.arrivals(feed.flights(spark, sf_dir)))


@_query
def departures(spark, sf_dir):
    return _flight_view(flights.departures(feed.flights(spark, sf_dir)))


def _incoming(rows: DataFrame) -> DataFrame:
    return alarms.incoming_metric(rows, F.col("ts").cast("timestamp"), "events")


def _rollup_view(rows: DataFrame) -> DataFrame:
    return rows.withColumn("period_start", _seconds("period_start", "period_start"))


@_query
def incoming_rollup(spark, sf_dir):
    return _rollup_view(alarms.metric_rollup(_incoming(feed.events(spark, sf_dir)), 600, "Sum"))


def _idle(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = alarms.ALARMS["stream-idle"]
    rows = _incoming(feed.events(spark, sf_dir))
    rollup = alarms.metric_rollup(rows, spec.period_seconds, spec.statistic)
    return alarms.firing(alarms.evaluate_alarm(rollup, spec))


@_query
def idle_alarm(spark, sf_dir):
    return _rollup_view(_idle(spark, sf_dir))


LAG_SPEC = alarms.AlarmSpec("value-lag", alarms.LAG, "Max", 300, 2, 2, ">", 60.0)
BURST_SPEC = alarms.AlarmSpec("error-burst", alarms.ERRORS, "Sum", 3600, 3, 5, ">", 1.0)


@_query
def lag_alarm(spark, sf_dir):
    rows = feed.events(spark, sf_dir).select(
        F.lit(alarms.LAG).alias("metric"), F.col("event_type").alias("source"),
        F.col("ts").cast("timestamp").alias("ts"), "value",
    )
    rollup = alarms.metric_rollup(rows, LAG_SPEC.period_seconds, LAG_SPEC.statistic)
    return _rollup_view(alarms.firing(alarms.evaluate_alarm(rollup, LAG_SPEC)))


@_query
def error_burst_alarm(spark, sf_dir):
    errors = feed.events(spark, sf_dir).where(F.col("event_type") == "error")
    rows = alarms.error_metric(errors, F.col("ts").cast("timestamp"), "events")
    rollup = alarms.metric_rollup(rows, BURST_SPEC.period_seconds, BURST_SPEC.statistic)
    return _rollup_view(alarms.evaluate_alarm(rollup, BURST_SPEC))


@_query
def alert_messages(spark, sf_dir):
    return alarms.format_alert(_idle(spark, sf_dir), alarms.ALARMS["stream-idle"]).select("message")


def _stored(rows: DataFrame, name: str) -> DataFrame:
    path = work_dir(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def _metrics(rows: DataFrame) -> DataFrame:
    """Records, lag and errors of the events, from one read; one source of records falls silent in the middle of the month."""

    def of(metric: str, source: Column, value: Column) -> Column:
        return F.struct(F.lit(metric).alias("metric"), source.alias("source"), value.alias("value"))

    one, kind = F.lit(1.0), F.col("event_type")
    given = F.array(
        of(alarms.INCOMING, F.lit("events"), one),
        of(alarms.LAG, kind, F.col("value") * 1000),
        F.when(kind == "error", of(alarms.ERRORS, F.lit("events"), one)),
        F.when(F.unix_seconds(F.col("ts").cast("timestamp")) < MIDDLE, of(alarms.INCOMING, F.lit("first-half"), one)),
    )
    each = rows.select(F.col("ts").cast("timestamp").alias("ts"), F.explode(given).alias("m"))
    return each.where("m IS NOT NULL").select("m.metric", "m.source", "ts", "m.value")


def _refused(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records and requests that the receiver refused, from one read of the ledger."""
    failed = F.col("failed").cast("double")
    each = _ledger(_grouped(spark, sf_dir)).where("failed > 0").select(
        F.timestamp_seconds(F.lit(START) + F.col("snapshot_id").cast("bigint") * 60).alias("ts"),
        F.explode(F.array(
            F.struct(F.lit(alarms.THROTTLED).alias("metric"), (failed * 600).alias("value")),
            F.struct(F.lit(alarms.THROTTLED_REQUESTS).alias("metric"), F.lit(200.0).alias("value")),
        )).alias("m"),
    )
    return each.select("m.metric", F.lit("ledger").alias("source"), "ts", "m.value")


def _never_sends(spark: SparkSession) -> DataFrame:
    return spark.range(1).select(F.lit(alarms.INCOMING).alias("metric"), F.lit("silent").alias("source"))


@_query
def alarm_table(spark, sf_dir):
    """All alarms over a month, and as far beyond as metrics go: records, lag, errors and refused deliveries, and a source that sends nothing."""
    partials = _stored(alarms.metric_partials(_metrics(feed.events(spark, sf_dir)).unionByName(_refused(spark, sf_dir))), "partials")
    watched = partials.select("metric", "source").distinct().unionByName(_never_sends(spark))
    span = partials.agg(
        F.least(F.timestamp_seconds(F.lit(START)), F.min("minute")).alias("first"),
        F.greatest(F.timestamp_seconds(F.lit(END)), F.max("minute")).alias("last"),
    )
    fired = alarms.alarm_table(partials, watched.crossJoin(span), F.col("first"), F.col("last"))
    return _rollup_view(fired.drop("message"))


@_query
def feed_lag(spark, sf_dir):
    lag = alarms.lag_metric(_states(spark, sf_dir), _processed_at(), "states")
    return _rollup_view(alarms.metric_rollup(lag, 300, "Max"))


@_query
def retention(spark, sf_dir):
    good = _states(spark, sf_dir)
    newest = good.select(F.max("last_contact")).scalar()
    return latest.apply_retention(good, newest, HOURS).select(_event_id(), _seconds("last_contact", "last_contact"))


def _stream_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feed.states(feed.events_stream(spark, sf_dir))


def _land(rows: DataFrame, root: str) -> None:
    """Writes files that many tasks can read: each has as many row groups as its size asks."""
    rows.write.mode("append").option("parquet.block.size", ROW_GROUP_BYTES).parquet(f"{root}/landed")


def _landed_files(spark: SparkSession, root: str) -> DataFrame:
    """The landed files as a stream, one a batch; its rows are dealt to all cores, since decoding them takes far longer than reading."""
    files = spark.readStream.schema(feed.EVENTS_SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{root}/landed")
    return files.repartition(2 * spark.sparkContext.defaultParallelism)


def _landed(spark: SparkSession, sf_dir: str, root: str) -> DataFrame:
    """The events as a stream of four files, one a batch."""
    rows = feed.events(spark, sf_dir).repartitionByRange(4, "event_id")
    _land(rows, root)
    return _landed_files(spark, root)


def _settings(root: str) -> jobs.StreamSettings:
    return jobs.StreamSettings(f"{root}/checkpoint", available_now=True)


@_query
def stream_enriched(spark, sf_dir):
    root = work_dir(spark, "enriched")
    paths = jobs.LakePaths(root)
    envelopes = feed.envelopes(_stream_states(spark, sf_dir))
    jobs.run_enrichment_stream(envelopes, paths, _settings(root)).awaitTermination()
    return spark.read.schema(
        "icao24 STRING, callsign STRING, origin_country STRING, latitude DOUBLE, longitude DOUBLE,"
        " altitude DOUBLE, velocity DOUBLE, heading DOUBLE, last_contact STRING, location STRING, event_time STRING"
    ).json(f"{paths.enriched}/ingest_date=*/batch_id=*").withColumn(
        "event_time", F.col("event_time").rlike(r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d(\.\d{6})?\+00:00$")
    )


@_query
def stream_errors(spark, sf_dir):
    root = work_dir(spark, "errors")
    paths = jobs.LakePaths(root)
    envelopes = feed.envelopes(_stream_states(spark, sf_dir))
    jobs.run_enrichment_stream(envelopes, paths, _settings(root)).awaitTermination()
    errors = spark.read.schema("recordId STRING, data STRING, reason STRING").json(f"{paths.errors}/ingest_date=*/batch_id=*")
    return errors.select(F.col("recordId").cast("bigint").alias("event_id"), "data", "reason")


@_query
def stream_ingest(spark, sf_dir):
    """Damaged bodies in several batches; the job runs twice and the second run finds nothing to do."""
    root = work_dir(spark, "ingest")
    paths = jobs.LakePaths(root)
    stream = _landed(spark, sf_dir, root)
    for _ in range(2):
        jobs.run_ingest_stream(feed.damaged_bodies(stream), paths, _settings(root)).awaitTermination()
    records = spark.read.parquet(f"{paths.ingest}/records").select("snapshot_id", F.lit("good").alias("outcome"))
    bad = spark.read.parquet(f"{paths.ingest}/quarantine")
    outcome = F.when(F.col("pos").isNull(), F.col("reject_reason")).otherwise("row").alias("outcome")
    sent = spark.read.parquet(f"{paths.ingest}/ledger").select("snapshot_id", F.explode(F.sequence(F.lit(1), "sent")).alias("n"))
    sent = sent.select("snapshot_id", F.lit("sent").alias("outcome"))
    return records.unionByName(bad.select("snapshot_id", outcome)).unionByName(sent).select(_event_id(), "outcome")


@_query
def stream_published(spark, sf_dir):
    root = work_dir(spark, "published")
    jobs.run_publish_stream(_stream_states(spark, sf_dir), _settings(root), f"{root}/records").awaitTermination()
    records = spark.read.schema("key STRING, value STRING").parquet(f"{root}/records")
    return records.groupBy("key").agg(
        F.count("*").alias("records"),
        F.max(F.get_json_object("value", "$.last_contact")).alias("newest"),
    )


@_query
def stream_latest(spark, sf_dir):
    root = work_dir(spark, "latest")
    states = feed.states(_landed(spark, sf_dir, root))
    jobs.run_latest_stream(states, f"{root}/table", _settings(root)).awaitTermination()
    newest = sinks.read_latest(spark, f"{root}/table")
    return newest.select(
        "key", _event_id(), "callsign", _seconds("last_contact", "last_contact"),
        "longitude", "latitude", "squawk",
    )


@_query
def stream_raw(spark, sf_dir):
    root = work_dir(spark, "raw")
    paths = jobs.LakePaths(root)
    bodies = feed.single_bodies(feed.events_stream(spark, sf_dir)).select(F.col("body").alias("value"))
    jobs.run_raw_stream(bodies, paths.raw, _settings(root)).awaitTermination()
    time = F.get_json_object("value", "$.time").cast("bigint")
    return spark.read.text(paths.raw).groupBy(time.alias("time")).agg(F.count("*").alias("records"))


def _landed_by_time(spark: SparkSession, sf_dir: str, root: str, late: bool = False) -> DataFrame:
    """The events as a stream of four files, one a batch, the week of an event deciding its file; one in 20 a week late, if so asked."""
    rows = feed.events(spark, sf_dir)
    number = F.floor((F.unix_seconds(F.col("ts").cast("timestamp")) - START) / (8 * 86400))
    if late:
        number = number + (F.col("event_id") % 20 == 0).cast("int")
    week = F.least(F.lit(3), F.greatest(F.lit(0), number))
    for number in range(4):
        # All tasks search the events, one writes the file.
        _land(rows.where(week == number).repartition(1), root)
    return _landed_files(spark, root)


@_query
def stream_alarms(spark, sf_dir):
    """Beginnings and ends of alarms, over four batches, with a source that falls silent and one that never sends."""
    root = work_dir(spark, "alarms")
    metrics = _metrics(_landed_by_time(spark, sf_dir, root))
    settings = jobs.StreamSettings(f"{root}/closing", available_now=True)
    alarming.run_partials_stream(metrics, f"{root}/minutes", settings).awaitTermination()
    names = [(alarms.INCOMING, "events"), (alarms.INCOMING, "first-half"), (alarms.INCOMING, "silent"), (alarms.ERRORS, "events")]
    names += [(alarms.LAG, kind) for kind in ("click", "view", "purchase", "error", "signup")]
    watched = spark.createDataFrame(names, "metric STRING, source STRING")
    first = F.timestamp_seconds(F.lit(START))
    alarming.run_alarm_stream(spark, f"{root}/minutes", watched, first, f"{root}/changes", _settings(root)).awaitTermination()
    changes = spark.read.schema(alarming.CHANGES_SCHEMA).parquet(f"{root}/changes")
    return _rollup_view(changes)


@_query
def stream_tracks(spark, sf_dir):
    """Parts of ended tracks, with the points of each, from four batches in which one point in 20 comes a week late."""
    root = work_dir(spark, "tracks")
    points = tracks.track_points(feed.states(_landed_by_time(spark, sf_dir, root, late=True)))
    slicing = jobs.StreamSettings(f"{root}/slicing", available_now=True)
    tracking.run_slices_stream(points, f"{root}/slices", slicing, SLICE_SECONDS, "16 days").awaitTermination()
    tracking.run_tracks_stream(spark, f"{root}/slices", GAP_SECONDS, f"{root}/parts", _settings(root)).awaitTermination()
    ended = tracking.closed_tracks(spark.read.schema(tracking.PARTS_SCHEMA).parquet(f"{root}/parts"))
    first, last = F.element_at("path", 1), F.element_at("path", -1)
    return ended.select(
        "icao24", "callsign", _seconds("start_time", "started"), _seconds("end_time", "ended"), "part", "parts", "points",
        F.size("path").alias("path_length"), first["longitude"].alias("first_longitude"), first["altitude"].alias("first_altitude"),
        F.unix_seconds(last["timestamp"]).alias("last_seen"), last["latitude"].alias("last_latitude"), last["on_ground"].alias("on_ground"),
    )


@_query
def replayed_errors(spark, sf_dir):
    """Damaged records of the error sink, of which some can be read at the first, second or third attempt and some never."""
    root = work_dir(spark, "replayed")
    paths = jobs.LakePaths(root)
    states = _stored(feed.states(feed.events(spark, sf_dir)), "states")
    jobs.run_enrichment_stream(feed.envelopes(_stream_states(spark, sf_dir)), paths, _settings(root)).awaitTermination()
    known = states.select(F.col("snapshot_id").alias("id"), text.encode_envelope(text.state_to_json()).alias("sent"))

    def correct(rows):
        mended = F.col("recordId").cast("bigint") % 4 < F.col("attempt")
        mended = mended & (F.col("recordId").cast("bigint") % 4 < 3)
        return rows.join(known, rows["recordId"] == known["id"]).withColumn("data", F.when(mended, F.col("sent")).otherwise(F.col("data")))

    errors = jobs.read_records_stream(spark, f"{paths.errors}/*/*", "recordId STRING, data STRING")
    settings = jobs.StreamSettings(f"{root}/replaying", available_now=True)
    for _ in range(2):
        replay.run_replay_stream(errors, f"{root}/replays", settings, correct).awaitTermination()
    replay.drain_replays(spark, f"{root}/replays", correct)
    ends = replay.replayed(spark, f"{root}/replays").unionByName(replay.replays_given_up(spark, f"{root}/replays"))
    return ends.select(
        F.col("recordId").cast("bigint").alias("event_id"), "attempt", "result", F.get_json_object("value", "$.icao24").alias("icao24"),
    )


@_query
def stream_delivered(spark, sf_dir):
    """Records sent in four batches to a receiver that refuses some: who was taken at which attempt, and who was given up."""
    root = work_dir(spark, "delivered")
    records = publish.published_records(feed.states(_landed(spark, sf_dir, root)))

    def send(chunk):
        return [not (key.endswith("f") or key.endswith("a") and attempt < 3) for key, _, attempt in chunk]

    delivery.run_delivery_stream(records, f"{root}/sent", _settings(root), send, CHUNK).awaitTermination()
    delivery.drain_records(spark, f"{root}/sent", send, CHUNK)
    tried = spark.read.schema(delivery.ATTEMPT_SCHEMA).parquet(f"{root}/sent/attempts")
    taken = tried.where("accepted").groupBy("key", "attempt").agg(F.count("*").alias("records"), F.lit(True).alias("accepted"))
    lost = delivery.given_up(spark, f"{root}/sent").groupBy("key", "attempt").agg(F.count("*").alias("records"), F.lit(False).alias("accepted"))
    return taken.unionByName(lost)


@_query
def stream_deduplicated(spark, sf_dir):
    """Records published twice, in four batches each, as a receiver keeps them: each aircraft and time once."""
    root = work_dir(spark, "received")
    stream = _landed(spark, sf_dir, root)
    for run in ("first", "again"):
        settings = jobs.StreamSettings(f"{root}/publish-{run}", available_now=True)
        jobs.run_publish_stream(feed.states(stream), settings, f"{root}/published/run={run}").awaitTermination()
    records = jobs.read_records_stream(spark, f"{root}/published/*/*", "key STRING, value STRING", "parquet")
    for _ in range(2):
        delivery.run_receive_stream(records, f"{root}/received", _settings(root), "40 days").awaitTermination()
    kept = spark.read.parquet(f"{root}/received")
    return kept.groupBy("icao24", _seconds("last_contact", "last_contact")).agg(F.count("*").alias("records"))


@_query
def retained_table(spark, sf_dir):
    """A table by days after its upkeep, which is run twice."""
    path = work_dir(spark, "retained")
    states = _stored(_states(spark, sf_dir), "states")
    upkeep.write_by_day(states, path)
    newest = states.agg(F.max("last_contact")).first()[0]
    for _ in range(2):
        upkeep.expire_days(spark, path, newest, HOURS)
    return spark.read.parquet(path).select(_event_id(), _seconds("last_contact", "last_contact"))


@_query
def stream_rollup(spark, sf_dir):
    root = work_dir(spark, "rollup")
    rows = _incoming(feed.events_stream(spark, sf_dir))
    jobs.run_rollup_stream(rows, 600, "Sum", f"{root}/table", _settings(root), "1 hour").awaitTermination()
    closed = spark.read.schema("metric STRING, source STRING, period_start TIMESTAMP, value DOUBLE")
    return _rollup_view(closed.parquet(f"{root}/table"))
