"""The streaming jobs and their settings.

Every job takes a streaming DataFrame, applies batch operators and starts one query.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery, StreamingQueryListener

from aerolake.functions.units import duration_seconds
from aerolake.operators.alarms import metric_rollup
from aerolake.operators.enrich import enrich_outcome
from aerolake.operators.publish import CHUNK_SIZE, published_records
from aerolake.operators.tracks import KEY
from aerolake.sources.snapshots import MAX_AGE
from aerolake.streaming import sinks

# Storage layers of the lake.
LAYERS = ["workspace", "landing", "raw", "trusted", "business"]

# Batching window of the record consumer, flush interval of the raw sink and
# cadence of the feed, in seconds.
BATCH_SECONDS = 5
RAW_FLUSH_SECONDS = 300
FEED_SECONDS = 60


@dataclass(frozen=True)
class LakePaths:
    """Folders below the lake's root; ``suffix`` tells accounts apart."""

    root: str
    suffix: str = ""

    def layer(self, name: str) -> str:
        if name not in LAYERS:
            raise ValueError(f"unknown layer {name}")
        return f"{self.root.rstrip('/')}/{name}{'-' + self.suffix if self.suffix else ''}"

    @property
    def enriched(self) -> str:
        return self.layer("landing") + "/enriched-flights"

    @property
    def errors(self) -> str:
        return self.layer("landing") + "/enriched-flights-errors"

    @property
    def ingest(self) -> str:
        return self.layer("landing") + "/ingest"

    @property
    def raw(self) -> str:
        return self.layer("landing") + "/raw"


@dataclass(frozen=True)
class StreamSettings:
    """``checkpoint`` must lie in storage that all executors share.

    With ``available_now`` the job takes what is there and ends. Otherwise it starts a
    batch every ``trigger_seconds``, or as often as the job does by default.
    """

    checkpoint: str
    trigger_seconds: int | None = None
    available_now: bool = False

    def start(self, writer: DataStreamWriter, every: int = BATCH_SECONDS) -> StreamingQuery:
        writer = writer.option("checkpointLocation", self.checkpoint)
        if self.available_now:
            return writer.trigger(availableNow=True).start()
        return writer.trigger(processingTime=f"{self.trigger_seconds or every} seconds").start()


def read_records_stream(
    spark: SparkSession, path: str, schema: str, sink_format: str = "json",
    max_files: int | None = None, latest_first: bool = False,
) -> DataFrame:
    """Files of records; ``latest_first`` serves new files before the backlog."""
    reader = spark.readStream.schema(schema).format(sink_format).option("latestFirst", latest_first)
    reader = reader.option("maxFileAge", MAX_AGE)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def run_enrichment_stream(
    envelopes: DataFrame,
    paths: LakePaths,
    settings: StreamSettings,
    transform: Callable[[DataFrame], DataFrame] = enrich_outcome,
) -> StreamingQuery:
    """Envelopes (recordId, data) to the enriched folder and the error folder.

    ``transform`` maps them to (recordId, data, result, value); pass one built on
    ``mapInPandas`` to run user code per record. The job keeps no state and shuffles
    nothing. The ingest time is fixed per batch before the sinks see it.
    """
    outcome = transform(envelopes).withColumn("ingested_at", F.current_timestamp())

    def write(batch: DataFrame, batch_id: int) -> None:
        sinks.write_outcome(batch, batch_id, paths.enriched, paths.errors)

    return settings.start(outcome.writeStream.foreachBatch(write))


def run_publish_stream(
    states: DataFrame, settings: StreamSettings, path: str | None = None,
    sink_format: str = "parquet", options: dict[str, str] | None = None,
) -> StreamingQuery:
    """State vectors to (key, value) records."""

    def write(batch: DataFrame, batch_id: int) -> None:
        sinks.publish_states(batch, batch_id, path, sink_format, options)

    return settings.start(published_records(states).writeStream.foreachBatch(write))


def run_latest_stream(states: DataFrame, path: str, settings: StreamSettings) -> StreamingQuery:
    """State vectors into the keyed table."""

    def write(batch: DataFrame, batch_id: int) -> None:
        sinks.upsert_latest(batch, batch_id, path)

    return settings.start(states.writeStream.foreachBatch(write))


def run_raw_stream(records: DataFrame, path: str, settings: StreamSettings) -> StreamingQuery:
    """The ``value`` text of every record, untouched and uncompressed."""
    writer = (
        records.select("value")
        .writeStream.format("text")
        .option("path", path)
        .option("compression", "none")
        .option("maxRecordsPerFile", sinks.RAW_RECORDS_PER_FILE)
    )
    return settings.start(writer, RAW_FLUSH_SECONDS)


def run_ingest_stream(
    snapshots: DataFrame, paths: LakePaths, settings: StreamSettings, country: str | None = None,
    chunk_size: int = CHUNK_SIZE,
) -> StreamingQuery:
    """Landed bodies to records, quarantine and delivery ledger.

    A batch is decoded once and kept while its three sinks are written. Every element is in
    the records, in the quarantine or of another country; unreadable bodies are in the quarantine.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        sinks.write_ingest(batch, batch_id, paths.ingest, country, chunk_size)

    return settings.start(snapshots.writeStream.foreachBatch(write), FEED_SECONDS)


def run_rollup_stream(
    metrics: DataFrame, period_seconds: int, statistic: str, path: str,
    settings: StreamSettings, watermark: str = "1 hour",
) -> StreamingQuery:
    """Closed periods to a table, once each; alarms are judged over that table.

    A period closes when the watermark passes its end. Rows later than that are dropped
    by the engine, which reports them as ``numRowsDroppedByWatermark``.
    """
    rolled = metric_rollup(metrics.withWatermark("ts", watermark), period_seconds, statistic)
    return settings.start(rolled.writeStream.format("parquet").option("path", path).outputMode("append"))


def track_sessions(points: DataFrame, gap_seconds: int, watermark: str = "1 hour") -> DataFrame:
    """Gap-cut tracks of a stream; a track ends once the watermark passes its gap.

    The extra microsecond keeps points exactly one gap apart together, as in batch.
    """
    gap = f"{gap_seconds} seconds 1 microsecond"
    return (
        points.withWatermark("timestamp", watermark)
        .groupBy(*KEY, F.session_window("timestamp", gap).alias("_session"))
        .agg(
            F.min("timestamp").alias("start_time"),
            F.max("timestamp").alias("end_time"),
            F.count("*").alias("points"),
        )
        .drop("_session")
        .withColumn("duration_seconds", duration_seconds(F.col("start_time"), F.col("end_time")))
    )


def run_sessions_stream(
    points: DataFrame, gap_seconds: int, path: str, settings: StreamSettings, watermark: str = "1 hour"
) -> StreamingQuery:
    sessions = track_sessions(points, gap_seconds, watermark)
    return settings.start(
        sessions.writeStream.format("parquet").option("path", path).outputMode("append")
    )


class LateRows(StreamingQueryListener):
    """Counts the rows that the engine drops behind the watermark, for each query by its id.

    Add it to ``spark.streams`` before the query starts; progress reports reach it a little later
    than the batch ends.
    """

    def __init__(self) -> None:
        self.dropped: dict[str, int] = {}

    def onQueryStarted(self, event) -> None:  # noqa: N802
        self.dropped.setdefault(str(event.id), 0)

    def onQueryProgress(self, event) -> None:  # noqa: N802
        late = sum(operator.numRowsDroppedByWatermark for operator in event.progress.stateOperators)
        self.dropped[str(event.progress.id)] = self.dropped.get(str(event.progress.id), 0) + late

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        pass
