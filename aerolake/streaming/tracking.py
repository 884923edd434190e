"""Tracks with their points while the points arrive.

Two jobs: points become one row for each track key and time slice, written once when the watermark closes
the slice; those are cut and joined by keyed state with timers. So the points of a busy key lie in as many groups as
there are slices, and the second job sees a row a slice.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery
from pyspark.sql.types import ArrayType, BooleanType, LongType, StringType, StructField, StructType

from aerolake.functions.units import duration_hours, duration_seconds
from aerolake.operators.tracks import KEY, POINT_FIELDS
from aerolake.streaming.alarming import STATE_STORE

# Seconds of a slice.
SLICE_SECONDS = 600

SLICES_SCHEMA = "icao24 STRING, callsign STRING, closed TIMESTAMP, times ARRAY<BIGINT>, path ARRAY<STRING>"
POINT_SCHEMA = "timestamp BIGINT, latitude DOUBLE, longitude DOUBLE, altitude DOUBLE, heading DOUBLE, on_ground BOOLEAN"

_PARTS = StructType([
    StructField("icao24", StringType()),
    StructField("callsign", StringType()),
    StructField("start", LongType()),
    StructField("end", LongType()),
    StructField("part", LongType()),
    StructField("points", LongType()),
    StructField("closed", BooleanType()),
    StructField("path", ArrayType(StringType())),
])
PARTS_SCHEMA = (
    "icao24 STRING, callsign STRING, start_time TIMESTAMP, end_time TIMESTAMP, part BIGINT, points BIGINT, closed BOOLEAN,"
    " path ARRAY<STRUCT<timestamp: TIMESTAMP, latitude: DOUBLE, longitude: DOUBLE, altitude: DOUBLE, heading: DOUBLE, on_ground: BOOLEAN>>"
)


def track_slices(points: DataFrame, slice_seconds: int = SLICE_SECONDS, watermark: str = "1 hour") -> DataFrame:
    """(icao24, callsign, closed, times, path): the ordered points of a key and slice, each as JSON text with microseconds."""
    fields = [F.unix_micros("timestamp").alias("timestamp"), *POINT_FIELDS[1:]]
    point = F.struct(
        F.unix_micros("timestamp").alias("micros"), "snapshot_id", "pos",
        F.to_json(F.struct(*fields)).alias("text"),
    )
    ordered = F.array_sort(F.collect_list(point)).alias("ordered")
    sliced = points.withWatermark("timestamp", watermark).groupBy(*KEY, F.window("timestamp", f"{slice_seconds} seconds").alias("slice"))
    return sliced.agg(ordered).select(
        *KEY, F.col("slice.end").alias("closed"),
        F.transform("ordered", lambda p: p["micros"]).alias("times"), F.transform("ordered", lambda p: p["text"]).alias("path"),
    )


def run_slices_stream(points: DataFrame, path: str, settings, slice_seconds: int = SLICE_SECONDS, watermark: str = "1 hour") -> StreamingQuery:
    """Track points to the table of closed slices; points behind the watermark are dropped by the engine."""
    slices = track_slices(points, slice_seconds, watermark)
    return settings.start(slices.writeStream.format("parquet").option("path", path).outputMode("append"))


def _processor(gap_seconds: int) -> StatefulProcessor:
    """The track that is open under one key: its first and last time, its parts and points so far and its last point.

    Slices wait in the state until the watermark reaches their end, so those of one batch are taken in
    order. A key has one timer, so a slice costs few calls of the state store, and rows of many keys come and go in one
    Arrow batch. Defined in here, so that workers need not
    import this package.
    """
    gap, part_row = gap_seconds * 1_000_000, Row(*_PARTS.names)
    state_type = StructType([
        *[StructField(n, LongType()) for n in ("start", "last", "part", "points")], StructField("tail", StringType()),
        StructField("timer", LongType()), StructField("ends", ArrayType(LongType())),
        StructField("times", ArrayType(ArrayType(LongType()))), StructField("paths", ArrayType(ArrayType(StringType()))),
    ])

    class Joiner(StatefulProcessor):
        def init(self, handle) -> None:
            self.handle = handle
            self.kept = handle.getValueState("track", state_type)

        def _load(self):
            """The open track, if there is one, the time of the timer and the slices that wait."""
            kept = self.kept.get()
            if kept is None:
                return None, 0, []
            *track, timer, ends, times, paths = kept
            return (None if track[0] is None else tuple(track)), timer, list(zip(ends, times, paths))

        def _keep(self, track, timer, waiting) -> None:
            """Saves the state, with a timer where the next slice or the track ends."""
            if track is None and not waiting:
                self.kept.clear()
                return
            times = [s[0] // 1000 for s in waiting]
            if track:
                times.append((track[1] + gap) // 1000 + 1)
            due = min(times)
            if due != timer:
                if timer:
                    self.handle.deleteTimer(timer)
                self.handle.registerTimer(due)
            lists = [list(c) for c in zip(*waiting)] if waiting else [[], [], []]
            self.kept.update((*(track or (None,) * 5), due, *lists))

        def handleInputRows(self, key, rows, timerValues) -> Iterator:  # noqa: N802, N803
            track, timer, waiting = self._load()
            waiting += [(row["end"], list(row["times"]), list(row["path"])) for row in rows]
            self._keep(track, timer, waiting)
            return iter(())

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator:  # noqa: N802, N803
            now, out = timerValues.getCurrentWatermarkInMs() * 1000, []
            track, _, waiting = self._load()
            due, later = sorted((s for s in waiting if s[0] <= now), key=lambda s: s[0]), [s for s in waiting if s[0] > now]

            def close() -> None:
                start, last, part, points, _ = track
                out.append(part_row(*key, start, last, part, points, True, []))

            for _, times, path in due:
                cuts = [0, *(i for i in range(1, len(times)) if times[i] - times[i - 1] > gap), len(times)]
                for i, j in zip(cuts, cuts[1:]):
                    if track and times[i] - track[1] > gap:
                        close()
                        track = None
                    start, _, part, points, tail = track or (times[i], 0, 0, 0, None)
                    line = ([] if tail is None else [tail]) + list(path[i:j])
                    out.append(part_row(*key, start, times[j - 1], part, j - i, False, line))
                    track = (start, times[j - 1], part + 1, points + j - i, path[j - 1])
            if track and now - track[1] > gap:
                close()
                track = None
            # The timer that fired is gone.
            self._keep(track, 0, later)
            return iter(out)

        def close(self) -> None:
            pass

    return Joiner()


def _point(text: Column) -> Column:
    point = F.from_json(text, POINT_SCHEMA)
    return F.struct(F.timestamp_micros(point["timestamp"]).alias("timestamp"), *[point[f].alias(f) for f in POINT_FIELDS[1:]])


def track_parts(slices: DataFrame, gap_seconds: int) -> DataFrame:
    """Rows (icao24, callsign, start_time, end_time, part, points, closed, path) of tracks cut where more than the gap passes.

    A part has the points that a track has in one slice, after the last point of the part before. Once the
    watermark is more than the gap beyond a track's last point, one row with ``closed`` and no path has the track's end and
    the numbers of its parts and points.
    """
    told = slices.select(*KEY, F.unix_micros("closed").alias("end"), "times", "path", "closed").withWatermark("closed", "0 seconds")
    parts = told.groupBy(*KEY).transformWithState(_processor(gap_seconds), _PARTS, "Append", "EventTime")
    times = [F.timestamp_micros(name).alias(f"{name}_time") for name in ("start", "end")]
    return parts.select(*KEY, *times, "part", "points", "closed", F.transform("path", _point).alias("path"))


def run_tracks_stream(spark: SparkSession, slices_path: str, gap_seconds: int, path: str, settings) -> StreamingQuery:
    """Parts of tracks to a table, from the table of closed slices that ``run_slices_stream`` writes."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    parts = track_parts(spark.readStream.schema(SLICES_SCHEMA).parquet(slices_path), gap_seconds)
    return settings.start(parts.writeStream.format("parquet").option("path", path).outputMode("append"))


def closed_tracks(parts: DataFrame) -> DataFrame:
    """The parts of ended tracks, each with its track's times, durations and number of parts, as ``track_geojson`` takes them."""
    same = F.lit(True)
    for name in [*KEY, "start_time"]:
        same = same & F.col(f"p.{name}").eqNullSafe(F.col(f"c.{name}"))
    ended = parts.where("closed").alias("c")
    joined = parts.where("NOT closed").alias("p").join(ended.hint("merge"), same).select(
        *[f"p.{k}" for k in KEY], "p.start_time", "c.end_time", "p.part", F.col("c.part").alias("parts"), "p.points", "p.path",
    )
    span = (F.col("start_time"), F.col("end_time"))
    return joined.withColumns({"duration_seconds": duration_seconds(*span), "duration_hours": duration_hours(*span)})
