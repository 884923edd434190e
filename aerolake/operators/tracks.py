"""Tracks: the ordered points of one aircraft under one callsign.

No group here grows with the data. A track is cut at time gaps by looking at blocks of
the gap's length only: two points of one block are closer than the gap, so a cut can
only lie between blocks, and a block is just its first and last time and its count.
Paths are arrays, so a track longer than ``max_points`` comes as several parts, each with
the track's own times and, for a line without holes, the last point of the part before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerolake.functions.text import json_with_nulls, ts_to_iso
from aerolake.functions.units import altitude_ft, duration_hours, duration_seconds

KEY = ["icao24", "callsign"]
POINT_FIELDS = ["timestamp", "latitude", "longitude", "altitude", "heading", "on_ground"]

# Block length, in seconds, for tracks that are not cut at gaps.
_DAY = 86_400


def track_points(states: DataFrame) -> DataFrame:
    """The points of all tracks: states with a time and a position."""
    return states.where(
        F.col("last_contact").isNotNull()
        & F.col("latitude").isNotNull()
        & F.col("longitude").isNotNull()
    ).select(
        *KEY,
        F.col("last_contact").alias("timestamp"),
        "latitude", "longitude", "altitude", "heading", "on_ground",
        "snapshot_id", "pos",
    )


def points_in_feet(points: DataFrame) -> DataFrame:
    return points.withColumn("altitude_ft", altitude_ft(F.col("altitude")))


def _with_durations(tracks: DataFrame) -> DataFrame:
    span = (F.col("start_time"), F.col("end_time"))
    return tracks.withColumns(
        {"duration_seconds": duration_seconds(*span), "duration_hours": duration_hours(*span)}
    )


def track_summary(points: DataFrame) -> DataFrame:
    """Per track: first and last time, number of points, duration."""
    return _with_durations(
        points.groupBy(*KEY).agg(
            F.min("timestamp").alias("start_time"),
            F.max("timestamp").alias("end_time"),
            F.count("*").alias("points"),
        )
    )


def _block_no(ts: Column, seconds: int) -> Column:
    return F.floor(F.unix_micros(ts) / F.lit(seconds * 1_000_000))


def _segmented(blocks: DataFrame, gap_seconds: int | None) -> DataFrame:
    """Numbers the segments of rows (key, block, first_ts, last_ts, points).

    The window runs over blocks, of which a key has as many as its time span has gap
    lengths.
    """
    if gap_seconds is None:
        return blocks.withColumn("segment", F.lit(0).cast("bigint"))
    by_time = Window.partitionBy(*KEY).orderBy("block")
    silence = F.unix_micros("first_ts") - F.unix_micros(F.lag("last_ts").over(by_time))
    starts = F.coalesce((silence > gap_seconds * 1_000_000).cast("bigint"), F.lit(0))
    return blocks.withColumn("_starts", starts).withColumn(
        "segment", F.sum("_starts").over(by_time)
    ).drop("_starts")


def track_segments(points: DataFrame, gap_seconds: int) -> DataFrame:
    """Tracks cut where more than ``gap_seconds`` pass without a point."""
    blocks = points.groupBy(*KEY, _block_no(F.col("timestamp"), gap_seconds).alias("block")).agg(
        F.min("timestamp").alias("first_ts"),
        F.max("timestamp").alias("last_ts"),
        F.count("*").alias("points"),
    )
    return _with_durations(
        _segmented(blocks, gap_seconds)
        .groupBy(*KEY, "segment")
        .agg(
            F.min("first_ts").alias("start_time"),
            F.max("last_ts").alias("end_time"),
            F.sum("points").alias("points"),
        )
    )


def _same_key(left: str, right: str, *more: str) -> Column:
    """Join condition between two aliases, under which a null key equals a null key."""
    condition = F.lit(True)
    for name in [*KEY, *more]:
        condition = condition & F.col(f"{left}.{name}").eqNullSafe(F.col(f"{right}.{name}"))
    return condition


def _instants(points: DataFrame, gap_seconds: int | None) -> DataFrame:
    """Segment of every (key, instant), with the points before it and those of the whole segment.

    The points before an instant are those of earlier blocks of the segment plus those
    of earlier instants of its block; both are sums over counts. Instants and blocks come
    from one shuffle, which Spark reuses.
    """
    before = (Window.unboundedPreceding, -1)
    in_block = Window.partitionBy(*KEY, "block").orderBy("timestamp").rowsBetween(*before)
    in_segment = Window.partitionBy(*KEY, "segment").orderBy("block").rowsBetween(*before)
    segment = Window.partitionBy(*KEY, "segment")
    instants = (
        points.groupBy(*KEY, "timestamp")
        .agg(F.count("*").alias("here"))
        .withColumn("block", _block_no(F.col("timestamp"), gap_seconds or _DAY))
    )
    blocks = instants.groupBy(*KEY, "block").agg(
        F.min("timestamp").alias("first_ts"),
        F.max("timestamp").alias("last_ts"),
        F.sum("here").alias("points"),
    )
    blocks = _segmented(blocks, gap_seconds).withColumns({
        "earlier": F.coalesce(F.sum("points").over(in_segment), F.lit(0)),
        "total": F.sum("points").over(segment),
        "start_time": F.min("first_ts").over(segment),
        "end_time": F.max("last_ts").over(segment),
    })
    instants = instants.withColumn("in_block", F.coalesce(F.sum("here").over(in_block), F.lit(0)))
    return instants.alias("i").join(blocks.alias("b").hint("merge"), _same_key("i", "b", "block")).select(
        *[f"i.{k}" for k in KEY],
        "i.timestamp", "b.segment", "b.total", "b.start_time", "b.end_time",
        (F.col("b.earlier") + F.col("i.in_block")).alias("before"),
    )


def assemble_tracks(
    points: DataFrame, gap_seconds: int | None = None, max_points: int = 10_000
) -> DataFrame:
    """Rows (icao24, callsign, segment, part, parts, start_time, end_time, points, path).

    ``path`` is ordered by time, then snapshot and position. A segment comes in ``parts`` rows, of
    ``max_points`` points each but for the last. Whatever that is, times and durations are
    the segment's, ``points`` add up to its number, and the lines of the parts join, since
    a part's path begins with the last point of the part before.
    """
    in_instant = Window.partitionBy(*[f"p.{k}" for k in KEY], "p.timestamp").orderBy("p.snapshot_id", "p.pos")
    number = F.col("n.before") + F.row_number().over(in_instant) - 1
    # Both sides grow with the input, and Spark takes decoded rows for smaller than they are: without the hint
    # it would collect one of them on the driver to broadcast it.
    placed = points.alias("p").join(
        _instants(points, gap_seconds).alias("n").hint("merge"), _same_key("p", "n", "timestamp")
    ).select(
        *[f"p.{k}" for k in KEY],
        "n.segment", "n.total", "n.start_time", "n.end_time",
        number.alias("number"),
        F.struct("p.timestamp", "p.snapshot_id", "p.pos", *[f"p.{f}" for f in POINT_FIELDS[1:]]).alias("point"),
    )
    own = F.floor(F.col("number") / max_points)
    joins = (F.col("number") % max_points == max_points - 1) & (F.col("number") + 1 < F.col("total"))
    placed = placed.withColumn("part", F.explode(F.when(joins, F.array(own, own + 1)).otherwise(F.array(own)))).withColumn("own", F.col("part") == own)
    assembled = placed.groupBy(*KEY, "segment", "part").agg(
        F.ceil(F.first("total") / max_points).alias("parts"),
        F.first("start_time").alias("start_time"),
        F.first("end_time").alias("end_time"),
        F.count_if("own").alias("points"),
        F.array_sort(F.collect_list("point")).alias("ordered"),
    )
    path = F.transform("ordered", lambda p: F.struct(*[p[f].alias(f) for f in POINT_FIELDS]))
    return _with_durations(assembled.withColumn("path", path).drop("ordered"))


def track_geojson(tracks: DataFrame) -> DataFrame:
    """Adds ``geojson``: a Feature with a LineString, altitude only where it is known."""

    def coordinate(point: Column) -> Column:
        flat = F.array(point["longitude"], point["latitude"])
        return F.when(point["altitude"].isNull(), flat).otherwise(
            F.array(point["longitude"], point["latitude"], point["altitude"])
        )

    properties = F.struct(
        F.col("icao24"),
        F.col("callsign"),
        ts_to_iso(F.col("start_time")).alias("start_time"),
        ts_to_iso(F.col("end_time")).alias("end_time"),
        duration_seconds(F.col("start_time"), F.col("end_time")).alias("duration_seconds"),
    )
    geometry = F.struct(
        F.lit("LineString").alias("type"), F.transform("path", coordinate).alias("coordinates")
    )
    feature = F.struct(
        F.lit("Feature").alias("type"), properties.alias("properties"), geometry.alias("geometry")
    )
    return tracks.withColumn("geojson", json_with_nulls(feature))
