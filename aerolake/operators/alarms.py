"""Metric rollups, threshold alarms and alert texts."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolake.functions.text import ts_to_iso

LAG, INCOMING, THROTTLED, ERRORS, THROTTLED_REQUESTS = (
    "iterator_age_ms", "incoming_records", "throttled_records", "errors", "throttled_requests",
)


@dataclass(frozen=True)
class AlarmSpec:
    """Fires when ``breaching`` of the last ``periods`` periods break the limit."""

    name: str
    metric: str
    statistic: str  # Sum or Max
    period_seconds: int
    breaching: int
    periods: int
    comparison: str  # > or <
    threshold: float
    description: str = ""
    severity: str | None = None
    response: str | None = None


# Periods (seconds), counts and limits of the alarms.
ALARMS = {
    a.name: a
    for a in [
        AlarmSpec("stream-lag", LAG, "Max", 300, 2, 2, ">", 60000,
                  "records wait longer than 60 seconds in the stream"),
        AlarmSpec("stream-idle", INCOMING, "Sum", 600, 2, 2, "<", 1,
                  "no record has entered the stream for 10 minutes or more"),
        AlarmSpec("delivery-lag", LAG, "Max", 300, 2, 2, ">", 60000,
                  "records wait longer than 60 seconds for delivery"),
        AlarmSpec("delivery-idle", INCOMING, "Sum", 600, 2, 2, "<", 1,
                  "no record has reached delivery for 10 minutes or more"),
        AlarmSpec("throttling", THROTTLED, "Sum", 60, 3, 5, ">", 500,
                  "high volume: the stream throttles records", "critical", "scale-up-shards"),
        AlarmSpec("critical-lag", LAG, "Max", 60, 3, 3, ">", 300000,
                  "critical delay: processing is behind", "high", "check-lambda-scaling"),
        AlarmSpec("transform-errors", ERRORS, "Sum", 60, 1, 1, ">", 10,
                  "failure: errors while processing records", "critical", "check-logs"),
        AlarmSpec("table-throttling", THROTTLED_REQUESTS, "Sum", 60, 5, 5, ">", 100,
                  "capacity: the keyed table throttles requests", "medium", "enable-auto-scaling"),
    ]
}

# The layout of an alert text.
ALERT_TEXT = (
    "[ALERTA] %s\n"
    "Status: %s\n"
    "Descrição: %s\n"
    "\n"
    "Métrica: %s = %s (Limite: %s)\n"
    "Recurso: %s\n"
    "Ação Recomendada: %s"
)

# Periods generated per row of the first spine level.
_RUN = 1440


def _metric(rows: DataFrame, metric: str, source: str, ts: Column, value: Column) -> DataFrame:
    return rows.select(
        F.lit(metric).alias("metric"),
        F.lit(source).alias("source"),
        ts.alias("ts"),
        value.cast("double").alias("value"),
    )


def incoming_metric(rows: DataFrame, ts: Column, source: str) -> DataFrame:
    """One event of value 1 per row."""
    return _metric(rows, INCOMING, source, ts, F.lit(1))


def lag_metric(states: DataFrame, processed_at: Column, source: str) -> DataFrame:
    """Milliseconds between the last contact and processing, at processing time."""
    age = (F.unix_micros(processed_at) - F.unix_micros("last_contact")) / F.lit(1000.0)
    return _metric(states, LAG, source, processed_at, age)


def error_metric(quarantine: DataFrame, ts: Column, source: str) -> DataFrame:
    """One event of value 1 per quarantined row."""
    return _metric(quarantine, ERRORS, source, ts, F.lit(1))


def throttled_metric(ledger: DataFrame, ts: Column, source: str) -> DataFrame:
    """The records of each chunk that the receiver refused."""
    return _metric(ledger.where("failed > 0"), THROTTLED, source, ts, F.col("failed"))


def throttled_requests_metric(ledger: DataFrame, ts: Column, source: str) -> DataFrame:
    """One event of value 1 per chunk with refused records."""
    return _metric(ledger.where("failed > 0"), THROTTLED_REQUESTS, source, ts, F.lit(1))


def metric_rollup(metrics: DataFrame, period_seconds: int, statistic: str) -> DataFrame:
    """Sum or Max per metric, source and tumbling period; batch or stream."""
    aggregate = {"Sum": F.sum, "Max": F.max}[statistic]
    return (
        metrics.groupBy("metric", "source", F.window("ts", f"{period_seconds} seconds").alias("_window"))
        .agg(aggregate("value").alias("value"))
        .select("metric", "source", F.col("_window.start").alias("period_start"), "value")
    )


#: Seconds of a partial rollup; the period of every alarm is a multiple of it.
PARTIAL_SECONDS = 60


def metric_partials(metrics: DataFrame) -> DataFrame:
    """(metric, source, minute, total, most) of each minute with rows; batch or stream.

    Sums and maxima of longer periods follow from them, so all alarms read the metrics once.
    """
    window = F.window("ts", f"{PARTIAL_SECONDS} seconds").alias("_window")
    return metrics.groupBy("metric", "source", window).agg(F.sum("value").alias("total"), F.max("value").alias("most")).select(
        "metric", "source", F.col("_window.start").alias("minute"), "total", "most"
    )


def rollup_of(partials: DataFrame, period_seconds: int, statistic: str) -> DataFrame:
    """The rollup of longer periods, the same as ``metric_rollup`` gives of the metrics."""
    if period_seconds % PARTIAL_SECONDS:
        raise ValueError(f"{period_seconds} seconds are not whole minutes")
    value = {"Sum": F.sum("total"), "Max": F.max("most")}[statistic]
    start = F.timestamp_seconds(F.floor(F.unix_seconds("minute") / period_seconds) * period_seconds)
    return partials.groupBy("metric", "source", start.alias("period_start")).agg(value.alias("value"))


def watched_range(rollup: DataFrame, start: Column | None = None, end: Column | None = None) -> DataFrame:
    """First and last period to judge per metric and source, by default those with data."""
    return rollup.groupBy("metric", "source").agg(
        F.min("period_start").alias("_first"), F.max("period_start").alias("_last")
    ).select(
        "metric", "source",
        (F.col("_first") if start is None else start).alias("first_period"),
        (F.col("_last") if end is None else end).alias("last_period"),
    )


def _spine(watched: DataFrame, period: int) -> DataFrame:
    """Every period of the watched range, unrolled in two levels of bounded length."""
    last = F.col("_last")
    return (
        watched.select(
            "metric", "source",
            F.unix_seconds("first_period").alias("_first"),
            F.unix_seconds("last_period").alias("_last"),
        )
        .where("_first <= _last")
        .select("metric", "source", "_last", F.explode(F.sequence("_first", "_last", F.lit(period * _RUN))).alias("_run"))
        .select(
            "metric", "source",
            F.explode(
                F.sequence("_run", F.least(F.col("_run") + period * (_RUN - 1), last), F.lit(period))
            ).alias("_second"),
        )
    )


def evaluate_alarm(rollup: DataFrame, spec: AlarmSpec, watched: DataFrame | None = None) -> DataFrame:
    """Rows (metric, source, period_start, value, breaches, in_alarm) for every period.

    A period without data has sum 0 and no maximum. Each period hands its verdict to
    itself and the following periods it counts for, so that all grouping is by period
    and a long history of one source is not a single task.

    ``watched`` (see ``watched_range``) names the periods to judge; pass it to judge
    sources that have gone silent past their last row.
    """
    rollup = rollup.where(F.col("metric") == spec.metric)
    watched = watched_range(rollup) if watched is None else watched
    seconds = rollup.select("metric", "source", F.unix_seconds("period_start").alias("_second"), "value")
    periods = _spine(watched, spec.period_seconds).join(seconds, ["metric", "source", "_second"], "left")
    if spec.statistic == "Sum":
        periods = periods.withColumn("value", F.coalesce("value", F.lit(0.0)))
    breach = F.col("value") > spec.threshold if spec.comparison == ">" else F.col("value") < spec.threshold
    votes = periods.withColumn("_breach", F.coalesce(breach, F.lit(False))).withColumn(
        "_ahead", F.explode(F.array(*[F.lit(n) for n in range(spec.periods)]))
    )
    own = F.col("_ahead") == 0
    return (
        votes.withColumn("_second", F.col("_second") + F.col("_ahead") * spec.period_seconds)
        .groupBy("metric", "source", "_second")
        .agg(
            F.max(F.when(own, F.col("value"))).alias("value"),
            F.count_if("_breach").alias("breaches"),
            F.bool_or(own).alias("_judged"),
        )
        .where("_judged")
        .select(
            "metric", "source",
            F.timestamp_seconds("_second").alias("period_start"),
            "value", "breaches",
            (F.col("breaches") >= spec.breaching).alias("in_alarm"),
        )
    )


def firing(alarms: DataFrame) -> DataFrame:
    return alarms.where("in_alarm").drop("in_alarm")


def _by_spec(specs: list[AlarmSpec], field: str) -> Column:
    """A field of the alarm that the column ``_k`` numbers."""
    return F.get(F.array(*[F.lit(getattr(spec, field)) for spec in specs]), F.col("_k"))


def _each_spec(rows: DataFrame, specs: list[AlarmSpec]) -> DataFrame:
    """Each row once for every alarm on its metric."""
    numbers = F.create_map(*[x for metric in sorted({s.metric for s in specs}) for x in (
        F.lit(metric), F.array(*[F.lit(k) for k, s in enumerate(specs) if s.metric == metric])
    )])
    return rows.withColumn("_k", F.explode(F.try_element_at(numbers, F.col("metric"))))


def alarm_table(
    partials: DataFrame, sources: DataFrame, first: Column, last: Column, specs: Iterable[AlarmSpec] = tuple(ALARMS.values())
) -> DataFrame:
    """A row for each alarm, source and period that fires, with its message.

    ``partials`` are those of ``metric_partials``, ``sources`` the (metric, source) pairs to watch, with
    rows or without. All periods from that of ``first`` to that of ``last`` are judged, so silence
    after a source's last row fires as well. All alarms are judged together, from one read of the partials: each
    minute counts for the periods of all alarms on its metric.
    """
    specs = list(specs)
    seconds = _by_spec(specs, "period_seconds").cast("long")
    key = ["_k", "metric", "source", "_second"]

    def period(ts: Column) -> Column:
        return F.floor(F.unix_seconds(ts) / seconds) * seconds

    rolled = _each_spec(partials, specs).select(*key[:3], period(F.col("minute")).alias("_second"), "total", "most", F.lit(False).alias("_judged"))
    runs = _each_spec(sources.select("metric", "source", first.alias("_first"), last.alias("_last")), specs).select(
        *key[:3], period(F.col("_last")).alias("_end"), F.explode(F.sequence(period(F.col("_first")), period(F.col("_last")), seconds * _RUN)).alias("_run")
    )
    spine = runs.select(
        *key[:3], F.explode(F.sequence("_run", F.least(F.col("_run") + seconds * (_RUN - 1), F.col("_end")), seconds)).alias("_second"),
        F.lit(None).cast("double").alias("total"), F.lit(None).cast("double").alias("most"), F.lit(True).alias("_judged"),
    )
    periods = rolled.unionByName(spine).groupBy(*key).agg(F.sum("total").alias("total"), F.max("most").alias("most"), F.bool_or("_judged").alias("_judged"))
    value = F.when(_by_spec(specs, "statistic") == "Sum", F.coalesce("total", F.lit(0.0))).otherwise(F.col("most"))
    limit, above = _by_spec(specs, "threshold").cast("double"), _by_spec(specs, "comparison") == ">"
    breach = F.coalesce(F.when(above, F.col("value") > limit).otherwise(F.col("value") < limit), F.lit(False))
    judged = periods.where("_judged").withColumn("value", value).withColumn("_breach", breach)
    # A verdict counts for its own period and those after it; periods without a breach need no other to know of them.
    ahead = F.when(F.col("_breach"), F.sequence(F.lit(0), _by_spec(specs, "periods") - 1)).otherwise(F.array(F.lit(0)))
    votes = judged.withColumn("_ahead", F.explode(ahead))
    own = F.col("_ahead") == 0
    fired = (
        votes.withColumn("_second", F.col("_second") + F.col("_ahead") * seconds)
        .groupBy(*key)
        .agg(F.max(F.when(own, F.col("value"))).alias("value"), F.count_if("_breach").alias("breaches"), F.bool_or(own).alias("_judged"))
        .where(F.col("_judged") & (F.col("breaches") >= _by_spec(specs, "breaching")))
    )
    texts = {"alarm": "name", "severity": "severity", "_description": "description", "_response": "response", "_threshold": "threshold"}
    named = fired.withColumns({column: _by_spec(specs, field) for column, field in texts.items()}).withColumn("period_start", F.timestamp_seconds("_second"))
    message = _alert_text(F.col("alarm"), F.col("_description"), F.col("_threshold").cast("double"), F.coalesce("_response", F.lit("-")))
    return named.select("alarm", "severity", "metric", "source", "period_start", "value", "breaches", message.alias("message"))


def _number_text(value: Column) -> Column:
    """Whole numbers without decimals."""
    whole = value == F.floor(value)
    return F.when(whole, value.cast("bigint").cast("string")).otherwise(value.cast("string"))


def _alert_text(name: Column, description: Column, threshold: Column, response: Column) -> Column:
    time = F.concat(ts_to_iso(F.col("period_start")), F.lit("Z"))
    value = F.coalesce(_number_text(F.col("value")), F.lit("-"))
    return F.format_string(ALERT_TEXT, name, time, description, F.col("metric"), value, _number_text(threshold), F.col("source"), response)


def format_alert(alarms: DataFrame, spec: AlarmSpec) -> DataFrame:
    """Adds ``message``, the alert text of a firing period."""
    text = _alert_text(F.lit(spec.name), F.lit(spec.description), F.lit(float(spec.threshold)), F.lit(spec.response or "-"))
    return alarms.withColumn("message", text)
