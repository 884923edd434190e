"""Alarms that fire while metrics arrive.

Two jobs: metrics become one partial rollup a minute, each written once when the watermark closes it; those
are judged by keyed state with timers. So a busy source costs the second job a row a minute, and a source
that sends nothing is judged by its timer.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery
from pyspark.sql.types import (
    ArrayType, BooleanType, DoubleType, LongType, StringType, StructField, StructType, TimestampType,
)

from aerolake.operators.alarms import ALARMS, AlarmSpec, metric_partials

PARTIALS_SCHEMA = "metric STRING, source STRING, minute TIMESTAMP, total DOUBLE, most DOUBLE"

CHANGES_SCHEMA = StructType([
    StructField("alarm", StringType()),
    StructField("metric", StringType()),
    StructField("source", StringType()),
    StructField("period_start", TimestampType()),
    StructField("value", DoubleType()),
    StructField("breaches", LongType()),
    StructField("in_alarm", BooleanType()),
])

#: The state store that keeps timers.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def run_partials_stream(metrics: DataFrame, path: str, settings, watermark: str = "1 hour") -> StreamingQuery:
    """Metrics (metric, source, ts, value) to the table of closed minutes."""
    partials = metric_partials(metrics.withWatermark("ts", watermark))
    return settings.start(partials.writeStream.format("parquet").option("path", path).outputMode("append"))


def _processor(specs: list[AlarmSpec]) -> StatefulProcessor:
    """The judge of one (metric, source).

    Its state is: for each alarm on the metric the next period to judge, the verdicts that still count and
    whether it is in alarm; the minutes that periods to come need; and its timer. Defined in here, so that
    workers need not import this package.
    """
    by_metric: dict[str, list[dict]] = {}
    for spec in specs:
        by_metric.setdefault(spec.metric, []).append({
            "name": spec.name, "sum": spec.statistic == "Sum", "seconds": spec.period_seconds, "breaching": spec.breaching,
            "periods": spec.periods, "above": spec.comparison == ">", "threshold": float(spec.threshold),
        })
    columns = CHANGES_SCHEMA.names
    state_type = StructType([
        StructField("next", ArrayType(LongType())), StructField("verdicts", ArrayType(ArrayType(BooleanType()))),
        StructField("firing", ArrayType(BooleanType())), StructField("minutes", ArrayType(LongType())),
        StructField("total", ArrayType(DoubleType())), StructField("most", ArrayType(DoubleType())), StructField("timer", LongType()),
    ])

    class Judge(StatefulProcessor):
        def init(self, handle) -> None:
            self.handle = handle
            self.kept = handle.getValueState("judge", state_type)

        def _load(self, metric: str, first: int | None):
            own = by_metric.get(metric, [])
            if self.kept.exists():
                at, verdicts, firing, minutes, total, most, timer = self.kept.get()
                return own, list(at), [list(v) for v in verdicts], list(firing), list(minutes), list(total), list(most), timer
            return own, [first // s["seconds"] * s["seconds"] for s in own], [[] for _ in own], [False] * len(own), [], [], [], 0

        def _keep(self, own, at, verdicts, firing, minutes, total, most, timer) -> None:
            """Saves the state, with a timer where the next period ends."""
            due = 1000 * min(t + s["seconds"] for t, s in zip(at, own))
            if due != timer:
                if timer:
                    self.handle.deleteTimer(timer)
                self.handle.registerTimer(due)
            self.kept.update((at, verdicts, firing, minutes, total, most, due))

        def handleInitialState(self, key, initialState, timerValues) -> None:  # noqa: N802, N803
            first = int(initialState["first"].iloc[0])
            state = self._load(key[0], first)
            if state[0] and not self.kept.exists():
                self._keep(*state)

        def handleInputRows(self, key, rows, timerValues) -> Iterator:  # noqa: N802, N803
            import pandas as pd

            for frame in rows:
                minutes = frame["second"].tolist()
                state = self._load(key[0], min(minutes))
                if state[0]:
                    for kept, new in zip(state[4:7], (minutes, frame["total"].tolist(), frame["most"].tolist())):
                        kept += new
                    self._keep(*state)
            yield pd.DataFrame(columns=columns)

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator:  # noqa: N802, N803
            import numpy as np
            import pandas as pd

            if not self.kept.exists():
                return
            own, at, verdicts, firing, minutes, total, most, timer = self._load(key[0], None)
            now = timerValues.getCurrentWatermarkInMs() // 1000
            second, out = np.array(minutes, dtype=np.int64), []
            for k, s in enumerate(own):
                count = max(0, (now - at[k]) // s["seconds"])
                if not count:
                    continue
                place = (second - at[k]) // s["seconds"]
                here = (second >= at[k]) & (place < count)
                if s["sum"]:
                    value = np.zeros(count)
                    np.add.at(value, place[here], np.array(total, dtype=float)[here])
                else:
                    value = np.full(count, -np.inf)
                    np.maximum.at(value, place[here], np.array(most, dtype=float)[here])
                    value[np.isneginf(value)] = np.nan
                breach = value > s["threshold"] if s["above"] else value < s["threshold"]
                known = np.append(np.array(verdicts[k], dtype=bool), breach)
                sums = np.append(0, np.cumsum(known))
                ends = np.arange(len(known) - count + 1, len(known) + 1)
                breaches = sums[ends] - sums[np.maximum(0, ends - s["periods"])]
                state = breaches >= s["breaching"]
                changed = np.flatnonzero(state != np.append(firing[k], state[:-1]))
                starts = (at[k] + changed * s["seconds"]).astype("datetime64[s]").astype("datetime64[ns]")
                out.append(pd.DataFrame({
                    "alarm": s["name"], "metric": key[0], "source": key[1], "period_start": pd.DatetimeIndex(starts, tz="UTC"),
                    "value": value[changed], "breaches": breaches[changed].astype("int64"), "in_alarm": state[changed],
                }, columns=columns))
                at[k] += int(count) * s["seconds"]
                verdicts[k] = [bool(v) for v in known[len(known) - min(len(known), s["periods"] - 1) :]]
                firing[k] = bool(state[-1])
            stay = np.flatnonzero(second >= min(at))
            minutes, total, most = ([column[i] for i in stay] for column in (minutes, total, most))
            # The timer that fired is gone.
            self._keep(own, at, verdicts, firing, minutes, total, most, 0)
            yield from (frame for frame in out if len(frame))

        def close(self) -> None:
            pass

    return Judge()


def alarm_changes(
    partials: DataFrame, watched: DataFrame, first: Column, specs: Iterable[AlarmSpec] = tuple(ALARMS.values())
) -> DataFrame:
    """(alarm, metric, source, period_start, value, breaches, in_alarm): a row whenever an alarm begins or ends.

    ``partials`` is the stream of closed minutes, ``watched`` a table of the (metric, source) pairs to judge from the
    period of ``first`` on, with rows or without; other sources are judged from their first minute on. A period is
    judged when the watermark reaches its end, which any source moves.
    """
    seconds = partials.select(
        "metric", "source", F.unix_seconds("minute").alias("second"), "total", "most",
        F.timestamp_seconds(F.unix_seconds("minute") + 60).alias("closed"),
    ).withWatermark("closed", "0 seconds")
    begin = watched.select("metric", "source", F.unix_seconds(first).alias("first")).groupBy("metric", "source").agg(F.min("first").alias("first"))
    return seconds.groupBy("metric", "source").transformWithStateInPandas(
        _processor(list(specs)), CHANGES_SCHEMA, "Append", "EventTime", initialState=begin.groupBy("metric", "source")
    )


def run_alarm_stream(
    spark: SparkSession, partials_path: str, watched: DataFrame, first: Column, path: str, settings,
    specs: Iterable[AlarmSpec] = tuple(ALARMS.values()), max_files: int | None = None,
) -> StreamingQuery:
    """Changes of alarms to a table, from the table of closed minutes that ``run_partials_stream`` writes."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    reader = spark.readStream.schema(PARTIALS_SCHEMA)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    changes = alarm_changes(reader.parquet(partials_path), watched, first, specs)
    return settings.start(changes.writeStream.format("parquet").option("path", path).outputMode("append"))
