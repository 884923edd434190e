"""Records of the error sink, corrected and transformed again, up to a number of attempts.

A step takes what failed in the step before and the errors of its batch, and writes a row for each record
with the number of the attempt and its result. A step is written whole or not at all; a repeated batch
writes its step again.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from aerolake.operators.enrich import FAILED, OK, enrich_outcome
from aerolake.session import deleted
from aerolake.streaming.delivery import step_name, whole_steps

# How often a record that failed is tried again.
REPLAYS = 3

REPLAY_SCHEMA = "recordId STRING, data STRING, result STRING, value STRING, attempt INT"

Transform = Callable[[DataFrame], DataFrame]


def _failed(spark: SparkSession, path: str, step: str) -> DataFrame:
    return spark.read.schema(REPLAY_SCHEMA).parquet(f"{path}/attempts/step={step}").where(F.col("result") == FAILED)


def _replay_step(errors: DataFrame | None, spark: SparkSession, path: str, step: str, correct: Transform, transform: Transform, attempts: int) -> None:
    before = [name for name in whole_steps(spark, path) if name < step]
    rows = []
    if before:
        rows.append(_failed(spark, path, before[-1]).where(F.col("attempt") < attempts).select("recordId", "data", F.col("attempt") + 1))
    if errors is not None:
        rows.append(errors.select("recordId", "data", F.lit(1)))
    wanted = reduce(DataFrame.unionAll, rows).toDF("recordId", "data", "attempt")
    for later in [name for name in whole_steps(spark, path) if name > step]:
        deleted(spark, f"{path}/attempts/step={later}")
    corrected = correct(wanted).select("recordId", "data", "attempt").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        # The transform gives its own columns only, so each attempt goes through it by itself.
        tried = [
            transform(corrected.where(F.col("attempt") == n).select("recordId", "data"))
            .select("recordId", "data", "result", "value", F.lit(n).alias("attempt"))
            for n in range(1, attempts + 1)
        ]
        reduce(DataFrame.unionAll, tried).write.mode("overwrite").parquet(f"{path}/attempts/step={step}")
    finally:
        corrected.unpersist()


def replay_errors(
    errors: DataFrame, batch_id: int, path: str, correct: Transform, transform: Transform = enrich_outcome, attempts: int = REPLAYS
) -> None:
    """Tries what failed in the step before, then the (recordId, data) rows of a batch.

    ``correct`` maps rows (recordId, data, attempt) to the same columns with the data to try.
    """
    _replay_step(errors, errors.sparkSession, path.rstrip("/"), step_name(batch_id), correct, transform, attempts)


def drain_replays(spark: SparkSession, path: str, correct: Transform, transform: Transform = enrich_outcome, attempts: int = REPLAYS) -> None:
    """Tries what the last batch left until nothing has failed or all that failed is given up."""
    path = path.rstrip("/")
    while (steps := whole_steps(spark, path)) and not _failed(spark, path, steps[-1]).where(F.col("attempt") < attempts).isEmpty():
        batch_id, drain = map(int, steps[-1].split("-"))
        _replay_step(None, spark, path, step_name(batch_id, drain + 1), correct, transform, attempts)


def _tried(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(f"{REPLAY_SCHEMA}, step STRING").parquet(f"{path.rstrip('/')}/attempts")


def replayed(spark: SparkSession, path: str) -> DataFrame:
    """The records that could be read in the end: enriched (``value``), or dropped as the transform says in ``result``."""
    return _tried(spark, path).where(F.col("result") != FAILED)


def replays_given_up(spark: SparkSession, path: str, attempts: int = REPLAYS) -> DataFrame:
    """The records that failed in their last attempt."""
    return _tried(spark, path).where((F.col("result") == FAILED) & (F.col("attempt") >= attempts))


def write_replayed(spark: SparkSession, path: str, target: str) -> None:
    """The enriched records as JSON lines, the whole folder anew, so that a repeat leaves them once."""
    replayed(spark, path).where(F.col("result") == OK).select("value").write.mode("overwrite").text(target)


def run_replay_stream(
    errors: DataFrame, path: str, settings, correct: Transform, transform: Transform = enrich_outcome, attempts: int = REPLAYS
) -> StreamingQuery:
    """A stream over the error sink; ``drain_replays`` tries what the last batch leaves."""

    def write(batch: DataFrame, batch_id: int) -> None:
        replay_errors(batch, batch_id, path, correct, transform, attempts)

    return settings.start(errors.writeStream.foreachBatch(write))
