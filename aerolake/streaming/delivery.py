"""Delivery of records to a receiver that may refuse some, and the receiver's own end of it.

A sending step writes a row for each record that it tried, with the number of the attempt and whether the
receiver took it. What was refused is what the next step sends first, up to a number of attempts. A step is
written whole or not at all, and a repeated batch sends its step again: a record arrives once or more, and
receivers keep the first.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from aerolake.operators.publish import CHUNK_SIZE
from aerolake.session import deleted, listed

# Attempts of a record, the first and three retries.
MAX_ATTEMPTS = 4

ATTEMPT_SCHEMA = "key STRING, value STRING, attempt INT, accepted BOOLEAN"

Send = Callable[[list[tuple[str, str, int]]], list[bool]]


def attempted(records: DataFrame, send: Send, chunk_size: int = CHUNK_SIZE) -> DataFrame:
    """Hands (key, value, attempt) rows to a client in chunks; adds ``accepted``.

    ``send`` tells for each record of a chunk whether it was taken; an exception refuses the chunk and others go
    on. A task holds the answers of one batch of rows and one chunk at a time. Write the result once: every evaluation sends again.
    """
    import pandas as pd

    names = ["key", "value", "attempt", "accepted"]

    def answers(chunk: list[tuple[str, str, int]]) -> list[bool]:
        try:
            taken = [bool(x) for x in send(chunk)]
        except Exception:
            taken = []
        return taken if len(taken) == len(chunk) else [False] * len(chunk)

    def sent(batches):
        chunk: list[tuple[str, str, int]] = []

        def flushed():
            return [(*row, ok) for row, ok in zip(chunk, answers(chunk))]

        for batch in batches:
            done = []
            for row in zip(batch["key"], batch["value"], batch["attempt"].tolist()):
                chunk.append(row)
                if len(chunk) == chunk_size:
                    done += flushed()
                    chunk.clear()
            if done:
                yield pd.DataFrame(done, columns=names)
        if chunk:
            yield pd.DataFrame(flushed(), columns=names)

    return records.select("key", "value", F.col("attempt").cast("int").alias("attempt")).mapInPandas(sent, ATTEMPT_SCHEMA)


def step_name(batch_id: int, drain: int = 0) -> str:
    return f"{batch_id:012d}-{drain:06d}"


def whole_steps(spark: SparkSession, path: str) -> list[str]:
    names = [name.split("=")[1] for name in listed(spark, f"{path}/attempts") if name.startswith("step=")]
    return [name for name in names if "_SUCCESS" in listed(spark, f"{path}/attempts/step={name}")]


def _refused(spark: SparkSession, path: str, step: str) -> DataFrame:
    return spark.read.schema(ATTEMPT_SCHEMA).parquet(f"{path}/attempts/step={step}").where("NOT accepted")


def _send_step(records: DataFrame | None, spark: SparkSession, path: str, step: str, send: Send, chunk_size: int, attempts: int) -> None:
    before = [name for name in whole_steps(spark, path) if name < step]
    rows = []
    if before:
        again = _refused(spark, path, before[-1]).where(F.col("attempt") < attempts)
        rows.append(again.select("key", "value", F.col("attempt") + 1))
    if records is not None:
        rows.append(records.select("key", "value", F.lit(1)))
    wanted = rows[0].unionByName(rows[1].toDF(*rows[0].columns)) if len(rows) == 2 else rows[0]
    for later in [name for name in whole_steps(spark, path) if name > step]:
        deleted(spark, f"{path}/attempts/step={later}")  # a repeated batch: what followed was sent after another outcome
    attempted(wanted.toDF("key", "value", "attempt"), send, chunk_size).write.mode("overwrite").parquet(f"{path}/attempts/step={step}")


def send_records(records: DataFrame, batch_id: int, path: str, send: Send, chunk_size: int = CHUNK_SIZE, attempts: int = MAX_ATTEMPTS) -> None:
    """Sends what the step before left, then the (key, value) rows of a batch."""
    _send_step(records, records.sparkSession, path.rstrip("/"), step_name(batch_id), send, chunk_size, attempts)


def drain_records(spark: SparkSession, path: str, send: Send, chunk_size: int = CHUNK_SIZE, attempts: int = MAX_ATTEMPTS) -> None:
    """Sends what the last batch left until all is taken or given up."""
    path = path.rstrip("/")
    while (steps := whole_steps(spark, path)) and not _refused(spark, path, steps[-1]).where(F.col("attempt") < attempts).isEmpty():
        batch_id, drain = map(int, steps[-1].split("-"))
        _send_step(None, spark, path, step_name(batch_id, drain + 1), send, chunk_size, attempts)


def delivery_steps(spark: SparkSession, path: str, attempts: int = MAX_ATTEMPTS) -> DataFrame:
    """The ledger: step, records tried, sent again, accepted, refused and given up."""
    rows = spark.read.schema(f"{ATTEMPT_SCHEMA}, step STRING").parquet(f"{path.rstrip('/')}/attempts")
    refused = ~F.col("accepted")
    return rows.groupBy("step").agg(
        F.count("*").alias("records"), F.count_if(F.col("attempt") > 1).alias("again"), F.count_if("accepted").alias("accepted"),
        F.count_if(refused).alias("refused"), F.count_if(refused & (F.col("attempt") >= attempts)).alias("given_up"),
    )


def given_up(spark: SparkSession, path: str, attempts: int = MAX_ATTEMPTS) -> DataFrame:
    """The records that were refused in their last attempt."""
    rows = spark.read.schema(f"{ATTEMPT_SCHEMA}, step STRING").parquet(f"{path.rstrip('/')}/attempts")
    return rows.where(~F.col("accepted") & (F.col("attempt") >= attempts)).select("key", "value", "attempt", "step")


def run_delivery_stream(records: DataFrame, path: str, settings, send: Send, chunk_size: int = CHUNK_SIZE, attempts: int = MAX_ATTEMPTS) -> StreamingQuery:
    """(key, value) records to a client, with a step for each batch; ``drain_records`` sends what the last one leaves."""

    def write(batch: DataFrame, batch_id: int) -> None:
        send_records(batch, batch_id, path, send, chunk_size, attempts)

    return settings.start(records.writeStream.foreachBatch(write))


def received_records(records: DataFrame, watermark: str = "1 day") -> DataFrame:
    """(key, value, icao24, last_contact): the first record of each aircraft and time, within the watermark.

    State holds the times that the watermark has not passed yet, so it does not grow with the stream; records
    older than that are dropped as late, repeated ones among them. Records without a time cannot be told apart and
    pass.
    """
    read = records.select(
        "key", "value", F.get_json_object("value", "$.icao24").alias("icao24"),
        F.try_to_timestamp(F.get_json_object("value", "$.last_contact")).alias("last_contact"),
    )
    timed = read.where(F.col("last_contact").isNotNull()).withWatermark("last_contact", watermark)
    first = timed.dropDuplicatesWithinWatermark(["icao24", "last_contact"])
    return first.unionByName(read.where(F.col("last_contact").isNull()))


def run_receive_stream(records: DataFrame, path: str, settings, watermark: str = "1 day") -> StreamingQuery:
    """Published (key, value) records to a table, each aircraft and time once."""
    received = received_records(records, watermark)
    return settings.start(received.writeStream.format("parquet").option("path", path).outputMode("append"))
