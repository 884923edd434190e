"""Helpers of the operators in this folder."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType, StructField, StructType
from pyspark.sql.window import Window

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

#: Bytes that separate words and are stripped from lines.
BLANKS = " \t\n\x0b\x0c\r"

#: Rows handed to Python at a time, so that a batch of long texts stays small.
BATCH_ROWS = "500"
BATCH_BYTES = "32m"


def ready(spark: SparkSession) -> SparkSession:
    """Lets Python workers import this package and keeps their batches small, in rows and in bytes.

    Plans are run later, so both settings stay with the session.
    """
    environment = spark.sparkContext.environment
    if ROOT not in environment.get("PYTHONPATH", "").split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, environment.get("PYTHONPATH")]))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return spark


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder that the driver and all executors see.

    It lies below ``spark.checkpoint.dir``; where that is unset, as in tests, below the
    session's warehouse.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/aerolake-llm/{name}-{uuid.uuid4().hex}"


#: Fewest tasks that write a stored table of known size, however small it is.
FEWEST_FILES = 16


def stored(df: DataFrame, name: str, rows: int | None = None, each: int = 1 << 20) -> DataFrame:
    """The rows, written to the shared folder and read again: what follows doesn't compute them anew.

    Where a bound on the number of rows is known, tasks are joined until each writes about ``each`` of them, so that
    a small table isn't as many files as there are shuffle partitions.
    """
    spark = df.sparkSession
    path = shared_dir(spark, name)
    sized = df if rows is None else df.coalesce(max(FEWEST_FILES, -(-rows // each)))
    sized.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_held: dict[str, object] = {}


def held(name: str, build: Callable[[], object]) -> object:
    """What build makes, kept in this process until another name is asked for: workers live on between operators."""
    if name not in _held:
        _held.clear()
        _held[name] = build()
    return _held[name]


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def without(df: DataFrame, *names: str) -> DataFrame:
    """The columns whose names, in any case, are none of these."""
    gone = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in gone])


def remainder(doc_id: Column, of: int) -> Column:
    """crc32 of the id as text, modulo ``of``; null ids count as the empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(of))


def by_frame(df: DataFrame, step: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """One output frame for each batch of rows."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                yield step(frame)

    return df.mapInPandas(run, schema)


def mapped(
    df: DataFrame, column: str, made: dict[str, DataType], step: Callable[[list], list[list]], keep: list[str] | None = None
) -> DataFrame:
    """The kept columns (all, unless named) and those that step makes of the values of one column, batch by batch."""
    ready(df.sparkSession)
    names = [c for c in (df.columns if keep is None else keep) if c.lower() not in {m.lower() for m in made}]
    kinds = [to_arrow_type(kind) for kind in made.values()]
    picked = df.select(F.col(f"`{column}`").alias("__value"), *[F.col(f"`{c}`") for c in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = step(batch.column(0).to_pylist())
            new = [pa.array(v, kind) for v, kind in zip(values, kinds)]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], *new], names=[*names, *made])
        pa.default_memory_pool().release_unused()

    return picked.mapInArrow(run, StructType([*picked.schema.fields[1:], *[StructField(n, k) for n, k in made.items()]]))


def whole_groups(batches: Iterator[pa.RecordBatch], keys: int, rows: int = 8_000) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole groups of rows sorted by the first ``keys`` columns, and where each group starts."""
    waiting: list[pa.RecordBatch] = []
    size = 0

    def starts(table: pa.Table) -> np.ndarray:
        new = np.zeros(len(table), dtype=bool)
        new[:1] = True
        for k in range(keys):
            column = table.column(k).to_numpy()
            new[1:] |= column[1:] != column[:-1]
        return np.flatnonzero(new)

    for batch in batches:
        waiting.append(batch)
        size += len(batch)
        if size >= rows:
            table = pa.Table.from_batches(waiting).combine_chunks()
            at = starts(table)
            if at[-1]:
                yield table[: at[-1]], at[:-1]
                table = table[at[-1] :].combine_chunks()
            waiting, size = table.to_batches(), len(table) if at[-1] else 0
    if waiting and sum(map(len, waiting)):
        table = pa.Table.from_batches(waiting).combine_chunks()
        yield table, starts(table)


#: Parts that the links of one node are dealt into, so that a node with very many is not one task.
SPLIT = 64
#: With so many links at most, even all of them are few for one task, and dealing nodes out costs more than it saves.
FEW_LINKS = 1 << 20


def _with_least(links: DataFrame, split: bool) -> DataFrame:
    """(u, v, m): distinct links with the smallest v of their u, or u itself.

    With ``split``, a node's links lie in up to SPLIT parts by their other end. The smallest of each part and then of
    each node is found, and handed back to the parts that the node has.
    """
    if not split:  # distinct links and their order by u need no other exchange
        order = Window.partitionBy("u").orderBy("v")
        return links.repartition("u").distinct().select("u", "v", F.least(F.first("v").over(order), "u").alias("m"))
    part = F.pmod(F.xxhash64("v"), F.lit(SPLIT))
    parted = links.distinct().withColumn("part", part)
    least = parted.groupBy("u", "part").agg(F.min("v").alias("m")).groupBy("u").agg(F.least(F.min("m"), F.col("u")).alias("m"), F.collect_list("part").alias("parts"))
    return parted.join(least.select("u", "m", F.explode("parts").alias("part")), ["u", "part"]).select("u", "v", "m")


def components(edges: DataFrame, few_links: int = FEW_LINKS) -> DataFrame:
    """(node, component): the smallest node that links reach from each node of (a, b).

    Alternates large stars and small stars (every node tells its neighbours the smallest one), each
    round written to the shared folder, until nothing changes. A star gives one link for each that it takes,
    so no round has more links than the first. Only two numbers go to the driver.
    """
    pairs = edges.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    pairs, before = stored(pairs, "links"), None
    while (now := tuple(pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())) != before:
        before = now
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _with_least(both, now[0] > few_links).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # The link to the smallest node ties the node itself, any other ties its other end.
        small = _with_least(large, now[0] > few_links).select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        pairs = stored(small, "links", now[0])
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
