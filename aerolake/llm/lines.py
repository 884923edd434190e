"""Line deduplication over levelled sorted runs of line hashes.

A run is a table of (key, docs, last, fresh), bucketed by key and sorted in each bucket: a line's hash, how
many documents of the run hold it, the largest of their ids, and whether no run before held it. A batch
of documents is merge-joined with all runs: its lines that no run knows are fresh, the rest adds to what is
known. Both form the batch's own run of level 0; when a level has ``fan_in`` runs, they are
compacted into one run of the next level. Old runs are never shuffled or sorted again, since all have the
same buckets.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolake.llm.common import BLANKS, by_frame, ready, shared_dir, stored, without

MIN_LENGTH = 20
MIN_DOCS = 3
BATCHES = 4
FAN_IN = 2

_BLANK_BYTES = BLANKS.encode()

#: The setting by which bucketed tables are merged in the order in which they lie.
_ORDER = "spark.sql.legacy.bucketedTableScan.outputOrdering"


def line_key(line: bytes, min_length: int) -> bytes | None:
    """The hash of a line without outer blanks and with A-Z in lower case; None for a short one."""
    line = line.strip(_BLANK_BYTES)
    if len(line) < min_length or not line.isascii() and len(line.decode()) < min_length:
        return None
    return xxhash.xxh3_128_digest(line.lower())


class LineRuns:
    """The runs of all documents seen, in a shared folder, which may be opened again by another session.

    ``manifest/<n>`` says which runs count after step n, so a step that fails leaves what was before. The
    number of buckets is that of the session's shuffle partitions when the folder is new, and stays.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, fan_in: int = FAN_IN) -> None:
        self.spark, self.fan_in = ready(spark), fan_in
        self.path = path or shared_dir(spark, "line-runs")
        self.levels: list[list[str]] = [[]]
        self.written, self.kind = 0, None
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self._reopen()

    def _folder(self, name: str):
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return path, path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _reopen(self) -> None:
        folder, files = self._folder("manifest")
        if not files.exists(folder):
            return
        steps = [int(f.getPath().getName()) for f in files.listStatus(folder) if files.exists(self._folder(f"manifest/{f.getPath().getName()}/_SUCCESS")[0])]
        if steps:
            self.written = max(steps)
            state = self.spark.read.json(f"{self.path}/manifest/{self.written}").first()
            self.buckets, self.kind = state["buckets"], state["kind"]
            self.levels = [list(level) for level in state["levels"]]

    def _record(self) -> None:
        """What counts from now on; runs that no longer do are deleted."""
        state = self.spark.createDataFrame([(self.buckets, self.kind, self.levels)], "buckets int, kind string, levels array<array<string>>")
        state.coalesce(1).write.mode("overwrite").json(f"{self.path}/manifest/{self.written}")
        folder, files = self._folder("runs")
        live = {run for level in self.levels for run in level}
        for found in files.listStatus(folder):
            if found.getPath().getName() not in live:
                files.delete(found.getPath(), True)

    def open(self, run: str) -> DataFrame:
        """The rows of a run, with its buckets and their order known to Spark."""
        table = f"line_run_{uuid.uuid4().hex}"
        columns = f"key BINARY, docs BIGINT, last {self.kind}, fresh BOOLEAN"
        self.spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet CLUSTERED BY (key) SORTED BY (key) INTO {self.buckets} BUCKETS LOCATION '{self.path}/runs/{run}'")
        rows = self.spark.table(table)
        self.spark.sql(f"DROP TABLE {table}")  # of the name only: the files stay
        return rows

    def _write(self, rows: DataFrame, level: int) -> None:
        self.written += 1
        run, table = f"{self.written}-level-{level}", f"line_run_{uuid.uuid4().hex}"
        placed = rows.select("key", "docs", "last", "fresh").write.bucketBy(self.buckets, "key").sortBy("key").option("compression", "zstd")
        placed.mode("overwrite").option("path", f"{self.path}/runs/{run}").saveAsTable(table)
        self.spark.sql(f"DROP TABLE {table}")
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(run)

    @contextmanager
    def _in_order(self) -> Iterator[None]:
        """Lets Spark rely on the order of a bucket's file while a step runs."""
        before = self.spark.conf.get(_ORDER, "false")
        self.spark.conf.set(_ORDER, "true")
        try:
            yield
        finally:
            self.spark.conf.set(_ORDER, before)

    def add(self, lines: DataFrame) -> None:
        """Adds a batch of (doc_id, key), each pair once, of documents not added before."""
        self.kind = self.kind or lines.schema["doc_id"].dataType.simpleString()
        batch = lines.groupBy("key").agg(F.count(F.lit(1)).alias("docs"), F.max("doc_id").alias("last"))
        fresh = F.lit(True)
        with self._in_order():
            for n, run in enumerate(run for level in self.levels for run in level):
                known = self.open(run).where("fresh").select("key", F.lit(True).alias(f"known{n}"))
                batch = batch.join(known.hint("merge"), "key", "left")
                fresh = fresh & F.col(f"known{n}").isNull()
            self._write(batch.withColumn("fresh", fresh), 0)
            self._record()
            level = 0
            while len(self.levels[level]) >= self.fan_in:
                merged = self._merged(self.levels[level])
                self.levels[level] = []
                level += 1
                self._write(merged, level)
                self._record()

    def _merged(self, runs: list[str]) -> DataFrame:
        """One row for each key of these runs: two runs are merged as they lie, more also shuffle what they make."""
        rows = self.open(runs[0])
        for run in runs[1:]:
            own, other = rows.alias("a"), self.open(run).alias("b")
            both = own.join(other.hint("merge"), F.col("a.key") == F.col("b.key"), "full")
            rows = both.select(
                F.coalesce("a.key", "b.key").alias("key"),
                (F.coalesce("a.docs", F.lit(0)) + F.coalesce("b.docs", F.lit(0))).alias("docs"),
                F.greatest("a.last", "b.last").alias("last"),
                (F.coalesce("a.fresh", F.lit(False)) | F.coalesce("b.fresh", F.lit(False))).alias("fresh"),
            )
        return rows

    def repeated(self, min_docs: int = MIN_DOCS) -> DataFrame:
        """(key, last) of lines that at least so many documents hold."""
        runs = [run for level in self.levels for run in level]
        return self._merged(runs).where(F.col("docs") >= min_docs).select("key", "last")


def line_keys(docs: DataFrame, min_length: int = MIN_LENGTH) -> DataFrame:
    """(doc_id, key): each line key of a document once. Rows without an id have none."""

    def keys(frame: pd.DataFrame) -> pd.DataFrame:
        ids, found = [], []
        for doc_id, text in zip(frame["doc_id"], frame["text"]):
            own = {line_key(line, min_length) for line in text.encode().split(b"\n")} - {None}
            ids += [doc_id] * len(own)
            found += own
        return pd.DataFrame({"doc_id": pd.Series(ids, dtype=frame["doc_id"].dtype), "key": pd.Series(found, dtype=object)})

    rows = docs.where(F.col("doc_id").isNotNull() & (F.length("text") >= min_length)).select("doc_id", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return by_frame(rows, keys, f"doc_id {kind}, key binary").dropDuplicates()


def _kept(min_length: int) -> Column:
    """(text, n_dropped) of rows with keys to drop; null for others, whose text isn't sent."""

    @F.pandas_udf("text string, n_dropped long")
    def kept(texts: pd.Series, drops: pd.Series) -> pd.DataFrame:
        out, counts = [], []
        for text, drop in zip(texts, drops):
            if text is None or drop is None:
                out.append(None), counts.append(0)
                continue
            gone = {bytes(k) for k in drop}
            lines = text.encode().split(b"\n")
            stay = [line for line in lines if line_key(line, min_length) not in gone]
            out.append(b"\n".join(stay).decode())
            counts.append(len(lines) - len(stay))
        return pd.DataFrame({"text": pd.Series(out, dtype=object), "n_dropped": pd.Series(counts, dtype="int64")})

    return kept(F.when(F.col("__drops").isNotNull(), F.col("text")), F.col("__drops"))


def dedup_lines(docs: DataFrame, min_length: int = MIN_LENGTH, min_docs: int = MIN_DOCS, batches: int = BATCHES, fan_in: int = FAN_IN) -> DataFrame:
    """Each row of docs with kept_text, n_lines and n_dropped.

    Lines whose key has at least min_length code points and is found in at least min_docs
    documents go, except all those of the largest doc_id that holds it. A document is what has
    one doc_id: rows that share an id count once and keep or lose lines alike. Rows without
    an id aren't counted and keep all lines. A null or empty text is one empty line and its
    kept_text is empty. A text whose lines all go is empty, too. Columns of the input that are
    named like the new ones are replaced; others are kept. An empty table gives no rows.
    """
    spark = ready(docs.sparkSession)
    docs = without(docs, "kept_text", "n_lines", "n_dropped", "__drops")
    lines = stored(line_keys(docs, min_length), "line-keys")
    runs = LineRuns(spark, fan_in=fan_in)
    for b in range(batches):
        runs.add(lines.where(F.pmod(F.xxhash64("doc_id"), F.lit(batches)) == b))
    with runs._in_order():
        repeated = stored(runs.repeated(min_docs), "lines-repeated")
    drops = (
        lines.join(repeated, "key")
        .where(F.col("doc_id") != F.col("last"))
        .groupBy("doc_id")
        .agg(F.collect_list("key").alias("__drops"))
    )
    text = F.coalesce(F.col("text"), F.lit(""))
    n_lines = F.octet_length(text) - F.octet_length(F.replace(text, F.lit("\n"), F.lit(""))) + 1
    return (
        docs.join(drops, "doc_id", "left")
        .withColumn("__kept", _kept(min_length))
        .select(
            *[F.col(f"`{c}`") for c in docs.columns],
            F.coalesce(F.col("__kept.text"), text).alias("kept_text"),
            n_lines.cast("long").alias("n_lines"),
            F.coalesce(F.col("__kept.n_dropped"), F.lit(0)).cast("long").alias("n_dropped"),
        )
    )


def line_digest(docs: DataFrame) -> DataFrame:
    return dedup_lines(docs.select("doc_id", "text")).select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))
