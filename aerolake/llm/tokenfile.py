"""Token files: documents as lists of token ids in Parquet, for selective reads.

A table of tokens is a folder. ``tokens`` has a row for each document, in order of doc_id over all files: the
ids as a list column in dictionary encoding, ascending numbers in delta encoding, in row groups and
pages of bounded size with page indexes. So a range of documents reads few pages, and counts read no
tokens. ``parts`` has a row for each file's documents, with the number of ids before them: a document's place
in the whole is that of its part plus that in the part, so nothing but parts is ever summed up in one place.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType
from pyspark.sql.window import Window

from aerolake.llm.bpe import codec
from aerolake.llm.common import ready, shared_dir
from aerolake.llm.packing import Added

END = 0
#: Bytes of a row group and of a page, and rows of a page: what a selective read fetches at least.
ROW_GROUP_BYTES = 32 << 20
PAGE_BYTES = 1 << 20
PAGE_ROWS = 1000

_PLACES = ("part", "before", "n_tokens")


def _options(row_group: int, page: int, page_rows: int) -> dict[str, str]:
    ascending = {f"parquet.enable.dictionary#{name}": "false" for name in ("doc_id", "before")}
    return {
        "compression": "zstd",
        "parquet.writer.version": "v2",
        "parquet.block.size": str(row_group),
        "parquet.page.size": str(page),
        "parquet.page.row.count.limit": str(page_rows),
        "parquet.block.size.row.check.min": "10",
        "parquet.page.size.row.check.min": "10",
        **ascending,
    }


def _in_order(docs: DataFrame) -> DataFrame:
    """Documents in order of doc_id; rows that share one, however many, in order of their texts' hashes."""
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    spread = docs.select("doc_id", "text").repartitionByRange(*order, F.monotonically_increasing_id())
    return spread.sortWithinPartitions(*order)


def _encoded(docs: DataFrame, path: str, added: str | None, end_id: int) -> DataFrame:
    """doc_id, part, before (ids before it in its part), n_tokens and ids of documents that lie in order."""
    ready(docs.sparkSession)
    doc_id = docs.schema["doc_id"]
    fields = [doc_id, *[StructField(n, LongType()) for n in _PLACES], StructField("ids", ArrayType(IntegerType()))]
    kinds = [to_arrow_type(doc_id.dataType), *[pa.int64()] * 3, pa.list_(pa.int32())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before = TaskContext.get().partitionId(), 0
        special = Added(added) if added else None
        for batch in batches:
            rows = []
            for text in batch.column(1).to_pylist():
                ids = special.encode(codec(path), text or "") if special else codec(path).encode(text or "")
                rows.append(np.array([*ids, end_id], dtype=np.int32))
            sizes = np.array([len(r) for r in rows], dtype=np.int64)
            places = before + np.cumsum(sizes) - sizes
            before += int(sizes.sum())
            ends = pa.array(np.append(0, np.cumsum(sizes)), pa.int32())
            ids = pa.ListArray.from_arrays(ends, pa.array(np.concatenate(rows) if rows else np.zeros(0, np.int32)))
            columns = [batch.column(0), pa.array(np.full(len(rows), part)), pa.array(places), pa.array(sizes), ids]
            yield pa.RecordBatch.from_arrays([c.cast(k) for c, k in zip(columns, kinds)], names=[f.name for f in fields])

    return docs.mapInArrow(run, StructType(fields))


def write_tokens(
    docs: DataFrame, path: str, vocabulary: str | None = None, added: str | None = None, end_id: int = END,
    row_group: int = ROW_GROUP_BYTES, page: int = PAGE_BYTES, page_rows: int = PAGE_ROWS,
) -> None:
    """Writes the tokens of docs (doc_id, text) to a new folder ``path``.

    Ids are those of the text, whole, and end_id; a null or empty text is end_id alone. ``added`` names a vocabulary
    file whose added tokens count as such, else their strings are ordinary text. Documents lie in ascending
    order of doc_id, null first; rows that share an id are documents of their own, in order of their
    texts' hashes. Other columns are left out. An empty table gives an empty folder that can be read.
    """
    vocabulary = vocabulary or public_tokenizers.path("byte_bpe_50k.tiktoken")
    rows = _encoded(_in_order(docs), vocabulary, added, end_id)
    rows.write.options(**_options(row_group, page, page_rows)).parquet(f"{path}/tokens")
    spark = docs.sparkSession
    counts = spark.read.schema(rows.schema).parquet(f"{path}/tokens").groupBy("part").agg(
        F.count(F.lit(1)).alias("docs"), F.sum("n_tokens").alias("n_tokens"), F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id")
    )
    # A row for each task that wrote: the only numbers that are summed in one order.
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts.withColumn("start", F.coalesce(F.sum("n_tokens").over(earlier), F.lit(0))).coalesce(1).write.parquet(f"{path}/parts")


def read_tokens(spark: SparkSession, path: str, where: Column | None = None, tokens: bool = True) -> DataFrame:
    """doc_id, start, n_tokens and, if wanted, ids of the documents that meet a condition on doc_id.

    start is the number of ids before the document in the whole table. Only the pages that may hold such documents are
    read, and without ``tokens`` none of the ids.
    """
    parts = spark.read.parquet(f"{path}/parts").select("part", F.col("start").alias("part_start"))
    kind = spark.read.parquet(f"{path}/parts").schema["first_id"].dataType
    schema = StructType([StructField("doc_id", kind), *[StructField(n, LongType()) for n in _PLACES], StructField("ids", ArrayType(IntegerType()))])
    rows = spark.read.schema(schema).parquet(f"{path}/tokens")
    if where is not None:
        rows = rows.where(where)
    place = (F.col("part_start") + F.col("before")).alias("start")
    return rows.join(parts, "part").select("doc_id", place, "n_tokens", *["ids"] * tokens)


def with_crc32(rows: DataFrame) -> DataFrame:
    """Replaces ids by ids_crc32, the unsigned crc32 of all ids as little-endian unsigned 32-bit integers. Null ids have no bytes."""
    ready(rows.sparkSession)
    kept = [c for c in rows.columns if c != "ids"]
    schema = StructType([*rows.select(kept).schema.fields, StructField("ids_crc32", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(len(kept)).fill_null([])
            # The ids lie side by side in one buffer: no list is made of them.
            data = np.ascontiguousarray(lists.flatten().to_numpy().astype("<u4", copy=False)).view(np.uint8)
            ends = 4 * np.cumsum(lists.value_lengths().to_numpy())
            sums = [zlib.crc32(data[start:end]) for start, end in zip(np.append(0, ends).tolist(), ends.tolist())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(sums, pa.int64())], names=schema.names)

    return rows.select(*kept, "ids").mapInArrow(run, schema)


def token_digest(docs: DataFrame) -> DataFrame:
    path = shared_dir(docs.sparkSession, "tokens")
    write_tokens(docs, path, added=public_tokenizers.path("byte_bpe_50k.json"))
    return with_crc32(read_tokens(docs.sparkSession, path))
