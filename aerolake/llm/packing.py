"""Harmonic packing of token sequences.

A piece of length n belongs to class k, the largest k with k * n <= capacity, and a bin of
class k holds k pieces. A document gives whole sequences while it lasts; its rest stays
whole where it fills its class well, else a piece of exactly the next class's length is cut off
and the rest goes on. Each worker fills bins by itself. What stays in its open bins, less than k pieces of
class k, goes to groups of workers, which do the same; at last less than a bin for
each class is left and packed into the fullest bin that has room.
"""

from __future__ import annotations

import json
import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from aerolake.llm.bpe import Codec, codec
from aerolake.llm.common import ready, stored

CAPACITY = 1024
END = 0
#: A rest stays whole if it fills this share of the room that its class gives.
WHOLE = 0.98
#: Workers whose open bins are merged by one task.
FAN_IN = 16


def cuts(total: int, capacity: int = CAPACITY, whole: float = WHOLE) -> list[tuple[int, int, int]]:
    """(start, length, class) of the pieces of a document, in order."""
    out = [(at, capacity, 1) for at in range(0, total - capacity + 1, capacity)]
    at, rest = len(out) * capacity, total % capacity
    while rest:
        k = capacity // rest
        if rest < whole * (capacity // k) and (part := capacity // (k + 1)) < rest:
            out.append((at, part, k + 1))
            at, rest = at + part, rest - part
        else:
            out.append((at, rest, k))
            rest = 0
    return out


class Filler:
    """The open bins of one worker, one for each class."""

    def __init__(self) -> None:
        self.open: dict[int, list[tuple]] = {}
        self.closed = 0

    def put(self, piece: tuple, length: int, k: int) -> list[tuple[tuple, int, int]] | None:
        """The pieces of the bin that this one closes, each with the bin's number and its offset."""
        content = self.open.setdefault(k, [])
        content.append((piece, length))
        if len(content) < k:
            return None
        del self.open[k]
        out, offset = [], 0
        for own, size in content:
            out.append((own, self.closed, offset))
            offset += size
        self.closed += 1
        return out


def _sequence(level: int, worker: int, number: int) -> int:
    return level << 60 | worker << 33 | number


class Added:
    """The added tokens of a vocabulary file of the tokenizers library, which it takes out of a text before anything else."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            tokens = json.load(file)["added_tokens"]
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in tokens):
            raise ValueError(f"{path}: added tokens that don't match just their own text")
        self.ids = {t["content"]: t["id"] for t in tokens}
        self.pattern = re.compile("(" + "|".join(map(re.escape, sorted(self.ids, key=len, reverse=True))) + ")") if tokens else None

    def encode(self, codec: Codec, text: str) -> list[int]:
        """The ids of added tokens where they stand, and of the stretches between, each encoded by itself."""
        if self.pattern is None or self.pattern.search(text) is None:
            return codec.encode(text)
        out: list[int] = []
        for i, part in enumerate(self.pattern.split(text)):
            out += [self.ids[part]] if i % 2 else codec.encode(part)
        return out


def added_path() -> str:
    """The file whose added tokens the queries count as such."""
    return public_tokenizers.path("byte_bpe_50k.json")


@lru_cache(maxsize=1)
def _added(path: str) -> Added:
    return Added(path)


def _pieces(docs: DataFrame, path: str, added: str | None, end_id: int, capacity: int, with_ids: bool) -> DataFrame:
    """Cut documents, with the sequence and offset of each piece in a bin that its worker filled."""
    ready(docs.sparkSession)
    names = ["start", "length", "ids_crc32", "doc_tokens", "k", "worker", "serial", "sequence_id", "offset"]
    fields = [docs.schema["doc_id"], *[StructField(n, LongType()) for n in names]] + [StructField("ids", BinaryType())] * with_ids
    kind = to_arrow_type(docs.schema["doc_id"].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker, serial, filler = TaskContext.get().partitionId(), 0, Filler()

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows)) if rows else [()] * len(fields)
            kinds = [kind] + [pa.int64()] * len(names) + [pa.binary()] * with_ids
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=[f.name for f in fields])

        def row(piece: tuple, sequence: int | None, offset: int | None) -> tuple:
            return (*piece[:8], sequence, offset, *piece[8:])

        for batch in batches:
            out = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = _added(added).encode(codec(path), text or "") if added else codec(path).encode(text or "")
                ids.append(end_id)
                data = np.array(ids, dtype="<u4")
                for start, length, k in cuts(len(ids), capacity):
                    part = data[start : start + length].tobytes()
                    piece = (doc_id, start, length, zlib.crc32(part), len(ids), k, worker, serial) + (part,) * with_ids
                    serial += 1
                    for own, number, offset in filler.put(piece, length, k) or ():
                        out.append(row(own, _sequence(0, worker, number), offset))
            yield batch_of(out)
        yield batch_of([row(own, None, None) for content in filler.open.values() for own, _ in content])

    return docs.select("doc_id", "text").mapInArrow(run, StructType(fields))


_PLACED = "worker long, serial long, length long, k long, sequence_id long, offset long"


def _merged(left: DataFrame, level: int) -> DataFrame:
    """The open pieces of groups of workers, put into bins again."""

    def fill(group: pd.DataFrame) -> pd.DataFrame:
        filler, place = Filler(), {}
        worker = int(group["__group"].iloc[0])
        group = group.sort_values(["worker", "serial"], ignore_index=True)
        for i, (length, k) in enumerate(zip(group["length"].tolist(), group["k"].tolist())):
            for own, number, offset in filler.put((i,), length, k) or ():
                place[own[0]] = (_sequence(level, worker, number), offset)
        rows = [place.get(i, (None, None)) for i in range(len(group))]
        group["sequence_id"] = pd.array([a for a, _ in rows], dtype="Int64")
        group["offset"] = pd.array([b for _, b in rows], dtype="Int64")
        return group.drop(columns="__group")

    schema = f"{_PLACED}, parent long"
    return left.withColumn("__group", F.floor(F.col("parent") / FAN_IN)).groupBy("__group").applyInPandas(fill, schema)


def _last(left: DataFrame, level: int, capacity: int) -> DataFrame:
    """The last open pieces: fewer than a bin of each class, so less than capacity squared tokens in all."""

    def fit(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["length", "worker", "serial"], ascending=[False, True, True], ignore_index=True)
        room: list[tuple[int, int]] = []
        place, bins = [], 0
        for length in group["length"].tolist():
            at = bisect_left(room, (length, -1))
            free, number = room.pop(at) if at < len(room) else (capacity, bins)
            bins += number == bins
            place.append((_sequence(level, 0, number), capacity - free))
            insort(room, (free - length, number))
        group["sequence_id"], group["offset"] = [a for a, _ in place], [b for _, b in place]
        return group[["worker", "serial", "length", "k", "sequence_id", "offset"]]

    return left.withColumn("__group", F.lit(0)).groupBy("__group").applyInPandas(fit, _PLACED)


def pack(docs: DataFrame, capacity: int = CAPACITY, end_id: int = END, path: str | None = None, with_ids: bool = False, added: str | None = None) -> DataFrame:
    """A row for each piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id and offset, with ids on demand.

    A document is the tokens of its text and end_id. Strings of special tokens are ordinary
    text, unless ``added`` names a vocabulary file of the tokenizers library: then its added tokens get
    their ids, as that library gives them. A null or empty text is end_id alone. Pieces of a document cover its tokens once; those of
    a sequence lie side by side from 0 and have capacity tokens at most. Rows with the same or no
    doc_id are packed each. Other columns of the input are left out. An empty table gives no rows.
    """
    path = path or public_tokenizers.path("byte_bpe_50k.tiktoken")
    pieces = stored(_pieces(docs, path, added, end_id, capacity, with_ids), "pieces")
    left = pieces.where(F.col("sequence_id").isNull()).select("worker", "serial", "length", "k", F.col("worker").alias("parent"))
    workers = (pieces.agg(F.max("worker")).first()[0] or 0) + 1
    level, placed = 1, []
    while workers > 1:
        merged = stored(_merged(left, level), "packed")
        placed.append(merged.where(F.col("sequence_id").isNotNull()).drop("parent"))
        left = merged.where(F.col("sequence_id").isNull()).select("worker", "serial", "length", "k", F.floor(F.col("parent") / FAN_IN).alias("parent"))
        workers = -(-workers // FAN_IN)
        level += 1
    placed.append(_last(left, level, capacity))
    late = placed[0]
    for more in placed[1:]:
        late = late.unionByName(more)
    result = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] + ["ids"] * with_ids
    early = pieces.where(F.col("sequence_id").isNotNull()).select(result)
    rest = pieces.where(F.col("sequence_id").isNull()).drop("sequence_id", "offset", "length", "k").join(late, ["worker", "serial"])
    return early.unionByName(rest.select(result))
