"""Token files against the tokenizers library, and what a selective read touches."""

import glob
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from aerolake.llm import tokenfile

ADDED = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(ADDED)


def brute(rows, library):
    out, start = [], 0
    for doc_id, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids + [0]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    return out


def test_token_digest(spark, library):
    rnd = random.Random(13)
    words = ["the", "naïve", "日本", "<|endoftext|>", "12,345", "it's", "x" * 90, "\n\n", "  ", "🙂"]
    rows = [(i * 7 - 300, " ".join(rnd.choices(words, k=rnd.randint(0, 60)))) for i in range(300)]
    rows += [(10_000, None), (10_001, ""), (10_002, "word " * 40_000), (10_003, "y" * 20_000)]
    rnd.shuffle(rows)
    docs = spark.createDataFrame([(*r, 1, "clash") for r in rows], "doc_id long, text string, start int, ids string").repartition(5)
    found = tokenfile.token_digest(docs)
    assert found.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert sorted(map(tuple, found.collect())) == brute(sorted(rows), library)


def test_rows_that_share_an_id(spark, library):
    rows = [(5, f"text {i}") for i in range(2000)] + [(5, "same")] * 2000 + [(1, "first"), (None, "none"), (9, "last")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = sorted(map(tuple, tokenfile.token_digest(docs).collect()), key=lambda r: r[1])
    assert [r[0] for r in got] == [None, 1, *[5] * 4000, 9]
    assert all(a[1] + a[2] == b[1] for a, b in zip(got, got[1:]))
    whole = {(r[2], r[3]) for r in brute(rows, library)}
    assert sorted(r[2:] for r in got) == sorted(r[2:] for r in brute(rows, library)) and {r[2:] for r in got} == whole


def test_empty_table(spark, tmp_path):
    tokenfile.write_tokens(spark.createDataFrame([], "doc_id long, text string"), str(tmp_path / "t"))
    assert tokenfile.read_tokens(spark, str(tmp_path / "t")).count() == 0


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tokens") / "t")
    docs = spark.range(6000).select(F.col("id").alias("doc_id"), F.concat_ws(" ", F.transform(F.sequence(F.lit(1), F.lit(60)), lambda k: F.xxhash64(F.col("id"), k).cast("string"))).alias("text"))
    tokenfile.write_tokens(docs, path, row_group=1 << 18, page=1 << 14, page_rows=100)
    return path


def test_encodings_row_groups_and_pages(folder):
    files = sorted(glob.glob(f"{folder}/tokens/*.parquet"))
    seen = []
    for name in files:
        meta = pq.ParquetFile(name).metadata
        for g in range(meta.num_row_groups):
            group = meta.row_group(g)
            columns = {group.column(c).path_in_schema: group.column(c) for c in range(group.num_columns)}
            assert group.total_byte_size < 1 << 20
            assert "RLE_DICTIONARY" in columns["ids.list.element"].encodings
            assert "DELTA_BINARY_PACKED" in columns["doc_id"].encodings and "DELTA_BINARY_PACKED" in columns["before"].encodings
            assert all(c.has_offset_index and c.has_column_index for c in columns.values())
            seen.append((columns["doc_id"].statistics.min, columns["doc_id"].statistics.max))
    assert len(seen) > len(files)
    seen.sort()
    assert all(a[1] < b[0] for a, b in zip(seen, seen[1:]))


def test_selective_reads(spark, folder):
    few = tokenfile.read_tokens(spark, folder, F.col("doc_id").between(3000, 3009))
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(doc_id,3000)" in plan
    whole = {r["doc_id"]: r for r in tokenfile.read_tokens(spark, folder).collect()}
    assert sorted(map(tuple, few.collect())) == sorted(tuple(whole[i]) for i in range(3000, 3010))
    counts = tokenfile.read_tokens(spark, folder, tokens=False)
    assert "ids" not in counts._jdf.queryExecution().executedPlan().toString()
    assert counts.agg(F.sum("n_tokens")).first()[0] == sum(r["n_tokens"] for r in whole.values())
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows = tokenfile.read_tokens(spark, folder, F.col("doc_id") == 4321)
        rows.collect()
        leaves = rows._jdf.queryExecution().executedPlan().collectLeaves()
        read = [leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()) if "/t/tokens" in leaves.apply(i).toString()]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    # Of 6,000 rows, those of a few pages of 100 are read.
    assert len(read) == 1 and 0 < read[0] <= 300
