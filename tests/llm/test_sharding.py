"""Uniform shuffle: exact sizes, the law of the draws, odd rows."""

import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from aerolake.llm import sharding


@pytest.mark.parametrize("total,good,draws", [(10, 5, 3), (7, 6, 5), (100, 12, 40), (300, 37, 210)])
def test_draws_follow_the_hypergeometric_law(spark, total, good, draws):
    n = 20000
    x = spark.range(n).select(sharding.hypergeometric(F.lit(total), F.lit(good), F.lit(draws), F.lit(11), F.col("id")).alias("x"))
    found = {r["x"]: r["count"] for r in x.groupBy("x").count().collect()}
    low, high = max(0, draws - (total - good)), min(draws, good)
    assert set(found) <= set(range(low, high + 1))
    chi, cells = 0.0, 0
    for k in range(low, high + 1):
        expected = n * math.comb(good, k) * math.comb(total - good, draws - k) / math.comb(total, draws)
        if expected > 5:
            chi, cells = chi + (found.get(k, 0) - expected) ** 2 / expected, cells + 1
    assert chi < cells + 5 * math.sqrt(2 * cells)


def test_degenerate_draws(spark):
    cases = [(0, 0, 0, 0), (5, 0, 3, 0), (5, 5, 3, 3), (5, 2, 5, 2), (5, 2, 0, 0)]
    rows = spark.createDataFrame(cases, "t long, g long, d long, want long")
    got = rows.select("want", sharding.hypergeometric(F.col("t"), F.col("g"), F.col("d"), F.lit(1)).alias("x")).collect()
    assert all(r["x"] == r["want"] for r in got)


def test_matrix_has_exact_margins(spark):
    sizes = [100 + i for i in range(150)]
    blocks = spark.createDataFrame(list(enumerate(sizes)), "block long, rows long")
    lines = {r["block"]: r["line"] for r in sharding.communication_matrix(blocks, sum(sizes), len(sizes), 8, 3, fan_out=8).collect()}
    assert [sum(lines[b]) for b in range(150)] == sizes
    columns = np.array([lines[b] for b in range(150)]).sum(axis=0)
    assert columns.max() - columns.min() <= 1


def test_every_row_has_its_own_slot(spark):
    rows = [(i if i % 5 else None, None if i % 7 == 0 else "x" * (i % 3), i) for i in range(997)] + [(1, "same", 0)] * 500
    docs = spark.createDataFrame(rows, "doc_id long, text string, Shard int").repartition(5)
    out = sharding.shuffle_into_shards(docs, 7, block_bits=4, bucket_rows=20)
    assert out.columns == ["doc_id", "text", "shard", "slot"]
    got = out.toPandas()
    assert len(got) == len(rows)
    sizes = got.groupby("shard").size()
    assert sorted(sizes.index) == list(range(7)) and sizes.max() - sizes.min() <= 1
    assert all(sorted(g["slot"]) == list(range(len(g))) for _, g in got.groupby("shard"))


def test_shuffle_is_even(spark):
    docs = spark.range(8000).withColumnRenamed("id", "doc_id")
    got = sharding.shuffle_into_shards(docs, 4, block_bits=8, bucket_rows=300).toPandas()
    # Neighbours of the input are in the same shard one time in four, and order is lost.
    got = got.sort_values("doc_id")
    same = (got["shard"].to_numpy()[1:] == got["shard"].to_numpy()[:-1]).mean()
    assert abs(same - 0.25) < 0.03
    assert abs(np.corrcoef(got["doc_id"], got["slot"])[0, 1]) < 0.05


def test_digest(spark):
    docs = spark.createDataFrame([(1, "é"), (2, None), (None, "")], "doc_id long, text string")
    got = {r["doc_id"]: r for r in sharding.shard_digest(docs).collect()}
    assert got[1]["size"] == 3 and got[1]["text_crc32"] == zlib.crc32("é".encode())
    assert got[2]["size"] == 1 and got[2]["text_crc32"] == 0 and got[None]["size"] == 1
    assert {r["law"] for r in got.values()} == {"rows"} and all(r["grown_shard"] is None for r in got.values())


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert sharding.shard_digest(docs).count() == 0


def test_files_of_shards(spark, tmp_path):
    docs = spark.createDataFrame([(i, "t%d" % i) for i in range(50)], "doc_id long, text string")
    sharding.write_shards(docs, str(tmp_path / "out"), 4)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 50 and sorted(back.columns) == ["doc_id", "shard", "slot", "text"]
