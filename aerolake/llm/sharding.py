"""Uniform shuffle into shards of exact size, by a hypergeometric communication matrix.

How many rows of each input block go to each shard is drawn first, from the exact law that a
uniform permutation of all rows has. Each block then permutes its rows and deals them out by
its line of the matrix, and each shard permutes what it got. Only columns functions run; no
task holds more than a block, a bucket or ``fan_out`` lines of the matrix.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from aerolake.llm.common import let, stored, without

#: Rows of a block: consecutive rows of one input partition, at most 2 ** BLOCK_BITS.
BLOCK_BITS = 16
#: Children of a node of the tree that splits shard sizes among blocks.
FAN_OUT = 64
#: Mean rows of a bucket of the second permutation.
BUCKET_ROWS = 8192
#: Draws of a pair of uniforms; each is accepted with a probability over one half.
ATTEMPTS = 64

# Constants of Stadlober's ratio-of-uniforms hat, 2 sqrt(2/e) and 3 - 2 sqrt(3/e).
HAT_SLOPE = 2 * math.sqrt(2 / math.e)
HAT_SHIFT = 3 - 2 * math.sqrt(3 / math.e)


def log_factorial(n: Column) -> Column:
    """Exact up to 20, then Stirling's series, whose error is below 1e-12 there."""
    x = n.cast("double") + 1
    series = (
        (x - 0.5) * F.log(x) - x + 0.5 * math.log(2 * math.pi)
        + 1 / (12 * x) - 1 / (360 * x * x * x) + 1 / (1260 * x * x * x * x * x)
    )
    small = F.log(F.factorial(F.greatest(F.least(n, F.lit(20)), F.lit(0)).cast("int")).cast("double"))
    return F.when(n <= 20, small).otherwise(series)


def uniform(*salt: Column) -> Column:
    """In (0, 1), fixed by the salt."""
    return (F.shiftrightunsigned(F.xxhash64(*salt), 11).cast("double") + 0.5) / float(1 << 53)


def hypergeometric(total: Column, good: Column, draws: Column, *salt: Column) -> Column:
    """How many of ``draws`` rows, taken without replacement from ``total``, are among ``good``.

    Ratio of uniforms with the exact probabilities; salt fixes the result. If the range has
    one value, that is the result.
    """

    def draw(p: Column) -> Column:
        total, good, draws = (p[k].cast("double") for k in ("total", "good", "draws"))
        share = good / total
        spread = F.sqrt(draws * share * (1 - share) * (total - draws) / (total - 1) + 0.5)

        def height(z: Column) -> Column:
            rest = p["total"] - p["good"] - p["draws"]
            return log_factorial(z) + log_factorial(p["good"] - z) + log_factorial(p["draws"] - z) + log_factorial(rest + z)

        mode = F.floor((draws + 1) * (good + 1) / (total + 2))
        settings = F.struct(
            (draws * share + 0.5).alias("centre"), (HAT_SLOPE * spread + HAT_SHIFT).alias("width"), height(mode).alias("top"), mode.alias("mode")
        )

        def tried(s: Column) -> Column:
            def attempt(i: Column) -> Column:
                u, v = uniform(*salt, i, F.lit(1)), uniform(*salt, i, F.lit(2))
                return let(
                    F.struct(u.alias("u"), F.floor(s["centre"] + s["width"] * (v - 0.5) / u).alias("z")),
                    lambda t: F.when(
                        (t["z"] >= p["low"]) & (t["z"] <= p["high"]),
                        F.when(2 * F.log(t["u"]) <= s["top"] - height(t["z"]), t["z"]),
                    ),
                )

            found = F.aggregate(
                F.sequence(F.lit(1), F.lit(ATTEMPTS)), F.lit(None).cast("long"), lambda a, i: F.when(a.isNotNull(), a).otherwise(attempt(i))
            )
            return F.coalesce(found, s["mode"])

        return F.when(p["low"] >= p["high"], p["low"]).otherwise(let(settings, tried))

    return let(
        F.struct(
            total.cast("long").alias("total"), good.cast("long").alias("good"), draws.cast("long").alias("draws"),
            F.greatest(F.lit(0), draws - (total - good)).cast("long").alias("low"), F.least(draws, good).cast("long").alias("high"),
        ),
        draw,
    )


def _dealt(left: Column, rows: Column, *salt: Column) -> Column:
    """A block's line of the matrix: how many of its rows go to each shard, of which ``left`` are free."""
    start = F.struct(rows.cast("long").alias("rows"), F.aggregate(left, F.lit(0).cast("long"), lambda a, x: a + x).alias("free"), F.array().cast("array<long>").alias("line"))

    def next_shard(a: Column, good: Column) -> Column:
        return let(
            hypergeometric(a["free"], good, a["rows"], *salt, F.size(a["line"])),
            lambda x: F.struct((a["rows"] - x).alias("rows"), (a["free"] - good).alias("free"), F.concat(a["line"], F.array(x)).alias("line")),
        )

    return F.aggregate(left, start, next_shard)["line"]


def communication_matrix(blocks: DataFrame, n_rows: int, n_blocks: int, shards: int, seed: int, fan_out: int = FAN_OUT) -> DataFrame:
    """(block, line): for block numbers from 0 and their ``rows``, the rows that go to each shard.

    A tree over the blocks: the root has the shard sizes, a node deals what it has to its
    children one after the other, ``fan_out`` at most, so no task sees all blocks.
    """
    spark = blocks.sparkSession
    sizes = [n_rows // shards + (s < n_rows % shards) for s in range(shards)]
    lines = spark.range(1).select(F.lit(0).cast("long").alias("node"), F.array(*[F.lit(x).cast("long") for x in sizes]).alias("line"))
    depth = max(1, math.ceil(math.log(max(n_blocks, 2)) / math.log(fan_out) - 1e-9))
    for level in range(depth - 1, -1, -1):
        step = fan_out**level
        children = (
            blocks.groupBy(F.floor(F.col("block") / step).alias("child"))
            .agg(F.sum("rows").alias("rows"))
            .groupBy(F.floor(F.col("child") / fan_out).alias("node"))
            .agg(F.sort_array(F.collect_list(F.struct("child", "rows"))).alias("children"))
        )
        start = F.struct(F.col("line").alias("left"), F.array().cast("array<struct<child:bigint,line:array<bigint>>>").alias("out"))

        def next_child(a: Column, child: Column) -> Column:
            line = _dealt(a["left"], child["rows"], F.lit(seed), F.lit(step), child["child"])
            return let(
                line,
                lambda x: F.struct(
                    F.zip_with(a["left"], x, lambda p, q: p - q).alias("left"),
                    F.concat(a["out"], F.array(F.struct(child["child"].alias("child"), x.alias("line")))).alias("out"),
                ),
            )

        lines = (
            lines.join(children, "node")
            .select(F.explode(F.aggregate("children", start, next_child)["out"]).alias("x"))
            .select(F.col("x.child").alias("node"), F.col("x.line").alias("line"))
        )
    return lines.withColumnRenamed("node", "block")


def shuffle_into_shards(docs: DataFrame, shards: int = 8, seed: int = 7, block_bits: int = BLOCK_BITS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """All rows with ``shard`` (int, from 0) and ``slot`` (long, gapless from 0 within a shard).

    Law: ``rows``. Every permutation of the rows over the shards' slots is equally likely, and
    shard sizes differ by one at most. Nulls, empty and long texts and repeated rows are rows
    like any other; equal rows are dealt independently. An empty table gives no rows. Columns of
    the input named shard or slot are replaced, others are kept.

    The rows are stored once in the shared folder, so that a lost executor can't change a draw.
    Pass ids and join texts later where texts are long.
    """
    serial = F.monotonically_increasing_id()
    kept = without(docs, "shard", "slot", "__row")
    rows = stored(kept.withColumn("__row", serial), "shard-rows")
    ids = rows.select("__row", F.shiftright("__row", block_bits).alias("part"))
    sizes = stored(ids.groupBy("part").agg(F.count(F.lit(1)).alias("rows")).withColumn("block", F.row_number().over(Window.orderBy("part")) - F.lit(1).cast("long")), "shard-blocks")
    n_blocks, n_rows = sizes.agg(F.count(F.lit(1)), F.coalesce(F.sum("rows"), F.lit(0))).first()
    matrix = communication_matrix(sizes.select("block", "rows"), n_rows, n_blocks, shards, seed)
    start = F.struct(F.lit(0).cast("long").alias("sum"), F.array().cast("array<long>").alias("ends"))
    ends = F.aggregate("line", start, lambda a, x: F.struct((a["sum"] + x).alias("sum"), F.concat(a["ends"], F.array(a["sum"] + x)).alias("ends")))["ends"]
    ends = sizes.join(matrix, "block").select("part", ends.alias("ends"))
    local = Window.partitionBy("part").orderBy(F.xxhash64(F.lit(seed), F.lit("first"), "__row"), "__row")
    buckets = max(1, math.ceil(n_rows / shards / bucket_rows))
    second = F.xxhash64(F.lit(seed), F.lit("second"), "__row")
    dealt = (
        ids.withColumn("rank", F.row_number().over(local) - 1)
        .join(ends, "part")
        .select("__row", F.size(F.filter("ends", lambda e: e <= F.col("rank"))).alias("shard"), second.alias("key"))
        .withColumn("bucket", F.pmod("key", F.lit(buckets)))
    )
    dealt = stored(dealt, "shard-dealt")
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = dealt.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("rows")).select("shard", "bucket", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"))
    within = Window.partitionBy("shard", "bucket").orderBy("key", "__row")
    placed = (
        dealt.withColumn("rank", F.row_number().over(within) - 1)
        .join(offsets, ["shard", "bucket"])
        .select("__row", "shard", (F.col("offset") + F.col("rank")).cast("long").alias("slot"))
    )
    return rows.join(placed, "__row").drop("__row")


def write_shards(docs: DataFrame, path: str, shards: int = 8, seed: int = 7) -> None:
    """One folder for each shard, its rows in the order of their slots over its files."""
    placed = shuffle_into_shards(docs, shards, seed)
    placed.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def shard_digest(docs: DataFrame, shards: int = 8, seed: int = 7) -> DataFrame:
    """Sizes, checksums and places of documents; null texts count as empty."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    return shuffle_into_shards(rows, shards, seed).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
