"""Landed API snapshots: one JSON body per file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolake.functions.json import json_value

# Longer than any feed lasts: a backlog is read whole, whatever its files' dates.
MAX_AGE = "36500d"

_LISTED = "states ARRAY<STRING>, _corrupt STRING"


def read_snapshots(spark: SparkSession, path: str) -> DataFrame:
    """Columns snapshot_id (the file) and body."""
    files = spark.read.text(path, wholetext=True)
    return files.select(F.col("_metadata.file_path").alias("snapshot_id"), F.col("value").alias("body"))


def read_snapshots_stream(
    spark: SparkSession, path: str, max_files: int | None = None, max_age: str = MAX_AGE
) -> DataFrame:
    """The same as files land. Files older than ``max_age`` before the newest one seen are left out."""
    reader = spark.readStream.option("maxFileAge", max_age)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    files = reader.text(path, wholetext=True)
    return files.select(F.col("_metadata.file_path").alias("snapshot_id"), F.col("value").alias("body"))


def _listed(body: Column) -> Column:
    """The elements of ``states`` as JSON texts, for bodies that are no VARIANT as a whole.

    That is so for bodies over the size a VARIANT may have and for repeated names, of which the
    last counts.
    """
    return F.from_json(body, _LISTED, {"columnNameOfCorruptRecord": "_corrupt"})


def state_arrays(body: Column) -> Column:
    """ARRAY<VARIANT> of the elements of ``states``; null if there is no such list."""
    whole = json_value(body)
    one_by_one = F.transform(_listed(body)["states"], lambda element: F.try_parse_json(element))
    return F.when(whole.isNotNull(), F.try_variant_get(whole, "$.states", "array<variant>")).otherwise(one_by_one)


def body_reason(body: Column) -> Column:
    """Why a body cannot be read at all; null for a good one, be it without states."""
    whole, listed = json_value(body), _listed(body)
    states = F.try_variant_get(whole, "$.states", "variant")
    kind = F.coalesce(F.schema_of_variant(states), F.lit("VOID"))
    return F.when(
        whole.isNotNull(),
        F.when(~F.schema_of_variant(whole).startswith("OBJECT"), "body_not_an_object")
        .when((kind != "VOID") & ~kind.startswith("ARRAY"), "states_not_a_list"),
    ).when(listed.isNull() | listed["_corrupt"].isNotNull(), "body_unreadable")


def quarantined_bodies(snapshots: DataFrame) -> DataFrame:
    """Bodies that cannot be read: snapshot_id, null pos, reject_reason and the body as ``raw``."""
    return snapshots.select(
        "snapshot_id", F.lit(None).cast("int").alias("pos"), body_reason(F.col("body")).alias("reject_reason"), F.col("body").alias("raw")
    ).where("reject_reason IS NOT NULL")


def explode_states(snapshots: DataFrame, keep_empty: bool = False) -> DataFrame:
    """One row (snapshot_id, pos, raw) per element of ``states``, in array order.

    ``raw`` is a VARIANT, so an element of any shape passes. Missing or null ``states``
    give no row, or with ``keep_empty`` one with null ``pos``. So do unreadable bodies, which
    ``quarantined_bodies`` lists.
    """
    explode = F.posexplode_outer if keep_empty else F.posexplode
    return snapshots.select("snapshot_id", explode(state_arrays(F.col("body"))).alias("pos", "raw"))
