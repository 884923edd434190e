"""Session settings and the shared working folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", app: str = "aerolake") -> SparkSession:
    """A session for tests and benchmarks; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def use_utc(spark: SparkSession) -> SparkSession:
    """Every rule of the library reads and prints times in UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for checkpoints and intermediate tables.

    It lies below ``spark.checkpoint.dir`` or, where that is unset, below the session's
    warehouse; every executor sees both.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/aerolake/{name}-{uuid.uuid4().hex}"


def stored_at(spark: SparkSession, path: str):
    """(file system, path) of a folder, on whatever storage it lies."""
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), found


def listed(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, in order; none if there is no such folder."""
    files, folder = stored_at(spark, path)
    return sorted(f.getPath().getName() for f in files.listStatus(folder)) if files.exists(folder) else []


def deleted(spark: SparkSession, path: str) -> None:
    files, folder = stored_at(spark, path)
    files.delete(folder, True)
