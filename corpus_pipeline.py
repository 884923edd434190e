"""A training corpus from raw documents, in stages that each call one operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolake.llm import languages, lines, minhash, packing, quality
from aerolake.llm.common import ready, stored

#: A language is believed from this posterior on.
LANGUAGE_SCORE = 0.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known; null texts and those without a letter go."""
    model = languages.learn(docs)
    predicted = languages.predict_language(docs, model)
    return predicted.where((F.col("lang_pred") != "und") & (F.col("score") >= LANGUAGE_SCORE)).select(docs.columns)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are good more likely than not."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model, prior = quality.learn(docs, labels)
    return quality.score_quality(docs, model, prior).where("predicted = 1").select(docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that many of them share; n_chars follows the text."""
    found = lines.dedup_lines(docs)
    changed = F.col("n_dropped") > 0
    new = {"text": F.when(changed, F.col("kept_text")).otherwise(F.col("text")), "n_chars": F.when(changed, F.length("kept_text")).otherwise(F.col("n_chars"))}
    return found.withColumns({c: new[c].cast(docs.schema[c].dataType) for c in new}).select(docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates, that with the smallest id (of equal ids any). Rows without an id stay.

    Rows that share an id are documents of their own: unless their texts are near-duplicates, all of them stay.
    """
    own = docs.where(F.col("doc_id").isNotNull())
    if own.groupBy("doc_id").count().where("count > 1").isEmpty():
        ids = minhash.near_duplicates(docs).where("kept and doc_id is not null").select("doc_id").distinct()
        kept = own.join(ids, "doc_id", "left_semi").select(docs.columns)
    else:
        row = "__row"
        while row in docs.columns:
            row += "_"
        rows = stored(own.withColumn(row, F.monotonically_increasing_id()), "numbered")  # written, so numbers stay
        found = minhash.near_duplicates(rows.select(F.col(row).alias("doc_id"), "text")).select(F.col("doc_id").alias(row), "component_id")
        first = found.join(rows.select(row, "doc_id"), row).groupBy("component_id").agg(F.min(F.struct("doc_id", row)).alias("first"))
        kept = rows.join(first.select(F.col(f"first.{row}").alias(row)), row, "left_semi").select(docs.columns)
    return kept.unionByName(docs.where(F.col("doc_id").isNull()))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 1024 tokens."""
    return packing.pack(docs, added=packing.added_path())


STAGES = [
    ("language_id", language_id),
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("packing", pack),
]

#: Models and tokens are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = ready(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = stored(docs, name)
    return docs


def queries() -> dict:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
