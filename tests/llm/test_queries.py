"""Registered queries: SQL where there is some, whole tables, and the pipeline's stages."""

import random

import pytest
from oracle_check import compare, connect
from test_llm_text import packed_right

import __spark_entry__ as entry_points
import corpus_pipeline
from aerolake.llm import catalog, minhash

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_matches_sql(spark, name):
    assert compare(spark, connect(SF_DIR), catalog.queries()[name], catalog.oracle_sql()[name], SF_DIR) is None


def test_all_are_registered():
    names = set(entry_points.queries())
    assert set(catalog.queries()) | {"pipeline"} <= names
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)] == [1] * 13


@pytest.mark.parametrize("name", ["op1_sharding", "op4_toxicity", "op5_quality", "op9_language_id", "op10_byte_bpe", "op13_token_file"])
def test_query_covers_all_documents(spark, name):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    got = catalog.queries()[name](spark, SF_DIR).select("doc_id")
    assert got.exceptAll(docs.select("doc_id")).isEmpty() and docs.select("doc_id").exceptAll(got).isEmpty()


def test_packing_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]
    packed_right(rows, catalog.queries()["op8_packing"](spark, SF_DIR).toPandas())


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    columns, before = docs.columns, docs
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, SF_DIR).cache()
        assert after.columns == columns and after.dtypes == docs.dtypes
        kept[name] = after.count()
        before = after
    clean = labels.where("quality = 1").join(docs, "doc_id")
    assert kept["language_id"] >= 0.99 * docs.count() and kept["line_dedup"] == kept["quality_classifier"]
    lost = clean.join(before, "doc_id", "left_anti").count()
    near = minhash.near_duplicates(docs).where("not kept").count()
    assert lost <= near
    pieces = corpus_pipeline.run(spark, SF_DIR)
    assert pieces.select("doc_id").distinct().count() == kept["near_dedup"]


def test_pipeline_of_odd_rows(spark):
    text = "der und die mit dem aus eine kurze Geschichte von vielen Worten"
    rows = [(1, text, "de", "s", 5), (1, text, "de", "s", 5), (2, text, "de", "s", 5), (None, text, None, None, None), (3, None, "de", "s", 0), (4, "", "en", "s", 0), (5, "1 2 3", "en", "s", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(2)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF_DIR).cache()
    assert sorted((r["doc_id"] or 0, r["text"]) for r in docs.collect()) == [(0, text), (1, text)]
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), SF_DIR).count() == 0


def near_brute(rows, words=5, share=80):
    """Groups of rows by plain sets of shingles."""

    def shingles(text):
        own = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").split()
        return {tuple(own[i : i + words]) for i in range(max(1, len(own) - words + 1))} if own else set()

    sets = [shingles(t) for _, t in rows]
    group = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= share * len(a | b) and group[i] != group[j]:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    return group


def test_distinct_texts_of_one_id_all_stay(spark):
    rnd = random.Random(9)
    word = lambda: "".join(rnd.choices("abcdefgh", k=6))
    base = [[word() for _ in range(80)] for _ in range(12)]
    rows = []
    for i, own in enumerate(base):
        near = [*own[:40], word(), *own[41:]]
        rows += [(i // 3, " ".join(own)), (i // 3, " ".join(own)), (20 + i, " ".join(near)), (30 + i % 4, " ".join(rnd.choices(own, k=60)))]
    rows += [(50, "x " * 400_000 + "end"), (50, "x " * 400_001 + "end"), (50, "short"), (50, ""), (51, None)]
    docs = spark.createDataFrame([(*r, "de", "s", 1, 7) for r in rows], "doc_id long, text string, lang string, source string, n_chars long, __row int").repartition(3)
    kept = corpus_pipeline.near_dedup(spark, docs, SF_DIR)
    assert kept.columns == docs.columns
    groups = near_brute(rows)
    want = {min((i, t or "") if t else (i, "") for (i, t), h in zip(rows, groups) if h == g)[0] for g in set(groups)}
    got = [(r["doc_id"], r["text"]) for r in kept.collect()]
    assert len(got) == len(set(groups))
    by_text = {t: g for (_, t), g in zip(rows, groups)}
    assert sorted(by_text[t] for _, t in got) == sorted({by_text[t] for _, t in rows})
    assert {i for i, _ in got} == want
