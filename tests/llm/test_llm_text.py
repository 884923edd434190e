"""Line deduplication, tokens and packing against plain Python."""

import base64
import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

import corpus_pipeline
from aerolake.llm import bpe, catalog, lines, packing

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
BLANKS = " \t\n\x0b\x0c\r"


def lines_brute(rows):
    holders = defaultdict(set)
    for i, text in rows:
        for line in (text or "").split("\n"):
            key = line.strip(BLANKS).translate(LOW)
            if i is not None and len(key) >= 20:
                holders[key].add(i)
    out = []
    for i, text in rows:
        all_lines = (text or "").split("\n")
        stay = [x for x in all_lines if i is None or len(holders[k := x.strip(BLANKS).translate(LOW)]) < 3 or max(holders[k]) == i]
        out.append((i, len(all_lines), len(all_lines) - len(stay), hashlib.sha256("\n".join(stay).encode()).hexdigest()))
    return sorted(out, key=repr)


def test_lines(spark):
    rnd = random.Random(4)
    pool = ["A shared line of over 20 signs %d" % i for i in range(12)] + ["short", "", "  x", "ÉÉÉÉÉÉÉÉÉÉÉÉÉÉÉÉÉÉÉÉ", "ééééééééééééééééééé", "exactly twenty signs"]
    rows = []
    for i in range(120):
        own = [rnd.choice(["", " ", "\t"]) + rnd.choice([str.upper, str.lower, str])(rnd.choice(pool)) + rnd.choice(["", "\r", " \x0b"]) for _ in range(rnd.randint(0, 9))]
        rows.append((i, "\n".join(own)))
    rows += [(200, None), (201, ""), (None, pool[0]), (3, pool[0]), (3, pool[0]), (202, "\n\n"), (203, "unique line of a very long text\n" * 30000)]
    docs = spark.createDataFrame([(*r, "extra") for r in rows], "doc_id long, text string, n_dropped string").repartition(3)
    found = lines.line_digest(docs)
    assert sorted(map(tuple, found.collect()), key=repr) == lines_brute(rows)


def test_lines_keep_other_columns(spark):
    docs = spark.createDataFrame([(1, "a", "x", 5)], "doc_id long, text string, Kept_Text string, more int")
    assert lines.dedup_lines(docs).columns == ["doc_id", "text", "more", "kept_text", "n_lines", "n_dropped"]
    assert lines.dedup_lines(docs.limit(0)).count() == 0


def batch_of(spark, n):
    return spark.createDataFrame([(n * 10 + i, b"k%d" % (i % 3)) for i in range(n % 4)], "doc_id long, key binary")


def test_runs_are_levelled(spark, tmp_path):
    runs = lines.LineRuns(spark, str(tmp_path), fan_in=2)
    for n in range(7):
        runs.add(batch_of(spark, n))
    assert [len(level) for level in runs.levels] == [1, 1, 1]
    got = {bytes(k): last for k, last in runs.repeated(3).collect()}
    assert got == {b"k0": 60, b"k1": 61}
    assert len(list((tmp_path / "runs").iterdir())) == 3  # compacted runs are gone
    for run in (run for level in runs.levels for run in level):
        assert runs.open(run).toPandas()["key"].is_unique


def test_runs_go_on_in_another_session(spark, tmp_path):
    """The second session knows the runs of the first by their folder, and only new keys are fresh in its run."""
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        first = lines.LineRuns(spark, str(tmp_path), fan_in=4)
        first.add(spark.createDataFrame([(1, b"a"), (1, b"b"), (2, b"a")], "doc_id long, key binary"))
        first.add(spark.createDataFrame([(3, b"b"), (3, b"c")], "doc_id long, key binary"))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    second = lines.LineRuns(spark.newSession(), str(tmp_path), fan_in=4)
    assert second.buckets == 3 and second.levels == first.levels
    second.add(second.spark.createDataFrame([(9, b"c"), (9, b"d"), (8, b"a"), (7, b"a")], "doc_id long, key binary"))
    own = {bytes(r["key"]): (r["docs"], r["last"], r["fresh"]) for r in second.open(second.levels[0][-1]).collect()}
    assert own == {b"a": (2, 8, False), b"c": (1, 9, False), b"d": (1, 9, True)}
    assert {bytes(k): last for k, last in second.repeated(2).collect()} == {b"a": 8, b"b": 3, b"c": 9}
    # A step that stopped before its manifest counts for nothing.
    second.spark.range(1).write.parquet(f"{tmp_path}/runs/99-level-0")
    assert lines.LineRuns(spark, str(tmp_path)).levels == second.levels


def test_old_runs_are_merged_without_a_shuffle(spark, tmp_path):
    runs = lines.LineRuns(spark, str(tmp_path), fan_in=9)
    for n in (3, 7, 11):
        runs.add(batch_of(spark, n))
    with runs._in_order():
        batch = spark.createDataFrame([(5, b"k1")], "doc_id long, key binary").groupBy("key").count()
        joined = batch.join(runs.open(runs.levels[0][0]).where("fresh").hint("merge"), "key", "left")
        merged = runs._merged(runs.levels[0][:2])
        plans = [df._jdf.queryExecution().executedPlan().toString() for df in (joined, merged)]
    assert "SortMergeJoin" in plans[0] and plans[0].count("Exchange") == 1 and plans[0].count("Sort [") == 1
    assert "SortMergeJoin" in plans[1] and "Exchange" not in plans[1] and "Sort [" not in plans[1]


@pytest.fixture(scope="module")
def whole():
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("whole", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


TEXTS = [
    "", " ", "\n", "a", "Hello world's 12,345 things  and\n\n more\t\tblanks   ", "don't won't I'll we've it's",
    "zażółć gęślą jaźń 日本語テキスト и русский 😀👩‍👩‍👧", "x" * 3000, "ab" * 2500, "9" * 2000, "!?" * 2000, " " * 3000, "\r\n" * 900, "a" * 1000 + " " + "é" * 1500,
    "   mixed　blanks \x1c\x1d", "<|endoftext|> is text", "'" * 1500, "_'s'll" * 700,
]


@pytest.mark.parametrize("leaf", [8, 64, 8192])
def test_tree_encodes_like_one_pass(whole, leaf):
    codec = bpe.codec(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    for text in TEXTS:
        ids = codec.encode(text, leaf)
        assert ids == whole.encode_ordinary(text), (leaf, text[:40])
        assert codec.decode(ids) == text.encode()


def test_random_texts_and_runs(whole):
    codec, rnd = bpe.codec(public_tokenizers.path("byte_bpe_50k.tiktoken")), random.Random(8)
    for n in range(150):
        alphabet = rnd.choice(["ab", "etaoin shr", "aé \n'", "0123456789 .", "the an in er", "x日 \t", "abcdefghijklmnopqrstuvwxyz"])
        text = "".join(rnd.choice(alphabet) for _ in range(rnd.randint(1, 3000)))
        assert codec.encode(text, rnd.choice([4, 16, 100, 1000])) == whole.encode_ordinary(text)
        data = "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(3000)).encode()
        if n < 20:
            assert codec.piece(data) == whole._encode_single_piece(data)


def test_documents_round_trip(spark, whole):
    rows = [(i, t, "clash") for i, t in enumerate(TEXTS)] + [(None, None, None), (1, "a", "clash"), (1, "a", "clash")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, IDS string")
    encoded = bpe.encode_documents(docs)
    assert encoded.columns == ["doc_id", "text", "ids"]
    for r in bpe.decode_documents(encoded).collect():
        assert r["ids"] == whole.encode_ordinary(r["text"] or "") and bytes(r["decoded"]) == (r["text"] or "").encode()
    digest = {r["doc_id"]: r for r in bpe.bpe_digest(docs).collect()}
    ids = whole.encode_ordinary(TEXTS[4])
    assert digest[4]["n_tokens"] == len(ids) and digest[4]["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
    assert digest[None]["ids_sha256"] == digest[None]["decoded_sha256"] == hashlib.sha256(b"").hexdigest()
    assert bpe.bpe_digest(docs.limit(0)).count() == 0


def test_cuts_cover_a_document():
    for total in [*range(1, 2200), 5000, 123456]:
        pieces = packing.cuts(total)
        assert pieces[0][0] == 0 and sum(n for _, n, _ in pieces) == total
        assert all(a[0] + a[1] == b[0] for a, b in zip(pieces, pieces[1:]))
        assert all(n * k <= 1024 for _, n, k in pieces) and len(pieces) <= total // 1024 + 8


def packed_right(rows, got, capacity=1024):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    want = sorted((i, tuple(tokenizer.encode(t or "", add_special_tokens=False).ids + [0])) for i, t in rows)
    fills = []
    for _, group in got.groupby("sequence_id"):
        group = group.sort_values("offset")
        assert group["offset"].tolist() == [0, *group["length"].cumsum().tolist()[:-1]]
        fills.append(int(group["length"].sum()))
    assert max(fills, default=0) <= capacity
    for doc_id, ids in want:
        group = got[got["doc_id"] == doc_id].sort_values("start")
        data, at = np.array(ids, dtype="<u4"), 0
        for r in group.itertuples():
            assert r.start == at and r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(data[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    return fills


@pytest.mark.parametrize("parts", [1, 40])
def test_packing(spark, parts, monkeypatch):
    monkeypatch.setattr(packing, "FAN_IN", 3)
    rnd = random.Random(parts)
    rows = [(i, " ".join(rnd.choice(["alpha", "Beta", "gamma's", "délta", "<|endoftext|>"]) for _ in range(rnd.choice([0, 1, 5, 60, 300, 900, 3000])))) for i in range(160)]
    rows += [(1000, None), (1001, "")]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, offset string").repartition(parts)
    out = packing.pack(docs)
    assert out.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    fills = packed_right(rows, out.toPandas())
    assert 1 - sum(fills) / (1024 * len(fills)) < 0.03


@pytest.mark.parametrize("query", ["op8_packing", "pipeline"])
def test_queries_take_added_tokens_as_the_library_does(spark, tmp_path, query):
    end = "<|endoftext|>"
    texts = [f"a{end} b", end, end * 3, f" {end} \n{end}x", f"<|endoftext|{end}|>", f"{'word ' * 3000}{end}{'  more' * 3000}", "<|endoftext", *TEXTS]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    if query == "op8_packing":
        docs.write.parquet(f"{tmp_path}/documents.parquet")
        got = catalog.op8_packing(spark, str(tmp_path)).toPandas()
    else:
        got = corpus_pipeline.pack(spark, docs, str(tmp_path)).toPandas()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert tokenizer.encode(texts[0], add_special_tokens=False).ids == [64, 50256, 275]
    for i, text in enumerate(texts):
        ids = np.array(tokenizer.encode(text, add_special_tokens=False).ids + [0], dtype="<u4")
        pieces = got[got["doc_id"] == i].sort_values("start")
        assert pieces["length"].sum() == len(ids) and set(pieces["doc_tokens"]) == {len(ids)}
        assert all(r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes()) for r in pieces.itertuples())


def test_packing_of_repeated_rows_and_none(spark):
    docs = spark.createDataFrame([(1, "same text"), (1, "same text"), (None, "same text")], "doc_id long, text string")
    got = packing.pack(docs, with_ids=True).toPandas()
    assert len(got) == 3 and got["sequence_id"].nunique() == 1 and sorted(got["offset"]) == [0, 3, 6]
    assert all(zlib.crc32(bytes(r.ids)) == r.ids_crc32 for r in got.itertuples())
    assert packing.pack(docs.limit(0)).count() == 0
