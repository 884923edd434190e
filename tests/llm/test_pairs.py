"""Near-duplicates of documents and vectors, and nearest neighbours, against brute force."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from aerolake.llm import caps, common, minhash, vptree

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def groups(ids, links):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {i: find(i) for i in ids}


def shingles(text, k):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    n = min(k, len(words))
    return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1)) if n else frozenset()


def near_brute(rows, k, least):
    sets = {i: shingles(t, k) for i, t in rows}
    holders = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            holders[x].append(i)
    links = []
    for i, s in sets.items():
        for j, n in Counter(j for x in s for j in holders[x] if j < i).items():
            if 100 * n >= least * (len(s) + len(sets[j]) - n):
                links.append((i, j))
    component = groups(sets, links)
    return {i: (len(sets[i]), component[i], component[i] == i) for i in sets}


def families(seed):
    rnd = random.Random(seed)
    words = ["w%d" % i for i in range(3000)]
    rows = []
    for _ in range(8):
        base = [rnd.choice(words) for _ in range(200)]
        for _ in range(30):
            own = list(base)
            for _ in range(rnd.randint(0, 12)):
                own[rnd.randrange(len(own))] = rnd.choice(words)
            rows.append((len(rows), rnd.choice([" ", "\n", "\t "]).join(own)))
    odd = ["", "  \n", None, "A b", "a  B", "one", "ONE", "É x y", "é x y", "a b c d", "long " * 5000, "long " * 5001]
    return rows + [(len(rows) + i, t) for i, t in enumerate(odd * 2)]


@pytest.mark.parametrize("words,similarity,chunk", [(3, 85, 1024), (3, 85, 16), (5, 80, 1024)])
def test_near_duplicates(spark, words, similarity, chunk):
    rows = families(words)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r[0]: tuple(r)[1:] for r in minhash.near_duplicates(docs, words, similarity, chunk).collect()}
    assert got == near_brute(rows, words, similarity)


def test_asking_tasks_hold_two_chunks_and_meet_all_pairs(spark):
    rows = spark.createDataFrame([(1, i, i if i < 150 else 150, 1 / 16) for i in range(200)], "bucket long, node long, part long, room double")
    tasks = defaultdict(lambda: (set(), set()))
    for r in minhash._asking(rows, "bucket", F.ceil(F.col("n") / 16)).collect():
        tasks[r.bucket, r.ask, r.chunk][r.asks].add(r.node)
    assert max(len(there) + len(asks) for there, asks in tasks.values()) <= 2 * 2 * 16  # hashes don't fill chunks evenly
    met = {(a, b) for there, asks in tasks.values() for a in asks for b in there}
    assert met == {(a, b) for a in range(150) for b in range(200)}


def test_links_between_clusters_of_a_bucket_are_found(spark):
    # A chain: neighbours are similar enough, the ends are not, and all share most of their text.
    words = ["c%d" % i for i in range(300)]
    rows = []
    for step in range(12):
        own = list(words)
        for i in range(step * 6):
            own[i * 4] = "x%d" % i
        rows.append((step, " ".join(own)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r[0]: tuple(r)[1:] for r in minhash.near_duplicates(docs, 3, 85).collect()}
    assert got == near_brute(rows, 3, 85)


def test_near_duplicates_of_odd_rows(spark):
    text = " ".join("w%d" % i for i in range(50))
    rows = [(5, text, "x"), (5, text, "x"), (3, text, "y"), (None, text, "z"), (None, None, None), (7, "other text here", "x"), (7, text, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id string")
    out = minhash.near_duplicates(docs)
    assert out.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    got = Counter(map(tuple, out.collect()))
    # Both texts of document 7 are one document, which the second links with 3.
    assert got == Counter([(5, 46, 3, False)] * 2 + [(3, 46, 3, True), (None, 46, None, True), (None, 0, None, True), (7, 1, 3, False), (7, 46, 3, False)])


def test_near_duplicates_of_nothing(spark):
    assert minhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_word_hashes_don_t_depend_on_slices(monkeypatch):
    text = ("Word " + "x" * 300 + "\tend ").encode() * 50
    whole = minhash.word_hashes(text)
    monkeypatch.setattr(minhash, "_SLICE", 64)
    assert (minhash.word_hashes(text) == whole).all() and len(whole) == 150


def opposites(size):
    """Two words of letters a and b that hashes by powers of one base can't tell apart."""
    word = "a"
    while len(word) < size:
        word += word.translate(str.maketrans("ab", "ba"))
    return word, word.translate(str.maketrans("ab", "ba"))


def test_words_that_differ_don_t_link(spark):
    rows = [(k, word) for k, word in enumerate([*opposites(1024), *opposites(4096)])]
    rows += [(10 + k, f"{word} second third fourth fifth sixth") for k, (_, word) in enumerate(rows)]
    found = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert all(r["kept"] and r["n_shingles"] > 0 for r in found.collect())


def test_a_word_of_many_megabytes_is_one_word():
    assert len(minhash.shingle_set("x" * 30_000_000 + " y", 1)) == 2


def test_components_of_a_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (101, 101)], "a long, b long")
    got = dict(map(tuple, common.components(edges).collect()))
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}


@pytest.mark.parametrize("few", [0, common.FEW_LINKS])
def test_components_of_a_large_star(spark, few):
    leaves = spark.range(1, 5000).select(F.lit(0).cast("long").alias("a"), F.col("id").alias("b"))
    got = common.components(leaves.unionByName(spark.createDataFrame([(7000, 4999), (7000, 7001), (8000, 8001)], "a long, b long")), few)
    assert got.groupBy("component").count().orderBy("component").collect() == [(0, 5002), (8000, 2)]


def valid(v):
    return bool(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)


def vector_brute(rows, least=0.9):
    good = [(i, np.array(v, dtype=float)) for i, v in rows if valid(v)]
    links = []
    for n, (i, v) in enumerate(good):
        for j, w in good[:n]:
            if len(v) == len(w) and v @ w / np.linalg.norm(v) / np.linalg.norm(w) >= least:
                links.append((i, j))
    count = Counter(x for link in links for x in link)
    component = groups([i for i, _ in rows], links)
    return {i: (count[i], component[i], component[i] == i) for i, _ in rows}


def vectors(seed, dim=64):
    rng = np.random.default_rng(seed)
    out = [v.tolist() for v in rng.standard_normal((250, dim))]
    for _ in range(4):
        base = rng.standard_normal(dim)
        out += [(base + rng.standard_normal(dim) * rng.uniform(0.1, 0.35)).tolist() for _ in range(30)]
    out += [out[3]] * 5 + [[2 * x for x in out[3]], [0.0] * dim, None, [], [float("nan")] * dim, [float("inf")] * dim, [None] * dim, [1.0, 2.0], [2.0, 4.0]]
    return list(zip(rng.permutation(len(out)).tolist(), out))


@pytest.mark.parametrize("chunk", [2048, 8])
def test_near_vectors(spark, chunk):
    rows = vectors(1)
    got = {r[0]: tuple(r)[1:] for r in caps.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), chunk=chunk).collect()}
    want = vector_brute(rows)
    found, all_links = sum(v[0] for v in got.values()), sum(v[0] for v in want.values())
    assert found >= 0.99 * all_links and all(got[i][0] <= want[i][0] for i in want)
    if found == all_links:
        assert got == want


def test_near_vectors_of_odd_rows(spark):
    v = [1.0] + [0.0] * 15
    rows = [(4, v, "a"), (4, v, "a"), (2, v, "b"), (None, v, "c"), (9, None, "d"), (None, None, "e")]
    out = caps.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, kept string"))
    assert Counter(map(tuple, out.collect())) == Counter([(4, 3, 2, False)] * 2 + [(2, 3, 2, True), (None, 3, 2, False), (9, 0, 9, True), (None, 0, None, True)])
    assert caps.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_list_decoding_finds_all_filters():
    rng = np.random.default_rng(3)
    parts = [rng.standard_normal(20) for _ in range(3)]
    sums = (parts[0][:, None, None] + parts[1][None, :, None] + parts[2][None, None, :]).ravel()
    assert caps.decoded(parts, 3.0).tolist() == np.flatnonzero(sums >= 3.0).tolist()


@pytest.mark.parametrize("n", [1_000, 10_000_000])
def test_recall_is_the_same_at_any_size(n):
    rng = np.random.default_rng(6)
    x, z = rng.standard_normal((2, 250, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z -= (z * x).sum(axis=1, keepdims=True) * x
    y = 0.9 * x + np.sqrt(1 - 0.81) * z / np.linalg.norm(z, axis=1, keepdims=True)
    pairs = zip(caps.filters_of(x, n, 0.9), caps.filters_of(y, n, 0.9))
    assert np.mean([len(np.intersect1d(a, b)) > 0 for a, b in pairs]) >= 0.98


@pytest.mark.parametrize("dim", [8, 12, 16, 64, 768])
def test_filters_of_many_vectors(dim):
    for n in (0, 1_000, 1_000_000, 10_000_000):
        bound, words = caps.caps(n, dim)
        assert 0 < bound <= 0.9 and 1 <= words < 50_000


def nearest_brute(rows, every, k):
    good = [(i, np.array(v, dtype=float)) for i, v in rows if i is not None and valid(v)]
    out = {}
    for i, v in good:
        if i % every == 0:
            scored = sorted((-sum(float(a) * float(b) for a, b in zip(v, w)), j) for j, w in good if j != i and len(v) == len(w))
            out[i] = [(r + 1, j, -s) for r, (s, j) in enumerate(scored[:k])]
    return out


def test_nearest_is_exact_with_factor_one(spark):
    rows = vectors(2)
    rows = [(i, [x * (1 + i % 3) for x in v] if valid(v) else v) for i, v in rows]
    out = vptree.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), every=7).collect()
    got = defaultdict(list)
    for q, rank, i, score in sorted(map(tuple, out)):
        got[q].append((rank, i, score))
    want = nearest_brute(rows, 7, 20)
    assert {q: [(r, i) for r, i, _ in x] for q, x in got.items()} == {q: [(r, i) for r, i, _ in x] for q, x in want.items() if x}
    assert all(abs(a[2] - b[2]) < 1e-9 for q in got for a, b in zip(got[q], want[q]))


def test_blocks_of_queries_visit_trees_that_stay(spark):
    draw = np.random.default_rng(11)
    points = {i: draw.normal(size=3 if i % 4 else 5) for i in range(240)}
    rows = spark.createDataFrame([(i, p.astype("<f8").tobytes()) for i, p in points.items()], "vec_id long, vec binary")
    index = common.stored(vptree.build_index(rows, shard_rows=40), "vp-index")
    assert index.select("shard").distinct().count() > 3
    found = vptree.search(index, rows.where("vec_id % 3 = 0"), k=4, block=16)
    assert "Join" not in found._jdf.queryExecution().executedPlan().toString()
    got = {}
    for r in found.collect():
        got.setdefault(r.query_id, {})[r.rank] = r.vec_id
    for i in range(0, 240, 3):
        near = sorted((-float(points[i] @ p), j) for j, p in points.items() if j != i and len(p) == len(points[i]))[:4]
        assert [got[i][n] for n in range(1, 5)] == [j for _, j in near]


def best_in_order(ids, points, own, queries, k):
    """(names, scores) of the k nearest of each query by products summed coordinate by coordinate."""
    out = []
    for i, q in zip(own, queries):
        score = np.zeros(len(points))
        for x, column in zip(q, points.T):
            score += x * column
        order = [j for j in np.lexsort((ids, -score)) if ids[j] != i][:k]
        out.append((ids[order].tolist(), score[order].tolist()))
    return out


def test_few_products_are_summed_one_by_one(monkeypatch):
    draw = np.random.default_rng(17)
    points, ids, summed = draw.normal(size=(3000, 64)), np.arange(3000), []

    def counted(make):
        def run(*parts):
            out = make(*parts)
            summed.append(out.size)
            return out

        return run

    monkeypatch.setattr(vptree, "products", counted(vptree.products))
    if hasattr(vptree, "some_products"):
        monkeypatch.setattr(vptree, "some_products", counted(vptree.some_products))
    names, scores, _ = vptree.Tree(ids, points).search(ids[::10], points[::10], 20, 1.0)
    assert [(a.tolist(), b.tolist()) for a, b in zip(names, scores)] == best_in_order(ids, points, ids[::10], points[::10], 20)
    assert sum(summed) < 0.2 * len(names) * len(points)  # no structure, so each product is made, but few decide anything


@pytest.mark.parametrize("kind", ["copies", "whole numbers", "scales", "tiny", "huge and small"])
def test_products_that_are_nearly_equal_keep_their_order(kind):
    draw = np.random.default_rng(18)
    points = draw.normal(size=(900, 12))
    if kind == "copies":
        points = points[draw.integers(30, size=900)]
    elif kind == "whole numbers":
        points = np.round(points)
    elif kind == "scales":
        points *= 10.0 ** draw.integers(-12, 13, size=(900, 1))
    elif kind == "tiny":
        points *= 1e-160
    else:
        points[:, 0], points[:, 1] = 1e9, draw.choice([-1e9, 1e9], size=900)
    ids = draw.permutation(900)
    ids[5] = ids[6]  # rows that share an id are candidates each
    tree, names, scores = vptree.Tree(ids, points), *vptree.Tree(ids[:400], points[:400]).search(ids[::9], points[::9], 7, 1.0)[:2]
    whole = best_in_order(ids, points, ids[::9], points[::9], 7)
    found = tree.search(ids[::9], points[::9], 7, 1.0)
    assert [(a.tolist(), b.tolist()) for a, b in zip(*found[:2])] == whole
    rest = vptree.Tree(ids[400:], points[400:]).search(ids[::9], points[::9], 7, 1.0, (names, scores))
    assert [(a.tolist(), b.tolist()) for a, b in zip(*rest[:2])] == whole


def test_trees_of_a_task_hand_on_what_they_found(spark, monkeypatch):
    monkeypatch.setattr(vptree, "TASKS", 2, raising=False)
    draw = np.random.default_rng(19)
    points = {i: draw.normal(size=6 if i % 5 else 3) for i in range(400)}
    rows = spark.createDataFrame([(i, p.astype("<f8").tobytes()) for i, p in points.items()], "vec_id long, vec binary")
    index = common.stored(vptree.build_index(rows, shard_rows=30), "vp-index")
    asked = rows.where("vec_id % 4 = 0")
    for held, tasks in ((1 << 30, 2), (1, 14)):
        monkeypatch.setattr(vptree, "HELD", held, raising=False)
        found = vptree.search(index, asked, k=5, block=16)
        dealt = re.search(r"direct_shuffle_partition_id\(task#\d+\), (\d+)\)", found._jdf.queryExecution().executedPlan().toString())
        assert dealt and int(dealt.group(1)) == tasks
        got = {}
        for r in found.collect():
            got.setdefault(r.query_id, {})[r.rank] = r.vec_id
        for i in range(0, 400, 4):
            near = sorted((-float(points[i] @ p), j) for j, p in points.items() if j != i and len(p) == len(points[i]))[:5]
            assert [got[i][n] for n in range(1, 6)] == [j for _, j in near]


def test_nearest_of_few_and_none(spark):
    rows = [(0, [1.0, 0.0], "x"), (1, [1.0, 0.0], "x"), (2, [1.0, 0.0], "x"), (None, [9.0, 9.0], "x"), (40, None, "x")]
    out = vptree.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>, rank string")).collect()
    assert sorted(map(tuple, out)) == [(0, 1, 1, 1.0), (0, 2, 2, 1.0)]
    assert vptree.nearest(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_relaxed_pruning_trades_recall_for_work():
    rng = np.random.default_rng(5)
    centres = rng.standard_normal((40, 8)) * 4
    points = centres[rng.integers(40, size=4000)] + rng.standard_normal((4000, 8))
    queries, ids = points[::40], np.arange(4000)
    tree, recall, work = vptree.Tree(ids, points), [], []
    exact = tree.search(ids[::40], queries, 20, 1.0)[0]
    for factor in (1.0, 1.5, 6.0):
        names, _, made = tree.search(ids[::40], queries, 20, factor)
        recall.append(np.mean([len(set(a) & set(b)) / 20 for a, b in zip(names, exact)]))
        work.append(made)
    assert recall[0] == 1 and recall[1] >= 0.9 and work[0] > work[1] > work[2]
    assert work[0] < len(queries) * len(points)
