"""Language, toxicity and quality: plain references, counterfactuals, shrinkage, held-out accuracy."""

import math
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from aerolake.llm import languages, linear, quality, toxicity

SF_DIR = "/root/testdata/sf0.01"


def ppm_bits(text, counts, order=4):
    """Code length of a text by the definition, one byte at a time."""
    total, data = 0.0, bytes(order) + text
    for i in range(order, len(data)):
        for k in range(order, -1, -1):
            seen = counts.get((k, data[i - k : i]))
            if seen is None:
                continue
            n, kinds = sum(seen.values()), len(seen)
            if data[i] in seen:
                total += math.log2((n + kinds) / seen[data[i]])
                break
            total += math.log2((n + kinds) / kinds)
        else:
            total += 8
    return total


def test_code_lengths_by_definition(monkeypatch):
    texts = {"a": [b"abracadabra", b"abra"], "b": ["żółć żółw".encode(), b"zolw" * 5]}
    trees = {}
    for lang, own in texts.items():
        counts = defaultdict(lambda: defaultdict(int))
        for text in own:
            data = bytes(4) + text
            for i in range(4, len(data)):
                for k in range(5):
                    counts[k, data[i - k : i]][data[i]] += 1
        trees[lang] = counts
    found = {lang: np.unique(np.concatenate([languages.grams(t) for t in own]), return_counts=True) for lang, own in texts.items()}
    model = languages.Model(list(found), [g for g, _ in found.values()], [n.astype(float) for _, n in found.values()])
    asked = [b"abracadabra", b"cadabra abra", "żółty".encode(), b"", b"\x00\x00zzz", b"abra" * 400]
    want = np.array([[ppm_bits(t, trees[lang]) for lang in found] for t in asked])
    assert np.allclose(languages.Scorer(model).bits(asked), want, rtol=1e-4)
    monkeypatch.setattr(languages, "SLICE", 7)
    assert np.allclose(languages.Scorer(model).bits(asked), want, rtol=1e-4)
    monkeypatch.setattr(languages, "TABLE_BITS", 2)
    assert np.allclose(languages.Scorer(model).bits(asked), want, rtol=1e-4)
    monkeypatch.setattr(languages, "CELLS", 6)
    assert np.allclose(languages.Scorer(model).bits(asked), want, rtol=1e-4)


def test_any_number_of_languages(spark):
    words = {f"l{k:03}": [f"{chr(97 + k % 26)}{chr(97 + k // 26)}{x}{k}" for x in ("um", "or", "ek", "al", "is")] for k in range(300)}
    rnd = random.Random(7)
    rows = [(10 * k + i, " ".join(rnd.choices(own, k=30)), lang) for k, (lang, own) in enumerate(words.items()) for i in range(3)]
    rows += [(0, rows[0][1], "l000")] * 500  # copies of one document are one of the sample
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = languages.learn(docs, sample_docs=2, sample_total=600)
    assert model.languages == sorted(words)
    wrong = languages.predict_language(docs, model).where("lang != lang_pred")
    assert wrong.count() == 0
    assert languages.learn(docs, sample_total=5).languages == sorted(words)


def test_languages_of_odd_rows(spark):
    learn = [(i, "the and of with this from", "en") for i in range(4)] + [(10 + i, "der und die mit dem aus", "de") for i in range(4)] + [(20, None, "en"), (21, "text", None), (None, "the other", "en")]
    docs = spark.createDataFrame(learn, "doc_id long, text string, lang string")
    model = languages.learn(docs)
    assert model.languages == ["de", "en"]
    ask = spark.createDataFrame([(1, "with the"), (2, "und mit"), (3, None), (4, ""), (5, "123 !?"), (6, "der " * 100000), (1, "with the")], "doc_id long, text string").withColumn("SCORE", F.lit("x"))
    out = languages.predict_language(ask, model)
    assert out.columns == ["doc_id", "text", "lang_pred", "score"]
    got = out.collect()
    assert [r["lang_pred"] for r in sorted(got, key=lambda r: r["doc_id"])] == ["en", "en", "de", "und", "und", "und", "de"]
    assert all(0 <= r["score"] <= 1 for r in got)
    nothing = languages.learn(docs.limit(0))
    assert {r["lang_pred"] for r in languages.predict_language(ask, nothing).collect()} == {"und"}
    assert languages.predict_language(ask.limit(0), model).count() == 0


@pytest.fixture(scope="module")
def tables(spark):
    read = lambda name: spark.read.parquet(f"{SF_DIR}/{name}.parquet")
    return read("documents"), read("labels")


def test_languages_held_out(tables):
    docs, _ = tables
    got = languages.language_digest(docs).join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    held = got[got["held_out"]]
    assert len(got) == docs.count() and len(held) > 100 and (held["lang"] == held["lang_pred"]).mean() > 0.98


def test_toxicity_held_out(tables):
    docs, labels = tables
    found = toxicity.toxicity_digest(docs, labels)
    assert found.count() == docs.count() and found.where("score < 0 or score > 1 or score is null").isEmpty()
    got = found.join(labels, "doc_id").where("held_out").toPandas()
    ranks = got["score"].rank()
    ones = got["toxic"] == 1
    area = (ranks[ones].sum() - ones.sum() * (ones.sum() + 1) / 2) / (ones.sum() * (~ones).sum())
    assert area > 0.75 and (got["predicted"] == got["toxic"]).mean() > 0.9


def test_swaps_make_group_mentions_neutral(spark):
    rnd = random.Random(1)
    plain = ["river", "stone", "morning", "garden", "letter", "window", "market", "road"]
    rows = []
    for i in range(600):
        words = [rnd.choice(plain) for _ in range(12)]
        toxic = i % 3 == 0
        # The data are biased: insults mostly come with one group's name.
        if toxic:
            words += [rnd.choice(["scum", "filth"])] * (rnd.random() < 0.7)
        if rnd.random() < (0.8 if toxic else 0.1):
            words.append("muslim")
        rows.append((i, " ".join(words), int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    ask = spark.createDataFrame([(1, "a muslim in the garden"), (2, "a person in the garden"), (3, "scum of the road")], "doc_id long, text string")
    scores = {}
    for penalty in (0.0, 1.0):
        model = toxicity.learn(docs, docs.select("doc_id", "toxic"), penalty=penalty)
        scores[penalty] = {r["doc_id"]: r["score"] for r in toxicity.score_toxicity(ask, model).collect()}
    assert scores[0.0][1] - scores[0.0][2] > 0.3
    assert abs(scores[1.0][1] - scores[1.0][2]) < 0.1 and scores[1.0][3] > 0.7


def newton(x, y, prior, ridge, changes, penalty):
    """The minimum of the same loss over dense rows: weights and bias."""
    n, k = x.shape
    weight = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean())) / n
    design = np.hstack([x, np.ones((n, 1))])
    fixed = np.zeros((k + 1, k + 1))
    fixed[:k, :k] = ridge * np.eye(k) + 2 * penalty * changes.T @ changes / max(1, len(changes))
    w = np.zeros(k + 1)
    for _ in range(100):
        p = 1 / (1 + np.exp(-design @ w))
        slope = design.T @ (weight * (p - y)) + fixed @ w
        w -= np.linalg.solve(design.T @ ((weight * p * (1 - p))[:, None] * design) + fixed + 1e-12 * np.eye(k + 1), slope)
    return w[:k], w[k] + np.log(prior / (1 - prior))


@pytest.mark.parametrize("penalty", [0.0, 0.3])
def test_the_classifier_is_at_the_minimum(penalty):
    rng = np.random.default_rng(3)
    truth = np.array([2.0, -2.0, 1.5, -1.5, 1.0])
    x = (rng.random((1500, 5)) < 0.4).astype(float)
    y = (rng.random(1500) < 1 / (1 + np.exp(-(x @ truth - 0.4)))).astype(float)
    changes = np.zeros((60, 5))
    changes[:, 0], changes[:, 2] = -1, 1
    slots = np.array([11, 222, 3333, 44444, 200000])
    sparse = lambda m: linear.Rows.of([slots[r != 0] for r in m], [r[r != 0] for r in m])
    model = linear.fit(sparse(x), y, 0.2, 1e-3, sparse(changes), penalty)
    weights, bias = newton(x, y, 0.2, 1e-3, changes, penalty)
    assert np.allclose(model.weights[slots], weights, atol=0.02) and abs(model.bias - bias) < 0.02
    assert np.count_nonzero(model.weights) == 5
    gap = abs(model.weights[11] - model.weights[3333])
    assert (gap < 0.3) if penalty else (gap > 0.3)


def test_swaps_by_definition():
    slot = lambda word: int(toxicity._slots(word.encode())[0])
    own = {a for a, b in (tuple(x[0]) for x in toxicity.swaps("The Muslim, the jewish and a garden"))}
    assert own == {slot("muslim"), slot("jewish")}
    kind = next(k for k in toxicity.IDENTITIES if "muslim" in k)
    want = {(slot(a), slot(b)) for a in ("muslim", "jewish") for b in kind if b not in ("muslim", "jewish")}
    found = toxicity.swaps("The Muslim, the jewish and a garden")
    assert {tuple(x[0]) for x in found} == want and all(x[1] == [-1.0, 1.0] for x in found)


def shrunk(docs, prior):
    """(score, host_share, path_share) of rows (host, path, evidence, p) by plain loops."""
    base = np.log(prior / (1 - prior))

    def weight(groups):
        total = noises = more = 0.0
        for n, good, parent in groups:
            if n > 1:
                noise = parent * (1 - parent)
                total, noises, more = total + n * (good / n - parent) ** 2, noises + noise, more + (n - 1) * noise
        if not more:
            return quality.MOST_WEIGHT
        between = (total - noises) / more
        return quality.MOST_WEIGHT if between <= 1 / (quality.MOST_WEIGHT + 1) else min(quality.MOST_WEIGHT, max(quality.LEAST_WEIGHT, 1 / between - 1))

    p = [1 / (1 + np.exp(-(e + base))) for _, _, e in docs]
    hosts, paths = defaultdict(lambda: [0, 0.0]), defaultdict(lambda: [0, 0.0])
    for (h, s, _), own in zip(docs, p):
        for group in (hosts[h], paths[h, s]):
            group[0] += 1
            group[1] += own
    share = (sum(p) + prior) / (len(p) + 1)
    a = weight([(n, g, share) for n, g in hosts.values()])
    b = weight([(n, g, (share * a + hosts[h][1]) / (a + hosts[h][0])) for (h, _), (n, g) in paths.items()])
    out = []
    for (h, s, e), own in zip(docs, p):
        host = (share * a + hosts[h][1] - own) / (a + hosts[h][0] - 1)
        path = (host * b + paths[h, s][1] - own) / (b + paths[h, s][0] - 1)
        held = min(max(path, 1e-6), 1 - 1e-6)
        out.append((1 / (1 + np.exp(-(e + np.log(held / (1 - held))))), host, path))
    return out


def test_posteriors_by_plain_loops(spark):
    rnd = random.Random(11)
    weights = np.zeros(1 << linear.SLOT_BITS, dtype=np.float32)
    for text, w in (("word", 2.0), ("###", -2.5), ("12", 0.5)):
        weights[quality.features(text)[0][0]] = w
    model = linear.Linear(weights, 0.2)
    rows = []
    for i in range(400):
        host = rnd.choice(["a", "b", "c", None, "tiny%d" % i])
        good = {"a": 0.9, "b": 0.2}.get(host, 0.6)
        rows.append((i, host, rnd.choice(["x", "y", None]), "word" if rnd.random() < good else rnd.choice(["###", "12", ""])))
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, text string").repartition(3)
    got = {r["doc_id"]: r for r in quality.score_quality(docs, model, 0.7).collect()}
    want = shrunk([(h, s, got[i]["evidence"]) for i, h, s, _ in rows], 0.7)
    base = np.log(0.7 / 0.3)
    for (i, _, _, text), (score, host, path) in zip(rows, want):
        assert abs(got[i]["evidence"] - (model.logit(*quality.features(text)) - base)) < 1e-9
        assert np.allclose([got[i]["score"], got[i]["host_share"], got[i]["path_share"]], [score, host, path], atol=1e-9)


def test_toxicity_of_odd_rows(spark):
    docs = spark.createDataFrame([(i, "good words" if i % 2 else "bad words") for i in range(40)] + [(99, None), (None, "x")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, (i + 1) % 2) for i in range(40)] + [(99, 1), (None, 1), (5, None), (7, 3)], "doc_id long, toxic int")
    model = toxicity.learn(docs, labels)
    ask = spark.createDataFrame([(1, "bad"), (1, "bad"), (2, "good"), (3, None), (4, ""), (5, "bad " * 100000)], "doc_id long, text string").withColumn("Score", F.lit(7))
    out = toxicity.score_toxicity(ask, model)
    assert out.columns == ["doc_id", "text", "score"]
    got = out.toPandas().groupby("doc_id")["score"].agg(["min", "max"])
    assert (got["min"] == got["max"]).all() and got.loc[1, "min"] == got.loc[5, "min"] > got.loc[3, "min"] == got.loc[4, "min"] > got.loc[2, "min"]
    nothing = toxicity.learn(docs.limit(0), labels.limit(0))
    assert {r["score"] for r in toxicity.score_toxicity(ask, nothing).collect()} == {0.5}
    assert toxicity.score_toxicity(ask.limit(0), model).count() == 0


def test_quality_held_out(tables):
    docs, labels = tables
    got = quality.quality_digest(docs, labels).join(labels, "doc_id").where("held_out").toPandas()
    assert got["predicted"][got["quality"] == 1].mean() > 0.99 and got["predicted"][got["quality"] == 0].mean() < 0.2


def test_sites_are_shrunk(spark):
    size = 1 << linear.SLOT_BITS
    weights = np.zeros(size, dtype=np.float32)
    good, bad = (quality.features(t)[0][0] for t in ("word", "###"))
    weights[good], weights[bad] = 3.0, -3.0
    model = linear.Linear(weights, 0.0)
    rows = []
    for host, n, share in (("big-good", 300, 0.97), ("big-bad", 300, 0.1), ("tiny-good", 1, 1.0), ("tiny-bad", 1, 0.0)):
        rows += [(host, "p%d" % (i % 2), "word" if i < share * n else "###") for i in range(n)]
    rows += [(None, None, "..."), ("big-bad", "p0", "..."), ("big-good", "p0", "..."), ("big-good", "new", "...")]
    docs = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, source string, lang string, text string")
    got = quality.score_quality(docs, model, 0.5).toPandas().set_index("doc_id").sort_index()
    n = len(rows)
    everywhere = got["evidence"].between(-1, 1)
    assert everywhere[n - 4 :].all()
    none, in_bad, in_good, new = (got.loc[n - k, "score"] for k in (4, 3, 2, 1))
    assert in_bad < none < in_good and in_bad < 0.35 and in_good > 0.75
    assert abs(new - in_good) < 0.1
    tiny = got[got["source"].isin(["tiny-good", "tiny-bad"])]
    assert np.ptp(tiny["host_share"]) < 1e-9


def test_quality_of_odd_rows(spark):
    docs = spark.createDataFrame([(1, "a b", "s", "en"), (1, "a b", "s", "en"), (2, None, None, None), (3, "", "s", None), (4, "w " * 100000, "s", "en")], "doc_id long, text string, source string, lang string").withColumn("Predicted", F.lit("x"))
    labels = spark.createDataFrame([(1, 1), (2, None)], "doc_id long, quality int")
    model, prior = quality.learn(docs, labels)
    out = quality.score_quality(docs, model, prior)
    assert out.columns == ["doc_id", "text", "source", "lang", "evidence", "host_share", "path_share", "score", "predicted"]
    got = out.collect()
    assert len(got) == 5 and all(0 <= r["score"] <= 1 and r["predicted"] in (0, 1) for r in got)
    assert quality.score_quality(docs.limit(0), model, prior).count() == 0
