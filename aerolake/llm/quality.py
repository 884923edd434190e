"""Document quality by hierarchical empirical Bayes.

A classifier reads the text: how words are written, not which they are. Its evidence is summed
for each host and each section (path) of a host. A host's share of good documents is shrunk towards the
share of all, a section's towards its host's, as strongly as the spread between hosts and
between sections asks for, so a site with few documents follows its parent. A document's own
evidence, left out of its site's, then moves its site's share to its posterior.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from aerolake.llm import linear
from aerolake.llm.common import mapped, ready, remainder, stored, without
from aerolake.llm.minhash import word_hashes

RIDGE = 3e-6
THRESHOLD = 0.5
#: Bounds of the weight of a parent's share, in documents.
LEAST_WEIGHT, MOST_WEIGHT = 1.0, 1e6

# Small letters and all bytes beyond ASCII look alike, so do capitals and digits; other bytes stay.
_SHAPE = bytes(97 if 97 <= b <= 122 or b >= 128 else 66 if 65 <= b <= 90 else 48 if 48 <= b <= 57 else b for b in range(256))

_PAIR = np.uint64(0x9E3779B97F4A7C15)
#: A slot for each tenth of repeated pairs of neighbouring words, and one for texts without pairs.
_REPEATED = [int(word_hashes(b"repeated:%d" % k)[0] >> np.uint64(64 - linear.SLOT_BITS)) for k in range(11)]


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Slots of the word shapes, with the square root of their share of all words, and that of the share of repeated word pairs."""
    data = np.frombuffer((text or "").encode().translate(_SHAPE), dtype=np.uint8)
    # Capitals become 'x', since hashing words drops case; runs of one kind of letter become one.
    data = np.where(data == 66, 120, data)
    letter = (data == 97) | (data == 120) | (data == 48)
    stay = np.ones(len(data), dtype=bool)
    stay[1:] = ~letter[1:] | (data[1:] != data[:-1])
    shapes = word_hashes(data[stay].astype(np.uint8).tobytes())
    slots, counts = np.unique((shapes >> np.uint64(64 - linear.SLOT_BITS)).astype(np.int64), return_counts=True)
    words = word_hashes((text or "").encode())
    pairs = words[:-1] * _PAIR + words[1:]
    repeated = int(10 * (1 - len(np.unique(pairs)) / len(pairs))) if len(pairs) else 10
    return np.append(slots, _REPEATED[repeated]), np.append(np.sqrt(counts / max(1, counts.sum())), 1.0)


def learn(docs: DataFrame, labels: DataFrame, sample_rows: int = linear.SAMPLE_ROWS) -> tuple[linear.Linear, float]:
    """A model of labels.quality from at most sample_rows documents of each label, and the share of good ones."""
    ready(docs.sparkSession)
    rows, prior = linear.sample(docs, labels, "quality", sample_rows)
    own, marks, _ = linear.collected(rows, features)
    return linear.fit(own, marks, prior, RIDGE), prior


def _weight(groups: DataFrame, parent_share: Column) -> float:
    """How many documents the parent's share counts for: by moments, from the spread of groups around their parents."""
    n, good = F.col("n"), F.col("good")
    share = good / n
    noise = parent_share * (1 - parent_share)
    found = groups.where("n > 1").agg(
        F.sum(n * (share - parent_share) * (share - parent_share)), F.sum(noise), F.sum((n - 1) * noise), F.count(F.lit(1))
    ).first()
    if not found[3] or not found[2]:
        return MOST_WEIGHT
    # n * (share - parent)^2 is noise * (1 + (n - 1) / (weight + 1)) on average.
    between = (found[0] - found[1]) / found[2]
    return MOST_WEIGHT if between <= 1 / (MOST_WEIGHT + 1) else min(MOST_WEIGHT, max(LEAST_WEIGHT, 1 / between - 1))


def score_quality(docs: DataFrame, model: linear.Linear, prior: float, host: Column | None = None, path: Column | None = None, keep: list[str] | None = None) -> DataFrame:
    """The kept columns (all by default) with evidence, host_share, path_share, score and predicted.

    ``host`` and ``path`` are columns of docs' rows, by default source and lang; a null is a host
    or path like any other. evidence is the classifier's log likelihood ratio, score the posterior that
    the document is good, predicted 1 if that is at least THRESHOLD. Null and empty texts have
    the evidence of no words. Columns of the input named like the new ones are replaced. Repeated
    rows count each. An empty table gives no rows.
    """
    made = ["evidence", "host_share", "path_share", "score", "predicted", "__host", "__path", "__p"]
    docs = without(docs, *made)
    kept = [c for c in (docs.columns if keep is None else keep) if c in docs.columns]
    sited = docs.withColumns({"__host": F.col("source") if host is None else host, "__path": F.col("lang") if path is None else path})
    shared = docs.sparkSession.sparkContext.broadcast(model)
    base = float(np.log(prior / (1 - prior)))

    def step(texts: list[str | None]) -> list[list]:
        return [[shared.value.logit(*features(t)) - base for t in texts]]

    rows = mapped(sited, "text", {"evidence": DoubleType()}, step, [*kept, "__host", "__path"])
    rows = stored(rows.withColumn("__p", 1 / (1 + F.exp(-(F.col("evidence") + base)))), "quality-rows")
    paths = stored(rows.groupBy("__host", "__path").agg(F.count(F.lit(1)).alias("n"), F.sum("__p").alias("good")), "quality-paths")
    hosts = paths.groupBy("__host").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    total = hosts.agg(F.sum("n"), F.sum("good")).first()
    share = F.lit(float((total[1] or 0) + prior) / ((total[0] or 0) + 1))
    host_weight = _weight(hosts, share)
    hosts = hosts.withColumn("host_share", (share * host_weight + F.col("good")) / (host_weight + F.col("n")))
    sites = paths.join(hosts.select(F.col("__host").alias("h"), "host_share", F.col("n").alias("host_n"), F.col("good").alias("host_good")), F.col("__host").eqNullSafe(F.col("h")))
    sites = stored(sites.drop("h"), "quality-sites")
    path_weight = _weight(sites, F.col("host_share"))
    p, n, good = F.col("__p"), F.col("n"), F.col("good")
    # The document's own share is left out of both levels.
    host_share = (share * host_weight + F.col("host_good") - p) / (host_weight + F.col("host_n") - 1)
    path_share = (host_share * path_weight + good - p) / (path_weight + n - 1)
    held = F.greatest(F.least(path_share, F.lit(1 - 1e-6)), F.lit(1e-6))
    sites = sites.select(F.col("__host").alias("h"), F.col("__path").alias("s"), "n", "good", "host_n", "host_good")
    score = 1 / (1 + F.exp(-(F.col("evidence") + F.log(held / (1 - held)))))
    return (
        rows.join(sites, F.col("__host").eqNullSafe(F.col("h")) & F.col("__path").eqNullSafe(F.col("s")))
        .select(*[F.col(f"`{c}`") for c in kept], "evidence", host_share.alias("host_share"), path_share.alias("path_share"), score.alias("score"))
        .withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
    )


def held_out(doc_id: Column) -> Column:
    return remainder(doc_id, 3) == 1


def quality_digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    model, prior = learn(docs, labels.where(~held_out(F.col("doc_id"))))
    scored = score_quality(docs, model, prior, keep=["doc_id"])
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "evidence", "host_share", "path_share", "score", "predicted")
