"""Logistic models over hashed features, learnt on the driver from a bounded sample."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from aerolake.llm.common import mapped, stored

#: Slots of the hashed features, as a power of two.
SLOT_BITS = 18
#: The learning sample: labelled rows of each label at most, taken by a hash of their id.
SAMPLE_ROWS = 5000
STEPS = 1000
#: A feature takes part if its likelihood-ratio statistic against the label is this large: one in a thousand by chance.
TELLING = 10.8


@dataclass
class Linear:
    """score = 1 / (1 + exp(-(bias + weights of the features)))."""

    weights: np.ndarray
    bias: float
    name: str = field(default_factory=lambda: uuid.uuid4().hex)

    def logit(self, slots: np.ndarray, values: np.ndarray) -> float:
        return float(self.bias + self.weights[slots] @ values)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


@dataclass
class Rows:
    """Sparse rows: slots and values of all rows one after the other, and the length of each."""

    slots: np.ndarray
    values: np.ndarray
    sizes: np.ndarray

    @staticmethod
    def of(slots: list, values: list) -> Rows:
        join = lambda parts, kind: np.concatenate([np.asarray(p, dtype=kind) for p in parts] + [np.zeros(0, dtype=kind)])
        return Rows(join(slots, np.int64), join(values, np.float64), np.array([len(s) for s in slots], dtype=np.int64))

    def only(self, chosen: np.ndarray) -> Rows:
        """The rows with the chosen slots alone, numbered from 0."""
        good = chosen[self.slots]
        row = np.repeat(np.arange(len(self.sizes)), self.sizes)[good]
        return Rows((np.cumsum(chosen) - 1)[self.slots[good]], self.values[good], np.bincount(row, minlength=len(self.sizes)))

    def times(self, weights: np.ndarray) -> np.ndarray:
        ends = np.cumsum(self.sizes)
        sums = np.concatenate([[0.0], np.cumsum(weights[self.slots] * self.values)])
        return sums[ends] - sums[ends - self.sizes]

    def back(self, signal: np.ndarray, size: int) -> np.ndarray:
        return np.bincount(self.slots, weights=np.repeat(signal, self.sizes) * self.values, minlength=size)


def telling(rows: Rows, labels: np.ndarray, least: float = TELLING) -> np.ndarray:
    """Which slots are in rows of one label more often than chance explains."""
    size = 1 << SLOT_BITS
    ones, zeros = labels.sum(), len(labels) - labels.sum()
    a = np.bincount(rows.slots, weights=np.repeat(labels, rows.sizes), minlength=size)
    b = np.bincount(rows.slots, minlength=size) - a
    share = np.clip((a + b) / len(labels), 1e-9, 1 - 1e-9)

    def gain(k: np.ndarray, n: float) -> np.ndarray:
        own = np.clip(k / n, 1e-12, 1 - 1e-12)
        return k * np.log(own / share) + (n - k) * np.log((1 - own) / (1 - share))

    return 2 * (gain(a, ones) + gain(b, zeros)) >= least


def fit(rows: Rows, labels: np.ndarray, prior: float, ridge: float, swaps: Rows | None = None, penalty: float = 0.0, steps: int = STEPS) -> Linear:
    """Weighted so that both labels count alike, then shifted to the prior share of label 1.

    ``swaps`` are rows of feature changes; the mean squared change of the logit over them is penalised.
    """
    size = 1 << SLOT_BITS
    if len(labels) == 0 or labels.min() == labels.max():
        return Linear(np.zeros(size, dtype=np.float32), float(np.log(prior / (1 - prior))))
    share = labels.mean()
    weight = np.where(labels == 1, 0.5 / share, 0.5 / (1 - share)) / len(labels)
    chosen = telling(rows, labels)
    used = np.flatnonzero(chosen)
    own = rows.only(chosen)
    change = swaps.only(chosen) if swaps and len(swaps.sizes) else None
    w, bias = np.zeros(len(used) + 1), 0.0
    first, second = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, steps + 1):
        signal = weight * (sigmoid(own.times(w[:-1]) + w[-1]) - labels)
        slope = np.append(own.back(signal, len(used)), signal.sum()) + ridge * np.append(w[:-1], 0)
        if change is not None:
            slope[:-1] += penalty * change.back(2 * change.times(w[:-1]) / len(change.sizes), len(used))
        first, second = 0.9 * first + 0.1 * slope, 0.999 * second + 0.001 * slope * slope
        w -= 0.1 * (1 - step / (steps + 1)) * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-10)
    weights = np.zeros(size, dtype=np.float32)
    weights[used] = w[:-1]
    return Linear(weights, float(w[-1] + np.log(prior / (1 - prior))))


def _first(known: DataFrame, label: int, count: int, rows: int) -> DataFrame:
    """The ids of this label with the smallest hashes, so many at most.

    Of more labels than that, those below a limit of the hash are taken first, which leaves a few more
    than wanted; so neither a hot id nor a long table reaches the task that orders them.
    """
    ids = known.where(F.col("label") == label)
    if count > 2 * rows:
        ids = ids.where(F.xxhash64("doc_id") < int(-(1 << 63) + (1 << 64) * min(1.0, 1.5 * rows / count)))
    return ids.distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)


def sample(docs: DataFrame, labels: DataFrame, label: str, rows: int = SAMPLE_ROWS) -> tuple[DataFrame, float]:
    """(text, label) of a bounded sample of labelled documents, and the share of label 1 among all labels.

    Labels that are neither 0 nor 1, and documents without a text, are left out. Of rows that share an id one
    text is taken, the smallest; an id with both labels may be in the sample with both.
    """
    known = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull()).select("doc_id", F.col(label).cast("int").alias("label"))
    counts = dict(map(tuple, known.groupBy("label").agg(F.count(F.lit(1))).collect()))
    zeros, ones = counts.get(0, 0), counts.get(1, 0)
    prior = (ones + 1) / (zeros + ones + 2)
    chosen = stored(_first(known, 0, zeros, rows).unionByName(_first(known, 1, ones, rows)), "label-sample")
    # At most 2 * rows ids: small enough to send to where the texts are.
    found = docs.where(F.col("text").isNotNull()).select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    return found.groupBy("doc_id", "label").agg(F.min("text").alias("text")).select("text", "label"), prior


#: How features travel: slots and values take four bytes each.
_KINDS = {"slots": np.int32, "values": np.float32, "sizes": np.int64}


def collected(rows: DataFrame, features, more=None) -> tuple[Rows, np.ndarray, Rows]:
    """Features, labels and feature changes of the sample, made by the executors."""

    def step(texts: list[str]) -> list[list]:
        own = [Rows.of(*[[part] for part in features(t)]) for t in texts]
        changes = [Rows.of(*map(list, zip(*found))) if more and (found := more(t)) else Rows.of([], []) for t in texts]
        return [[getattr(r, part).astype(kind).tobytes() for r in side] for side in (own, changes) for part, kind in _KINDS.items()]

    names = [f"{side}_{part}" for side in ("own", "change") for part in _KINDS]
    found = mapped(rows, "text", {n: BinaryType() for n in names}, step, ["label"]).collect()
    own, changes = (
        Rows(*[np.frombuffer(b"".join(r[f"{side}_{part}"] for r in found), dtype=kind) for part, kind in _KINDS.items()]) for side in ("own", "change")
    )
    return own, np.array([r["label"] for r in found], dtype=float), changes
