"""Language identification by prediction with partial matching over bytes.

A language's model is a tree of byte contexts of up to ORDER bytes with the symbols seen
after each, and is frozen after learning. A byte costs -log2 of its share in the longest
context that was seen; where the byte is new there, an escape is paid and the next
shorter context tried (escape method C, without exclusions; a byte that no context knows costs 8
bits). The language with the shortest code for the whole text wins.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType
from pyspark.sql.window import Window

from aerolake.llm.common import by_frame, held, mapped, ready, remainder, stored

ORDER = 4
#: The sample that a model is learnt from: documents of a language at most, and of all languages together
#: (but one of each at least), taken by a hash of their id.
SAMPLE_DOCS = 400
SAMPLE_TOTAL = 20_000
#: Bytes scored at a time.
SLICE = 1 << 18
#: Slots of the table of code lengths of contexts that learning saw, as a power of two, and the code lengths
#: that it and a slice may have: with many languages both get shorter.
TABLE_BITS = 20
CELLS = 1 << 24

_MASK = [(1 << 8 * (k + 1)) - 1 for k in range(ORDER + 1)]
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


def grams(data: bytes, before: bytes = b"") -> np.ndarray:
    """Each byte with the ORDER bytes before it, packed; zeros stand before the first."""
    padded = np.frombuffer((bytes(ORDER) + before)[-ORDER:] + data, dtype=np.uint8)
    out = np.zeros(len(data), dtype=np.uint64)
    for k in range(ORDER + 1):
        out = (out << np.uint64(8)) | padded[k : k + len(data)]
    return out


@dataclass
class Tree:
    """The contexts of one language, for each order: sorted keys and what they cost."""

    keys: list[np.ndarray]
    bits: list[np.ndarray]
    contexts: list[np.ndarray]
    escapes: list[np.ndarray]

    @staticmethod
    def of(found: np.ndarray, counts: np.ndarray) -> Tree:
        tree = Tree([], [], [], [])
        for k in range(ORDER + 1):
            keys, inverse = np.unique(found & np.uint64(_MASK[k]), return_inverse=True)
            n = np.bincount(inverse, weights=counts)
            contexts, at = np.unique(keys >> np.uint64(8), return_inverse=True)
            seen, kinds = np.bincount(at, weights=n), np.bincount(at)
            tree.keys.append(keys)
            tree.bits.append(np.log2((seen + kinds)[at] / n))
            tree.contexts.append(contexts)
            tree.escapes.append(np.log2((seen + kinds) / kinds))
        return tree

    def cost(self, wanted: np.ndarray) -> np.ndarray:
        total, open_ = np.zeros(len(wanted)), np.arange(len(wanted))
        for k in range(ORDER, -1, -1):
            key = wanted[open_] & np.uint64(_MASK[k])
            at, hit = _found(self.keys[k], key)
            total[open_[hit]] += self.bits[k][at[hit]]
            open_, key = open_[~hit], key[~hit]
            at, known = _found(self.contexts[k], key >> np.uint64(8))
            total[open_[known]] += self.escapes[k][at[known]]
        total[open_] += 8
        return total


def _found(table: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(table):
        return np.zeros(len(wanted), dtype=int), np.zeros(len(wanted), dtype=bool)
    at = np.minimum(np.searchsorted(table, wanted), len(table) - 1)
    return at, table[at] == wanted


@dataclass
class Model:
    """Frozen statistics of all languages; ``name`` tells models apart in a Python worker."""

    languages: list[str]
    grams: list[np.ndarray]
    counts: list[np.ndarray]
    name: str = field(default_factory=lambda: uuid.uuid4().hex)


class Scorer:
    def __init__(self, model: Model) -> None:
        self.languages = model.languages
        self.trees = [Tree.of(g, n) for g, n in zip(model.grams, model.counts)]
        room = CELLS // max(1, len(self.trees))
        self.table_bits = max(1, min(TABLE_BITS, room.bit_length() - 1))
        self.slice = max(1, min(SLICE, room))
        known = np.unique(np.concatenate([*model.grams, np.zeros(0, np.uint64)]))
        slot = self._slot(known)
        self.keys = np.full(1 << self.table_bits, np.uint64(0xFFFFFFFFFFFFFFFF))
        self.keys[slot] = known  # of keys that share a slot the last stays, the others are looked up
        slot = np.unique(slot)
        self.values = np.zeros((1 << self.table_bits, len(self.trees)), dtype=np.float32)
        for at in range(0, len(slot), self.slice):
            part = slot[at : at + self.slice]
            self.values[part] = self.cost(self.keys[part])

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * _SPREAD) >> np.uint64(64 - self.table_bits)).astype(np.int64)

    def cost(self, keys: np.ndarray) -> np.ndarray:
        return np.stack([t.cost(keys) for t in self.trees], axis=1) if self.trees else np.zeros((len(keys), 0))

    def _sums(self, keys: np.ndarray, starts: list[int]) -> np.ndarray:
        slot = self._slot(keys)
        values, missed = self.values[slot], np.flatnonzero(self.keys[slot] != keys)
        if len(missed):
            rare, inverse = np.unique(keys[missed], return_inverse=True)
            values[missed] = self.cost(rare)[inverse]
        return np.add.reduceat(values, starts, axis=0, dtype=np.float64)

    def bits(self, texts: list[bytes]) -> np.ndarray:
        """The code length of each text in each language."""
        out = np.zeros((len(texts), len(self.trees)))
        waiting: list[np.ndarray] = []
        owners: list[int] = []
        size = 0

        def settle() -> None:
            nonlocal waiting, owners, size
            if waiting:
                starts = np.cumsum([0, *[len(w) for w in waiting[:-1]]])
                np.add.at(out, owners, self._sums(np.concatenate(waiting), starts))
            waiting, owners, size = [], [], 0

        for i, text in enumerate(texts):
            for at in range(0, len(text), self.slice):
                waiting.append(grams(text[at : at + self.slice], text[max(0, at - ORDER) : at]))
                owners.append(i)
                size += len(waiting[-1])
                if size >= self.slice:
                    settle()
        settle()
        return out


def scorer(model: Model) -> Scorer:
    """One for each Python worker."""
    return held(model.name, lambda: Scorer(model))


def learn(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_total: int = SAMPLE_TOTAL) -> Model:
    """A model of all languages in ``lang``; rows with a null text or lang are left out.

    Learns from sample_docs documents of each language at most and from sample_total in all, but from one of
    each language at least; of rows that share id and language, from one text. Counting is done by Spark; the
    driver gets the distinct contexts of the sample.
    """
    ready(docs.sparkSession)
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    good = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "lang", "text")
    labelled = good.select("doc_id", "lang")
    ranked = labelled.distinct().withColumn("n", F.row_number().over(order)).where(F.col("n") <= sample_docs)
    chosen = stored(ranked.select("doc_id", "lang", "n"), "language-sample")
    each = max(1, sample_total // max(1, chosen.select("lang").distinct().count()))
    # At most sample_total ids, or one of each language: small enough to send to where the texts are.
    chosen = F.broadcast(chosen.where(F.col("n") <= each).drop("n").withColumnsRenamed({"doc_id": "__id", "lang": "__lang"}))
    found = good.join(chosen, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("lang") == F.col("__lang")), "left_semi")
    sample = found.groupBy("doc_id", "lang").agg(F.min("text").alias("text")).select("lang", "text")

    def counted(frame: pd.DataFrame) -> pd.DataFrame:
        parts = []
        for lang, group in frame.groupby("lang"):
            keys, n = np.unique(np.concatenate([grams(t.encode()) for t in group["text"]]), return_counts=True)
            parts.append(pd.DataFrame({"lang": lang, "gram": keys.astype(np.int64), "n": n}))
        return pd.concat(parts)

    counts = by_frame(sample, counted, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    found = counts.toPandas().sort_values(["lang", "gram"])
    groups = [(lang, g) for lang, g in found.groupby("lang")]
    return Model([x for x, _ in groups], [g["gram"].to_numpy(np.uint64) for _, g in groups], [g["n"].to_numpy(np.float64) for _, g in groups])


def predict_language(docs: DataFrame, model: Model, keep: list[str] | None = None) -> DataFrame:
    """The kept columns (all by default) with lang_pred and score.

    The score is the posterior of the predicted language under equal priors; of equal code lengths
    the smaller name wins. ``und`` with score 0 where the text is null or has no letter, or no
    language was learnt. Columns of the input named like the new ones are replaced.
    Repeated rows get equal results; an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def step(texts: list[str | None]) -> list[list]:
        table = scorer(shared.value)
        good = [i for i, t in enumerate(texts) if table.languages and t and any(map(str.isalpha, t))]
        names, scores = ["und"] * len(texts), [0.0] * len(texts)
        bits = table.bits([texts[i].encode() for i in good])
        for i, row in zip(good, bits):
            best = int(row.argmin())
            names[i] = table.languages[best]
            scores[i] = float(1 / np.exp2(np.maximum(row[best] - row, -1000)).sum())
        return [names, scores]

    return mapped(docs, "text", {"lang_pred": StringType(), "score": DoubleType()}, step, keep)


def held_out(doc_id: Column) -> Column:
    return remainder(doc_id, 4) == 2


def language_digest(docs: DataFrame) -> DataFrame:
    model = learn(docs.where(~held_out(F.col("doc_id"))))
    return predict_language(docs, model, ["doc_id"]).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
