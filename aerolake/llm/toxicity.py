"""Toxicity by a logistic model that is regularised with counterfactuals.

For each mention of a group in a labelled document the term is swapped for others of its kind, and the
change of the score is penalised. A group's name then says as little as a neutral word.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from aerolake.llm import linear
from aerolake.llm.common import mapped, ready, remainder
from aerolake.llm.minhash import word_hashes

#: Terms of one kind; the first are neutral and pull the others to them.
IDENTITIES = (
    ("people", "persons", "humans", "women", "men", "girls", "boys", "transgender", "nonbinary"),
    ("person", "human", "woman", "man", "girl", "boy"),
    ("believers", "christians", "muslims", "jews", "hindus", "buddhists", "sikhs", "atheists", "catholics", "protestants"),
    ("religious", "christian", "muslim", "jewish", "hindu", "buddhist", "sikh", "atheist", "catholic", "protestant"),
    ("citizen", "immigrant", "migrant", "refugee", "foreigner", "black", "white", "asian", "african", "arab", "latino", "indigenous"),
    ("citizens", "immigrants", "migrants", "refugees", "foreigners", "blacks", "whites", "asians", "africans", "arabs", "latinos"),
    ("straight", "gay", "lesbian", "bisexual", "queer", "homosexual", "heterosexual"),
    ("young", "old", "elderly", "disabled", "deaf", "blind", "autistic"),
)
THRESHOLD = 0.7
RIDGE = 3e-6
PENALTY = 0.1

_PLAIN = bytes(b if chr(b).isalnum() or b >= 128 else 32 for b in range(256))


def _slots(text: bytes) -> np.ndarray:
    return (word_hashes(text.translate(_PLAIN)) >> np.uint64(64 - linear.SLOT_BITS)).astype(np.int64)


_TERMS = [np.array([int(_slots(t.encode())[0]) for t in kind]) for kind in IDENTITIES]


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """The distinct words, in lower case and without punctuation, each with value 1."""
    slots = np.unique(_slots((text or "").encode()))
    return slots, np.ones(len(slots))


def swaps(text: str) -> list[tuple[list[int], list[float]]]:
    """The change of the features by each swap of a group term for another of its kind."""
    slots, _ = features(text)
    out = []
    for kind in _TERMS:
        there = np.isin(kind, slots)
        out += [([int(a), int(b)], [-1.0, 1.0]) for a in kind[there] for b in kind[~there]]
    return out


def learn(docs: DataFrame, labels: DataFrame, sample_rows: int = linear.SAMPLE_ROWS, penalty: float = PENALTY) -> linear.Linear:
    """A model of labels.toxic from at most sample_rows documents of each label."""
    ready(docs.sparkSession)
    rows, prior = linear.sample(docs, labels, "toxic", sample_rows)
    own, marks, changes = linear.collected(rows, features, swaps)
    return linear.fit(own, marks, prior, RIDGE, changes, penalty)


def score_toxicity(docs: DataFrame, model: linear.Linear, keep: list[str] | None = None) -> DataFrame:
    """The kept columns (all by default) with score, from 0 to 1 over the whole text.

    Null and empty texts get the score of the bias alone. A score column of the input is replaced.
    Repeated rows get equal scores; an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def step(texts: list[str | None]) -> list[list]:
        return [linear.sigmoid(np.array([shared.value.logit(*features(t)) for t in texts]))]

    return mapped(docs, "text", {"score": DoubleType()}, step, keep)


def held_out(doc_id: Column) -> Column:
    return remainder(doc_id, 3) == 1


def toxicity_digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    model = learn(docs, labels.where(~held_out(F.col("doc_id"))))
    scored = score_toxicity(docs, model, ["doc_id"])
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
