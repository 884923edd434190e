"""Groups of spelling variants, by composing automata.

The minimised acceptor of the vocabulary, a transducer that makes one edit, and the acceptor again:
what the composition accepts are the pairs of words one inserted, deleted or replaced letter apart. Its states are
(p, edits, q). Up to the edit both sides are in the same state, so a state before the edit is a prefix, and
the words are dealt by prefixes: by the shortest that few enough words begin with. Each task composes the acceptor of
what follows its prefix with itself. Edits that come before that prefix ends start in one of few states, the prefixes
of many words; there both sides continue alike after the edit, so they meet by prefix and rest.

Words too long for a task to hold are cut: pairs that agree outside a block of 64 letters are
found by what lies outside, and their blocks are composed like words.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolake.llm.common import by_frame, ready, stored

RUN = re.compile("[A-Za-zÀ-ÿ]+")
MIN_LENGTH = 6
MIN_COUNT = 5
#: A form has at least so many times the occurrences of the word.
RATIO = 5
#: Words that begin with one prefix, for a task to compose their acceptor.
WORDS = 20_000
#: Letters of a prefix whose words are counted in one job.
DEPTH = 6
#: Longer words are compared by blocks of BLOCK letters.
LONG = 256
BLOCK = 64
#: One run in DROP loses a letter.
DROP = 199

_LOW = {c: c + 32 for c in range(65, 91)}


def variant(doc_id: object, run: str) -> str:
    """The run, without one letter if a hash of document and run says so."""
    h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
    if h % DROP:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def vocabulary(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n): words of whole texts, with at least so many letters and occurrences."""

    def counted(frame: pd.DataFrame) -> pd.DataFrame:
        words: Counter[str] = Counter()
        for doc_id, text in zip(frame["id"], frame["text"]):
            for run, n in Counter(run.translate(_LOW) for run in RUN.findall(text)).items():
                words[variant(doc_id, run)] += n
        good = [(w, n) for w, n in words.items() if len(w) >= min_length]
        return pd.DataFrame({"word": pd.Series([w for w, _ in good], dtype=object), "n": pd.Series([n for _, n in good], dtype="int64")})

    texts = docs.where(F.col("text").isNotNull()).select(F.col("doc_id").cast("string").alias("id"), "text")
    counts = by_frame(texts, counted, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.where(F.col("n") >= min_count)


class Acceptor:
    """The smallest deterministic automaton of sorted words: state to {letter: state}, and which states end a word."""

    def __init__(self, words: list[str]) -> None:
        self.next: list[dict[str, int]] = [{}]
        self.final: list[bool] = [False]
        known: dict[tuple, int] = {}
        path: list[int] = [0]
        last = ""

        def merge(down: int) -> None:
            """States below this depth of the last word get no more words: equal ones become one."""
            while len(path) - 1 > down:
                state = path.pop()
                key = (self.final[state], *self.next[state].items())
                same = known.setdefault(key, state)
                if same != state:
                    self.next[path[-1]][last[len(path) - 1]] = same
                    self.next.pop(), self.final.pop()  # the newest state: all below it were merged before
                    assert state == len(self.next)

        for word in words:
            shared = 0
            for a, b in zip(word, last):
                if a != b:
                    break
                shared += 1
            merge(shared)
            last = word
            for letter in word[shared:]:
                self.next.append({})
                self.final.append(False)
                self.next[path[-1]][letter] = len(self.next) - 1
                path.append(len(self.next) - 1)
            self.final[path[-1]] = True
        merge(0)

    def words_of_both(self, p: int, q: int, memo: dict[tuple[int, int], list[str]]) -> list[str]:
        """What both states accept, which is what may follow an edit."""
        if p > q:
            p, q = q, p
        if (found := memo.get((p, q))) is not None:
            return found
        # A stack instead of recursion, since words may be long.
        stack = [(p, q)]
        while stack:
            a, b = stack[-1]
            if (a, b) in memo:
                stack.pop()
                continue
            steps = [(x, min(s, t), max(s, t)) for x, s in self.next[a].items() if (t := self.next[b].get(x)) is not None] if a != b else []
            missing = [(s, t) for _, s, t in steps if (s, t) not in memo]
            if missing:
                stack += missing
                continue
            stack.pop()
            if a == b:
                memo[a, b] = list(self.accepted(a))
            else:
                memo[a, b] = [""] * (self.final[a] and self.final[b]) + [x + rest for x, s, t in steps for rest in memo[s, t]]
        return memo[p, q]

    def accepted(self, state: int) -> Iterator[str]:
        stack = [(state, "")]
        while stack:
            at, word = stack.pop()
            if self.final[at]:
                yield word
            stack += [(s, word + x) for x, s in self.next[at].items()]

    def pairs(self) -> Iterator[tuple[str, str]]:
        """Pairs of words that one edit turns into each other, some of them more than once."""
        memo: dict[tuple[int, int], list[str]] = {}
        stack = [(0, "")]
        while stack:
            state, prefix = stack.pop()
            steps = list(self.next[state].items())
            for i, (a, s) in enumerate(steps):
                stack.append((s, prefix + a))
                for rest in self.words_of_both(state, s, memo):
                    yield prefix + rest, prefix + a + rest
                for b, t in steps[:i]:
                    for rest in self.words_of_both(s, t, memo):
                        yield prefix + a + rest, prefix + b + rest


def _large_prefixes(words: DataFrame, limit: int, depth: int) -> set[str]:
    """Prefixes that more than limit words begin with: at most length * words / limit, and with each all shorter ones."""
    large: set[str] = set()
    at, open_ = 0, words
    while True:
        lengths = F.sequence(F.lit(at), F.least(F.length("word"), F.lit(at + depth - 1)))
        each = open_.where(F.length("word") >= at).select(F.explode(F.transform(lengths, lambda k: F.left("word", k))).alias("prefix"))
        found = {r["prefix"] for r in each.groupBy("prefix").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > limit).collect()}
        large |= found
        at += depth
        last = [p for p in found if len(p) == at - 1]
        if not last:
            return large
        open_ = words.where(F.left("word", F.lit(at - 1)).isin(last))


def _blocks(word: str) -> Iterator[tuple[bytes, str]]:
    """(what lies outside, block) of a long word, cut as if it and a word one letter shorter."""
    n = len(word)
    heads, tail = [], xxhash.xxh3_128()
    head = xxhash.xxh3_128()
    for start in range(0, n, BLOCK):
        heads.append(head.digest())
        head.update(word[start : start + BLOCK].encode("utf-32-le"))
    for base in (n, n - 1):
        tail, after = xxhash.xxh3_128(), n
        for start in range((base - 1) // BLOCK * BLOCK, -1, -BLOCK):
            end = min(start + BLOCK, base) + n - base
            tail.update(word[end:after][::-1].encode("utf-32-le"))
            after = end
            key = b"%d,%d," % (base, start) + heads[start // BLOCK] + tail.digest()
            yield xxhash.xxh3_128_digest(key), word[start:end]


def _start_states(words: DataFrame, large: set[str], long: int) -> DataFrame:
    """(kind, key, rest, letter, id): where the composition meets a word.

    Kind 0 is the machine of a prefix (key) and what follows it, kind 1 an edit at a prefix of many words: what
    stands before it and after it (key) and the letter between, if any.
    """
    shared = words.sparkSession.sparkContext.broadcast(large)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prefixes = shared.value
        for batch in batches:
            out: list[tuple] = []
            for word in batch.column(0).to_pylist():
                own = xxhash.xxh3_128_digest(word.encode())
                if len(word) >= long:
                    out += [(0, key, block, "", own) for key, block in _blocks(word)]
                if len(word) > long:
                    continue
                depth = next((k for k in range(len(word) + 1) if word[:k] not in prefixes), None)
                for k in range(len(word) + 1 if depth is None else depth):
                    for letter, rest in {"": word[k:], word[k : k + 1]: word[k + 1 :]}.items() if k < len(word) else [("", "")]:
                        out.append((1, xxhash.xxh3_128_digest(f"{k} {word[:k]}{rest}".encode()), "", letter, own))
                if depth is not None:
                    out.append((0, xxhash.xxh3_128_digest(b"prefix " + word[:depth].encode()), word[depth:], "", own))
            kinds = [pa.int32(), pa.binary(), pa.string(), pa.string(), pa.binary()]
            for at in range(0, len(out), 50_000):
                columns = zip(*out[at : at + 50_000])
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["kind", "key", "rest", "letter", "id"])

    return words.select("word").mapInArrow(run, "kind int, key binary, rest string, letter string, id binary")


def _composed(rows: DataFrame) -> DataFrame:
    """(a, b): ids of words that the machine of their prefix pairs."""

    def pairs(own: dict[str, list[bytes]]) -> list[tuple[bytes, bytes]]:
        if len(own) < 2:
            return []
        return [(i, j) for u, v in set(Acceptor(sorted(own)).pairs()) for i in own[u] for j in own[v]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, own = None, {}

        def out(found: list[tuple[bytes, bytes]]) -> Iterator[pa.RecordBatch]:
            for at in range(0, len(found), 50_000):
                part = found[at : at + 50_000]
                yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in part], pa.binary()) for k in (0, 1)], names=["a", "b"])

        for batch in batches:
            for key, rest, word in zip(*[batch.column(c).to_pylist() for c in ("key", "rest", "id")]):
                if key != current:
                    yield from out(pairs(own))
                    current, own = key, {}
                own.setdefault(rest, []).append(word)
        yield from out(pairs(own))

    machines = rows.where("kind = 0").select("key", "rest", "id")
    return machines.repartition("key").sortWithinPartitions("key").mapInArrow(run, "a binary, b binary")


def near_words(words: DataFrame, limit: int = WORDS, depth: int = DEPTH, long: int = LONG) -> DataFrame:
    """(a, b): ids of distinct words (word) that differ by just one inserted, deleted or replaced code point, both ways round.

    A word's id is the xxh3_128 of its UTF-8 bytes.
    """
    ready(words.sparkSession)
    large = _large_prefixes(words.where(F.length("word") <= long), limit, depth)
    rows = stored(_start_states(words, large, long), "spelling-states")
    early = rows.where("kind = 1").select("key", "letter", "id")
    # What shares prefix and rest differs by one letter, so a group is as large as the alphabet at most.
    several = early.groupBy("key").agg(F.collect_list("id").alias("ids")).where("size(ids) > 1")
    both = several.select(F.explode("ids").alias("a"), "ids").select("a", F.explode("ids").alias("b")).where("a != b")
    composed = _composed(rows)
    return composed.unionByName(composed.select(F.col("b").alias("a"), F.col("a").alias("b"))).unionByName(both).distinct()


def _followed(forms: DataFrame) -> DataFrame:
    """(word, root) of words with a form, by following forms twice as far in each round: forms have RATIO times the occurrences, so few rounds do."""
    roots = stored(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("far"))
        moved = roots.join(further, "root", "left")
        if moved.where("far is not null").isEmpty():
            return roots
        roots = stored(moved.select("word", F.coalesce("far", "root").alias("root")), "spelling-roots")


def spelling_groups(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, ratio: int = RATIO, limit: int = WORDS, long: int = LONG) -> DataFrame:
    """word, n, form, form_n, n_near and root of each frequent word of docs (doc_id, text).

    Words are runs of Latin letters with A-Z in lower case, some with a letter dropped, see variant; those of min_length
    code points and min_count occurrences count. Two are near if one code point inserted, deleted or
    replaced makes them equal; n_near counts near words. The form is the most frequent near word (of
    equal ones the smallest), if it is ratio times as frequent, else null; root is where forms lead, the word
    itself without a form. Null texts have no words, a null doc_id counts as the empty text in variant,
    repeated rows count each, other columns are left out. No words give no rows.
    """
    ready(docs.sparkSession)
    words = stored(vocabulary(docs, min_length, min_count).select("word", "n"), "spelling-words")
    pairs = near_words(words, limit, long=long)
    own = _identified(words)
    found = pairs.join(own.select(F.col("id").alias("b"), F.col("word").alias("near"), F.col("n").alias("near_n")), "b")
    best = found.groupBy("a").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("form"))).alias("best"))
    joined = own.join(best, own["id"] == best["a"], "left")
    enough = -F.col("best.less") >= ratio * F.col("n")
    rows = stored(joined.select(
        "word", "n", F.when(enough, F.col("best.form")).alias("form"), F.when(enough, -F.col("best.less")).alias("form_n"), F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near")
    ), "spelling-forms")
    roots = _followed(rows.where("form is not null"))
    return rows.join(roots, "word", "left").select("word", "n", "form", "form_n", "n_near", F.coalesce("root", "word").alias("root"))


def _identified(words: DataFrame) -> DataFrame:
    def step(frame: pd.DataFrame) -> pd.DataFrame:
        return frame.assign(id=[xxhash.xxh3_128_digest(w.encode()) for w in frame["word"]])

    return stored(by_frame(words, step, "word string, n long, id binary"), "spelling-ids")
