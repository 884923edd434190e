"""Spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from aerolake.llm import spelling


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[i + (len(a) == len(b)) :] == b[i + 1 :]


def words_brute(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def groups_brute(rows):
    words = words_brute(rows)
    form, near = {}, {w: [v for v in words if one_edit(w, v)] for w in words}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 5 * n else None
    out = []
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, n, form[w], words.get(form[w]), len(near[w]), root))
    return sorted(out)


def corpus(seed, documents=120):
    rnd = random.Random(seed)
    stems = ["".join(rnd.choices("abcdeé", k=rnd.randint(5, 9))) for _ in range(25)]

    def edited(w):
        i, c = rnd.randrange(len(w) + 1), rnd.choice("abÉzÿ")
        return rnd.choice([w[:i] + c + w[i:], w[:i] + w[i + 1 :], w[:i] + c + w[i + 1 :]])

    pool = stems * 30 + [edited(w) for w in stems for _ in range(8)] * 3 + [edited(edited(w)) for w in stems for _ in range(4)] * 2
    return [(i, " ".join(rnd.choice([str, str.upper, str.title])(rnd.choice(pool)) + rnd.choice(["", ",", "1", "×x", "日"]) for _ in range(rnd.randint(0, 300)))) for i in range(documents)]


@pytest.mark.parametrize("limit", [3, 40, 20_000])
def test_groups(spark, limit):
    rows = corpus(limit) + [(500, None), (501, ""), (None, "Abcdefg " * 3), (7, "Wordly worldly " * 60), (7, "Wordly worldly " * 60)]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, Word string").repartition(3)
    found = spelling.spelling_groups(docs, limit=limit)
    assert found.columns == ["word", "n", "form", "form_n", "n_near", "root"]
    assert sorted(map(tuple, found.collect())) == groups_brute(rows)


def test_long_words(spark):
    rnd = random.Random(2)
    base = "".join(rnd.choices("abcdefgh", k=700))
    words = [base, base[:3] + base[4:], base[:400] + "z" + base[400:], base + "z", "z" + base, base[:63] + "z" + base[64:], base[:64] + base[65:], "q" * 5000, "q" * 5001, "q" * 5002]
    words += [base[:15], base[:16], base[:17], "x" + base[1:17], base[:10] + "yy" + base[12:16]]
    rows = [(i, " ".join([w] * (5 + 30 * (i == 0)))) for i, w in enumerate(words)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for long in (16, 256):
        assert sorted(map(tuple, spelling.spelling_groups(docs, long=long, limit=2).collect())) == groups_brute(rows)


def test_forms_lead_on(spark):
    chain = [("abcdefg", 5), ("abcdefgh", 25), ("abcdefghi", 125), ("abcdefghij", 625), ("abcdefghijk", 3125)]
    rows = [(4, " ".join([w] * n)) for w, n in chain]
    got = {r["word"]: (r["form"], r["root"]) for r in spelling.spelling_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got["abcdefg"] == ("abcdefgh", "abcdefghijk") and got["abcdefghijk"] == (None, "abcdefghijk")


def test_no_words(spark):
    docs = spark.createDataFrame([(1, None), (2, "1 2 3"), (3, "short words")], "doc_id long, text string")
    assert spelling.spelling_groups(docs).count() == spelling.spelling_groups(docs.limit(0)).count() == 0


def test_the_acceptor_is_the_smallest():
    rnd = random.Random(5)
    words = sorted({"".join(rnd.choices("abc", k=rnd.randint(0, 6))) for _ in range(300)})
    machine = spelling.Acceptor(words)
    assert sorted(machine.accepted(0)) == words
    rests = defaultdict(set)
    for w in words:
        for k in range(len(w) + 1):
            rests[w[:k]].add(w[k:])
    assert len(machine.next) == len({frozenset(r) for r in rests.values()})
    assert {frozenset(p) for p in machine.pairs()} == {frozenset((a, b)) for a in words for b in words if one_edit(a, b)}
