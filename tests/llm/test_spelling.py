"""Spelling variants against all pairs of words."""

import random
import zlib
import re
from collections import Counter

import pytest

from tessera.llm import spelling


def near(a, b):
    """Whether exactly one inserted, deleted or replaced code point makes b of a."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(counts, factor=10):
    form, found = {}, {}
    for w, n in counts.items():
        by = sorted((x for x in counts if near(w, x)), key=lambda x: (-counts[x], x))
        form[w] = by[0] if by and counts[by[0]] >= factor * n else None
        found[w] = len(by)

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return sorted((w, form[w], root(w), n, found[w], counts.get(form[w])) for w, n in counts.items())


def words(seed, alphabet, lengths, n):
    rng = random.Random(seed)
    out = {}
    for _ in range(n):
        w = "".join(rng.choice(alphabet) for _ in range(rng.choice(lengths)))
        for _ in range(rng.randint(0, 4)):
            out[w] = rng.choice([1, 2, 3, 30, 31, 400, 5000])
            at = rng.randrange(len(w) + 1)
            w = rng.choice([w[:at] + rng.choice(alphabet) + w[at:], w[:at] + w[at + 1 :] or w, w[:at] + rng.choice(alphabet) + w[at + 1 :]])
    return out


@pytest.mark.parametrize(("literal", "alphabet", "lengths"), [(128, "ab", (7, 8, 9)), (128, "abcdeféÿ", (7, 12)), (12, "ab", (9, 10, 11, 12, 13, 14)), (128, "abc", (126, 127, 128, 129, 130))])
def test_against_all_pairs(spark, monkeypatch, literal, alphabet, lengths):
    monkeypatch.setattr(spelling, "LITERAL", literal)
    counts = words(3, alphabet, lengths, 150)
    df = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(3)
    got = sorted((tuple(r) for r in spelling.variants(df).collect()), key=lambda r: r[0])
    assert got == brute(counts)
    pairs = Counter(tuple(r) for r in spelling.neighbours(df).collect())
    assert set(pairs) == {(a, b) for a in counts for b in counts if near(a, b)} and set(pairs.values()) <= {1}


def test_chains_of_forms(spark):
    counts = {"aaaaaaa": 2, "aaaaaab": 20, "aaaaabb": 200, "aaaabbb": 2000, "aaabbbb": 20_000, "aabbbbb": 200_000, "lonely": 5}
    got = {r.word: r.root for r in spelling.variants(spark.createDataFrame(list(counts.items()), "word string, n long")).collect()}
    assert got == {w: "lonely" if w == "lonely" else "aabbbbb" for w in counts}


def test_long_words_cost_in_proportion(spark):
    a = "ab" * 60_000
    rows = [(a, 50), (a[:-1] + "c", 2), (a + "x", 3), ("q" * 100_000, 2), ("q" * 99_999, 20)]
    got = {r.word: (r.form, r.n_near) for r in spelling.variants(spark.createDataFrame(rows, "word string, n long")).collect()}
    assert got == {a: (None, 2), a[:-1] + "c": (a, 1), a + "x": (a, 1), "q" * 100_000: ("q" * 99_999, 1), "q" * 99_999: (None, 1)}


def counted(docs):
    n = Counter()
    for i, text in docs:
        for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = "".join(c.lower() if "A" <= c <= "Z" else c for c in w)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % 31 == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            n[w] += 1
    return {w: c for w, c in n.items() if len(w) >= 7 and c >= 2}


def test_words_of_documents(spark):
    rng = random.Random(1)
    vocabulary = ["Straße", "ÉCOLEécole", "longest", "Longest", "abcdefgh", "sevenlt", "a", "x×y÷zabcd", "naïvement", "tenletters"]
    docs = [(i, " ".join(rng.choice(vocabulary) for _ in range(60)) + rng.choice([".", "'s", "9", "Āabcdefg"])) for i in range(80)] + [(None, "longest abcdefgh"), (None, None), (3, ""), (4, "longest " * 30_000), (9, "z" * 50_000)] * 2
    df = spark.createDataFrame([(i, t, 1, 2) for i, t in docs], "doc_id long, text string, word int, n int")
    assert {r.word: r.n for r in spelling.word_counts(df).collect()} == counted(docs)
    assert spelling.variant_report(df.limit(0)).collect() == []
    got = sorted((tuple(r) for r in spelling.variant_report(df).collect()), key=lambda r: r[0])
    assert got == brute(counted(docs))
