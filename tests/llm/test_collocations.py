"""Collocations against a count of all phrases."""

import random
import re
from collections import Counter

import pytest

from tessera.llm import collocations


def brute(docs, longest=3, least=10, covered=50, top=2000):
    f = Counter()
    for text, lang in docs:
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", text):
            w = [x for x in re.split(r"[\x20\x09]+", piece) if x]
            for k in range(1, longest + 1):
                f.update((lang if lang is not None else "und", tuple(w[i : i + k])) for i in range(len(w) - k + 1))
    total, out = Counter(), {}
    for (lang, p), a in f.items():
        total[lang] += a if len(p) == 1 else 0
    kept = {(lang, p): a for (lang, p), a in f.items() if len(p) > 1 and a >= least}
    inside = Counter()
    for (lang, p), a in kept.items():
        for i in range(len(p)):
            for j in range(i + 2, len(p) + 1):
                if j - i < len(p):
                    inside[lang, p[i:j]] = max(inside[lang, p[i:j]], a)
    for (lang, p), a in kept.items():
        if 100 * inside[lang, p] >= covered * a and inside[lang, p]:
            continue
        score, k = min((10**6 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p)))
        out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return sorted((lang, i + 1, p.decode(), -a, left, right, total[lang], -s) for lang, rows in out.items() for i, (s, a, p, left, right) in enumerate(sorted(rows)[:top]))


def documents(seed=4):
    rng = random.Random(seed)
    words = ["the", "The", "of", "new", "york", "city", "a\x01", "a", "a\x01b", "éa", "naïve", "x-y", "9", " "]
    end = [" ", " ", " ", "  ", "\t", " \t ", ". ", ",", "\n", "\x0b", "?", "; "]
    docs = [("".join(rng.choice(words) + rng.choice(end) for _ in range(rng.randint(0, 120))), rng.choice(["en", "en", "de", None, "und", ""])) for _ in range(150)]
    return docs + [(None, "en"), ("", None), ("word", "lone"), ("new york city " * 20_000, "en"), ("...", "en")] + [("the same text of new york", "en")] * 40


@pytest.mark.parametrize(("budget", "longest", "least"), [(1 << 18, 3, 10), (64, 3, 10), (8, 3, 3), (8, 5, 10), (8, 2, 10)])
def test_against_all_phrases(spark, budget, longest, least):
    docs = documents()
    df = spark.createDataFrame([(*d, 1, 2) for d in docs], "text string, lang string, phrase int, n int").repartition(3)
    got = collocations.collocations(df, longest=longest, least=least, top=100, budget=budget)
    assert sorted(tuple(r) for r in got.collect()) == brute(docs, longest, least, top=100)


def test_several_chunks(spark):
    docs = documents(9) + [("big apple pie " * 25_000, "en")] * 16
    df = spark.createDataFrame(docs, "text string, lang string").coalesce(1)
    assert sorted(tuple(r) for r in collocations.collocations(df).collect()) == brute(docs)


def test_empty_tables(spark):
    df = spark.createDataFrame([], "text string, lang string")
    assert collocations.collocations(df).collect() == []
    assert collocations.collocations(spark.createDataFrame([(None, None), ("", "en"), ("one", "en")], "text string, lang string")).collect() == []
