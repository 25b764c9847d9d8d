import random
import re

import numpy as np
import pytest

from tessera.llm import jaccard
from tessera.llm.jaccard import jaccard_groups, one_of_each_group, overlaps


def sets(text, n):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w)} if 0 < len(w) < n else {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}


def brute(rows, n, percent):
    s = {}
    for i, t in rows:
        s.setdefault(i, []).append(sets(t, n))
    root = {i: i for i in s}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = list(s)
    for k, i in enumerate(ids):
        for j in ids[k + 1 :]:
            if any(x and y and 100 * len(x & y) >= percent * len(x | y) for x in s[i] for y in s[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return sorted((i, len(sets(t, n)), find(i)) for i, t in rows)


def made(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    passage = rng.choices(vocabulary, k=40)
    rows, bases = [], [rng.choices(vocabulary, k=rng.randint(1, 120)) for _ in range(25)]
    for i in range(160):
        words = list(rng.choice(bases))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 5])):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        if rng.random() < 0.3:
            words[:0] = passage
        rows.append((i, rng.choice([" ", "\n", "\x0b "]).join(w.upper() if rng.random() < 0.2 else w for w in words)))
    return rows


ODD = [(500, None), (501, ""), (502, " \t"), (503, "one"), (504, "ONE"), (505, "one two three"), (506, "One two three"), (507, "é É"), (508, "é é"), (3, "same id other text a b c d e"), (3, "same id other text a b c d e"), (900, "long " * 30_000), (901, "long " * 29_000)]


@pytest.mark.parametrize(("n", "percent", "rows"), [(4, 85, made(1) + ODD), (5, 80, made(2))])
def test_against_brute_force(spark, n, percent, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert sorted(map(tuple, jaccard_groups(df, n=n, percent=percent).collect())) == brute(rows, n, percent)


def test_one_of_each_group_nulls_and_clashing_columns(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "PART", 100)
    text = " ".join(f"v{i}" for i in range(50))
    rows = [(i, f"{text} x{i}", i, "s") for i in range(1, 12)] + [(None, text, 1, "s"), (40, None, 1, "s")]
    df = spark.createDataFrame(rows, "doc_id long, text string, id int, sig string")
    rows += [rows[0], (1, "another text of the same id", 9, "t"), (60, "once more", 9, "t"), (60, "once more", 9, "t")]
    df = spark.createDataFrame(rows, df.schema)
    out = one_of_each_group(df)
    assert out.columns == df.columns and sorted(r.doc_id or 0 for r in out.collect()) == [0, 1, 40, 60]
    assert jaccard_groups(df.limit(0)).count() == 0


def test_trie_walk_against_plain_overlaps():
    rng = np.random.default_rng(3)
    for percent in (50, 80, 95):
        probe = np.unique(rng.integers(0, 400, 200)).astype("uint64")
        members = [np.unique(np.concatenate([rng.choice(probe, rng.integers(1, 190)), rng.integers(0, 400, rng.integers(1, 60)).astype("uint64")])) for _ in range(80)]
        members += [probe[: rng.integers(1, len(probe))] for _ in range(40)]
        raw = sorted({m.astype(">u8").tobytes() for m in members})
        for r, got in zip(raw, overlaps(probe, raw, percent), strict=True):
            m = set(np.frombuffer(r, ">u8").tolist())
            both = len(m & set(probe.tolist()))
            assert got == (both if 100 * both >= percent * (len(m) + len(probe) - both) else -1)
