import math
from collections import Counter

import numpy as np
import pytest

from tessera.llm.queries import op5_embedding_near_dedup, op9_exact_top_k
from tessera.llm.vectors import _apart, _centres, near_vectors, top_k

ODD = [
    (900, None, 0), (901, [float("nan")] * 4, 0), (902, [1.0, None, 0.0, 0.0], 0), (903, [float("inf"), 0.0, 0.0, 0.0], 0), (904, [0.0] * 4, 0),
    (905, [], 0), (906, [1.0, 2.0], 1), (907, [2.0, 4.0], 1), (950, [1.0, 2.0], 1), (1000, [0.0] * 4, None),
]


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def good(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def brute_links(rows, cosine):
    links, root = Counter(), {i: i for i, _, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    use = [(i, np.array(v, "float64")) for i, v, _ in rows if good(v) and any(v)]
    for n, (i, x) in enumerate(use):
        for j, y in use[n + 1 :]:
            if len(x) == len(y) and x @ y / math.sqrt((x @ x) * (y @ y)) >= cosine:
                links[i] += 1
                links[j] += 1
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: (links[i], find(i), find(i) == i) for i, _, _ in rows}


def made(n, seed):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n, 4))
    near = base[: n // 2] + rng.normal(size=(n // 2, 4)) * 0.1
    return [(i, [float(np.float32(x)) for x in v], 0) for i, v in enumerate([*base, *near, *near[:5]])]


def test_links_against_brute_force(spark):
    rows = made(60, 1) + ODD
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in near_vectors(table(spark, rows), nearest=64, shared=1, pivots=64).collect()}
    assert got == brute_links(rows, 0.9)


def test_links_recall_with_production_parameters(spark):
    path = "/root/testdata/sf0.01"
    rows = [(r.vec_id, r.embedding, 0) for r in spark.read.parquet(f"{path}/embeddings.parquet").collect()]
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in op5_embedding_near_dedup(spark, path).collect()}
    want = brute_links(rows, 0.9)
    assert all(got[i][0] <= want[i][0] for i in want)
    assert sum(x[0] for x in got.values()) >= 0.9 * sum(x[0] for x in want.values())


def test_small_tiles_lose_nothing(spark):
    rows = [(i, [1.0, 0.001 * (i % 7), 0.0, 0.0], 0) for i in range(90)]
    got = near_vectors(table(spark, rows), tile=2).collect()
    assert {(r.n_links, r.component_id) for r in got} == {(89, 0)}


@pytest.mark.parametrize("pivots", [32, 256, 800])
def test_links_of_a_hot_group_and_of_isolated_pairs(spark, pivots):
    """A third of the rows is one group of near vectors; the others are alone or pairs."""
    rng = np.random.default_rng(pivots)
    unit = lambda x: x / np.linalg.norm(x, axis=-1, keepdims=True)
    hot = unit(unit(rng.normal(size=48)) + 0.27 * unit(rng.normal(size=(400, 48))))
    alone = unit(rng.normal(size=(760, 48)))
    x = np.concatenate([hot, alone, alone[:40] + 0.4 * unit(rng.normal(size=(40, 48)))]).astype("float32")
    x = x[rng.permutation(len(x))]
    near = unit(x.astype("float64")) @ unit(x.astype("float64")).T >= 0.9
    want = near.sum(1) - 1
    got = {r.vec_id: r for r in near_vectors(table(spark, [(i, v.tolist(), 0) for i, v in enumerate(x)]), pivots=pivots).collect()}
    found = np.array([got[i].n_links for i in range(len(x))])
    big, small = want > 100, (want > 0) & (want <= 100)
    assert big.sum() == 400 and small.sum() >= 70 and (found <= want).all()
    assert found[big].sum() >= 0.999 * want[big].sum()
    assert found[small].sum() >= 0.95 * want[small].sum()
    assert {got[i].component_id for i in np.flatnonzero(big)} == {np.flatnonzero(big)[0]}


@pytest.mark.parametrize("cone", [0.4, 0.72, 0.85])
def test_links_of_vectors_in_a_cone(spark, cone):
    """Vectors with a mean cosine of `cone`, some of them with one at 0.90 to 0.93."""
    rng = np.random.default_rng(int(100 * cone))
    unit = lambda x: x / np.linalg.norm(x, axis=-1, keepdims=True)
    x = unit(unit(rng.normal(size=64)) + math.sqrt((1 - cone) / cone) * unit(rng.normal(size=(2000, 64))))
    c, aside = rng.uniform(0.9, 0.93, size=(200, 1)), rng.normal(size=(200, 64))
    x = np.concatenate([x, c * x[:200] + np.sqrt(1 - c * c) * unit(aside - (aside * x[:200]).sum(1, keepdims=True) * x[:200])]).astype("float32")
    near = unit(x.astype("float64")) @ unit(x.astype("float64")).T >= 0.9
    want = near.sum(1) - 1
    got = {r.vec_id: r.n_links for r in near_vectors(table(spark, [(i, v.tolist(), 0) for i, v in enumerate(x)])).collect()}
    found = np.array([got[i] for i in range(len(x))])
    assert (found <= want).all() and found.sum() >= 0.95 * want.sum() >= 0.95 * 2 * 199
    drawn = [(64, v) for v in x]
    centres = _centres(iter(drawn), 0.9)
    assert (np.abs(centres[64]).max() > 0) == (cone < 0.8)
    if cone < 0.8:  # enough pivots for short lists
        assert len(_apart(iter(drawn), centres, 256, 0.62)[64]) == 256


def test_lengths_with_fewer_pivots_than_must_be_shared(spark):
    got = near_vectors(table(spark, [(1, [1.0, 0.1], 0), (2, [1.0, 0.0], 0), (3, [0.0, 1.0], 0)])).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got) == [(1, 1, 1), (2, 1, 1), (3, 0, 3)]


@pytest.mark.parametrize("rows", [[], ODD])
def test_empty_and_odd(spark, rows):
    assert near_vectors(table(spark, rows)).count() == len(rows)
    top_k(table(spark, rows), table(spark, rows)).collect()


def brute_top(rows, k):
    q = [(i, [math.floor(256 * x) for x in v]) for i, v, _ in rows if good(v)]
    out = {}
    for i, x in q:
        if i % 50 == 0:
            found = sorted((-sum(a * b for a, b in zip(x, y, strict=True)), j) for j, y in q if j != i and len(x) == len(y))
            out |= {(i, r + 1): (j, -s) for r, (s, j) in enumerate(found[:k])}
    return out


def test_top_k_against_brute_force(spark):
    rows = made(200, 2) + ODD
    df = table(spark, rows)
    got = top_k(df.where("vec_id % 50 = 0"), df, query_tile=2, row_tile=30).collect()
    assert {(r.query_id, r.rank): (r.vec_id, r.score) for r in got} == brute_top(rows, 5)


def test_top_k_ties_and_large_values(spark):
    rows = [(i, [1e5, 3e6, 2.0, 0.0], 0) for i in range(120)]
    df = table(spark, rows)
    got = top_k(df.where("vec_id % 50 = 0"), df).collect()
    assert {(r.query_id, r.rank): (r.vec_id, r.score) for r in got} == brute_top(rows, 5)


def test_top_k_extra_columns(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").selectExpr("*", "1 AS id", "2 AS q", "3 AS score")
    assert op9_exact_top_k(spark, "/root/testdata/sf0.001").count() == top_k(df.where("vec_id % 50 = 0"), df).count()
