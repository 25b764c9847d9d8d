import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tessera.llm import quality
from tessera.llm.quality import classify, kept, train, trusted_rows


def fold(t):
    return "\x02\x02" + "".join("0" if c in "0123456789" else " " if c in "\t\n\v\f\r\xa0" else c for c in t)


def brute(train_texts):
    """log p of a trigram, by dictionaries and recursion."""
    K = {3: Counter(), 2: Counter(), 1: Counter()}
    for t in map(fold, train_texts):
        for i in range(2, len(t)):
            K[3][t[i - 2 : i + 1]] += 1
    for n in (2, 1):
        for g in K[n + 1]:
            K[n][g[1:]] += 1
    D, ctx = {}, {}
    for n in K:
        m = [sum(v == i for v in K[n].values()) for i in range(5)]
        y = m[1] / max(1, m[1] + 2 * m[2])
        D[n] = [0] + [max(0.1, min(i - 0.01, i - (i + 1) * y * m[i + 1] / max(1, m[i]))) for i in (1, 2, 3)]
        ctx[n] = defaultdict(lambda: [0, 0.0])
        for g, v in K[n].items():
            ctx[n][g[:-1]][0] += v
            ctx[n][g[:-1]][1] += min(v, D[n][min(v, 3)])

    def p(g):
        n = len(g)
        if not n:
            return 1 / (len(K[1]) + 1)
        if g[:-1] not in ctx[n]:
            return p(g[1:])
        total, freed = ctx[n][g[:-1]]
        v = K[n].get(g, 0)
        return (max(0, v - D[n][min(v, 3)]) if v else 0) / total + freed / total * p(g[1:])

    return lambda t: -sum(math.log(p(t[i - 2 : i + 1])) for i in range(2, len(t))) / (len(t) - 2)


TEXTS = ["the cat sat on the mat", "a dog 123 ran\nto the cat", "mat and dog and cat", "the end of the matter 9", "on and on it ran"]


def test_perplexity_against_brute_force(spark):
    nats = brute(TEXTS)
    model = train(spark.createDataFrame([("en", t) for t in TEXTS], "lang string, text string"))
    unseen = ["the cat", "zebra Q", "dog dog 77", "\tmat", "éé"]
    df = spark.createDataFrame([(i, "en" if i % 2 else "xx", t) for i, t in enumerate(TEXTS + unseen)], "i int, lang string, text string")
    shared = spark.sparkContext.broadcast(model)
    for r in quality.scored(df, shared, "s").collect():
        assert r.s.n == len(r.text) and r.s.nats == pytest.approx(nats(fold(r.text)), rel=1e-5)


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, "en", 5), (2, "", None, 5), (3, "the cat " * 20_000, "en", 5), (3, "the cat", "en", 6), (None, "%%%%%%%% ####### !!!!!! %%%%", "en", None)], "doc_id long, text string, lang string, quality int")
    docs = docs.union(spark.createDataFrame([(100 + i, t, "en", 5) for i, t in enumerate(TEXTS)], docs.schema))
    trusted = docs.where("doc_id >= 100")
    got = classify(docs, trusted, into="verdict").where("doc_id < 100 OR doc_id IS NULL").select("doc_id", "verdict.*").collect()
    assert [(r.doc_id, r.n) for r in got] == [(1, 0), (2, 0), (3, 160_000), (3, 7), (None, 28)]
    assert got[0].keep and got[1].keep and not got[4].keep
    assert classify(docs, trusted.limit(0)).where("quality.keep").count() == 10
    assert classify(docs.limit(0), trusted).count() == 0
    labels = spark.createDataFrame([(3, 1, 0), (3, 0, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    assert trusted_rows(labels).count() == 0
    assert [tuple(r) for r in quality.report(docs, trusted).where("doc_id < 3").select("doc_id", "n", "keep").orderBy("doc_id").collect()] == [(1, 0, True), (2, 0, True)]
    assert kept(docs, labels).columns == docs.columns


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    odd = F.col("doc_id") % 2 == 1
    judged = classify(docs, trusted_rows(labels.where(~odd)), into="verdict").where(odd).join(labels, "doc_id")
    rates = {r.quality: r.rate for r in judged.groupBy("quality").agg(F.avg(F.col("verdict.keep").cast("int")).alias("rate")).collect()}
    assert rates[1] > 0.98 and rates[0] < 0.15


def test_model_counts_all_trusted_text(spark, monkeypatch):
    """Of more trusted documents than the 20 000 that were once taken, every one is in the model."""
    n = 30_000
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.lit("en").alias("lang"), F.when(F.col("id") % 2 == 0, "the cat").otherwise("a dog").alias("text"))
    got = []
    monkeypatch.setattr(quality, "train", lambda rows, **options: got.append(rows.count()) or train(rows, **options))
    assert classify(docs, docs.select("doc_id")).count() == n
    assert got == [n]


def test_all_characters_and_languages_are_in_the_model(spark, monkeypatch):
    """More characters than the workers' table has symbols, beyond the first plane too, and more languages than there are tables."""
    rng = random.Random(2)
    signs = [chr(0x4E00 + i) for i in range(300)] + [chr(0x1F600 + i) for i in range(20)]
    han = ["".join(rng.choice(signs[: rng.choice([40, 320])]) for _ in range(60)) for _ in range(30)]
    texts = {"zh": han[:20], "en": TEXTS, "fr": ["le chat et le chien", "la fin de la nuit"], "es": ["el gato y el perro", "la noche"]}
    rows = [(lang, t) for lang, some in texts.items() for t in some]
    trusted = spark.createDataFrame([*rows, (None, "mixed text")], "lang string, text string")
    nats = {lang: brute(some) for lang, some in texts.items()} | {None: brute([t for _, t in rows] + ["mixed text"])}
    model = train(trusted, max_languages=2)
    assert max(map(len, model.codes.values())) <= quality.SIZE - 2 and len(model.rows) == 3 and sum(map(len, model.rare.values())) > 200
    new = [("zh", t) for t in han[20:]] + [("fr", "le chat"), ("es", "el perro"), ("es", ""), ("es", None), ("it", "il gatto"), ("it", han[0]), (None, "mixed"), ("fr", "le chat"), ("zh", "\u2603\u2603 the end")]
    df = spark.createDataFrame(rows + new, "lang string, text string")
    for listed in (model.listed, None):  # None: too many languages for a list
        model.listed = listed
        got = quality.scored(df, spark.sparkContext.broadcast(model), "s").collect()
        assert len(got) == len(rows + new)
        for r in got:
            assert r.s.n == len(r.text or "") and (not r.text or r.s.nats == pytest.approx(nats.get(r.lang, nats[None])(fold(r.text)), rel=1e-5)), r
    docs = df.withColumn("doc_id", F.monotonically_increasing_id())
    verdict = quality.classify(docs, docs.where("lang = 'zh'"), max_languages=1)
    assert verdict.columns == [*docs.columns, "quality"] and verdict.count() == len(rows + new)
