import re

import pytest
from pyspark.sql import functions as F

from tessera.llm.mixing import mix, mix_report, mixed_documents, permuted, targets

WEIGHTS = (5, 2, 1)


def table(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, source string, extra int")


def water(sizes):
    """Targets by the rule as it reads: reshare until none is above its cap."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: WEIGHTS[i % 3] for i, s in enumerate(names)}
    left, out, free = 1.5 * sum(sizes.values()), {}, set(names)
    while free:
        each = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        above = {s for s in free if each[s] > 2 * sizes[s]}
        if not above:
            return out | each
        for s in above:
            out[s] = 2.0 * sizes[s]
            left -= out[s]
        free -= above
    return out


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


ROWS = [(i, " ".join(f"w{j}" for j in range(i % 90)), None if i % 11 == 0 else f"s{i % 4}", 1) for i in range(400)]
ROWS += [(1000, None, "s0", 1), (1001, "", "s1", 1), (1002, " \t\n", "lone", 1), (5, "again the same id", "s1", 1), (5, "again the same id", "s1", 1), (1003, "x " * 30_000, "é", 1)]


def test_report(spark):
    got = [r.asDict() for r in mix_report(table(spark, ROWS)).collect()]
    sizes = {}
    for _, text, source, _ in ROWS:
        sizes[source] = sizes.get(source, 0) + size(text)
    want, taken = water(sizes), {}
    source = {r[0]: r[2] for r in ROWS if r[0] != 5}
    for r in got:
        assert r["taken"] <= 2 * r["size"]
        if r["doc_id"] != 5:
            s = source[r["doc_id"]]
            assert r["source_size"] == sizes[s] and r["target"] == pytest.approx(want[s])
    docs = table(spark, ROWS)
    per, sources, pieces = mix(docs)
    taken = {r.sid: r.n for r in pieces.groupBy("sid").agg(F.sum(F.expr("last - first")).alias("n")).collect()}
    for r in sources.collect():
        assert abs(taken.get(r.sid, 0) - r.target) <= 64 + 0.01 * r.target
    assert sorted(map(str, got)) == sorted(str(r.asDict()) for r in mix_report(table(spark, ROWS).repartition(1)).collect())


@pytest.mark.parametrize("sizes", [(646, 430, 494), (625, 237, 275, 0), (10, 1000), (5,), (0, 0), (300, 20, 7, 500, 1, 90, 4000), (1, 1, 1, 1, 1, 1, 1)])
def test_targets_by_resharing(spark, sizes):
    rows = [(f"s{i}", n) for i, n in enumerate(sizes)]
    got = {r.source: r.target for r in targets(spark.createDataFrame(rows, "source string, size long"), WEIGHTS, 1.5, 2.0).collect()}
    assert got == pytest.approx(water(dict(rows)))


def test_pieces_are_whole_blocks_of_each_pass(spark):
    _, _, pieces = mix(table(spark, ROWS), block=8)
    seen = pieces.groupBy("sid", "pass", "block", "__row").count()
    assert seen.where("count > 1").count() == 0 and pieces.where("pass > 1").count() == 0


def test_multinomial_counts_and_shards(spark):
    _, sources, pieces = mix(table(spark, ROWS), block=4, shard_slots=200)
    per = pieces.select("shard", "sid", "pass", "block").distinct().groupBy("shard").count().orderBy("shard").collect()
    assert len(per) > 5 and all(r["count"] <= 200 for r in per[:-1])


def test_slots_are_not_broadcast(spark):
    """A few counts become many slots, which may not go through the driver."""
    _, _, pieces = mix(table(spark, ROWS))
    assert pieces.collect()
    final = pieces._jdf.queryExecution().executedPlan().toString().partition("Initial Plan")[0]
    keys = r"Join \[sid#\d+, block#\d+L\], \[sid#\d+, block#\d+L\]"
    assert re.search("SortMerge" + keys, final) and not re.search("BroadcastHash" + keys, final)


@pytest.mark.parametrize("n", [1, 2, 3, 10, 97])
def test_permutation(spark, n):
    got = [r[0] for r in spark.range(n).select(permuted(F.col("id"), F.lit(n), F.lit(3))).collect()]
    assert sorted(got) == list(range(n)) and (n < 10 or got != sorted(got))


def test_documents(spark):
    docs = table(spark, [r for r in ROWS if r[0] != 5]).withColumn("n_chars", F.length("text"))
    out = mixed_documents(docs).collect()
    text = {r[0]: r[1] for r in ROWS}
    assert out[0].asDict().keys() == {*docs.columns}
    taken = {r.doc_id: r.taken for r in mix_report(docs).collect()}
    for r in out:
        words = iter(text[r.doc_id].split())
        assert all(w in words for w in r.text.split()) and r.n_chars == len(r.text)
        taken[r.doc_id] -= size(r.text)
    assert not any(taken.values())


@pytest.mark.parametrize("rows", [[], [(1, None, None, 0)], [(1, "one", "a", 0)]])
def test_small(spark, rows):
    got = mix_report(table(spark, rows)).collect()
    assert len(got) == len(rows)
    mixed_documents(table(spark, rows)).collect()


def test_columns_of_any_name_come_back(spark):
    names = "__reads __key __n __r __words __row sid size target row shard block first last".split()
    df = spark.createDataFrame([(i, "a few words " * i, "s", *range(len(names))) for i in range(40)], "doc_id long, text string, source string, " + ", ".join(f"{c} long" for c in names))
    got = mixed_documents(df)
    assert got.columns == df.columns and {tuple(r[c] for c in names) for r in got.collect()} == {tuple(range(len(names)))}
    assert mix_report(df).count() == 40
