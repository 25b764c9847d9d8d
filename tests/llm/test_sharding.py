"""Sharding: all records once, counts at most one apart, the same in every run."""

import hashlib
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tessera.llm import sharding

ROWS = [(i, f"text {i} " * (i % 9), None if i % 5 == 0 else "en") for i in range(300)]
ROWS += [(None, None, None), (None, "", None), (7, "text", "en"), (1000, "x" * 2_000_000, "en")] + [(5, "again", "de")] * 120


def table(spark, rows=ROWS):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def placed(df):
    return sorted((r.shard, r.slot, str(r.row)[:60]) for r in df.collect())


def test_every_record_has_one_place(spark):
    df = sharding.shuffled(table(spark), 7, bucket_rows=40)
    got = df.collect()
    assert Counter(tuple(r.row) for r in got) == Counter(ROWS)
    counts = Counter(r.shard for r in got)
    assert set(counts) == set(range(7)) and max(counts.values()) - min(counts.values()) <= 1
    for s in counts:
        assert sorted(r.slot for r in got if r.shard == s) == list(range(counts[s]))
    copies = [r.shard for r in got if r.row.doc_id == 5 and r.row.text == "again"]
    assert max(Counter(copies).values()) < 40  # of 120: repeated rows are scattered too
    again = sharding.shuffled(table(spark).repartition(5, "text"), 7, bucket_rows=40)
    assert placed(df) == placed(again)
    assert placed(df) != placed(sharding.shuffled(table(spark), 7, bucket_rows=40, seed=1))


def test_buckets_are_bounded_by_bytes_too(spark):
    rows = [(i, "y" * 50_000, "en") for i in range(60)]
    assert sharding.shuffled(table(spark, rows), 4, bucket_bytes=200_000).groupBy("shard").count().where("count = 15").count() == 4


def test_fisher_yates_follows_its_draws(spark):
    def want(n, *key):
        a = []
        for i in range(n):
            j = int(hashlib.md5(":".join(map(str, (*key, i))).encode()).hexdigest()[:15], 16) % (i + 1)
            a.append(i)
            a[i], a[j] = a[j], i
        return a

    df = spark.range(1, 60).select("id", sharding.fisher_yates(F.col("id").cast("int"), F.lit("k"), F.col("id")).alias("p"))
    for r in df.collect():
        assert r.p == want(r.id, "k", r.id) and sorted(r.p) == list(range(r.id))
    first = Counter(r.p[0] for r in spark.range(3000).select(sharding.fisher_yates(F.lit(4), F.col("id")).alias("p")).collect())
    assert all(650 < n < 850 for n in first.values()) and len(first) == 4


def test_clashing_names_maps_and_empty_tables(spark):
    names = "id, nth, row, bucket, before, records, at, place, shard, slot, record, n, high, span, first, count".split(", ")
    df = spark.range(50).select(*[(F.col("id") + k).alias(c) for k, c in enumerate(names)], F.create_map(F.lit("a"), F.col("id")).alias("m"), F.array("id").alias("x"), F.lit(1.5).alias("a.b"))
    got = sharding.shuffled(df, 3, bucket_rows=8)
    assert got.columns == ["row", "shard", "slot"]
    assert sorted(map(str, got.select("row.*").collect())) == sorted(map(str, df.collect()))
    assert sharding.shuffled(df.union(df), 3, bucket_rows=8).count() == 100
    assert sharding.shuffled(table(spark, []), 3).count() == 0 and sharding.shard_report(table(spark, [])).count() == 0
    assert sharding.shard_report(table(spark, [(1, "one", None)])).first().slot == 0


def test_report_of_null_texts(spark):
    got = {r.doc_id: r for r in sharding.shard_report(table(spark, [(1, None, None), (2, "", None), (3, "é", None)])).collect()}
    assert [(got[i].size, got[i].text_crc32, got[i].law, got[i].grown_shard) for i in (1, 2, 3)] == [(8, 0, "rows", None), (8, 0, "rows", None), (10, zlib.crc32("é".encode()), "rows", None)]


def test_written_shards_are_in_the_order_of_slots(spark, tmp_path):
    df = table(spark)
    sharding.write_shards(df, f"{tmp_path}/out", shards=3, bucket_rows=50)
    want = {}
    for r in sharding.shuffled(df, 3, bucket_rows=50).orderBy("shard", "slot").collect():
        want.setdefault(r.shard, []).append((r.row.doc_id, r.row.text))
    for s in range(3):
        files = sorted((tmp_path / "out" / f"__shard={s}").glob("part-*.parquet"))
        assert [tuple(x) for f in files for x in spark.read.parquet(str(f)).select("doc_id", "text").collect()] == want[s]


def test_no_python_in_the_plan(spark):
    plan = sharding.shuffled(table(spark), 3)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan and plan.count("Exchange rangepartitioning(bucket") == 1


@pytest.mark.parametrize("n", [1, 23, 24, 25])
def test_few_records(spark, n):
    got = sharding.shard_report(table(spark, [(i, str(i), None) for i in range(n)])).collect()
    assert len({(r.shard, r.slot) for r in got}) == n and max(Counter(r.shard for r in got).values()) == -(-n // 24)
