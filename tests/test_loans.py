"""The traps of the loan files, sinks, sampling, metrics and models, on small tables."""

import gzip
import hashlib
import math
import time
from dataclasses import replace

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tessera.functions.columns import delinquent, number, prepaid, stripped, year_number
from tessera.functions.schemas import FEATURES, ORIGINATION_COLUMNS, PERFORMANCE_COLUMNS, schema
from tessera.operators import boosting, metrics, panel, sampling
from tessera.plans import pipelines, queries
from tessera.sources import sinks, vintages
from tessera.streaming.ingest import follow

LOAN = panel.LOAN


def line(kind, **values):
    return "|".join(values.get(c, "") for c in (ORIGINATION_COLUMNS if kind == "orig" else PERFORMANCE_COLUMNS))


@pytest.mark.parametrize(("text", "want"), [("1d", None), ("1f", None), ("", None), ("abc", None), ("1,000", None), ("0x1F", None), ("1L", None), ("True", None), ("nan", None), (" 12 ", 12.0), ("1e5", 1e5), ("+5", 5.0), (".5", 0.5), ("5.", 5.0), ("01", 1.0), ("inf", math.inf)])
def test_numbers(spark, text, want):
    assert spark.createDataFrame([(text,)], "x string").select(number(F.col("x"))).first()[0] == want


def test_schemas():
    assert len(schema("orig")) == len(schema("perf")) == 32
    assert schema("orig")["LOAN_SEQUENCE_NUMBER"].dataType.simpleString() == "string" and schema("perf")["ZERO_BALANCE_CODE"].dataType.simpleString() == "double"
    with pytest.raises(ValueError):
        schema("other")


def test_labels(spark):
    df = spark.createDataFrame([("0", 1.0, "200001", "200101"), ("RA", 1.0, "200201", "200101"), ("", None, "200001", "200101"), (None, 1.0, None, "200101"), ("XX", 9.0, "200001", "200101")], "CURRENT_LOAN_DELINQUENCY_STATUS string, ZERO_BALANCE_CODE double, ZERO_BALANCE_EFFECTIVE_DATE string, MATURITY_DATE string")
    assert [tuple(r) for r in df.select(delinquent(), prepaid()).collect()] == [(0, 1), (0, 0), (1, 0), (0, 0), (1, 0)]


def test_ingest_files(spark, tmp_path):
    good = line("orig", LOAN_SEQUENCE_NUMBER="\t L1 ", CREDIT_SCORE=" 700", CHANNEL="")
    for year, lines in ((1999, [good, good + "|x", good.replace("L1", "L2") + "\r"]), (2000, ["a|b", line("orig", LOAN_SEQUENCE_NUMBER="L3", CREDIT_SCORE="1d", MI_CANCELLATION_INDICATOR="N")])):
        folder = tmp_path / f"sample_{year}"
        folder.mkdir()
        (folder / f"sample_orig_{year}.txt").write_text("\n".join(lines) + "\n", newline="")
    base = str(tmp_path)
    with pytest.warns(UserWarning):
        path, bad, audit = pipelines.ingest(spark, base, [1999, 2000, 2001], "orig", f"{base}/tables", dedup_keys=["LOAN_SEQUENCE_NUMBER"])
    rows = {r.LOAN_SEQUENCE_NUMBER: r for r in spark.read.parquet(path).collect()}
    assert {k: (r.CREDIT_SCORE, r.CHANNEL) for k, r in rows.items()} == {"L1": (700.0, ""), "L2": (700.0, ""), "L3": (None, "")}
    assert sorted((r.vintage, r.n_fields) for r in bad.collect()) == [(1999, 33), (2000, 2)]
    assert sorted(map(tuple, audit.collect())) == [(1999, 2, 1), (2000, 1, 1)]
    with pytest.raises(FileNotFoundError):
        vintages.read_lines(spark, base, [2001], "orig", on_missing="raise")
    pipelines.ingest(spark, base, [1999], "orig", f"{base}/tables", dedup_keys=["LOAN_SEQUENCE_NUMBER"])
    assert spark.read.parquet(path).count() == 3
    pipelines.ingest(spark, base, [1999], "orig", f"{base}/tables")
    assert spark.read.parquet(path).count() == 5
    with pytest.raises(ValueError):
        sinks.append_table(spark.range(1), "other", base)


def test_files_that_cannot_be_read_are_left_out(spark, tmp_path):
    (tmp_path / "sample_1999" / "sample_orig_1999.txt").mkdir(parents=True)
    with pytest.warns(UserWarning):
        assert vintages.read_lines(spark, str(tmp_path), [1999], "orig").count() == 0
    with pytest.raises(FileNotFoundError):
        vintages.read_lines(spark, str(tmp_path), [1999], "orig", on_missing="raise")


def test_keys(spark):
    df = spark.createDataFrame([("199912",), ("199913",), ("19991",), (" 19991",), ("",), (None,)], "m string")
    assert [tuple(r) for r in vintages.key_check(df, ["m"]).collect()] == [("m", 6, 2, 3)]
    assert df.where("m = '199912'").select(year_number(F.col("m"))).first()[0] == 1999
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        df.where("m = ''").select(year_number(F.col("m"))).collect()


def test_follow(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text(line("perf", LOAN_SEQUENCE_NUMBER="L1", CURRENT_LOAN_DELINQUENCY_STATUS="RA") + "\nbad\n")
    for _ in range(2):
        follow(spark, f"{tmp_path}/in", "perf", f"{tmp_path}/out", f"{tmp_path}/state").awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/out/performance").count() == 1 and spark.read.parquet(f"{tmp_path}/out/performance_quarantine").count() == 1


def test_unemployment_keys(spark):
    want = [("202001", 3.5, "CA")]
    for kind, value in (("int", 202001), ("string", "202001")):
        df = spark.createDataFrame([("CAUR", value, 3.5), ("DCUR", value, 1.0), ("CAXX", value, 1.0)], f"series_id string, date {kind}, value double")
        assert [tuple(r) for r in vintages.unemployment(df).collect()] == want
    df = spark.sql("SELECT 'CAUR' AS series_id, DATE '2020-01-01' AS date, 3.5D AS value")
    assert [tuple(r) for r in vintages.unemployment(df).collect()] == want


def test_panel_written_in_row_groups_and_pruned(spark, tmp_path):
    rows = spark.range(2000).select(F.concat(F.lit("L"), "id").alias("LOAN_SEQUENCE_NUMBER"), F.when(F.col("id") < 1000, "199901").otherwise("200002").alias("MONTHLY_REPORTING_PERIOD"))
    sinks.write_panel(rows, f"{tmp_path}/panel")
    train, later = panel.split_by_year(spark.read.parquet(f"{tmp_path}/panel"), 1999)
    assert train.count() == later.count() == 1000
    assert "LessThan(MONTHLY_REPORTING_PERIOD,200001)" in train._jdf.queryExecution().toString()


def test_duplicate_loans(spark):
    perf = spark.createDataFrame([("L1",), ("L9",)], "LOAN_SEQUENCE_NUMBER string")
    orig = spark.createDataFrame([("L1", 1), ("L1", 2)], "LOAN_SEQUENCE_NUMBER string, x int")
    assert panel.join_loans(perf, orig).count() == 3
    with pytest.raises(ValueError):
        panel.join_loans(perf, orig, assert_unique=True)


def test_membership(spark):
    ids = spark.range(20_000).select(F.concat(F.lit("L"), "id").alias("LOAN_SEQUENCE_NUMBER"))
    got = sampling.membership(ids, 20, 0.05, seed=3)
    assert got.count() == pytest.approx(20 * 20_000 * (1 - math.exp(-0.05)), rel=0.05)
    assert got.exceptAll(sampling.membership(ids.repartition(3), 20, 0.05, seed=3)).isEmpty()
    exact = sampling.exact_membership(ids, 4, 0.05, seed=3)
    assert {r["sum(weight)"] for r in exact.groupBy("replicate").sum("weight").collect()} == {1000}


def test_losses(spark):
    df = spark.createDataFrame([("200001", 1, 0.8), ("200001", 0, 0.0), ("200002", 1, 1.0)], "MONTHLY_REPORTING_PERIOD string, DELINQUENT int, DELINQ_PROB double")
    r = metrics.losses(df).first()
    assert r.n_extreme == 2 and r.log_loss == pytest.approx(-math.log(0.8) / 3, abs=1e-9) and r.brier_score == pytest.approx(0.04 / 3)
    assert metrics.losses(df, clip=False).first().log_loss == pytest.approx(-math.log(0.8))
    assert metrics.monthly_calibration(df, labels="display").columns[1] == "Total Delinquent"


def planted(spark, n=4000):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(n, 7))
    p = 1 / (1 + np.exp(-(2 * x[:, 1] - 1.5 * x[:, 4])))
    y = (rng.random(n) < p).astype(int)
    x[rng.random(x.shape) < 0.05] = np.nan
    rows = [(f"L{i // 4}", f"{1999 + i % 2}0{i % 4 + 1}", int(y[i]), *[None if np.isnan(v) else float(v) for v in x[i]]) for i in range(n)]
    return spark.createDataFrame(rows, "LOAN_SEQUENCE_NUMBER string, MONTHLY_REPORTING_PERIOD string, DELINQUENT int, " + ", ".join(f"{c} double" for c in FEATURES))


def test_forecast_beats_the_base_rate_and_is_stable(spark):
    df, params = planted(spark), boosting.Params(trees=30)
    got = pipelines.forecast(df, 1999, 4, 0.5, seed=1, params=params)
    rate = df.agg(F.avg("DELINQUENT")).first()[0]
    loss = metrics.losses(got).first().log_loss
    assert loss < 0.8 * -(rate * math.log(rate) + (1 - rate) * math.log(1 - rate))
    again = pipelines.forecast(df.repartition(7), 1999, 4, 0.5, seed=1, params=params)
    key = ["LOAN_SEQUENCE_NUMBER", "MONTHLY_REPORTING_PERIOD"]
    assert got.join(again.withColumnRenamed("DELINQ_PROB", "q"), key).where("abs(DELINQ_PROB - q) > 1e-12").count() == 0
    assert pipelines.forecast(df, 1999, 2, 0.2, weighted=True, id_population="train", params=boosting.Params(trees=2)).count() == got.count()


def test_stripped(spark):
    assert spark.createDataFrame([("  a b\t",)], "x string").select(stripped(F.col("x"))).first()[0] == "a b"


def test_table_of_predictions_outlives_its_catalog_entry(spark, tmp_path):
    df = spark.createDataFrame([("L1", "200001", 1, 0.5), ("L2", "200002", 0, 0.25)], "LOAN_SEQUENCE_NUMBER string, MONTHLY_REPORTING_PERIOD string, DELINQUENT int, DELINQ_PROB double")
    for run in (1, 2, 2):
        losses, monthly = pipelines.publish(df, run, "kept", f"{tmp_path}/kept", f"{tmp_path}/report")
    assert losses.first().n_rows == monthly.count() == spark.read.parquet(f"{tmp_path}/report").count() == 2
    spark.sql("DROP TABLE kept")
    sinks.create_predictions(spark, "kept", f"{tmp_path}/kept")
    assert sinks.read_predictions(spark, table="kept").count() == 4
    assert "DELINQ_PROB:double" in (plan := sinks.read_predictions(spark, 1, "kept")._jdf.queryExecution().executedPlan().toString()) and "LOAN_SEQUENCE_NUMBER" not in plan.split("ReadSchema")[1]
    spark.sql("DROP TABLE kept")


def test_predictions_walk_the_trees(spark):
    rng = np.random.default_rng(2)
    x, y = rng.normal(size=(500, 3)), rng.integers(0, 2, 500)
    x[rng.random(x.shape) < 0.2] = np.nan
    edges = [sorted(set(np.quantile(c[~np.isnan(c)], np.linspace(0, 1, 20)))) for c in x.T]
    binned = np.stack([boosting.bins_of(c, e) for c, e in zip(x.T, edges, strict=True)], 1)
    found = [(r, *t) for r in (0, 1) for t in boosting.fit_trees(binned, y, np.ones(500), np.arange(500), edges, boosting.Params(trees=5), r)]
    nodes = {(r, t, n): rest for r, t, n, *rest in found}

    def p(replicate, row):
        margin = 0.0
        for tree in range(5):
            n = 0
            while nodes[replicate, tree, n][0] >= 0:
                feature, threshold, left, _ = nodes[replicate, tree, n]
                n = 2 * n + (1 if (left if np.isnan(row[feature]) else row[feature] <= threshold) else 2)
            margin += nodes[replicate, tree, n][3]
        return 1 / (1 + math.exp(-margin))

    model = pd.DataFrame(found, columns=["replicate", "tree", "node", "feature", "threshold", "default_left", "leaf"])
    assert boosting.predict(boosting.laid_out(model), x) == pytest.approx([(p(0, row) + p(1, row)) / 2 for row in x], abs=1e-12)


def test_time_split_reads_only_the_years_asked_for(spark, tmp_path):
    rows = [("L1", f"{y}{m:02d}", y) for y in (1998, 1999, 2000) for m in (1, 12)] + [("L2", None, 0)]
    df = spark.createDataFrame(rows, "LOAN_SEQUENCE_NUMBER string, MONTHLY_REPORTING_PERIOD string, x int")
    sinks.write_panel(df, str(tmp_path / "panel"))
    first, later = panel.split_by_year(spark.read.parquet(str(tmp_path / "panel")), 1999)
    assert sorted({r.x for r in first.collect()}) == [1998, 1999] and {r.x for r in later.collect()} == {2000}
    for part in (first, later):
        assert "PartitionFilters: []" not in part._jdf.queryExecution().executedPlan().toString()
        assert "REPORTING_YEAR" in part._jdf.queryExecution().executedPlan().toString().split("PartitionFilters:")[1].split("]")[0]


def test_rows_to_append_are_the_same_in_every_run(spark):
    df = spark.createDataFrame([(1, x) for x in range(50)] + [(2, 7)], "k int, x int")
    got = [sorted(map(tuple, sinks.new_rows(df.repartition(n), None, ["k"]).collect())) for n in (1, 3, 7)]
    assert got[0] == got[1] == got[2] and len(got[0]) == 2


def test_trees_grown_over_the_cluster_are_those_of_one_task(spark):
    df = planted(spark, 1500).withColumn("replicate", F.explode(F.array(F.lit(0), F.lit(3), F.lit(7)))).where("replicate <> 3 OR abs(hash(LOAN_SEQUENCE_NUMBER)) % 3 > 0")
    df = df.withColumn("weight", (F.abs(F.hash(LOAN, "replicate")) % 3).cast("double"))
    params = boosting.Params(trees=4, depth=2, bins=16, seed=5)
    model = [sorted(tuple(r) for r in boosting.fit(t, params=params, group_rows=n).collect()) for t, n in ((df, 10**9), (df, 0), (df.repartition(5), 1200))]
    assert model[0] == model[1] == model[2]
    assert {r[0] for r in model[0]} == {0, 3, 7} and {r[1] for r in model[0]} == set(range(4)) and max(r[2] for r in model[0]) > 2
    assert boosting.fit(df.limit(0), params=params).count() == 0


def test_the_best_split_is_the_same_by_windows_and_arrays(spark):
    rng = np.random.default_rng(8)
    rows, want, one = [], {}, 1 << 30
    for node in range(60):
        n = rng.integers(0, 4, (3, 6))
        if node % 3 == 0:
            n[:, 0] = 0
        h = n * one // 2
        g = rng.integers(-1, 2, n.shape) * h // (1 + node % 2)
        g[:, 5] += g[0].sum() - g.sum(1)  # all features see the same rows
        h[:, 5] += h[0].sum() - h.sum(1) + (n[:, 5] > 0) * 0
        n[:, 5] = np.maximum(n[:, 5], 1)
        h = np.maximum(h, 0)
        for c in range(3):
            h[c, 5] += h.sum(1).max() - h[c].sum()
        want[node] = boosting._best(g, h, n, np.arange(3), boosting.Params())
        rows += [(0, node, c, b, int(g[c, b]), int(h[c, b])) for c in range(3) for b in range(6) if n[c, b]]
    found = boosting.best_splits(spark.createDataFrame(rows, "replicate int, node int, feature int, bin int, g long, h long").repartition(3), 1.0).collect()
    got = {r.node: None if r.feature is None else (r.feature, r.bin, r.missing_left, r.a, r.b) for r in found}
    assert got == want and sum(x is not None for x in want.values()) > 30


def test_scores_as_expressions(spark):
    df, params = planted(spark, 800), boosting.Params(trees=3, depth=2)
    model = boosting.fit(df.withColumn("replicate", F.explode(F.array(F.lit(0), F.lit(1)))), params=params)
    a, b = (boosting.score(df, model, compiled_nodes=n) for n in (0, 500))
    assert "Python" not in b._jdf.queryExecution().executedPlan().toString() and "InPandas" in a._jdf.queryExecution().executedPlan().toString()
    key = [LOAN, panel.MONTH]
    both = a.join(b.withColumnRenamed("DELINQ_PROB", "q"), key)
    assert both.count() == a.count() and both.where("abs(DELINQ_PROB - q) > 1e-12").count() == 0


SF = "/root/testdata/sf0.001"


def test_months_and_loans_of_bucketed_tables_join_without_a_shuffle(spark):
    orig, perf = queries.bucketed_tables(spark, SF, 4)
    plan = panel.join_loans(panel.performance_columns(perf), panel.origination_columns(orig))._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan and plan.count("SelectedBucketsCount: 4 out of 4") == 2
    assert len({f.rpartition("/")[2] for f in perf.inputFiles()}) == 8  # two appends, a file for each bucket
    with pytest.raises(ValueError, match="LOAN_AGE"):
        sinks.append_bucketed(perf.drop("LOAN_AGE"), "performance_" + perf.inputFiles()[0].split("loans-")[1].split("/")[0], 4)


def test_counts_come_from_footers(spark, tmp_path):
    rows = spark.range(5000).select(F.concat(F.lit("L"), "id").alias(LOAN), F.when(F.col("id") < 1200, "199901").otherwise("200002").alias(panel.MONTH))
    sinks.write_panel(rows.repartition(7), f"{tmp_path}/panel", row_group=500, groups_a_file=4)
    got = sinks.stored_rows(spark, f"{tmp_path}/panel", "REPORTING_YEAR > 1999")
    assert got.first().n_rows == 3800
    assert "PushedAggregation: [COUNT(*)]" in got._jdf.queryExecution().executedPlan().toString().replace("PushedAggregates", "PushedAggregation")
    groups = [tuple(r) for r in sinks.row_groups(spark, f"{tmp_path}/panel").select("file", "row_group", "n_rows").collect()]
    files = {f for f, _, _ in groups}
    last = {f: max(i for g, i, _ in groups if g == f) for f in files}
    assert all(n == 500 for f, i, n in groups if i < last[f]) and sum(n for *_, n in groups) == 5000
    assert len(files) == 3  # 1200 rows; 3800 rows of at most 2000 a file
    sinks.write_panel(rows, f"{tmp_path}/flat", by_year=False)
    assert spark.read.parquet(f"{tmp_path}/flat").count() == 5000


def test_a_batch_is_there_as_a_whole_or_not_at_all(spark, tmp_path):
    folder, df = str(tmp_path), spark.range(100).select(F.concat(F.lit("L"), "id").alias(LOAN), F.col("id").cast("double").alias("x"))
    failing = df.withColumn("x", F.when(F.col("x") == 99, F.raise_error("broken").cast("double")).otherwise(F.col("x")))
    with pytest.raises(Exception, match="broken"):
        sinks.load_batch(failing, "origination", folder, 1)
    assert not (tmp_path / "origination").exists() and not list((tmp_path / "_staged").glob("*"))
    assert sinks.load_batch(df, "origination", folder, 1) and not sinks.load_batch(df, "origination", folder, 1)
    assert sinks.load_batch(df.withColumn("x", F.col("x") + 1), "origination", folder, "b", dedup_keys=[LOAN])
    assert sinks.base_table(spark, folder, "origination").columns == [LOAN, "x"] and sinks.base_table(spark, folder, "origination").count() == 100
    # two loads of one batch at once: the second one finds it and goes
    assert not sinks.commit_batch(spark, sinks.staged(df, "origination", folder), "origination", folder, 1)
    assert sinks.base_table(spark, folder, "origination").count() == 100 and not list((tmp_path / "_staged").glob("*"))
    for other in (df.withColumn("x", F.col("x").cast("string")), df.drop("x"), df.withColumn("y", F.lit(1))):
        with pytest.raises(ValueError, match="other columns"):
            sinks.load_batch(other, "origination", folder, 2)
    with pytest.raises(ValueError):
        sinks.load_batch(df, "other", folder, 1)
    sinks.append_table(df, "performance", folder)
    with pytest.raises(ValueError, match="x "):
        sinks.append_table(df.withColumn("x", F.col("x").cast("int")), "performance", folder)


def test_a_null_key_is_appended_once(spark):
    df = spark.createDataFrame([(None, 1), ("a", 2)], "k string, x int")
    assert sinks.new_rows(df, df, ["k"]).count() == 0 and sinks.new_rows(df, df.limit(0), ["k"]).count() == 2


def packed(path, text):
    path.parent.mkdir(exist_ok=True, parents=True)
    path.write_bytes(gzip.compress(text if isinstance(text, bytes) else text.encode()))
    return path


@pytest.fixture
def vintage_base(tmp_path):
    """Five years' files: sound, cut off, not UTF-8, empty, and one that is no gzip at all; 2005 is missing."""
    text = "".join(line("orig", LOAN_SEQUENCE_NUMBER=f"L{i}", SELLER_NAME=str(i * i)) + "\n" for i in range(3000)) + "short|line\n"
    name = lambda y: tmp_path / f"sample_{y}" / f"sample_orig_{y}.txt.gz"
    packed(name(2000), text)
    cut = packed(name(2001), text)
    cut.write_bytes(cut.read_bytes()[:-200])
    packed(name(2002), b"a|b\xff\xfe\n" + text.encode())
    packed(name(2003), "")
    name(2004).parent.mkdir()
    name(2004).write_bytes(b"not packed\n" * 10)
    return tmp_path


def test_broken_files_cost_their_own_rows_only(spark, vintage_base):
    base, folder = str(vintage_base), f"{vintage_base}/tables"
    with pytest.warns(UserWarning):
        got = {r.vintage: r for r in pipelines.ingest_batches(spark, base, range(2000, 2006), "orig", folder, at_a_time=6).collect()}
    assert {y: (r.state, r.n_rows, r.n_rejected) for y, r in got.items()} == {
        2000: ("loaded", 3000, 1), 2001: ("broken", None, None), 2002: ("broken", None, None), 2003: ("loaded", 0, 0), 2004: ("broken", None, None), 2005: ("missing", None, None),
    }
    assert all(got[y].reason for y in (2001, 2002, 2004)) and "UTF-8" in got[2002].reason
    assert sinks.base_table(spark, folder, "origination").count() == 3000
    assert not list((vintage_base / "tables" / "_staged").glob("*"))
    again = pipelines.ingest_batches(spark, base, range(2000, 2006), "orig", folder, at_a_time=6)
    assert {r.state for r in again.collect()} == {"held"} and sinks.base_table(spark, folder, "origination").count() == 3000


@pytest.mark.parametrize("years", [[2000, 2001], [2000, 2002], [2005]])
def test_broken_and_missing_files_raise_if_asked(spark, vintage_base, years):
    with pytest.raises((Exception, FileNotFoundError)):
        vintages.load_vintages(spark, str(vintage_base), years, "orig", f"{vintage_base}/tables", 1, on_missing="raise")
    assert not (vintage_base / "tables" / "origination").exists()


def test_sound_files_are_scanned_once(spark, vintage_base):
    before = spark.sparkContext.statusTracker()
    group = "scans"
    spark.sparkContext.setJobGroup(group, group)
    report = vintages.load_vintages(spark, str(vintage_base), [2000, 2003], "orig", f"{vintage_base}/tables", 1)
    jobs = before.getJobIdsForGroup(group)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) == 1 and sorted(tuple(r)[:4] for r in report.collect()) == [(2000, "loaded", 3000, 1), (2003, "loaded", 0, 0)]


def test_weighted_draws(spark):
    ids = spark.range(20_000).select(F.concat(F.lit("L"), "id").alias(LOAN))
    got = sampling.membership(ids, 10, 0.5, seed=3, weighted=True)
    plain = sampling.membership(ids, 10, 0.5, seed=3)
    assert got.select(LOAN, "replicate").exceptAll(plain).isEmpty() and got.count() == plain.count()
    counts = {r.weight: r["count"] for r in got.groupBy("weight").count().collect()}
    for k in (1, 2, 3):
        assert counts[k] == pytest.approx(200_000 * math.exp(-0.5) * 0.5**k / math.factorial(k), rel=0.05)
    assert max(counts) >= 5 and sampling.poisson_tails(0.01)[0] == pytest.approx(1 - math.exp(-0.01))
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()


def test_training_goes_on_where_it_was_stopped(spark, tmp_path):
    df, folder = planted(spark, 1000), str(tmp_path)
    run = pipelines.Forecast(1999, 5, 0.5, 1, params=boosting.Params(trees=3, depth=2), at_a_time=2)
    path = pipelines.train(df, folder, run, at_most=1)
    assert boosting.fitted(spark, path) == {0, 1}
    first = {f: f.stat().st_mtime_ns for f in tmp_path.glob("model-*/replicate=[01]/*.parquet")}
    assert pipelines.train(df, folder, run) == path and boosting.fitted(spark, path) == set(range(5))
    assert {f: f.stat().st_mtime_ns for f in tmp_path.glob("model-*/replicate=[01]/*.parquet")} == first
    whole = boosting.read_model(spark, pipelines.train(df, f"{folder}/other", replace(run, at_a_time=5)))
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, boosting.read_model(spark, path).collect()))
    assert pipelines.train(df, folder, replace(run, seed=2), at_most=0) != path  # other settings, another model
    got = pipelines.forecast(df, 1999, 5, 0.5, 1, params=run.params, folder=f"{folder}/third")
    assert got.count() == panel.split_by_year(df, 1999)[1].count()


def test_files_of_every_kind_are_parsed_alike(spark, tmp_path):
    text = line("perf", LOAN_SEQUENCE_NUMBER="L1", LOAN_AGE="3") + "\n"
    for y, end in ((2000, ".txt"), (2001, ".txt.gz")):
        path = tmp_path / f"sample_{y}" / f"sample_svcg_{y}{end}"
        path.parent.mkdir()
        path.write_bytes(gzip.compress(text.encode()) if end.endswith("gz") else text.encode())
    got = vintages.parse(vintages.read_lines(spark, str(tmp_path), [2000, 2001], "perf"), "perf", ("vintage",)).select("vintage", "LOAN_AGE").collect()
    assert sorted(map(tuple, got)) == [(2000, 3.0), (2001, 3.0)]


def test_draws_are_compiled_and_the_same(spark):
    """Draws are rows of a compiled scan, not lambdas over arrays; members are those that plain hashing gives."""
    ids = [f"L{i}" for i in range(300)] + [None]
    df = spark.createDataFrame([(x,) for x in ids], f"{LOAN} string")
    draw = lambda x, r: int(hashlib.md5("/".join([*([x] if x else []), str(r), "7"]).encode()).hexdigest()[:8], 16)
    got = sampling.membership(df, 20, 0.3, seed=7, portable=True)
    assert {tuple(r) for r in got.collect()} == {(x, r) for x in ids for r in range(20) if draw(x, r) < int((1 - math.exp(-0.3)) * 2**32)}
    weighted = sampling.membership(df, 20, 0.9, seed=7, portable=True, weighted=True)
    want = {(x, r): sum(draw(x, r) < int(t * 2**32) for t in sampling.poisson_tails(0.9)) for x in ids for r in range(20)}
    assert {(r[0], r.replicate): r.weight for r in weighted.collect()} == {k: n for k, n in want.items() if n}
    assert sampling.membership(df, 3, 50.0, portable=True).count() == 3 * len(ids)  # a limit of the whole range
    for m in (got, weighted, sampling.membership(df, 20, 0.3)):
        assert "lambda" not in m._jdf.queryExecution().executedPlan().toString()


def last_plan(spark):
    """The last SQL execution's plan as the status store has it."""
    store = spark._jsparkSession.sharedState().statusStore()
    runs = store.executionsList()
    return runs.apply(runs.size() - 1).physicalPlanDescription()


def test_the_panel_is_stored_without_sorting_a_task_s_rows(spark, tmp_path, monkeypatch):
    df = spark.range(3000).select(F.concat(F.lit("L"), "id").alias(LOAN), F.concat((1990 + F.col("id") % 5).cast("string"), F.lit("01")).alias(panel.MONTH))
    for open_files in (32, 2):  # with fewer files than years, the rest is sorted
        monkeypatch.setattr(sinks, "OPEN_FILES", open_files)
        sinks.write_panel(df, f"{tmp_path}/{open_files}", row_group=100)
        groups = sinks.row_groups(spark, f"{tmp_path}/{open_files}").collect()
        assert [r.n_rows for r in groups] == [100] * 30
        assert "Sort" not in last_plan(spark)
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"


def test_scores_by_tables_of_leaves_are_those_of_the_trees(spark):
    """Trees of all shapes up to depth 3, missing values, infinite thresholds, values on thresholds."""
    rng = np.random.default_rng(4)

    def tree(depth):
        found, todo = {}, [(0, 0)]
        while todo:
            node, d = todo.pop()
            if d == depth or rng.random() < 0.25:
                found[node] = (-1, 0.0, True, float(rng.normal()))
            else:
                found[node] = (int(rng.integers(0, 4)), float(rng.choice([-np.inf, -1, 0, 0.5, 1, np.inf])), bool(rng.integers(0, 2)), 0.0)
                todo += [(2 * node + 1, d + 1), (2 * node + 2, d + 1)]
        return found

    x = rng.choice([-np.inf, -2, -1, 0, 0.25, 0.5, 1, 3, np.inf, np.nan], (2000, 4))
    model = [[tree(3) for _ in range(n)] for n in (7, 1, 20)]
    assert boosting.scorer(model)(x) == pytest.approx(boosting.predict(model, x), abs=1e-12)
    flat = [[{0: (-1, 0.0, True, 0.3)}]]
    assert boosting.scorer(flat)(x) == pytest.approx(boosting.predict(flat, x))
    assert boosting.scorer([]) is None and boosting.scorer([[{**{n: (0, 0.0, True, 0.0) for n in range(15)}, **{n: (-1, 0.0, True, 1.0) for n in range(15, 31)}}]]) is None
    many = [[tree(3) for _ in range(100)] for _ in range(20)]
    fast, wide = boosting.scorer(many), rng.normal(size=(4000, 4))
    began = time.perf_counter()
    fast(wide)
    middle = time.perf_counter()
    boosting.predict(many, wide)
    assert 1.5 * (middle - began) < time.perf_counter() - middle


def test_lines_of_large_packed_files_are_parsed_by_all_tasks(spark, vintage_base, monkeypatch):
    want = sorted(map(tuple, vintages.read_lines(spark, str(vintage_base), [2000], "orig").collect()))
    monkeypatch.setattr(vintages, "SPREAD_BYTES", 1000)
    got = vintages.read_lines(spark, str(vintage_base), [2000], "orig")
    assert "Exchange" in got._jdf.queryExecution().executedPlan().toString() and sorted(map(tuple, got.collect())) == want
    with pytest.warns(UserWarning):
        report = pipelines.ingest_batches(spark, str(vintage_base), range(2000, 2006), "orig", f"{vintage_base}/tables", at_a_time=6)
    assert {r.vintage: r.state for r in report.collect()} == {2000: "loaded", 2001: "broken", 2002: "broken", 2003: "loaded", 2004: "broken", 2005: "missing"}
    assert sinks.base_table(spark, f"{vintage_base}/tables", "origination").count() == 3000
