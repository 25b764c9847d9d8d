"""One query for each operator over loan tables derived from the star-schema tables, and its SQL."""

from __future__ import annotations

import gzip
import math
from collections.abc import Callable

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import delinquent, number, period, prepaid, year_number
from ..functions.schemas import STATES
from ..operators import boosting, metrics, panel, sampling
from ..sources import sinks, vintages
from ..sources.shared import written
from . import fixtures, pipelines

LOAN, MONTH, LAST_YEAR = panel.LOAN, panel.MONTH, 1999
PARAMS = boosting.Params()
REPLICATES, FRACTION = 100, 0.01
RATE_CUT = 0.50032  # a threshold that no difference of rates meets
#: A handwritten model (boosting.MODEL_SCHEMA): two replicates of two trees.
FIXED_MODEL = [
    (0, 0, 0, 1, 12.0, True, 0.0), (0, 0, 1, -1, 0.0, True, -0.4), (0, 0, 2, 4, 700.0, False, 0.0), (0, 0, 5, -1, 0.0, True, 0.3), (0, 0, 6, -1, 0.0, True, -0.2),
    (0, 1, 0, 3, 30.0, False, 0.0), (0, 1, 1, -1, 0.0, True, 0.1), (0, 1, 2, -1, 0.0, True, -0.1),
    (1, 0, 0, 6, 6.0, True, 0.0), (1, 0, 1, -1, 0.0, True, 0.25), (1, 0, 2, 5, RATE_CUT, True, 0.0), (1, 0, 5, -1, 0.0, True, -0.3), (1, 0, 6, -1, 0.0, True, 0.5),
    (1, 1, 0, -1, 0.0, True, -0.05),
]


def _orig(spark, d):
    return fixtures.origination(spark, d)


def _perf(spark, d):
    return fixtures.performance(spark, d)


def _panel(spark, d, keep_sparse=False):
    return panel.build_panel(_orig(spark, d), _perf(spark, d), fixtures.unemployment(spark, d), keep_sparse)


def _predictions(spark, d):
    return _panel(spark, d).select(LOAN, MONTH, "DELINQUENT", (F.pmod(F.col("LOAN_AGE").cast("bigint"), F.lit(101)) / F.lit(100.0)).cast("double").alias("DELINQ_PROB"))


def _joined(spark, d):
    return panel.join_loans(panel.performance_columns(_perf(spark, d)), panel.origination_columns(_orig(spark, d)))


def ingest_orig_parse(spark: SparkSession, d: str) -> DataFrame:
    table = _orig(spark, d)
    return vintages.parse(fixtures.lines(table, "orig"), "orig").select(*fixtures.parsed_columns("orig", table))


def ingest_perf_parse(spark: SparkSession, d: str) -> DataFrame:
    table = _perf(spark, d)
    return vintages.parse(fixtures.lines(table, "perf"), "perf").select(*fixtures.parsed_columns("perf", table))


def ingest_quarantine(spark: SparkSession, d: str) -> DataFrame:
    bad = vintages.quarantine(fixtures.lines(_orig(spark, d), "orig"), "orig")
    return bad.groupBy("n_fields").agg(F.count("*").alias("n_lines"), F.max(F.length("head")).alias("longest_head"))


def ingest_vintage_audit(spark: SparkSession, d: str) -> DataFrame:
    lines = fixtures.lines(_orig(spark, d), "orig")
    return vintages.audit(lines.withColumn("vintage", F.substring(F.split("value", r"\|")[1], 1, 4).cast("int")), "orig")


def numeric_coercion(spark: SparkSession, d: str) -> DataFrame:
    raw = spark.read.parquet(f"{d}/orders.parquet").select("o_orderkey", F.concat(F.col("o_orderkey").cast("string"), F.element_at(F.array(*map(F.lit, ("", "d", "f", "abc", " ", ",0", "L", ".5"))), (F.col("o_orderkey") % 8 + 1).cast("int"))).alias("raw"))
    return raw.select("o_orderkey", number(F.col("raw")).alias("value"))


def _observations(spark, d):
    """Daily order figures as observations of state series: months, known states and ids that aren't series."""
    ids = F.concat(F.element_at(F.array(*map(F.lit, [*STATES, "DC", "PR"])), (F.col("o_custkey") % 52 + 1).cast("int")), F.when(F.col("o_orderkey") % 10 == 0, "XX").otherwise("UR"))
    return spark.read.parquet(f"{d}/orders.parquet").select(ids.alias("series_id"), F.col("o_orderdate").alias("date"), F.col("o_totalprice").alias("value"))


def unemp_reshape(spark: SparkSession, d: str) -> DataFrame:
    return vintages.unemployment(_observations(spark, d))


def unemp_written(spark: SparkSession, d: str) -> DataFrame:
    """The series written twice with whole numbers as months, read back, and the months as the panel joins them."""
    path = fixtures.new_folder(spark)
    for _ in range(2):
        sinks.write_table(vintages.unemployment(_observations(spark, d), numbers=True), path)
    return spark.read.parquet(path).select(F.col("date").alias("date_number"), period(F.col("date"), "int").alias("date"), "unemp", "state")


def ingest_key_check(spark: SparkSession, d: str) -> DataFrame:
    """Months of the panel's kinds, with some that have no month between 1 and 12 and some that are empty."""
    month = F.lpad((F.month("o_orderdate") + 6 * (F.col("o_orderkey") % 3)).cast("string"), 2, "0")
    key = F.when(F.col("o_orderkey") % 7 != 0, F.concat(F.year("o_orderdate").cast("string"), month)).when(F.col("o_orderkey") % 2 == 0, "")
    table = spark.read.parquet(f"{d}/orders.parquet").select(key.alias("MONTHLY_REPORTING_PERIOD"), F.date_format("o_orderdate", "yyyyMM").alias("FIRST_PAYMENT_DATE"))
    return vintages.key_check(table, table.columns)


def years(spark: SparkSession, d: str) -> DataFrame:
    """Loan months by year, which every key must have."""
    return _perf(spark, d).groupBy(year_number(F.col(MONTH)).alias("year")).agg(F.count("*").alias("n_rows"))


def _files(spark, d, kind, packed=False):
    """Vintage files of a derived table, by Spark in a new folder: (folder, years)."""
    base = fixtures.new_folder(spark)
    return base, fixtures.write_vintages(_orig(spark, d) if kind == "orig" else _perf(spark, d), kind, base, packed)


def _ingested(spark, d, kind, packed):
    """The base table that a load of the files gives, which is stopped after three batches and repeated."""
    base, found = _files(spark, d, kind, packed)
    for part in (found[:3], found, found):
        pipelines.ingest_batches(spark, base, part, kind, f"{base}/tables")
    table = sinks.base_table(spark, f"{base}/tables", vintages.TABLES[kind])
    return table.select(*fixtures.parsed_columns(kind, _orig(spark, d) if kind == "orig" else _perf(spark, d)))


def ingest_orig_files(spark: SparkSession, d: str) -> DataFrame:
    return _ingested(spark, d, "orig", packed=True)


def ingest_perf_files(spark: SparkSession, d: str) -> DataFrame:
    return _ingested(spark, d, "perf", packed=False)


def ingest_broken_files(spark: SparkSession, d: str) -> DataFrame:
    """Reports of a load with a file cut off, one with bytes that aren't UTF-8 and one that isn't there."""
    base, found = _files(spark, d, "orig", packed=True)
    path = {y: vintages.vintage_path(base, y, "orig") + ".gz" for y in (1996, 2000)}
    fixtures.damage(spark, path[1996], keep=800)
    fixtures.damage(spark, path[2000], add=gzip.compress(b"a|\xff\xfe|b\n"))
    report = pipelines.ingest_batches(spark, base, [*found, 1901], "orig", f"{base}/tables")
    loaded = sinks.base_table(spark, f"{base}/tables", "origination").groupBy(F.substring("FIRST_PAYMENT_DATE", 1, 4).cast("int").alias("vintage")).agg(F.count("*").alias("n_loaded"))
    return report.drop("reason").join(loaded, "vintage", "left")


def loads_whole(spark: SparkSession, d: str) -> DataFrame:
    """Batches that are repeated, that fail on their way and are loaded again, and that have other types."""
    folder, orig = fixtures.new_folder(spark), _orig(spark, d)
    odd = F.substring(LOAN, 11, 1).cast("int") % 2 == 1
    sinks.load_batch(orig.where(odd), "origination", folder, 1, orig.schema)
    failing = orig.where(~odd).withColumn("CREDIT_SCORE", F.when(F.col("CREDIT_SCORE") > 700, F.raise_error("interrupted").cast("double")).otherwise(F.col("CREDIT_SCORE")))
    refused = 0
    for batch in (failing, orig.withColumn("CREDIT_SCORE", F.col("CREDIT_SCORE").cast("string"))):
        try:
            sinks.load_batch(batch, "origination", folder, 2, orig.schema)
        except (PySparkException, ValueError):
            refused += 1
    for _ in range(2):
        sinks.load_batch(orig.where(~odd), "origination", folder, 2, orig.schema)
    return sinks.base_table(spark, folder, "origination").groupBy("FIRST_PAYMENT_DATE").agg(F.count("*").alias("n_rows"), F.countDistinct(LOAN).alias("n_loans"), F.lit(refused).alias("n_refused"))


def bucketed_tables(spark: SparkSession, d: str, buckets: int = 8) -> tuple[DataFrame, DataFrame]:
    """Loans and months in base tables by bucket, the months appended in two parts."""
    folder, orig, perf = fixtures.new_folder(spark), _orig(spark, d), _perf(spark, d)
    names = [f"{t}_{folder.rpartition('-')[2]}" for t in ("origination", "performance")]
    for name, table in zip(names, (orig, perf), strict=True):
        sinks.create_bucketed(spark, name, table.schema, f"{folder}/{name}", buckets)
    sinks.append_bucketed(orig, names[0], buckets)
    for part in ("<", ">="):
        sinks.append_bucketed(perf.where(f"{MONTH} {part} '199601'"), names[1], buckets)
    return spark.table(names[0]).hint("merge"), spark.table(names[1])


def panel_bucketed(spark: SparkSession, d: str) -> DataFrame:
    """The panel of bucketed tables, whose months and loans meet without a shuffle; without the rates'
    difference, whose last digits follow the order in which a mean was added up."""
    orig, perf = bucketed_tables(spark, d)
    return panel.build_panel(orig, perf, fixtures.unemployment(spark, d)).drop("INTEREST_RATE_DIFF")


def panel_row_groups(spark: SparkSession, d: str) -> DataFrame:
    """Row groups of the stored panel by year, by its footers; a small size, so that there are some."""
    path = fixtures.new_folder(spark)
    sinks.write_panel(_panel(spark, d), path, row_group=1000)
    groups = sinks.row_groups(spark, path).withColumn("year", F.regexp_extract("file", r"REPORTING_YEAR=(\d+)", 1))
    return groups.groupBy("year").agg(F.sum("n_rows").alias("n_rows"), F.count("*").alias("n_groups"), F.count_if(F.col("n_rows") == 1000).alias("n_full"))


def validation_rows(spark: SparkSession, d: str) -> DataFrame:
    """The rows of the later months by the footers of their years' files."""
    path = fixtures.new_folder(spark)
    sinks.write_panel(_panel(spark, d), path)
    return sinks.stored_rows(spark, path, f"REPORTING_YEAR > {LAST_YEAR}")


def base_table_export(spark: SparkSession, d: str) -> DataFrame:
    """Two loads of the same loans into the base table, and its export."""
    folder = fixtures.new_folder(spark)
    for _ in range(2):
        sinks.append_table(_orig(spark, d), "origination", folder, [LOAN])
    sinks.export_table(spark, "origination", folder, f"{folder}/export")
    return spark.read.parquet(f"{folder}/export")


def base_table_appended(spark: SparkSession, d: str) -> DataFrame:
    """Two loads without keys: every row is there twice."""
    folder = fixtures.new_folder(spark)
    for _ in range(2):
        path = sinks.append_table(_orig(spark, d), "origination", folder)
    return spark.read.parquet(path).groupBy(LOAN).agg(F.count("*").alias("n"), F.max("CREDIT_SCORE").alias("CREDIT_SCORE"))


def panel_written(spark: SparkSession, d: str) -> DataFrame:
    """The later months of the panel as it is stored: only their years are read."""
    path = fixtures.new_folder(spark)
    sinks.write_panel(_panel(spark, d), path)
    return _rounded(panel.split_by_year(spark.read.parquet(path), LAST_YEAR)[1]).drop("REPORTING_YEAR")


def append_dedup(spark: SparkSession, d: str) -> DataFrame:
    """What a second load of overlapping loans would add."""
    orig = _orig(spark, d)
    odd = F.substring(LOAN, 11, 1).cast("int") % 2 == 1
    return sinks.new_rows(orig.unionByName(orig), orig.where(odd), [LOAN]).select(LOAN, "CREDIT_SCORE")


def append_plain(spark: SparkSession, d: str) -> DataFrame:
    orig = _orig(spark, d).select(LOAN)
    return orig.unionByName(sinks.new_rows(orig, orig, None)).groupBy(LOAN).agg(F.count("*").alias("n"))


def orig_projection(spark: SparkSession, d: str) -> DataFrame:
    return panel.origination_columns(_orig(spark, d))


def perf_projection(spark: SparkSession, d: str) -> DataFrame:
    return panel.performance_columns(_perf(spark, d))


def label_prepaid(spark: SparkSession, d: str) -> DataFrame:
    return _joined(spark, d).select(LOAN, MONTH, prepaid().alias("PREPAID"))


def label_delinquent(spark: SparkSession, d: str) -> DataFrame:
    return _perf(spark, d).select(LOAN, MONTH, delinquent().alias("DELINQUENT"))


def join_perf_orig_left(spark: SparkSession, d: str) -> DataFrame:
    return _joined(spark, d)


def avg_rate_by_month(spark: SparkSession, d: str) -> DataFrame:
    return panel.average_rate(_orig(spark, d)).select("FIRST_PAYMENT_DATE", F.round("AVG_INTEREST_RATE", 6).alias("AVG_INTEREST_RATE"))


def join_avg_rate(spark: SparkSession, d: str) -> DataFrame:
    out = panel.join_rate(panel.performance_columns(_perf(spark, d)), panel.average_rate(_orig(spark, d)))
    return out.select(LOAN, MONTH, F.round("AVG_INTEREST_RATE", 6).alias("AVG_INTEREST_RATE"))


def join_unemp_inner(spark: SparkSession, d: str) -> DataFrame:
    return panel.join_unemployment(_joined(spark, d), fixtures.unemployment(spark, d)).select(LOAN, MONTH, "PROPERTY_STATE", "unemp")


def rate_diff(spark: SparkSession, d: str) -> DataFrame:
    return _panel(spark, d).select(LOAN, MONTH, F.round("INTEREST_RATE_DIFF", 6).alias("INTEREST_RATE_DIFF"))


def origination_year_month(spark: SparkSession, d: str) -> DataFrame:
    return _panel(spark, d).groupBy("ORIGINATION_YEAR", "ORIGINATION_MONTH").agg(F.count("*").alias("n"))


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumn("INTEREST_RATE_DIFF", F.round("INTEREST_RATE_DIFF", 6))


def panel_full(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(_panel(spark, d, keep_sparse=True))


def panel_drop_sparse(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(_panel(spark, d))


def loans_per_month(spark: SparkSession, d: str) -> DataFrame:
    return panel.loans_per_month(_joined(spark, d))


def null_profile(spark: SparkSession, d: str) -> DataFrame:
    return panel.null_profile(_panel(spark, d, keep_sparse=True))


def unique_loans(spark: SparkSession, d: str) -> DataFrame:
    return sampling.loans(_panel(spark, d))


def split_train(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(panel.split_by_year(_panel(spark, d), LAST_YEAR)[0])


def split_validation(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(panel.split_by_year(_panel(spark, d), LAST_YEAR)[1])


def validation_count(spark: SparkSession, d: str) -> DataFrame:
    return panel.split_by_year(_panel(spark, d), LAST_YEAR)[1].agg(F.count("*").alias("n_rows"), F.countDistinct(LOAN).alias("n_loans"))


def head_5000(spark: SparkSession, d: str) -> DataFrame:
    """The preview's size; which rows it has isn't determined."""
    return _panel(spark, d).limit(5000).agg(F.count("*").alias("n_rows"))


def preview(spark: SparkSession, d: str) -> DataFrame:
    """The few rows that a notebook shows; which ones isn't determined."""
    return _panel(spark, d).limit(5).agg(F.count("*").alias("n_rows"))


def bootstrap_membership(spark: SparkSession, d: str) -> DataFrame:
    return sampling.membership(sampling.loans(_panel(spark, d)), REPLICATES, FRACTION, seed=7, portable=True)


def bootstrap_rows(spark: SparkSession, d: str) -> DataFrame:
    p = written(_panel(spark, d).select(LOAN, "DELINQUENT"), "panel")
    rows = sampling.sampled_rows(p, sampling.membership(sampling.loans(p), REPLICATES, FRACTION, seed=7, portable=True))
    return rows.groupBy("replicate").agg(F.count("*").alias("n_rows"), F.countDistinct(LOAN).alias("n_loans"), F.sum("DELINQUENT").alias("n_delinquent"))


def log_loss(spark: SparkSession, d: str) -> DataFrame:
    return metrics.losses(_predictions(spark, d)).select(F.round("log_loss", 6).alias("log_loss"), "n_rows", "n_extreme")


def brier_score(spark: SparkSession, d: str) -> DataFrame:
    return metrics.losses(_predictions(spark, d)).select(F.round("brier_score", 6).alias("brier_score"))


def monthly_calibration(spark: SparkSession, d: str) -> DataFrame:
    out = metrics.monthly_calibration(_predictions(spark, d))
    return out.select(MONTH, "total_delinquent", *[F.round(c, 9).alias(c) for c in ("predicted_delinquent", "difference", "delinquent_pct", "predicted_delinquent_pct")])


def monthly_delinquency(spark: SparkSession, d: str) -> DataFrame:
    """Flagship: the whole panel, and delinquent and prepaid loan months by month."""
    return _panel(spark, d).groupBy(MONTH).agg(F.count("*").alias("n_rows"), F.sum("DELINQUENT").alias("n_delinquent"), F.sum("PREPAID").alias("n_prepaid"), F.round(F.avg("UNEMPLOYMENT"), 6).alias("unemployment"))


def model_fit(spark: SparkSession, d: str) -> DataFrame:
    return boosting.fit(pipelines.sampled(written(_panel(spark, d), "panel"), pipelines.Forecast(LAST_YEAR, REPLICATES, FRACTION, 7)), params=PARAMS)


#: Edges of bins for the features, in their order; the rates' differences don't meet them.
FIXED_EDGES = [[12.0, 24, 36, 48], [float(x) for x in range(0, 120, 6)], [float(x) for x in range(45, 100, 5)], [float(x) for x in range(15, 55, 5)], [float(x) for x in range(600, 800, 20)], [x / 2 + 0.00032 for x in range(-6, 7)], [x / 2 for x in range(7, 22)]]
FEW = 20  # replicates of the queries that look at single splits


def first_splits(spark: SparkSession, d: str) -> DataFrame:
    """The first split of every replicate and its leaves, grown over the cluster whatever a replicate's size."""
    run = pipelines.Forecast(LAST_YEAR, FEW, 0.2, 7, portable=True)
    model = boosting.fit(pipelines.sampled(written(_panel(spark, d), "panel"), run), params=boosting.Params(trees=1, depth=1, rows=1.0, columns=1.0), edges=FIXED_EDGES, group_rows=0)
    return model.select("replicate", "node", "feature", "threshold", "default_left", F.round("leaf", 9).alias("leaf"))


def forecast_resumed(spark: SparkSession, d: str) -> DataFrame:
    """A training that is stopped after its first job and goes on: what each run has fitted, and
    how many later months the model that is read back scores."""
    p, folder = written(_panel(spark, d), "panel"), fixtures.new_folder(spark)
    run = pipelines.Forecast(LAST_YEAR, FEW, 0.2, 7, portable=True, params=boosting.Params(trees=10), at_a_time=8)
    path = pipelines.train(p, folder, run, at_most=1)
    first = boosting.fitted(spark, path)
    pipelines.train(p, folder, run)
    model = boosting.read_model(spark, path)
    scored = boosting.score(panel.split_by_year(p, LAST_YEAR)[1], model).agg(F.count_if((F.col("DELINQ_PROB") > 0) & (F.col("DELINQ_PROB") < 1)).alias("n_scored"))
    trees = model.groupBy("replicate").agg(F.countDistinct("tree").alias("n_trees"))
    return trees.select("replicate", F.when(F.col("replicate").isin(sorted(first)), 1).otherwise(2).alias("fitted_by_run"), "n_trees").join(scored)


def bootstrap_weighted(spark: SparkSession, d: str) -> DataFrame:
    """Loans of every replicate with how often each was drawn, and their rows counted so often."""
    p = written(_panel(spark, d).select(LOAN, "DELINQUENT"), "panel")
    rows = sampling.sampled_rows(p, sampling.membership(sampling.loans(p), FEW, 0.5, seed=7, portable=True, weighted=True))
    return rows.groupBy("replicate", "weight").agg(F.countDistinct(LOAN).alias("n_loans"), F.sum("weight").alias("n_rows"), F.sum(F.col("weight") * F.col("DELINQUENT")).alias("n_delinquent"))


def ensemble_score(spark: SparkSession, d: str) -> DataFrame:
    return pipelines.forecast(written(_panel(spark, d), "panel"), LAST_YEAR, REPLICATES, FRACTION, seed=7, params=PARAMS)


def forecast_eval(spark: SparkSession, d: str) -> DataFrame:
    return pipelines.evaluate(ensemble_score(spark, d))[0]


def _fixed_scores(spark, d):
    return boosting.score(_panel(spark, d), spark.createDataFrame(FIXED_MODEL, boosting.MODEL_SCHEMA))


def _published(spark, d, report=None):
    """Two runs of the same scores, the second one inserted again; its table, losses and monthly series."""
    folder = fixtures.new_folder(spark)
    table = "prediction_" + folder.rpartition("-")[2]
    scores = written(_fixed_scores(spark, d), "scores")
    for run in (1, 2, 2):
        out = pipelines.publish(scores, run, table, folder, report)
    return table, *out


def score_fixed_model(spark: SparkSession, d: str) -> DataFrame:
    return _fixed_scores(spark, d).withColumn("DELINQ_PROB", F.round("DELINQ_PROB", 9))


def predictions_read_back(spark: SparkSession, d: str) -> DataFrame:
    return sinks.read_predictions(spark, 2, _published(spark, d)[0]).withColumn("DELINQ_PROB", F.round("DELINQ_PROB", 9))


def prediction_runs(spark: SparkSession, d: str) -> DataFrame:
    """Rows of each run in the catalog's table: a run inserted again isn't there twice."""
    return spark.table(_published(spark, d)[0]).groupBy("run_id").agg(F.count("*").alias("n_rows"))


def forecast_losses(spark: SparkSession, d: str) -> DataFrame:
    out = _published(spark, d)[1]
    return out.select(F.round("log_loss", 6).alias("log_loss"), F.round("brier_score", 6).alias("brier_score"), "n_rows", "n_extreme")


def forecast_monthly(spark: SparkSession, d: str) -> DataFrame:
    """The series behind the chart, as the run's report has it."""
    report = fixtures.new_folder(spark)
    _published(spark, d, report)
    return spark.read.parquet(report).select(MONTH, "total_delinquent", *[F.round(c, 6).alias(c) for c in ("predicted_delinquent", "difference", "delinquent_pct", "predicted_delinquent_pct")])


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        ingest_orig_parse, ingest_perf_parse, ingest_quarantine, ingest_vintage_audit, numeric_coercion, unemp_reshape, append_dedup, append_plain, orig_projection, perf_projection, label_prepaid,
        label_delinquent, join_perf_orig_left, avg_rate_by_month, join_avg_rate, join_unemp_inner, rate_diff, origination_year_month, panel_full, panel_drop_sparse, loans_per_month, null_profile,
        unique_loans, split_train, split_validation, validation_count, head_5000, bootstrap_membership, bootstrap_rows, log_loss, brier_score, monthly_calibration, monthly_delinquency, model_fit,
        ensemble_score, forecast_eval, unemp_written, ingest_key_check, years, base_table_export, base_table_appended, panel_written, preview, score_fixed_model, predictions_read_back, prediction_runs,
        forecast_losses, forecast_monthly, first_splits, forecast_resumed, bootstrap_weighted, ingest_orig_files, ingest_perf_files,
        ingest_broken_files, loads_whole, panel_bucketed, panel_row_groups, validation_rows,
    )
}

_O, _P, _U = (x.format(**fixtures.DUCKDB) for x in (fixtures.ORIGINATION, fixtures.PERFORMANCE, fixtures.UNEMPLOYMENT))
_BASE = f"""WITH o AS ({_O}), p AS ({_P}), u AS ({_U}),
rate AS (SELECT FIRST_PAYMENT_DATE AS m, avg(ORIGINAL_INTEREST_RATE) AS AVG_INTEREST_RATE FROM o GROUP BY 1),
panel AS (
  SELECT p.LOAN_SEQUENCE_NUMBER, p.MONTHLY_REPORTING_PERIOD, o.ORIGINAL_LOAN_TERM, p.LOAN_AGE, o.PROPERTY_STATE, o.ORIGINAL_LOAN_TO_VALUE, o.ORIGINAL_DEBT_TO_INCOME, p.ESTIMATED_LOAN_TO_VALUE, o.CREDIT_SCORE,
    u.unemp AS UNEMPLOYMENT, CASE WHEN p.ZERO_BALANCE_CODE = 1 AND p.ZERO_BALANCE_EFFECTIVE_DATE < o.MATURITY_DATE THEN 1 ELSE 0 END AS PREPAID,
    CASE WHEN p.CURRENT_LOAN_DELINQUENCY_STATUS NOT IN ('0', 'RA') THEN 1 ELSE 0 END AS DELINQUENT, round(p.CURRENT_INTEREST_RATE - rate.AVG_INTEREST_RATE, 6) AS INTEREST_RATE_DIFF,
    substr(o.FIRST_PAYMENT_DATE, 1, 4) AS ORIGINATION_YEAR, substr(o.FIRST_PAYMENT_DATE, 5, 2) AS ORIGINATION_MONTH
  FROM p LEFT JOIN o ON p.LOAN_SEQUENCE_NUMBER = o.LOAN_SEQUENCE_NUMBER LEFT JOIN rate ON p.MONTHLY_REPORTING_PERIOD = rate.m
  JOIN u ON p.MONTHLY_REPORTING_PERIOD = u.date AND o.PROPERTY_STATE = u.state
), fixed AS (
  SELECT LOAN_SEQUENCE_NUMBER, MONTHLY_REPORTING_PERIOD, DELINQUENT, (1 / (1 + exp(-a)) + 1 / (1 + exp(-b))) / 2 AS p FROM (SELECT *,
    CASE WHEN LOAN_AGE IS NULL OR LOAN_AGE <= 12 THEN -0.4 WHEN CREDIT_SCORE <= 700 THEN 0.3 ELSE -0.2 END + CASE WHEN ORIGINAL_DEBT_TO_INCOME <= 30 THEN 0.1 ELSE -0.1 END AS a,
    CASE WHEN UNEMPLOYMENT IS NULL OR UNEMPLOYMENT <= 6 THEN 0.25 WHEN INTEREST_RATE_DIFF IS NULL OR INTEREST_RATE_DIFF <= {RATE_CUT} THEN -0.3 ELSE 0.5 END - 0.05 AS b FROM panel)
), prediction AS (SELECT LOAN_SEQUENCE_NUMBER, MONTHLY_REPORTING_PERIOD, DELINQUENT, CAST(LOAN_AGE AS BIGINT) % 101 / 100.0 AS p FROM panel),
member AS (
  SELECT LOAN_SEQUENCE_NUMBER, CAST(r AS INTEGER) AS replicate FROM (SELECT DISTINCT LOAN_SEQUENCE_NUMBER FROM panel), range({REPLICATES}) t(r)
  WHERE CAST(('0x' || substr(md5(LOAN_SEQUENCE_NUMBER || '/' || r || '/7'), 1, 8)) AS BIGINT) < CAST(floor((1 - exp(-{FRACTION})) * 4294967296) AS BIGINT)
)
"""
def _member(alias: str, columns: str, fraction: float, tails: bool = False) -> str:
    """Loans of FEW replicates by the portable draws, with their weights if tails."""
    cut = [f"CAST(floor({t!r} * 4294967296) AS BIGINT)" for t in (sampling.poisson_tails(fraction) if tails else [1 - math.exp(-fraction)])]
    return f"""{alias} AS (
  SELECT LOAN_SEQUENCE_NUMBER, replicate{columns} FROM (
    SELECT LOAN_SEQUENCE_NUMBER, CAST(r AS INTEGER) AS replicate, CAST(('0x' || substr(md5(LOAN_SEQUENCE_NUMBER || '/' || r || '/7'), 1, 8)) AS BIGINT) AS draw
    FROM (SELECT DISTINCT LOAN_SEQUENCE_NUMBER FROM panel), range({FEW}) t(r)) WHERE draw < {cut[0]}
)""".replace("{weight}", " + ".join(f"CAST(draw < {c} AS INTEGER)" for c in cut))


_SPLITS = f"""{_member("few", "", 0.2)}, value AS (
  SELECT replicate, DELINQUENT, unnest([ORIGINAL_LOAN_TERM, LOAN_AGE, ORIGINAL_LOAN_TO_VALUE, ORIGINAL_DEBT_TO_INCOME, CREDIT_SCORE, INTEREST_RATE_DIFF, UNEMPLOYMENT]) AS v, unnest(range(7)) AS feature
  FROM panel JOIN few USING (LOAN_SEQUENCE_NUMBER) WHERE CAST(substr(MONTHLY_REPORTING_PERIOD, 1, 4) AS INTEGER) <= {LAST_YEAR}
), edge AS (SELECT feature, unnest(range(1, len(edges) + 1)) AS bin, CAST(unnest(edges) AS DOUBLE) AS e FROM (SELECT unnest(range(7)) AS feature, unnest({FIXED_EDGES}) AS edges)
), total AS (SELECT replicate, sum(0.5 - DELINQUENT) AS g, sum(0.25) AS h FROM value WHERE feature = 0 GROUP BY 1
), side AS (
  SELECT value.replicate, value.feature, bin, e, missing_left, sum(CASE WHEN v <= e OR (v IS NULL AND missing_left) THEN 0.5 - DELINQUENT ELSE 0 END)::DOUBLE AS a, sum(CASE WHEN v <= e OR (v IS NULL AND missing_left) THEN 0.25 ELSE 0 END)::DOUBLE AS b
  FROM value JOIN (SELECT * FROM edge UNION ALL SELECT f, 0, '-inf'::DOUBLE FROM range(7) t(f)) AS edge USING (feature), (VALUES (true), (false)) t(missing_left) GROUP BY ALL
), gain AS (SELECT side.*, g::DOUBLE AS g, h::DOUBLE AS h, a * a / (b + 1) + (g - a) * (g - a) / (h - b + 1) - g * g / (h + 1) AS gain FROM side JOIN total USING (replicate) WHERE b >= 1 AND h - b >= 1
), best AS (SELECT * FROM gain WHERE gain > 1e-9 QUALIFY row_number() OVER (PARTITION BY replicate ORDER BY gain DESC, feature, missing_left DESC, bin) = 1)
SELECT replicate, 0 AS node, CAST(feature AS INTEGER) AS feature, e AS threshold, missing_left AS default_left, CAST(0 AS DOUBLE) AS leaf FROM best
UNION ALL SELECT replicate, 1, -1, 0, true, round(0 - 0.1 * a / (b + 1), 9) FROM best UNION ALL SELECT replicate, 2, -1, 0, true, round(0 - 0.1 * (g - a) / (h - b + 1), 9) FROM best"""
_PERF = "p.LOAN_SEQUENCE_NUMBER, p.LOAN_AGE, p.MONTHLY_REPORTING_PERIOD, p.ESTIMATED_LOAN_TO_VALUE, p.CURRENT_INTEREST_RATE, p.ZERO_BALANCE_CODE, p.ZERO_BALANCE_EFFECTIVE_DATE, p.CURRENT_LOAN_DELINQUENCY_STATUS"
_LEFT = "FROM p LEFT JOIN o ON p.LOAN_SEQUENCE_NUMBER = o.LOAN_SEQUENCE_NUMBER"
_GOOD = "CAST(substr(LOAN_SEQUENCE_NUMBER, 2) AS BIGINT) % 50 <> 0"
_KEY = "LOAN_SEQUENCE_NUMBER, MONTHLY_REPORTING_PERIOD"
_STATES = "[" + ", ".join(f"'{s}'" for s in [*STATES, "DC", "PR"]) + "]"

ORACLES = {
    k: _BASE + v
    for k, v in {
        "ingest_orig_parse": f"SELECT * FROM o WHERE {_GOOD}",
        "ingest_perf_parse": f"SELECT * REPLACE (coalesce(CURRENT_LOAN_DELINQUENCY_STATUS, '') AS CURRENT_LOAN_DELINQUENCY_STATUS) FROM p WHERE {_GOOD}",
        "ingest_quarantine": f"SELECT 31 AS n_fields, count(*) AS n_lines, 50 AS longest_head FROM o WHERE NOT ({_GOOD}) HAVING count(*) > 0",
        "ingest_vintage_audit": f"SELECT CAST(substr(FIRST_PAYMENT_DATE, 1, 4) AS INTEGER) AS vintage, count(*) FILTER ({_GOOD}) AS n_rows, count(*) FILTER (NOT ({_GOOD})) AS n_rejected FROM o GROUP BY 1",
        "numeric_coercion": "SELECT o_orderkey, CASE WHEN o_orderkey % 8 IN (0, 4) THEN CAST(o_orderkey AS DOUBLE) WHEN o_orderkey % 8 = 7 THEN o_orderkey + CAST(0.5 AS DOUBLE) END AS value FROM orders",
        "unemp_reshape": f"SELECT strftime(o_orderdate, '%Y%m') AS date, o_totalprice AS unemp, {_STATES}[o_custkey % 52 + 1] AS state FROM orders WHERE o_orderkey % 10 <> 0 AND o_custkey % 52 < 50",
        "unemp_written": f"SELECT year(o_orderdate) * 100 + month(o_orderdate) AS date_number, strftime(o_orderdate, '%Y%m') AS date, o_totalprice AS unemp, {_STATES}[o_custkey % 52 + 1] AS state FROM orders WHERE o_orderkey % 10 <> 0 AND o_custkey % 52 < 50",
        "ingest_key_check": "SELECT 'FIRST_PAYMENT_DATE' AS \"column\", count(*) AS n_rows, 0 AS n_missing, 0 AS n_invalid FROM orders UNION ALL SELECT 'MONTHLY_REPORTING_PERIOD', count(*), count(*) FILTER (o_orderkey % 7 = 0), count(*) FILTER (o_orderkey % 7 <> 0 AND month(o_orderdate) + 6 * (o_orderkey % 3) > 12) FROM orders",
        "years": "SELECT CAST(substr(MONTHLY_REPORTING_PERIOD, 1, 4) AS BIGINT) AS year, count(*) AS n_rows FROM p GROUP BY 1",
        "base_table_export": "SELECT * FROM o",
        "base_table_appended": "SELECT LOAN_SEQUENCE_NUMBER, CAST(2 * count(*) AS BIGINT) AS n, max(CREDIT_SCORE) AS CREDIT_SCORE FROM o GROUP BY 1",
        "panel_written": f"SELECT * EXCLUDE (ESTIMATED_LOAN_TO_VALUE) FROM panel WHERE CAST(substr(MONTHLY_REPORTING_PERIOD, 1, 4) AS INTEGER) > {LAST_YEAR}",
        "preview": "SELECT least(5, count(*)) AS n_rows FROM panel",
        "score_fixed_model": f"SELECT {_KEY}, DELINQUENT, round(p, 9) AS DELINQ_PROB FROM fixed",
        "predictions_read_back": "SELECT MONTHLY_REPORTING_PERIOD, DELINQUENT, round(p, 9) AS DELINQ_PROB FROM fixed",
        "prediction_runs": "SELECT CAST(r AS INTEGER) AS run_id, count(*) AS n_rows FROM fixed, range(1, 3) t(r) GROUP BY 1",
        "forecast_losses": "SELECT round(avg(-(DELINQUENT * ln(p) + (1 - DELINQUENT) * ln(1 - p))), 6) AS log_loss, round(avg((p - DELINQUENT) * (p - DELINQUENT)), 6) AS brier_score, count(*) AS n_rows, 0 AS n_extreme FROM fixed",
        "forecast_monthly": "SELECT MONTHLY_REPORTING_PERIOD, CAST(sum(DELINQUENT) AS BIGINT) AS total_delinquent, round(sum(p), 6) AS predicted_delinquent, round(sum(p) - sum(DELINQUENT), 6) AS difference, round(sum(DELINQUENT) / count(*), 6) AS delinquent_pct, round(sum(p) / count(*), 6) AS predicted_delinquent_pct FROM fixed GROUP BY 1",
        "ingest_orig_files": f"SELECT * FROM o WHERE {_GOOD}",
        "ingest_perf_files": f"SELECT * REPLACE (coalesce(CURRENT_LOAN_DELINQUENCY_STATUS, '') AS CURRENT_LOAN_DELINQUENCY_STATUS) FROM p WHERE {_GOOD}",
        "ingest_broken_files": f"""SELECT vintage, CASE WHEN vintage IN (1996, 2000) THEN 'broken' ELSE 'loaded' END AS state, CASE WHEN vintage NOT IN (1996, 2000) THEN n_rows END AS n_rows,
CASE WHEN vintage NOT IN (1996, 2000) THEN n_rejected END AS n_rejected, CASE WHEN vintage NOT IN (1996, 2000) AND n_rows > 0 THEN n_rows END AS n_loaded
FROM (SELECT CAST(substr(FIRST_PAYMENT_DATE, 1, 4) AS INTEGER) AS vintage, count(*) FILTER ({_GOOD}) AS n_rows, count(*) FILTER (NOT ({_GOOD})) AS n_rejected FROM o GROUP BY 1) UNION ALL SELECT 1901, 'missing', NULL, NULL, NULL""",
        "loads_whole": "SELECT FIRST_PAYMENT_DATE, count(*) AS n_rows, count(DISTINCT LOAN_SEQUENCE_NUMBER) AS n_loans, 2 AS n_refused FROM o GROUP BY 1",
        "panel_bucketed": "SELECT * EXCLUDE (ESTIMATED_LOAN_TO_VALUE, INTEREST_RATE_DIFF) FROM panel",
        "panel_row_groups": "SELECT year, n AS n_rows, (n + 999) // 1000 AS n_groups, n // 1000 AS n_full FROM (SELECT substr(MONTHLY_REPORTING_PERIOD, 1, 4) AS year, count(*) AS n FROM panel GROUP BY 1)",
        "validation_rows": f"SELECT count(*) AS n_rows FROM panel WHERE CAST(substr(MONTHLY_REPORTING_PERIOD, 1, 4) AS INTEGER) > {LAST_YEAR}",
        "first_splits": ", " + _SPLITS,
        "forecast_resumed": f"SELECT CAST(r AS INTEGER) AS replicate, CASE WHEN r < 8 THEN 1 ELSE 2 END AS fitted_by_run, CAST(10 AS BIGINT) AS n_trees, count(*) AS n_scored FROM panel, range({FEW}) t(r) WHERE CAST(substr(MONTHLY_REPORTING_PERIOD, 1, 4) AS INTEGER) > {LAST_YEAR} GROUP BY 1, 2",
        "bootstrap_weighted": f", {_member('few', ', {weight} AS weight', 0.5, tails=True)} SELECT replicate, weight, count(DISTINCT LOAN_SEQUENCE_NUMBER) AS n_loans, CAST(sum(weight) AS BIGINT) AS n_rows, CAST(sum(weight * DELINQUENT) AS BIGINT) AS n_delinquent FROM panel JOIN few USING (LOAN_SEQUENCE_NUMBER) GROUP BY 1, 2",
        "append_dedup": "SELECT LOAN_SEQUENCE_NUMBER, CREDIT_SCORE FROM o WHERE CAST(substr(LOAN_SEQUENCE_NUMBER, 11, 1) AS INTEGER) % 2 = 0",
        "append_plain": "SELECT LOAN_SEQUENCE_NUMBER, CAST(2 * count(*) AS BIGINT) AS n FROM o GROUP BY 1",
        "orig_projection": "SELECT * FROM o",
        "perf_projection": "SELECT * FROM p",
        "label_prepaid": f"SELECT p.LOAN_SEQUENCE_NUMBER, MONTHLY_REPORTING_PERIOD, CASE WHEN ZERO_BALANCE_CODE = 1 AND ZERO_BALANCE_EFFECTIVE_DATE < MATURITY_DATE THEN 1 ELSE 0 END AS PREPAID {_LEFT}",
        "label_delinquent": f"SELECT {_KEY}, CASE WHEN CURRENT_LOAN_DELINQUENCY_STATUS NOT IN ('0', 'RA') THEN 1 ELSE 0 END AS DELINQUENT FROM p",
        "join_perf_orig_left": f"SELECT {_PERF}, o.* EXCLUDE (LOAN_SEQUENCE_NUMBER) {_LEFT}",
        "avg_rate_by_month": "SELECT m AS FIRST_PAYMENT_DATE, round(AVG_INTEREST_RATE, 6) AS AVG_INTEREST_RATE FROM rate",
        "join_avg_rate": f"SELECT {_KEY}, round(AVG_INTEREST_RATE, 6) AS AVG_INTEREST_RATE FROM p LEFT JOIN rate ON MONTHLY_REPORTING_PERIOD = m",
        "join_unemp_inner": f"SELECT {_KEY}, PROPERTY_STATE, UNEMPLOYMENT AS unemp FROM panel",
        "rate_diff": f"SELECT {_KEY}, INTEREST_RATE_DIFF FROM panel",
        "origination_year_month": "SELECT ORIGINATION_YEAR, ORIGINATION_MONTH, count(*) AS n FROM panel GROUP BY ALL",
        "panel_full": "SELECT * FROM panel",
        "panel_drop_sparse": "SELECT * EXCLUDE (ESTIMATED_LOAN_TO_VALUE) FROM panel",
        "loans_per_month": "SELECT MONTHLY_REPORTING_PERIOD, count(*) AS number_of_loans FROM p GROUP BY 1 ORDER BY 1",
        "null_profile": "SELECT " + ", ".join(
            f"count(*) FILTER ({c} IS NULL) AS NULL_{c}"
            for c in "LOAN_SEQUENCE_NUMBER MONTHLY_REPORTING_PERIOD ORIGINAL_LOAN_TERM LOAN_AGE PROPERTY_STATE ORIGINAL_LOAN_TO_VALUE ORIGINAL_DEBT_TO_INCOME ESTIMATED_LOAN_TO_VALUE CREDIT_SCORE UNEMPLOYMENT PREPAID DELINQUENT INTEREST_RATE_DIFF ORIGINATION_YEAR ORIGINATION_MONTH".split()
        ) + " FROM panel",
        "unique_loans": "SELECT DISTINCT LOAN_SEQUENCE_NUMBER FROM panel",
        "split_train": f"SELECT * EXCLUDE (ESTIMATED_LOAN_TO_VALUE) FROM panel WHERE CAST(substr(MONTHLY_REPORTING_PERIOD, 1, 4) AS INTEGER) <= {LAST_YEAR}",
        "split_validation": f"SELECT * EXCLUDE (ESTIMATED_LOAN_TO_VALUE) FROM panel WHERE CAST(substr(MONTHLY_REPORTING_PERIOD, 1, 4) AS INTEGER) > {LAST_YEAR}",
        "validation_count": f"SELECT count(*) AS n_rows, count(DISTINCT LOAN_SEQUENCE_NUMBER) AS n_loans FROM panel WHERE CAST(substr(MONTHLY_REPORTING_PERIOD, 1, 4) AS INTEGER) > {LAST_YEAR}",
        "head_5000": "SELECT least(5000, count(*)) AS n_rows FROM panel",
        "bootstrap_membership": "SELECT * FROM member",
        "bootstrap_rows": "SELECT replicate, count(*) AS n_rows, count(DISTINCT LOAN_SEQUENCE_NUMBER) AS n_loans, CAST(sum(DELINQUENT) AS BIGINT) AS n_delinquent FROM panel JOIN member USING (LOAN_SEQUENCE_NUMBER) GROUP BY 1",
        "log_loss": "SELECT round(avg(-(DELINQUENT * ln(q) + (1 - DELINQUENT) * ln(1 - q))), 6) AS log_loss, count(*) AS n_rows, count(*) FILTER (p <= 0 OR p >= 1) AS n_extreme FROM (SELECT *, greatest(least(p, 1 - 1e-15), 1e-15) AS q FROM prediction)",
        "brier_score": "SELECT round(avg((p - DELINQUENT) * (p - DELINQUENT)), 6) AS brier_score FROM prediction",
        "monthly_calibration": "SELECT MONTHLY_REPORTING_PERIOD, CAST(sum(DELINQUENT) AS BIGINT) AS total_delinquent, round(sum(p), 9) AS predicted_delinquent, round(sum(p) - sum(DELINQUENT), 9) AS difference, round(sum(DELINQUENT) / count(*), 9) AS delinquent_pct, round(sum(p) / count(*), 9) AS predicted_delinquent_pct FROM prediction GROUP BY 1 ORDER BY 1",
        "monthly_delinquency": "SELECT MONTHLY_REPORTING_PERIOD, count(*) AS n_rows, CAST(sum(DELINQUENT) AS BIGINT) AS n_delinquent, CAST(sum(PREPAID) AS BIGINT) AS n_prepaid, round(avg(UNEMPLOYMENT), 6) AS unemployment FROM panel GROUP BY 1",
    }.items()
}
