"""Loan tables derived from the star-schema tables, by SQL that Spark and DuckDB both run."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.schemas import ORIGINATION_COLUMNS, PERFORMANCE_COLUMNS, schema
from ..sources.shared import moved, new_folder, placed  # noqa: F401
from ..sources.vintages import vintage_path

ORIGINATION = """
SELECT concat('L', lpad(CAST(o_orderkey AS {text}), 10, '0')) AS LOAN_SEQUENCE_NUMBER, CAST(12 * (1 + o_orderkey % 5) AS DOUBLE) AS ORIGINAL_LOAN_TERM,
  {ym}(o_orderdate, '{format}') AS FIRST_PAYMENT_DATE, concat(CAST(year(o_orderdate) + 1 + o_orderkey % 5 AS {text}), substr({ym}(o_orderdate, '{format}'), 5, 2)) AS MATURITY_DATE,
  2 + CAST(o_orderkey % 700 AS DOUBLE) / CAST(100 AS DOUBLE) AS ORIGINAL_INTEREST_RATE, CAST(40 + o_custkey % 60 AS DOUBLE) AS ORIGINAL_LOAN_TO_VALUE,
  CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE CAST(10 + o_custkey % 45 AS DOUBLE) END AS ORIGINAL_DEBT_TO_INCOME, CAST(floor(c_acctbal / 50) + 600 AS DOUBLE) AS CREDIT_SCORE,
  n_name AS PROPERTY_STATE
FROM {orders} JOIN {customer} ON o_custkey = c_custkey JOIN {nation} ON c_nationkey = n_nationkey WHERE o_orderkey % 97 <> 0"""

PERFORMANCE = """
SELECT concat('L', lpad(CAST(l_orderkey AS {text}), 10, '0')) AS LOAN_SEQUENCE_NUMBER,
  CAST(12 * (year(l_shipdate) - year(o_orderdate)) + month(l_shipdate) - month(o_orderdate) AS DOUBLE) AS LOAN_AGE, {ym}(l_shipdate, '{format}') AS MONTHLY_REPORTING_PERIOD,
  CASE WHEN l_quantity < 25 THEN NULL ELSE l_quantity END AS ESTIMATED_LOAN_TO_VALUE, round(2 + l_discount * 30 + l_tax * 10, 3) AS CURRENT_INTEREST_RATE,
  CASE WHEN l_returnflag = 'R' THEN CAST(1 AS DOUBLE) WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN CAST(9 AS DOUBLE) END AS ZERO_BALANCE_CODE,
  CASE WHEN l_returnflag = 'R' OR (l_returnflag = 'N' AND l_linestatus = 'O') THEN {ym}(l_shipdate, '{format}') ELSE '' END AS ZERO_BALANCE_EFFECTIVE_DATE,
  CASE WHEN l_linenumber <= 3 THEN '0' WHEN l_linenumber = 4 THEN 'RA' WHEN l_linenumber = 5 THEN '1' WHEN l_linenumber = 6 THEN '' END AS CURRENT_LOAN_DELINQUENCY_STATUS
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey WHERE l_shipdate >= o_orderdate"""

UNEMPLOYMENT = """
SELECT m AS date, 3 + CAST((n_nationkey * 7 + CAST(substr(m, 5, 2) AS INT) * 3) % 80 AS DOUBLE) / CAST(10 AS DOUBLE) AS unemp, n_name AS state
FROM {nation} CROSS JOIN (SELECT DISTINCT {ym}(l_shipdate, '{format}') AS m FROM {lineitem}) WHERE n_nationkey <> 24 AND m <> '199501'"""

DUCKDB = {t: t for t in ("orders", "customer", "nation", "lineitem")} | {"text": "VARCHAR", "ym": "strftime", "format": "%Y%m"}


def _loan_table(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    tables = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("orders", "customer", "nation", "lineitem") if f"{{{t}}}" in sql}
    return spark.sql(sql.replace("{text}", "STRING").replace("{ym}", "date_format").replace("{format}", "yyyyMM"), **tables)


def origination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _loan_table(spark, sf_dir, ORIGINATION)


def performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _loan_table(spark, sf_dir, PERFORMANCE)


def unemployment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _loan_table(spark, sf_dir, UNEMPLOYMENT)


def lines(table: DataFrame, kind: str, extra: tuple[str, ...] = ()) -> DataFrame:
    """Text lines (value) of a derived table as a vintage file has them; fields that the table
    doesn't have are empty, and every fiftieth loan's lines lack their last field. extra: columns to keep."""
    names = ORIGINATION_COLUMNS if kind == "orig" else PERFORMANCE_COLUMNS
    fields = [f"coalesce(CAST({c} AS STRING), '')" if c in table.columns else "''" for c in names]
    short = "CAST(substr(LOAN_SEQUENCE_NUMBER, 2) AS BIGINT) % 50 = 0"
    return table.selectExpr(f"CASE WHEN {short} THEN concat_ws('|', {', '.join(fields[:-1])}) ELSE concat_ws('|', {', '.join(fields)}) END AS value", *extra)


def parsed_columns(kind: str, table: DataFrame) -> list[str]:
    """The columns of a kind that a derived table fills."""
    return [f.name for f in schema(kind) if f.name in table.columns]


def write_vintages(table: DataFrame, kind: str, base: str, packed: bool = False) -> list[int]:
    """Files of a derived table's lines as a loan agency gives them out: one for each year of the first
    payment (orig) or of the month (perf). Returns the years."""
    spark, column = table.sparkSession, "FIRST_PAYMENT_DATE" if kind == "orig" else "MONTHLY_REPORTING_PERIOD"
    rows = lines(table.withColumn("__year", F.substring(column, 1, 4)), kind, ("__year",))
    folder, end = f"{base}/_{kind}-{uuid.uuid4().hex}", ".txt.gz" if packed else ".txt"
    rows.repartition("__year").write.partitionBy("__year").option("compression", "gzip" if packed else "none").text(folder)
    files, place = placed(spark, folder)
    years = []
    for part in files.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/__year=*/part-*")):
        year = int(part.getPath().getParent().getName().partition("=")[2])
        to = vintage_path(base, year, kind).removesuffix(".txt") + end
        moved(spark, part.getPath().toString(), to)
        years.append(year)
    return sorted(years)


def damage(spark: SparkSession, path: str, keep: int | None = None, add: bytes = b"") -> None:
    """Cuts a file after `keep` bytes and adds others, as a failed transfer may."""
    files, place = placed(spark, path)
    content = bytes(spark.read.format("binaryFile").load(path).first().content)[:keep] + add
    out = files.create(place, True)
    try:
        out.write(bytearray(content))
    finally:
        out.close()
