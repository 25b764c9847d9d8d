"""The loan-month panel: projections, labels, joins and its aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import delinquent, prepaid

LOAN, MONTH = "LOAN_SEQUENCE_NUMBER", "MONTHLY_REPORTING_PERIOD"
SPARSE = "ESTIMATED_LOAN_TO_VALUE"


def origination_columns(orig: DataFrame) -> DataFrame:
    return orig.select(LOAN, "ORIGINAL_LOAN_TERM", "FIRST_PAYMENT_DATE", "ORIGINAL_INTEREST_RATE", "ORIGINAL_LOAN_TO_VALUE", "PROPERTY_STATE", "MATURITY_DATE", "ORIGINAL_DEBT_TO_INCOME", "CREDIT_SCORE")


def performance_columns(perf: DataFrame) -> DataFrame:
    return perf.select(LOAN, "LOAN_AGE", MONTH, SPARSE, "CURRENT_INTEREST_RATE", "ZERO_BALANCE_CODE", "ZERO_BALANCE_EFFECTIVE_DATE", "CURRENT_LOAN_DELINQUENCY_STATUS")


def join_loans(perf: DataFrame, orig: DataFrame, assert_unique: bool = False) -> DataFrame:
    """Loan months with their loan's columns, null where it isn't known. Loans that are listed
    twice multiply their months, or raise ValueError with assert_unique."""
    if assert_unique and not orig.groupBy(LOAN).count().where("count > 1").isEmpty():
        raise ValueError(f"{LOAN} is not unique")
    return perf.join(orig, LOAN, "left")


def average_rate(orig: DataFrame) -> DataFrame:
    """The mean original rate by month of the first payment: a proxy of the market rate."""
    return orig.groupBy("FIRST_PAYMENT_DATE").agg(F.avg("ORIGINAL_INTEREST_RATE").alias("AVG_INTEREST_RATE"))


def join_rate(months: DataFrame, rates: DataFrame) -> DataFrame:
    """Adds the mean rate of the reporting month; null where no loan began in it. The rates have
    a row per month that the files name, so adaptive execution broadcasts them by their size."""
    return months.join(rates.withColumnRenamed("FIRST_PAYMENT_DATE", "__month"), F.col(MONTH) == F.col("__month"), "left").drop("__month")


def join_unemployment(months: DataFrame, unemployment: DataFrame) -> DataFrame:
    """Adds the state's rate of the month; months without one go. A few tens of thousands of
    rows at most (states by months): adaptive execution broadcasts them by their size."""
    return months.join(unemployment, (F.col(MONTH) == F.col("date")) & (F.col("PROPERTY_STATE") == F.col("state")), "inner").drop("date", "state")


def panel_columns(joined: DataFrame) -> DataFrame:
    return joined.select(
        LOAN, MONTH, "ORIGINAL_LOAN_TERM", "LOAN_AGE", "PROPERTY_STATE", "ORIGINAL_LOAN_TO_VALUE", "ORIGINAL_DEBT_TO_INCOME", SPARSE, "CREDIT_SCORE", F.col("unemp").alias("UNEMPLOYMENT"),
        prepaid().alias("PREPAID"), delinquent().alias("DELINQUENT"), (F.col("CURRENT_INTEREST_RATE") - F.col("AVG_INTEREST_RATE")).alias("INTEREST_RATE_DIFF"),
        F.substring("FIRST_PAYMENT_DATE", 1, 4).alias("ORIGINATION_YEAR"), F.substring("FIRST_PAYMENT_DATE", 5, 2).alias("ORIGINATION_MONTH"),
    )


def build_panel(orig: DataFrame, perf: DataFrame, unemployment: DataFrame, keep_sparse: bool = False) -> DataFrame:
    """The modelling panel. The loan join is the only shuffle of the big table; both monthly
    tables are small and joined by broadcast in the same stage."""
    orig = origination_columns(orig)
    joined = join_unemployment(join_rate(join_loans(performance_columns(perf), orig), average_rate(orig)), unemployment)
    panel = panel_columns(joined)
    return panel if keep_sparse else panel.drop(SPARSE)


def loans_per_month(months: DataFrame) -> DataFrame:
    return months.groupBy(MONTH).agg(F.count("*").alias("number_of_loans")).orderBy(MONTH)


def null_profile(df: DataFrame, limit_rows: int | None = None) -> DataFrame:
    """The number of nulls of every column, over all rows unless limit_rows says otherwise."""
    df = df if limit_rows is None else df.limit(limit_rows)
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(f"NULL_{c}") for c in df.columns])


def split_by_year(panel: DataFrame, last_year: int = 2021) -> tuple[DataFrame, DataFrame]:
    """Months up to last_year, and later ones. Plain ranges of the yyyyMM text reach the scan, and
    of a panel that is stored by REPORTING_YEAR only the years asked for are read; months below
    the year 1000 or null are in neither or compare as text."""
    cut = f"{last_year + 1:04d}01"
    first, later = panel.where(F.col(MONTH) < cut), panel.where(F.col(MONTH) >= cut)
    if "REPORTING_YEAR" in panel.columns:
        year = F.col("REPORTING_YEAR").cast("string")
        first, later = first.where(year <= f"{last_year:04d}"), later.where(year > f"{last_year:04d}")
    return first, later
