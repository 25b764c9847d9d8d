"""Column functions with the semantics of the loan files."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def stripped(c: Column) -> Column:
    """Without any Unicode white space at its ends."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def number(c: Column) -> Column:
    """A double, or null where the text isn't one. A trailing d or f, which Spark would take, and NaN give null."""
    suffix = F.right(c, F.lit(1)).isin(*"dDfF") & F.substring(c, -2, 1).isin(*"0123456789.")
    x = F.when((c != "") & ~suffix, c).try_cast("double")  # a cast that fails costs much, and most fields are empty
    return F.when(~F.isnan(x), x)


def period(c: Column, kind: str) -> Column:
    """yyyyMM from a date or timestamp, or from a whole number year * 100 + month."""
    return F.lpad(c.cast("bigint").cast("string"), 6, "0") if kind in ("int", "bigint", "double") else c if kind == "string" else F.date_format(c, "yyyyMM")


def month_number(c: Column) -> Column:
    """year * 100 + month of a date, as a whole number."""
    return F.year(c) * 100 + F.month(c)


def year_number(c: Column) -> Column:
    """The year of a yyyyMM text as a whole number; a text that doesn't begin with one stops the job."""
    return F.substring(c, 1, 4).cast("bigint")


def is_period(c: Column) -> Column:
    """Whether a text is a month of the form yyyyMM; null for null."""
    return c.rlike("^[0-9]{4}(0[1-9]|1[0-2])$")


def prepaid(code: str = "ZERO_BALANCE_CODE", effective: str = "ZERO_BALANCE_EFFECTIVE_DATE", maturity: str = "MATURITY_DATE") -> Column:
    """1 for a balance that went to zero by code 1 before maturity, else 0 (also where that is unknown)."""
    return F.when((F.col(code) == 1) & (F.col(effective) < F.col(maturity)), 1).otherwise(0)


def delinquent(status: str = "CURRENT_LOAN_DELINQUENCY_STATUS") -> Column:
    """1 for any status but 0 and RA, so also for an empty one; 0 for null."""
    return F.when(~F.col(status).isin("0", "RA"), 1).otherwise(0)


def clipped(p: Column, eps: float = 1e-15) -> Column:
    return F.greatest(F.least(p, F.lit(1 - eps)), F.lit(eps))


def log_loss(y: Column, p: Column) -> Column:
    """Of one row; null where p is 0 or 1 and not clipped."""
    return -(y * F.ln(p) + (1 - y) * F.ln(1 - p))
