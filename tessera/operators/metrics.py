"""Evaluation of predictions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import clipped, log_loss
from .panel import MONTH

DISPLAY = {"total_delinquent": "Total Delinquent", "predicted_delinquent": "Predicted Delinquent", "difference": "Difference", "delinquent_pct": "Delinquent pct", "predicted_delinquent_pct": "Predicted delinquent pct"}


def losses(predictions: DataFrame, clip: bool = True, eps: float = 1e-15) -> DataFrame:
    """One row: log_loss, brier_score, n_rows and n_extreme (rows with p of 0 or 1). Without
    clip, extreme rows have no finite loss and leave the mean of log_loss; n_extreme tells how many."""
    y, p = F.col("DELINQUENT"), F.col("DELINQ_PROB")
    used = clipped(p, eps) if clip else F.when((p > 0) & (p < 1), p)
    return predictions.agg(F.avg(log_loss(y, used)).alias("log_loss"), F.avg((p - y) * (p - y)).alias("brier_score"), F.count("*").alias("n_rows"), F.count_if((p <= 0) | (p >= 1)).alias("n_extreme"))


def monthly_calibration(predictions: DataFrame, labels: str = "plain") -> DataFrame:
    """Actual and predicted delinquencies by month, sorted. labels="display" gives titles as names."""
    y, p = F.coalesce(F.sum("DELINQUENT"), F.lit(0)), F.coalesce(F.sum("DELINQ_PROB"), F.lit(0.0))
    n = F.count("*")
    out = predictions.groupBy(MONTH).agg(y.alias("total_delinquent"), p.alias("predicted_delinquent"), (p - y).alias("difference"), (y / n).alias("delinquent_pct"), (p / n).alias("predicted_delinquent_pct")).orderBy(MONTH)
    return out.withColumnsRenamed(DISPLAY) if labels == "display" else out
