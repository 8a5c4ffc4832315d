"""Outlier flags. Statistics come from aggregates, so no window ever holds a whole group."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assay.operators.quantiles import exact_quantiles, sketched_quantiles
from assay.session import attach, names, settle


def flag_zscore(df: DataFrame, column: str, by=None, threshold: float = 4.0, out: str | None = None) -> DataFrame:
    """Flag values more than `threshold` sample deviations from the mean, overall or per group.

    A group without spread, or a null value, is not flagged.
    """
    stats = df.groupBy(*names(by)).agg(
        F.avg(column).alias("_mean"), F.stddev_samp(column).alias("_std")
    )
    if names(by):
        stats = settle(stats, "zscore")
    far = F.abs(F.col(column) - F.col("_mean")) / F.col("_std") > threshold
    flag = F.coalesce(F.when(F.col("_std") > 0, far), F.lit(False))
    return attach(df, stats, by).withColumn(out or f"{column}_outlier", flag).drop("_mean", "_std")


def flag_iqr(
    df: DataFrame,
    column: str,
    multiplier: float = 1.5,
    by=None,
    relative_error: float | None = None,
    out: str | None = None,
) -> DataFrame:
    """Flag values strictly outside the quartiles by more than `multiplier` times their distance.

    Quartiles are exact, or sketched in one pass when a rank error is given. Null is not flagged.
    """
    probs = {"_q1": 0.25, "_q3": 0.75}
    if relative_error is None:
        quartiles = exact_quantiles(df, column, probs, by)
    else:
        quartiles = settle(sketched_quantiles(df, column, probs, by, relative_error), "quartiles")
    margin = (F.col("_q3") - F.col("_q1")) * F.lit(float(multiplier))
    outside = (F.col(column) < F.col("_q1") - margin) | (F.col(column) > F.col("_q3") + margin)
    flagged = attach(df, quartiles, by).withColumn(
        out or f"{column}_outlier", F.coalesce(outside, F.lit(False))
    )
    return flagged.drop("_q1", "_q3")
