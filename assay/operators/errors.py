"""Errors of predictions: per row, overall and by group."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assay.functions.dates import month_label
from assay.operators.ordering import sample_n
from assay.operators.quantiles import exact_quantiles
from assay.session import attach, names, settle


def residuals(df: DataFrame, actual: str, predicted: str = "prediction") -> DataFrame:
    """Add residual, absolute error and absolute error in % of the actual value (null at zero)."""
    gap = F.col(actual) - F.col(predicted)
    return df.withColumns(
        {
            "residual": gap,
            "abs_error": F.abs(gap),
            "abs_pct_error": F.try_divide(F.abs(gap), F.col(actual)) * 100.0,
        }
    )


def regression_metrics(df: DataFrame, actual: str, predicted: str = "prediction", by=None) -> DataFrame:
    """RMSE, MAE, R2 and MAPE in %, overall or per group, over rows that have both values."""
    y, gap = F.col(actual).cast("double"), F.col(actual) - F.col(predicted)
    rows = df.where(gap.isNotNull())
    return rows.groupBy(*names(by)).agg(
        F.count("*").alias("n"),
        F.sqrt(F.avg(gap * gap)).alias("rmse"),
        F.avg(F.abs(gap)).alias("mae"),
        (1.0 - F.try_divide(F.avg(gap * gap), F.var_pop(y))).alias("r2"),
        F.avg(F.abs(F.try_divide(gap, y)) * 100.0).alias("mape"),
    )


def metrics_long(metrics: DataFrame, keep=()) -> DataFrame:
    """(metric, value) rows of a wide metrics table."""
    return metrics.unpivot(names(keep), ["rmse", "mae", "r2", "mape"], "metric", "value")


def compare_metrics(a: DataFrame, b: DataFrame) -> DataFrame:
    """Join two (metric, value) tables: change from a to b, also in % of a."""
    left = a.select("metric", F.col("value").alias("value_a"))
    right = b.select("metric", F.col("value").alias("value_b"))
    delta = F.col("value_b") - F.col("value_a")
    return left.join(right, "metric").withColumns(
        {"delta": delta, "delta_pct": F.try_divide(delta, F.col("value_a")) * 100.0}
    )


def error_by(df: DataFrame, by, min_n: int | None = None) -> DataFrame:
    """Per group: mean residual, mean absolute error, MAPE and rows; groups under min_n are left out."""
    out = df.groupBy(*names(by)).agg(
        F.avg("residual").alias("mean_residual"),
        F.avg("abs_error").alias("mean_abs_error"),
        F.avg("abs_pct_error").alias("mape"),
        F.count("*").alias("n"),
    )
    return out if min_n is None else out.where(F.col("n") >= min_n)


def error_by_month(df: DataFrame, date: str) -> DataFrame:
    return error_by(df.withColumn("month", month_label(date)), "month").orderBy("month")


def residual_summary(df: DataFrame, by=None) -> DataFrame:
    """One row: mean and sample deviation of the residual, median and 95th percentile of its size.

    For each column of `by` also the groups with the highest and the lowest MAPE, ties by name.
    """
    by = names(by)
    rows = settle(df.select(*by, "residual", "abs_error", "abs_pct_error"), "residuals")
    sizes = exact_quantiles(rows, "abs_error", {"median_abs_error": 0.5, "p95_abs_error": 0.95}, written=True)
    moments = rows.agg(
        F.avg("residual").alias("mean_residual"), F.stddev_samp("residual").alias("std_residual")
    )
    out = attach(moments, sizes)
    for column in by:
        groups = error_by(rows, column).where(F.col("mape").isNotNull() & F.col(column).isNotNull())
        ends = groups.agg(
            F.min_by(column, F.struct(-F.col("mape"), column)).alias(f"hardest_{column}"),
            F.min_by(column, F.struct("mape", column)).alias(f"easiest_{column}"),
        )
        out = attach(out, settle(ends, "ends"))
    return out


def sample_predictions(df: DataFrame, key: str, columns, actual: str, n: int = 10) -> DataFrame:
    """A repeatable sample of rows with rounded actual, predicted and error values."""
    rows = sample_n(df, key, n)
    return rows.select(
        *names(columns),
        F.round(actual).cast("long").alias("actual"),
        F.round("prediction").cast("long").alias("predicted"),
        F.round("abs_error").cast("long").alias("abs_error"),
        F.round("abs_pct_error", 2).alias("pct_error"),
    )
