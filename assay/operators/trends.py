"""Least-squares trends and variance inflation, from plain aggregates over all rows."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assay.operators.gram import gram
from assay.session import attach, names

# Eigenvalues up to this, per column, are no variance; smaller weights on them are rounding.
SINGULAR, TIED_WEIGHT = 1e-11, 1e-4


def _finite(df: DataFrame, x: str, y: str, by=()) -> DataFrame:
    out = df.select(*by, F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y"))
    for c in ("_x", "_y"):
        out = out.where(F.abs(F.col(c)) < float("inf"))
    return out


def slope(df: DataFrame, x: str, y: str, by=None, min_n: int = 50) -> DataFrame:
    """Slope of y on x over finite pairs, per group with more than `min_n` of them."""
    by = names(by)
    fits = _finite(df, x, y, by).groupBy(*by).agg(
        F.regr_slope("_y", "_x").alias("slope"), F.count("*").alias("n")
    )
    return fits.where(F.col("n") > min_n) if by else fits


def segment_slope(df: DataFrame, x: str, y: str, at: float = 60.0, ratio: float = 1.3, min_n: int = 100) -> DataFrame:
    """One row: slopes from `at` up and below it, and whether the lower one is clearly steeper.

    Slopes and the flag are null unless more than `min_n` rows lie below.
    """
    here, upper = F.col("_x"), F.col("_x") >= at
    fit = _finite(df, x, y).agg(
        F.count(F.when(here < at, 1)).alias("n_below"),
        F.regr_slope(F.when(upper, F.col("_y")), here).alias("_above"),
        F.regr_slope(F.when(~upper, F.col("_y")), here).alias("_below"),
    )
    enough = F.col("n_below") > min_n
    return fit.select(
        "n_below",
        F.when(enough, F.col("_above")).alias("slope_above"),
        F.when(enough, F.col("_below")).alias("slope_below"),
        F.when(enough, F.abs("_below") > F.abs("_above") * ratio).alias("non_linear"),
    )


def quadratic_coefficients(df: DataFrame, x: str, y: str) -> DataFrame:
    """One row: centre of x, its range, and a, b, c of y = a + b*u + c*u*u with u = x - centre."""
    rows = _finite(df, x, y)
    centre = rows.agg(F.avg("_x").alias("centre"))
    u, v = F.col("_x") - F.col("centre"), F.col("_y")
    sums = attach(rows, centre).groupBy("centre").agg(
        F.min("_x").alias("x_low"),
        F.max("_x").alias("x_high"),
        F.count("*").cast("double").alias("s0"),
        *[F.sum(F.pow(u, F.lit(float(k)))).alias(f"s{k}") for k in range(1, 5)],
        *[F.sum(v * F.pow(u, F.lit(float(k)))).alias(f"t{k}") for k in range(3)],
    )
    s = [F.col(f"s{k}") for k in range(5)]
    t = [F.col(f"t{k}") for k in range(3)]

    def determinant(m):
        return (
            m[0][0] * (m[1][1] * m[2][2] - m[1][2] * m[2][1])
            - m[0][1] * (m[1][0] * m[2][2] - m[1][2] * m[2][0])
            + m[0][2] * (m[1][0] * m[2][1] - m[1][1] * m[2][0])
        )

    normal = [[s[i + j] for j in range(3)] for i in range(3)]
    whole = determinant(normal)

    def solved(k: int):
        return F.try_divide(
            determinant([[t[i] if j == k else normal[i][j] for j in range(3)] for i in range(3)]), whole
        )

    return sums.select(
        "centre", "x_low", "x_high", solved(0).alias("a"), solved(1).alias("b"), solved(2).alias("c")
    )


def quadratic_fit(df: DataFrame, x: str, y: str, n: int = 200) -> DataFrame:
    """The fitted curve at n evenly spaced points over the range of x."""
    step = (F.col("x_high") - F.col("x_low")) / F.lit(float(n - 1))
    grid = quadratic_coefficients(df, x, y).withColumn(
        "point", F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    )
    grid = grid.withColumn("x", F.col("x_low") + F.col("point") * step)
    u = F.col("x") - F.col("centre")
    return grid.select("point", "x", (F.col("a") + F.col("b") * u + F.col("c") * u * u).alias("y"))


def vif(df: DataFrame, columns, min_rows: int = 10) -> DataFrame:
    """(feature, vif), uncentered, over all complete rows; constant columns are left out.

    One aggregate of outer products gives all products of columns (k by k numbers). With that small matrix scaled to
    a unit diagonal, the VIFs are the diagonal of its inverse, summed over its eigenvectors; a column
    with weight on an eigenvector of no variance is a combination of others, and its VIF is infinite.
    Empty if there are under two columns or ten rows.
    """
    columns = names(columns)
    sums = gram(df, columns)
    keep = np.flatnonzero(sums.varies())
    result = []
    if len(keep) >= 2 and sums.n >= min_rows:
        products = sums.raw_products()[np.ix_(keep, keep)]
        scale = np.sqrt(np.diag(products))
        values, vectors = np.linalg.eigh(products / np.outer(scale, scale))
        sound = values > SINGULAR * len(keep)
        vifs = (vectors[:, sound] ** 2 / values[sound]).sum(1)
        tied = (np.abs(vectors[:, ~sound]) > TIED_WEIGHT).any(1)
        result = [(columns[i], float("inf") if tied[k] else float(vifs[k])) for k, i in enumerate(keep)]
    table = df.sparkSession.createDataFrame(result, "feature string, vif double")
    return table.orderBy(F.col("vif").desc(), "feature")
