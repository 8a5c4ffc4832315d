"""Profiles, counts, summaries and correlations; each reads its input once where it can."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assay.functions.text import not_blank
from assay.operators.gram import gram
from assay.operators.ordering import top_k
from assay.operators.quantiles import exact_quantiles
from assay.session import attach, names, settle

NUMERIC = (T.DoubleType, T.FloatType, T.IntegerType, T.LongType)

# Text shapes worth reporting, by label.
TEXT_SHAPES = {
    "year_month": r"^\d{4}-\d{2}$",
    "x_to_y": r"^\d+ TO \d+$",
    "unit_text": r"\d+\s*(year|month)",
}


def count_if(condition: Column, each: Column | int = 1) -> Column:
    """The number of rows that meet the condition, a row counting for `each`."""
    return F.coalesce(F.sum(F.when(condition, each).otherwise(0).cast("long")), F.lit(0).cast("long"))


def to_rows(one_row: DataFrame, structs: list[Column]) -> DataFrame:
    """Turn the columns of a one-row aggregate into rows."""
    return one_row.select(F.explode(F.array(*structs)).alias("_r")).select("_r.*")


def null_counts(df: DataFrame, blanks: bool = False) -> DataFrame:
    """(column, nulls) for every column, in one pass; with `blanks`, empty text counts too."""
    text = {c for c, kind in df.dtypes if blanks and kind == "string"}
    one = df.agg(
        *[
            count_if(~not_blank(F.col(f"`{c}`")) if c in text else F.col(f"`{c}`").isNull()).alias(c)
            for c in df.columns
        ]
    )
    return one.unpivot([], list(df.columns), "column", "nulls")


def profile(df: DataFrame, approx: bool = True, relative_error: float = 0.05, written: bool = False) -> DataFrame:
    """One row per column: type, nulls, range, distinct values and shares of known text shapes.

    Blank text counts as null. `approx` counts distinct values by sketch, which needs one pass and
    no shuffle of values. The exact profile counts the rows of every distinct value, column by column, and takes all
    measures from these; it writes the table first unless it is a written one.
    """
    fields = df.schema.fields
    if approx:
        distinct = lambda c: F.approx_count_distinct(c, relative_error)
        measures = [m for field in fields for m in _measures(field, distinct)]
        return to_rows(df.agg(F.count("*").alias("_rows"), *measures), [_profile_row(field) for field in fields])
    rows, each = df if written else settle(df, "profiled"), F.col("_rows_of_value")

    def of(field: T.StructField) -> DataFrame:
        values = rows.groupBy(F.col(f"`{field.name}`").alias(field.name)).agg(F.count("*").alias("_rows_of_value"))
        one = values.agg(count_if(F.lit(True), each).alias("_rows"), *_measures(field, F.count, each))
        return to_rows(one, [_profile_row(field)])

    return reduce(DataFrame.union, map(of, fields))


def _measures(field: T.StructField, distinct, each: Column | int = 1) -> list[Column]:
    """What a column's profile is made of; a row stands for `each` rows with its value."""
    name, c = field.name, F.col(f"`{field.name}`")
    text = isinstance(field.dataType, T.StringType)
    present = not_blank(c) if text else c.isNotNull()
    measures = [count_if(present, each).alias(f"{name}__present"), distinct(c).alias(f"{name}__distinct")]
    if isinstance(field.dataType, NUMERIC):
        measures += [F.min(c).alias(f"{name}__min"), F.max(c).alias(f"{name}__max")]
    if text:
        measures += [count_if(present & c.rlike(shape), each).alias(f"{name}__{label}") for label, shape in TEXT_SHAPES.items()]
    return measures


def _profile_row(field: T.StructField) -> Column:
    name, n, kept = field.name, F.col("_rows"), F.col(f"`{field.name}__present`")
    text, numeric = isinstance(field.dataType, T.StringType), isinstance(field.dataType, NUMERIC)
    edge = lambda end: F.col(f"`{name}__{end}`").cast("double") if numeric else F.lit(None).cast("double")
    shares = [
        (F.try_divide(F.col(f"`{name}__{label}`") * 100.0, kept) if text else F.lit(None).cast("double")).alias(f"{label}_pct")
        for label in TEXT_SHAPES
    ]
    return F.struct(
        F.lit(name).alias("column"),
        F.lit(field.dataType.simpleString()).alias("type"),
        n.alias("n"),
        (n - kept).alias("nulls"),
        F.try_divide((n - kept) * 100.0, n).alias("null_pct"),
        F.col(f"`{name}__distinct`").alias("n_distinct"),
        edge("min").alias("min_value"),
        edge("max").alias("max_value"),
        *shares,
    )


def approx_distinct(df: DataFrame, columns=None, relative_error: float = 0.05) -> DataFrame:
    """(column, n_distinct) by HyperLogLog, all columns in one pass."""
    columns = names(columns) or df.columns
    one = df.agg(*[F.approx_count_distinct(c, relative_error).alias(c) for c in columns])
    return one.unpivot([], columns, "column", "n_distinct")


def distinct_counts(df: DataFrame, columns) -> DataFrame:
    """(column, n_distinct), exact."""
    one = df.agg(*[F.count_distinct(c).alias(c) for c in names(columns)])
    return one.unpivot([], names(columns), "column", "n_distinct")


def pattern_share(df: DataFrame, column: str, patterns: dict[str, str] | None = None, least: float = 10.0) -> DataFrame:
    """(pattern, share in %) among non-blank text, for patterns above the least share."""
    patterns, present = patterns or TEXT_SHAPES, not_blank(column)
    one = df.agg(
        count_if(present).alias("_present"),
        *[count_if(present & F.col(column).rlike(p)).alias(label) for label, p in patterns.items()],
    )
    rows = to_rows(
        one,
        [
            F.struct(
                F.lit(label).alias("pattern"),
                F.try_divide(F.col(label) * 100.0, F.col("_present")).alias("share_pct"),
            )
            for label in patterns
        ],
    )
    return rows.where(F.col("share_pct") > least)


def group_summary(df: DataFrame, by, means, median: str, accuracy: int | None = None) -> DataFrame:
    """Per group: mean of some columns, discrete median of one, and the number of rows.

    The median is exact, or from a sketch in the same pass if an accuracy is given.
    """
    by, out = names(by), f"median_{median}"
    measures = [F.avg(c).alias(f"mean_{c}") for c in names(means)] + [F.count("*").alias("n")]
    if accuracy is not None:
        return df.groupBy(*by).agg(F.percentile_approx(median, 0.5, accuracy).alias(out), *measures)
    values = settle(df.select(*dict.fromkeys([*by, *names(means), median])), "values")
    medians = exact_quantiles(values, median, {out: 0.5}, by, discrete=True, written=True)
    return attach(values.groupBy(*by).agg(*measures), medians, by)


def summary(df: DataFrame, column: str) -> DataFrame:
    """Overall mean and interpolated median."""
    values = settle(df.select(column), "values")
    median = exact_quantiles(values, column, {"median": 0.5}, written=True)
    return attach(values.agg(F.avg(column).alias("mean")), median)


def min_by_group(df: DataFrame, by, column: str, out: str = "least") -> DataFrame:
    return df.groupBy(*names(by)).agg(F.min(column).alias(out))


def histogram(df: DataFrame, column: str, bins: int = 80) -> DataFrame:
    """Counts in equal-width bins over the whole range; the last bin includes the maximum."""
    x = F.col("_x")
    rows = df.select(F.col(column).cast("double").alias("_x")).where(x.isNotNull() & ~F.isnan(x))
    edges = rows.agg(F.min("_x").alias("_lo"), F.max("_x").alias("_hi"))
    width = (F.col("_hi") - F.col("_lo")) / F.lit(float(bins))
    place = F.least(
        F.floor(F.coalesce(F.try_divide(x - F.col("_lo"), width), F.lit(0.0))).cast("int"),
        F.lit(bins - 1),
    )
    counts = attach(rows, edges).groupBy(place.alias("bin"), "_lo", width.alias("_width"))
    return counts.agg(F.count("*").alias("n")).select(
        "bin",
        (F.col("_lo") + F.col("bin") * F.col("_width")).alias("low"),
        (F.col("_lo") + (F.col("bin") + 1) * F.col("_width")).alias("high"),
        "n",
    )


def pearson_r(a: Column, b: Column) -> Column:
    """Pearson correlation over rows with both values; null if one is constant or a value is NaN."""
    x, y = F.when(b.isNotNull(), a), F.when(a.isNotNull(), b)
    r = F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))
    return F.when(~F.isnan(r), F.when(r > 1, 1.0).when(r < -1, -1.0).otherwise(r))


def corr_with(df: DataFrame, columns, target: str) -> DataFrame:
    """(feature, r): Pearson correlation of each column with the target, in one pass.

    A constant column has no correlation (null).
    """
    one = df.agg(*[pearson_r(F.col(c), F.col(target)).alias(c) for c in names(columns)])
    return one.unpivot([], names(columns), "feature", "r")


def corr_matrix(df: DataFrame, columns) -> DataFrame:
    """(a, b, r) for every ordered pair, over rows in which all columns are present.

    One aggregate of outer products serves any number of columns. A constant column has null with every
    column, itself included, and so has every pair of an empty table.
    """
    columns = names(columns)
    r = gram(df, columns).correlation()
    cells = [(a, b, None if math.isnan(r[i, j]) else float(r[i, j])) for i, a in enumerate(columns) for j, b in enumerate(columns)]
    return df.sparkSession.createDataFrame(cells, "a string, b string, r double")


def high_corr(matrix: DataFrame, threshold: float = 0.85, order=None) -> DataFrame:
    """Each pair once whose correlation exceeds the threshold in size, strongest first.

    Pairs without a correlation (null or NaN) do not exceed it. `order` lists the columns so that `a` comes before `b` in it; otherwise names are compared.
    """
    if order:
        place = F.create_map(*[F.lit(x) for i, c in enumerate(order) for x in (c, i)])
        upper = place[F.col("a")] < place[F.col("b")]
    else:
        upper = F.col("a") < F.col("b")
    return matrix.where(upper & ~F.isnan("r") & (F.abs("r") > threshold)).orderBy(F.abs(F.col("r")).desc(), "a", "b")


def collinear_drops(pairs: DataFrame, rules: list[tuple[str, str, str]]) -> DataFrame:
    """Columns to drop: for each rule (a, b, drop) whose pair occurs, in either order."""
    a, b = F.col("a"), F.col("b")
    first, second = F.least(a, b), F.greatest(a, b)
    hits = [
        F.when((first == min(x, y)) & (second == max(x, y)), F.lit(drop)) for x, y, drop in rules
    ]
    found = F.explode(F.array_compact(F.array(*hits)))
    return pairs.select(found.alias("column")).distinct().orderBy("column")


def value_counts(df: DataFrame, column: str, missing: str = "Unknown") -> DataFrame:
    value = F.coalesce(F.col(column).cast("string"), F.lit(missing))
    return df.groupBy(value.alias(column)).agg(F.count("*").alias("n"))


def quality_stats(df: DataFrame, key: str, period: str | None = None) -> DataFrame:
    """One row: rows, rows without key, distinct keys, mean rows per key, range of the period.

    Keys are counted from a per-key aggregate, so a hot key is combined before the shuffle.
    """
    per_key = df.groupBy(key).agg(
        F.count("*").alias("_n"),
        *([F.min(period).alias("_lo"), F.max(period).alias("_hi")] if period else []),
    )
    kept = F.col(key).isNotNull()
    out = per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("n_rows"),
        F.coalesce(F.sum(F.when(~kept, F.col("_n"))), F.lit(0)).alias("n_null_key"),
        F.count(key).alias("n_keys"),
        F.avg(F.when(kept, F.col("_n"))).alias("rows_per_key"),
        *([F.min("_lo").alias("period_low"), F.max("_hi").alias("period_high")] if period else []),
    )
    return out


def gap_stats(df: DataFrame, column: str, formula: Column) -> DataFrame:
    """Mean, discrete median and greatest absolute gap between a column and its formula."""
    gaps = settle(df.select(F.abs(F.col(column) - formula).alias("gap")), "gaps")
    median = exact_quantiles(gaps, "gap", {"median_gap": 0.5}, discrete=True, written=True)
    return attach(gaps.agg(F.avg("gap").alias("avg_gap"), F.max("gap").alias("max_gap")), median)


def box_summary(df: DataFrame, by, column: str, reach: float = 1.5) -> DataFrame:
    """Per group: quartiles and whiskers at the last values within `reach` box lengths, by median."""
    by = names(by)
    x, length = F.col("_x"), F.col("q3") - F.col("q1")
    rows = df.select(*by, F.col(column).cast("double").alias("_x")).where(x.isNotNull() & ~F.isnan(x))
    rows = settle(rows, "values")
    quartiles = exact_quantiles(rows, "_x", {"q1": 0.25, "median": 0.5, "q3": 0.75}, by, written=True)
    return (
        attach(rows, quartiles, by)
        .groupBy(*by, "q1", "median", "q3")
        .agg(
            F.min(F.when(x >= F.col("q1") - reach * length, x)).alias("whisker_low"),
            F.max(F.when(x <= F.col("q3") + reach * length, x)).alias("whisker_high"),
            F.count("*").alias("n"),
        )
        .orderBy("median", *by)
    )


def top_groups(df: DataFrame, group: str, metric: str, k: int, ascending: bool = False) -> DataFrame:
    """The k groups with the highest (or lowest) interpolated median."""
    medians = exact_quantiles(df, metric, {"median": 0.5}, group)
    return top_k(medians, "median", k, group, ascending)


def keep_top_groups(df: DataFrame, group: str, metric: str, k: int, ascending: bool = False) -> DataFrame:
    """Detail rows of the top groups only. The broadcast side has k rows by construction."""
    chosen = top_groups(df, group, metric, k, ascending).select(group)
    return df.join(F.broadcast(chosen), group, "left_semi")
