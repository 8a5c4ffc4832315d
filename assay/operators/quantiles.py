"""Quantiles: exact ones seeded by a sketch and proved by counting, and sketched ones."""

from __future__ import annotations

import math
from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from assay.session import attach, names, settle

LEAF_ROWS = 20_000
BINS = 4096
#: Size of the sketch, and the share of ranks on each side of a wanted one that its range takes in. The
#: sketch's own error is about a tenth of that.
SKETCH_K = 4096
MARGIN = 0.004
#: Rows that the ranges of one group may hold for the sketch to be enough.
SEEDED_ROWS = 2_000_000
TINY = 1e-300


def _ranks(prob: float, n: Column, discrete: bool) -> list[Column]:
    """Zero-based ranks of the order statistics that a quantile needs."""
    if discrete:
        return [F.greatest(F.ceil(F.lit(prob) * n) - 1, F.lit(0)).cast("long")]
    place = F.lit(float(prob)) * (n - 1)
    return [F.floor(place).cast("long"), F.ceil(place).cast("long")]


def _in_cells(rows: DataFrame, cells: DataFrame, by: list[str], width: int) -> tuple[DataFrame, list]:
    """Rows that fall into a cell still in question, with its number, and the cells' edges.

    Cells of a group do not overlap, so a row belongs to one at most. Edges come as plain columns,
    which keeps the pass over all rows inside generated code.
    """
    edges = [(F.col(f"_lo{i}"), F.col(f"_hi{i}"), F.col(f"_size{i}")) for i in range(width)]
    flat = cells.select(
        *by,
        *[
            F.try_element_at("_cells", F.lit(i + 1))[part].alias(f"_{part}{i}")
            for i in range(width)
            for part in ("lo", "hi", "size")
        ],
    )
    number = F.coalesce(*[F.when(F.col("_x").between(lo, hi), i) for i, (lo, hi, _) in enumerate(edges)])
    inside = attach(rows, flat, by).withColumn("_no", number)
    return inside.where(F.col("_no").isNotNull()), edges


def _running(counts: DataFrame, cells: DataFrame, by: list[str], order: str) -> DataFrame:
    """Give each count its cell and the rank range [_from, _upto) that it covers."""
    window = Window.partitionBy(*by, "_no").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    cell = F.element_at("_cells", F.col("_no") + 1)
    placed = counts.withColumn("_run", F.sum("_count").over(window))
    return (
        attach(placed, cells, by)
        .withColumns({"_upto": cell["below"] + F.col("_run"), "_ranks": cell["ranks"]})
        .withColumn("_from", F.col("_upto") - F.col("_count"))
        .withColumn(
            "_ranks", F.filter("_ranks", lambda r: (r >= F.col("_from")) & (r < F.col("_upto")))
        )
        .where(F.size("_ranks") > 0)
    )


def _log_scale(x: Column) -> Column:
    """Logarithm of the size with the sign kept: rises with x, also through zero."""
    return F.signum(x) * (F.log(F.greatest(F.abs(x), F.lit(TINY))) - F.lit(math.log(TINY)))


def _narrow(
    rows: DataFrame, cells: DataFrame, by: list[str], width: int, limit: int, bins: int, log_scale: bool
) -> DataFrame:
    """Cut each cell over the limit into bins and keep the bins that hold a wanted rank.

    A cell within the limit stays one bin, so small groups add one count each to the shuffle.
    """
    inside, edges = _in_cells(rows, cells, by, width)
    x, scale = F.col("_x"), _log_scale if log_scale else (lambda c: c)

    def place(lo: Column, hi: Column, size: Column) -> Column:
        share = F.try_divide(scale(x) - scale(lo), scale(hi) - scale(lo))
        share = F.nanvl(F.coalesce(share, F.lit(0.5)), F.lit(0.5))
        cut = F.least(F.floor(share * bins).cast("int"), F.lit(bins - 1))
        whole = (size <= limit) | (x <= lo)
        return F.when(whole, F.lit(0)).when(x >= hi, F.lit(bins - 1)).otherwise(cut)

    bin_number = F.coalesce(*[F.when(F.col("_no") == i, place(*edge)) for i, edge in enumerate(edges)])
    counts = inside.groupBy(*by, "_no", bin_number.alias("_bin")).agg(
        F.count("*").alias("_count"), F.min("_x").alias("lo"), F.max("_x").alias("hi")
    )
    cell = F.struct(
        "lo", "hi", F.col("_from").alias("below"), F.col("_count").alias("size"), F.col("_ranks").alias("ranks")
    )
    kept = _running(counts, cells, by, "_bin").select(*by, "_n", cell.alias("_cell"))
    return kept.groupBy(*by, "_n").agg(F.collect_list("_cell").alias("_cells"))


def _progress(cells: DataFrame, leaf_rows: int) -> tuple[int, bool]:
    """(most cells in a group, whether every cell has few rows or one value)."""
    each = cells.select(F.size("_cells").alias("width"), F.explode("_cells").alias("cell"))
    large = (F.col("cell.size") > leaf_rows) & (F.col("cell.lo") < F.col("cell.hi"))
    state = each.agg(F.max("width").alias("width"), F.max(large).alias("large")).head()
    return state["width"] or 1, not state["large"]


def _prob_ranks(prob: float, discrete: bool) -> list[Column]:
    return _ranks(prob, F.col("_n"), discrete)


def _seeds(rows: DataFrame, by: list[str], probs: list[float], discrete: bool, k: int, margin: float) -> DataFrame:
    """Per group its size, the wanted ranks and a range for each probability, from one pass with a sketch."""
    sketched = rows.groupBy(*by).agg(F.count("*").alias("_n"), F.kll_sketch_agg_double("_x", F.lit(k)).alias("_sketch"))
    # Of a group so small that the margin is a few ranks, the whole range is taken.
    small = F.col("_n") * margin < 4

    def edge(share: float, end: float) -> Column:
        at = lambda p: F.kll_sketch_get_quantile_double("_sketch", F.lit(float(p)))
        return F.when(small, at(end)).otherwise(at(min(max(share, 0.0), 1.0)))

    columns = []
    for i, p in enumerate(probs):
        columns += [edge(p - margin, 0.0).alias(f"_lo{i}"), edge(p + margin, 1.0).alias(f"_hi{i}")]
    wanted = F.array_distinct(F.array(*[r for p in probs for r in _prob_ranks(p, discrete)]))
    return sketched.where(F.col("_n") > 0).select(*by, "_n", wanted.alias("_ranks"), *columns)


def _counted(rows: DataFrame, seeds: DataFrame, by: list[str], width: int) -> DataFrame:
    """(groups, _n, _ranks, _at): the values at the wanted ranks that lie inside the ranges.

    One pass counts each value inside a range, and all rows between two ranges together. These counts,
    added up in order, give every row its true rank, whatever the sketch's error.
    """
    x, region, inside = F.col("_x"), F.lit(2 * width), F.lit(False)
    for i in reversed(range(width)):
        low, high = F.col(f"_lo{i}"), F.col(f"_hi{i}")
        region = F.when(x < low, 2 * i).when(x <= high, 2 * i + 1).otherwise(region)
    for i in range(width):
        inside = inside | x.between(F.col(f"_lo{i}"), F.col(f"_hi{i}"))
    counts = attach(rows, seeds.drop("_ranks"), by).groupBy(*by, "_n", region.alias("_region"), F.when(inside, x).alias("_x")).agg(
        F.count("*").alias("_count")
    )
    window = Window.partitionBy(*by, "_n").orderBy("_region", "_x").rowsBetween(Window.unboundedPreceding, 0)
    placed = counts.withColumn("_upto", F.sum("_count").over(window)).where(F.col("_x").isNotNull())
    hit = F.filter("_ranks", lambda r: (r >= F.col("_upto") - F.col("_count")) & (r < F.col("_upto")))
    placed = attach(placed, seeds.select(*by, "_ranks"), by).select(*by, "_n", "_x", F.explode(hit).alias("_rank"))
    found = placed.groupBy(*by, "_n").agg(F.map_from_entries(F.collect_list(F.struct("_rank", "_x"))).alias("_at"))
    return attach(seeds.select(*by, "_n", "_ranks"), found.drop("_n"), by) if by else attach(seeds.select("_n", "_ranks"), found.drop("_n"))


def _narrowed(rows: DataFrame, by: list[str], probs: list[float], discrete: bool, leaf_rows: int, bins: int) -> DataFrame:
    """(groups, _n, _at) at any size, without a sketch.

    The range that holds a wanted rank is cut into bins by counting, again and again, until each range
    holds few rows or one value. Rounds shuffle bin counts, the last one the distinct values of the small
    ranges that are left; no task ever holds a group. Bins are even and logarithmic by turns, so a few
    rounds suffice also when values differ by many orders of size. Ranges of a round go through a small
    written table, which the planner broadcasts by its real size.
    """
    span = rows.groupBy(*by).agg(
        F.count("*").alias("_n"), F.min("_x").alias("_lo"), F.max("_x").alias("_hi")
    )
    wanted = F.array(*[r for p in probs for r in _prob_ranks(p, discrete)])
    whole = F.struct(
        F.col("_lo").alias("lo"),
        F.col("_hi").alias("hi"),
        F.lit(0).cast("long").alias("below"),
        F.col("_n").alias("size"),
        F.array_distinct(wanted).alias("ranks"),
    )
    cells = span.where(F.col("_n") > 0).select(*by, "_n", F.array(whole).alias("_cells"))
    for step in count():
        cells = settle(cells, "cells")
        width, done = _progress(cells, leaf_rows)
        if done:
            break
        cells = _narrow(rows, cells, by, width, leaf_rows, bins, log_scale=step % 2 == 1)

    inside, _ = _in_cells(rows, cells, by, width)
    counts = inside.groupBy(*by, "_no", "_x").agg(F.count("*").alias("_count"))
    return (
        _running(counts, cells, by, "_x")
        .select(*by, "_n", "_x", F.explode("_ranks").alias("_rank"))
        .groupBy(*by, "_n")
        .agg(F.map_from_entries(F.collect_list(F.struct("_rank", "_x"))).alias("_at"))
    )


def exact_quantiles(
    df: DataFrame,
    column: str,
    probs: dict[str, float],
    by=None,
    discrete: bool = False,
    leaf_rows: int = LEAF_ROWS,
    bins: int = BINS,
    written: bool = False,
    sketch_k: int = SKETCH_K,
    margin: float = MARGIN,
    seeded_rows: int = SEEDED_ROWS,
) -> DataFrame:
    """One row per group with a column per named quantile, exact at any size; a small written table.

    The column is read twice. A mergeable sketch gives each wanted rank a range of values that holds it
    but for a very small chance; one counting pass then proves the ranks and sorts only what lies in the
    ranges, a hundredth of a group. Where a rank was missed, or where a range would hold over
    `seeded_rows` rows of a group, ranges are narrowed by counting alone, round by round, instead.
    The groups and the column are written once, unless `df` is `written` already, so that passes do not
    repeat the work before. Nulls and NaN do not count.

    `discrete` gives the least value whose rank share reaches p, otherwise values are interpolated.
    """
    by = names(by)
    rows = df.select(*by, F.col(column).cast("double").alias("_x"))
    rows = rows.where(F.col("_x").isNotNull() & ~F.isnan("_x"))
    if not written:
        rows = settle(rows, "values")

    wanted = sorted(set(probs.values()))
    found = None
    if sketch_k:
        seeds = settle(_seeds(rows, by, wanted, discrete, sketch_k, margin), "seeds")
        most = seeds.agg(F.max("_n")).first()[0] or 0
        if 2 * margin * most <= seeded_rows:
            found = settle(_counted(rows, seeds, by, len(wanted)), "found")
            missed = F.coalesce(F.cardinality("_at"), F.lit(0)) < F.size("_ranks")
            if not found.where(missed).isEmpty():
                found = None
    if found is None:
        found = settle(_narrowed(rows, by, wanted, discrete, leaf_rows, bins), "found")

    def value(prob: float) -> Column:
        at = [F.col("_at")[r] for r in _prob_ranks(prob, discrete)]
        if discrete:
            return at[0]
        place = F.lit(float(prob)) * (F.col("_n") - 1)
        return at[0] + (at[1] - at[0]) * (place - F.floor(place))

    return found.select(*by, *[value(p).alias(name) for name, p in probs.items()])


def sketched_quantiles(
    df: DataFrame, column: str, probs: dict[str, float], by=None, relative_error: float = 0.01
) -> DataFrame:
    """Quantiles from a mergeable sketch in one pass, within the given rank error."""
    accuracy = max(1, round(1 / relative_error))
    rows = df.where(~F.isnan(F.col(column).cast("double")))
    return rows.groupBy(*names(by)).agg(
        *[F.percentile_approx(F.col(column).cast("double"), p, accuracy).alias(n) for n, p in probs.items()]
    )


def group_median(df: DataFrame, by, column: str, out: str = "median", accuracy: int | None = None) -> DataFrame:
    """Discrete median per group, null for a group without values.

    It is exact, or comes from a one-pass sketch of the given accuracy (rank error 1 / accuracy).
    """
    by = names(by)
    if accuracy is not None:
        return df.groupBy(*by).agg(F.percentile_approx(column, 0.5, accuracy).alias(out))
    values = settle(df.select(*by, column), "values")
    medians = exact_quantiles(values, column, {out: 0.5}, by, discrete=True, written=True)
    return attach(values.select(*by).distinct(), medians, by) if by else medians
