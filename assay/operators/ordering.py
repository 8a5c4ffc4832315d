"""Sorting, top-k, samples and splits that do not depend on how the data is partitioned."""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from assay.functions.dates import quarters_back
from assay.session import col, names, same_keys, settle

DIGITS = 15  # of a digest that decide, so shares are exact to 2 ** -60


def order_by(df: DataFrame, keys, ties=()) -> DataFrame:
    """Total order. Tie columns also let the range partitioner cut a hot key into several tasks."""
    return df.orderBy(*names(keys), *names(ties))


def top_k(df: DataFrame, metric: str, k: int, ties, ascending: bool = False) -> DataFrame:
    """The k rows with the highest (or lowest) metric; tasks pass on k rows each."""
    return df.where(F.col(metric).isNotNull()).orderBy(
        F.col(metric).asc() if ascending else F.col(metric).desc(), *names(ties)
    ).limit(k)


def sort_abs(df: DataFrame, column: str, ties=()) -> DataFrame:
    return df.orderBy(F.abs(F.col(column)).desc_nulls_last(), *names(ties))


def limit_rows(df: DataFrame, n: int) -> DataFrame:
    """Any n rows, for a preview."""
    return df.limit(n)


def digest(key, seed: int = 42) -> Column:
    """MD5 of the seed and the key. A null key has the digest of an empty one."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(col(key).cast("string"), F.lit(""))))


def place_of(key, seed: int = 42) -> Column:
    """A key's whole number below 16 ** DIGITS: equal in every run, independent of the row's place."""
    return F.conv(F.substring(digest(key, seed), 1, DIGITS), 16, 10).cast("long")


def bucket_of(key, buckets: int, seed: int = 42) -> Column:
    return place_of(key, seed) % F.lit(buckets)


def first_places(fraction: float) -> int:
    """The number below which a key's place lies with the given probability."""
    if not 0 <= fraction <= 1:
        raise ValueError("a share lies between 0 and 1")
    return round(Fraction(fraction) * 16**DIGITS)


def sample_by_key(df: DataFrame, key, fraction: float, seed: int = 42) -> DataFrame:
    """Sample without replacement of the keys, all rows of a key together; null is one more key."""
    return df.where(place_of(key, seed) < first_places(fraction))


def split_by_key(df: DataFrame, key, fraction: float = 0.8, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """(rows of the sampled keys, all others); null is one more key."""
    cut = first_places(fraction)
    return df.where(place_of(key, seed) < cut), df.where(place_of(key, seed) >= cut)


def sample_n(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """n rows with the least key digests; a top-n, so nothing is sorted in full."""
    return df.orderBy(digest(key, seed), key).limit(n)


def bounds(df: DataFrame, column: str, months: int | None = None) -> DataFrame:
    """Least and greatest value; with `months`, also the quarter start that many months back."""
    out = df.agg(F.min(column).alias("low"), F.max(column).alias("high"))
    return out if months is None else out.withColumn("cutoff", quarters_back("high", months))


def temporal_split(df: DataFrame, column: str, months: int = 6) -> tuple[DataFrame, DataFrame]:
    """(rows before the cutoff, rows from it on); the cutoff comes in as a scalar subquery.

    Rows without a date belong to neither.
    """
    cutoff = bounds(df, column, months).select("cutoff").scalar()
    return df.where(F.col(column) < cutoff), df.where(F.col(column) >= cutoff)


def split_report(df: DataFrame, column: str, months: int = 6) -> DataFrame:
    """Size, range and share of both parts of the temporal split, from one aggregation."""
    cutoff = bounds(df, column, months).select("cutoff").scalar()
    part = F.when(F.col(column) < cutoff, F.lit("train")).otherwise(F.lit("holdout"))
    sizes = df.where(F.col(column).isNotNull()).groupBy(part.alias("part")).agg(
        F.count("*").alias("n"), F.min(column).alias("low"), F.max(column).alias("high")
    )
    total = df.agg(F.count(column).alias("n")).scalar()
    return sizes.withColumn("share", F.try_divide(F.col("n").cast("double"), total))


def check_no_overlap(report: DataFrame) -> None:
    """Raise unless the holdout has rows and starts after the training part ends."""
    parts = {r["part"]: r for r in report.collect()}
    if not parts.get("holdout") or not parts["holdout"]["n"]:
        raise ValueError("the holdout is empty; use another cutoff")
    if parts.get("train") and parts["train"]["high"] >= parts["holdout"]["low"]:
        raise ValueError("training rows reach into the holdout period")


def positions(df: DataFrame, group, order, out: str = "at") -> DataFrame:
    """`df` with the place of each row in its group from 0, by a sort by range and counts per task.

    A group may span any number of tasks. Rows that tie in the whole order get places in any order among
    themselves, and are spread over tasks too, so that no value holds one up.
    """
    group, order = names(group), names(order)
    keys = [*group, *order, "_spread"]
    ranged = (
        df.withColumn("_spread", F.monotonically_increasing_id())
        .repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .drop("_spread")
        .withColumns({"_line": F.monotonically_increasing_id(), "_task": F.spark_partition_id()})
    )
    ranged = settle(ranged, "ranged")
    blocks = ranged.groupBy(*group, "_task").agg(F.count("*").alias("_rows"), F.min("_line").alias("_first"))
    earlier = Window.partitionBy(*(group or [F.lit(0)])).orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_first")
    blocks = blocks.select(*[F.col(g).alias(f"_{g}") for g in group], F.col("_task").alias("_of"), shift.alias("_shift"))
    on = same_keys(ranged, blocks, [("_task", "_of"), *[(g, f"_{g}") for g in group]])
    return ranged.join(blocks, on).select(*df.columns, (F.col("_line") + F.col("_shift")).alias(out))
