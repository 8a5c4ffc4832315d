"""Union and de-duplication. Every result is the same in every run."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assay.session import names


def union_all(dfs: list[DataFrame]) -> DataFrame:
    """All rows of all extracts by column name; missing columns are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def dedupe_rows(df: DataFrame) -> DataFrame:
    """Exact duplicates removed. Copies collapse before the shuffle, so a hot row stays cheap."""
    return df.distinct()


def dedupe_keys(df: DataFrame, keys, order) -> DataFrame:
    """One row per key: the least by the order columns, then by the remaining ones.

    `order` holds column names or Columns. Done as an aggregate, so each task passes on at most one
    row per key. Null keys form a group.
    """
    keys, rest = names(keys), [c for c in df.columns if c not in names(keys)]
    position = F.struct(*names(order) if isinstance(order, str) else order, *rest)
    best = F.min_by(F.struct(*rest), position) if rest else F.lit(True)
    out = df.groupBy(*keys).agg(best.alias("_best"))
    return out.select(*keys, *[F.col("_best")[c].alias(c) for c in rest]).select(*df.columns)


def distinct_keys(df: DataFrame, keys) -> DataFrame:
    return df.select(*names(keys)).distinct()


def union_keys(a: DataFrame, b: DataFrame, keys) -> DataFrame:
    """Sorted set union of the key values of two tables."""
    keys = names(keys)
    return a.select(*keys).union(b.select(*keys)).distinct().orderBy(*keys)
