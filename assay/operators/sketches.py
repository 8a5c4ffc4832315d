"""Profiles of tables that grow by extracts, from mergeable sketches stored per extract.

An extract is read once, when it comes in. What is stored of it is one row per column: counts, range, a
sketch of the distinct values and, for numbers, one of their distribution. The profile of all extracts, or of some,
merges these rows and reads no extract again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assay.functions.text import not_blank
from assay.operators.aggregates import NUMERIC, count_if, to_rows

#: Base-2 logarithm of the distinct sketch's registers: 16,384, a relative error of 0.8 %.
DISTINCT_K = 14
#: Size of the quantile sketch: a rank error of about 0.3 %.
QUANTILE_K = 1024


def column_sketches(df: DataFrame, extract: str) -> DataFrame:
    """One row per column of the extract, from one pass. Blank text counts as null, NaN as no value of the distribution."""
    measures, rows = [F.count("*").alias("_rows")], []
    for i, field in enumerate(df.schema.fields):
        c, numeric = F.col(f"`{field.name}`"), isinstance(field.dataType, NUMERIC)
        present = not_blank(c) if isinstance(field.dataType, T.StringType) else c.isNotNull()
        number = F.when(~F.isnan(c.cast("double")), c.cast("double")) if numeric else F.lit(None).cast("double")
        measures += [
            count_if(present).alias(f"present{i}"),
            F.hll_sketch_agg(F.when(present, c.cast("string")), DISTINCT_K).alias(f"distinct{i}"),
            *([F.min(number).alias(f"low{i}"), F.max(number).alias(f"high{i}")] if numeric else []),
            *([F.kll_sketch_agg_double(number, F.lit(QUANTILE_K)).alias(f"values{i}")] if numeric else []),
        ]
        of = lambda name, kind: (F.col(f"{name}{i}") if numeric else F.lit(None)).cast(kind).alias(name)  # noqa: B023, E731
        rows.append(
            F.struct(
                F.lit(extract).alias("extract"),
                F.lit(field.name).alias("column"),
                F.lit(field.dataType.simpleString()).alias("type"),
                F.col("_rows").alias("n"),
                F.col(f"present{i}").alias("present"),
                of("low", "double"),
                of("high", "double"),
                F.col(f"distinct{i}").alias("distinct"),
                of("values", "binary"),
            )
        )
    return to_rows(df.agg(*measures), rows)


class SketchStore:
    """The stored sketches of all extracts under `path`, a folder for each."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def add(self, df: DataFrame, extract: str) -> None:
        """Store an extract's sketches; an extract of that name is replaced, the others stay as they are."""
        rows = column_sketches(df, extract).coalesce(1)
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("extract").parquet(self.path)

    def table(self, extracts: Sequence[str] | None = None) -> DataFrame:
        stored = self.spark.read.option("basePath", self.path).schema(
            "`column` string, type string, n long, present long, low double, high double, `distinct` binary, `values` binary, extract string"
        ).parquet(self.path)
        return stored if extracts is None else stored.where(F.col("extract").isin(list(extracts)))

    def profile(self, probs: dict[str, float], extracts: Sequence[str] | None = None) -> DataFrame:
        """One row per column over the extracts: n, nulls, range, distinct values and quantiles of numbers.

        A column that an extract lacks is null in all its rows. Distinct values are within 2 or 3 %, the
        rank of a quantile within 0.5 %.
        """
        stored = self.table(extracts)
        total = stored.groupBy("extract").agg(F.max("n").alias("n")).agg(F.sum("n")).scalar()
        merged = stored.groupBy("column").agg(
            F.max("type").alias("type"),
            F.sum("present").alias("present"),
            F.min("low").alias("low"),
            F.max("high").alias("high"),
            F.hll_sketch_estimate(F.hll_union_agg("distinct")).alias("n_distinct"),
            F.kll_merge_agg_double("values").alias("_values"),
        )
        known = F.col("low").isNotNull()
        return merged.select(
            "column", "type", total.alias("n"), (total - F.col("present")).alias("nulls"), "low", "high", "n_distinct",
            *[F.when(known, F.kll_sketch_get_quantile_double("_values", F.lit(p))).alias(name) for name, p in probs.items()],
        )
