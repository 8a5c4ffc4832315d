"""Quality gates and feature checks: rules in, one small table of findings out."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assay.functions.text import not_blank
from assay.operators.aggregates import count_if, to_rows
from assay.plans.features import FeatureConfig, required_columns


@dataclass(frozen=True)
class Expectation:
    """A rule on one aggregate of a table, such as ``Expectation("rows", F.count("*"), ">=", 100)``."""

    rule: str
    actual: Column
    op: str
    threshold: float


OPS = {
    ">=": lambda a, t: a >= t,
    "<=": lambda a, t: a <= t,
    "==": lambda a, t: a == t,
}


def blanks(column: str) -> Column:
    return count_if(~not_blank(column))


def present_pct(columns) -> Column:
    kept = F.lit(True)
    for c in columns:
        kept = kept & F.col(c).isNotNull()
    return F.try_divide(count_if(kept) * 100.0, F.count("*"))


# What each extracted table must reach before it is used.
def hawker_expectations(name="hawker_name") -> list[Expectation]:
    return [Expectation("rows", F.count("*"), ">=", 100), Expectation("blank_names", blanks(name), "==", 0)]


def supermarket_expectations() -> list[Expectation]:
    return [Expectation("rows", F.count("*"), ">=", 400)]


def station_expectations(name="station_name") -> list[Expectation]:
    return [
        Expectation("stations", F.count_distinct(name), ">=", 100),
        Expectation("exits", F.count("*"), ">=", 300),
    ]


def school_expectations(coordinates=("latitude", "longitude")) -> list[Expectation]:
    return [
        Expectation("rows", F.count("*"), ">=", 150),
        Expectation("geocoded_pct", present_pct(coordinates), ">=", 80),
    ]


def demographics_expectations(year="year") -> list[Expectation]:
    return [Expectation("years", F.count_distinct(year), ">=", 20)]


def index_expectations() -> list[Expectation]:
    return [Expectation("quarters", F.count("*"), ">=", 100)]


def gate(df: DataFrame, expectations: list[Expectation]) -> DataFrame:
    """(rule, actual, threshold, passed) from one aggregation over the table."""
    one = df.agg(*[e.actual.cast("double").alias(f"a{i}") for i, e in enumerate(expectations)])
    return to_rows(
        one,
        [
            F.struct(
                F.lit(e.rule).alias("rule"),
                F.col(f"a{i}").alias("actual"),
                F.lit(float(e.threshold)).alias("threshold"),
                F.coalesce(OPS[e.op](F.col(f"a{i}"), F.lit(float(e.threshold))), F.lit(False)).alias("passed"),
            )
            for i, e in enumerate(expectations)
        ],
    )


def proceed(gate_rows: DataFrame) -> bool:
    """True if every rule passed."""
    return gate_rows.where(~F.col("passed")).isEmpty()


def require(df: DataFrame, expectations: list[Expectation], what: str = "table") -> DataFrame:
    """The table itself if every rule passes; else an error that names the broken ones."""
    broken = [r["rule"] for r in gate(df, expectations).where(~F.col("passed")).collect()]
    if broken:
        raise ValueError(f"{what} does not reach: {', '.join(broken)}")
    return df


@dataclass(frozen=True)
class ColumnRules:
    """Which columns must be free of what."""

    not_null: tuple[str, ...] = ()
    not_nan: tuple[str, ...] = ()
    not_negative: tuple[str, ...] = ()
    binary: tuple[str, ...] = ()
    ranges: dict[str, tuple[float, float]] = field(default_factory=dict)

    def conditions(self) -> Iterable[tuple[str, str, Column]]:
        for c in self.not_null:
            yield c, "null", F.col(c).isNull()
        for c in self.not_nan:
            yield c, "nan", F.isnan(F.col(c).cast("double"))
        for c in self.not_negative:
            yield c, "negative", F.col(c) < 0
        for c in self.binary:
            yield c, "not_binary", ~F.col(c).isin(0, 1)
        for c, (low, high) in self.ranges.items():
            yield c, "out_of_range", ~F.col(c).between(low, high)


def violations(df: DataFrame, rules: ColumnRules) -> DataFrame:
    """(column, check, n): how many rows break each rule, all rules in one aggregation."""
    checks = list(rules.conditions())
    one = df.agg(*[count_if(bad).alias(f"v{i}") for i, (_, _, bad) in enumerate(checks)])
    return to_rows(
        one,
        [
            F.struct(F.lit(c).alias("column"), F.lit(label).alias("check"), F.col(f"v{i}").alias("n"))
            for i, (c, label, _) in enumerate(checks)
        ],
    )


@dataclass(frozen=True)
class FeatureSpec:
    """Columns a feature table must have, with their types, and the value rules on them."""

    types: dict[str, str]
    rules: ColumnRules

    @staticmethod
    def of(config: FeatureConfig) -> "FeatureSpec":
        types = required_columns(config)
        distances = tuple(c for c in types if c.startswith("dist_"))
        return FeatureSpec(
            types,
            ColumnRules(
                not_null=tuple(types),
                not_nan=distances,
                not_negative=distances,
                binary=tuple(c for c, t in types.items() if t == "int"),
            ),
        )


def validate_features(df: DataFrame, spec: FeatureSpec) -> DataFrame:
    """(column, problem, n): one row per error, none for a sound table.

    Missing columns and wrong types are seen in the schema; value rules run over the columns that
    exist, in one aggregation.
    """
    kinds = dict(df.dtypes)
    found = [(c, "missing", 0) for c in spec.types if c not in kinds]
    found += [
        (c, f"type {kinds[c]}, wanted {t}", 0) for c, t in spec.types.items() if kinds.get(c, t) != t
    ]
    schema = "column string, problem string, n bigint"
    errors = df.sparkSession.createDataFrame(found, schema)
    rules = ColumnRules(
        *[
            tuple(c for c in group if c in kinds)
            for group in (spec.rules.not_null, spec.rules.not_nan, spec.rules.not_negative, spec.rules.binary)
        ],
        ranges={c: r for c, r in spec.rules.ranges.items() if c in kinds},
    )
    if any(True for _ in rules.conditions()):
        broken = violations(df, rules).where(F.col("n") > 0)
        errors = errors.union(broken.select("column", F.col("check").alias("problem"), "n"))
    return errors
