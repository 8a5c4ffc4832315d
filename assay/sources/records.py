"""Record validation at ingest: typed rules per column, rejects kept apart with their reasons."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assay.functions.text import not_blank


@dataclass(frozen=True)
class Rule:
    """What a record must satisfy in one column.

    `type` is a Spark type name; text that does not cast breaks the rule unless it is blank.
    """

    column: str
    type: str = "string"
    required: bool = False
    low: float | None = None
    high: float | None = None

    def violations(self) -> list[Column]:
        c = F.col(self.column)
        typed = c.cast("string").try_cast(self.type)
        checks = []
        if self.required:
            checks.append(("required", ~not_blank(c)))
        if self.type != "string":
            checks.append(("type", not_blank(c) & typed.isNull()))
        if self.low is not None:
            checks.append(("low", F.coalesce(typed < self.low, F.lit(False))))
        if self.high is not None:
            checks.append(("high", F.coalesce(typed > self.high, F.lit(False))))
        return [F.when(bad, F.lit(f"{self.column}:{label}")) for label, bad in checks]


def check_records(df: DataFrame, rules: list[Rule], column: str = "_failed") -> DataFrame:
    """Add the array of broken rules of each row, empty for a valid one."""
    return df.withColumn(column, F.array_compact(F.array(*[v for r in rules for v in r.violations()])))


def split_valid(df: DataFrame, rules: list[Rule]) -> tuple[DataFrame, DataFrame]:
    """(valid rows with their types applied, rejected rows with the broken rules)."""
    checked = check_records(df, rules)
    typed = {
        r.column: F.col(r.column).cast("string").try_cast(r.type) for r in rules if r.type != "string"
    }
    valid = checked.where(F.size("_failed") == 0).drop("_failed").withColumns(typed)
    return valid, checked.where(F.size("_failed") > 0)
