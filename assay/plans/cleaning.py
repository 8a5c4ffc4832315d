"""Cleaning from a declarative configuration.

Each step declares what it reads, makes and removes, and the plan is an order that these declarations
allow, so nobody keeps a list in the right order. Each step is a lazy change of the DataFrame. Only the
profile that derives a default configuration, and the quartiles of the outlier step, run jobs.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assay.functions.dates import month_part, month_to_date, parse_date, remaining_term, year_part
from assay.functions.text import range_midpoint, replace_values, trim_upper, years_months
from assay.operators.aggregates import null_counts
from assay.operators.columns import drop_blank, range_filter, whitelist, without_flagged
from assay.operators.outliers import flag_iqr, flag_zscore
from assay.operators.sets import dedupe_rows

# Canonical dwelling types, the spellings mapped to them, and the text columns.
FLAT_TYPES = [
    "1 ROOM", "2 ROOM", "3 ROOM", "4 ROOM", "5 ROOM", "EXECUTIVE", "MULTI-GENERATION",
]
FLAT_TYPE_SPELLINGS = {
    "MULTI GENERATION": "MULTI-GENERATION",
    "MULTI-GEN": "MULTI-GENERATION",
    "multi generation": "MULTI-GENERATION",
}
CATEGORICALS = ["town", "flat_type", "flat_model", "street_name", "block"]


@dataclass(frozen=True)
class Step:
    name: str
    column: str
    options: dict = field(default_factory=dict)


@dataclass(frozen=True)
class CleaningConfig:
    outlier_method: str = "IQR"
    outlier_threshold: float = 1.5
    parse_storey_range: bool = True
    drop_nulls: tuple[str, ...] = ()
    drop_columns: tuple[str, ...] = ("_source",)
    relative_error: float | None = None


def _term_by_formula(df: DataFrame):
    return remaining_term(F.year(month_to_date("month")), "lease_commence_date")


def impute_term(df: DataFrame, column: str) -> DataFrame:
    """Fill missing remaining years by the formula; run it on a column that is already a number."""
    if df.schema[column].dataType.simpleString() == "string":
        raise ValueError(f"{column} is text; parse it to years first")
    return df.withColumn(column, F.coalesce(F.col(column), _term_by_formula(df)))


@dataclass(frozen=True)
class Operation:
    """A change of the table, and what it has to do with its columns.

    `reads`, `makes` and `removes` name columns, or a column in a state (`month date`, once it is a date).
    `{c}` stands for the column that a step is for. `rows` says that it takes rows away, `over_rows` that
    its result depends on which rows there are.
    """

    change: Callable[..., DataFrame]
    reads: tuple[str, ...] = ("{c}",)
    makes: tuple[str, ...] = ()
    removes: tuple[str, ...] = ()
    rows: bool = False
    over_rows: bool = False


# The names of steps, which configurations use.
STEPS: dict[str, Operation] = {
    "compute_remaining_lease": Operation(
        lambda df, c: df.withColumn("remaining_lease_years", remaining_term("transaction_year", "lease_commence_date")),
        reads=("transaction_year", "lease_commence_date"),
        makes=("remaining_lease_years",),
    ),
    "derive_year_month": Operation(
        lambda df, c: df.withColumns({"transaction_year": year_part(c), "transaction_month": month_part(c)}),
        reads=("{c} date",),
        makes=("transaction_year", "transaction_month"),
    ),
    "drop_column": Operation(lambda df, c: df.drop(df[c]), reads=(), removes=("{c}",)),
    "drop_nulls": Operation(drop_blank, rows=True),
    "flag_outliers_iqr": Operation(lambda df, c, **o: flag_iqr(df, c, **o), makes=("{c}_outlier",), over_rows=True),
    "flag_outliers_zscore": Operation(
        lambda df, c, group_by=None, **o: flag_zscore(df, c, group_by, **o), makes=("{c}_outlier",), over_rows=True
    ),
    "impute_remaining_lease": Operation(impute_term, reads=("{c} years", "month"), makes=("{c} whole",)),
    "parse_lease_string": Operation(lambda df, c, **o: df.withColumn(c, years_months(c, **o)), makes=("{c} years",)),
    "parse_storey_range": Operation(lambda df, c: df.withColumn("storey_midpoint", range_midpoint(c)), makes=("storey_midpoint",)),
    "parse_yyyymm_date": Operation(lambda df, c: df.withColumn(c, month_to_date(c)), makes=("{c} date",)),
    "parse_yyyymmdd_date": Operation(lambda df, c: df.withColumn(c, parse_date(c)), makes=("{c} date",)),
    "standardise_values": Operation(
        lambda df, c, replacements: df.withColumn(c, replace_values(c, replacements)), reads=("{c} tidy",), makes=("{c} canonical",)
    ),
    "trim_uppercase": Operation(lambda df, c: df.withColumn(c, trim_upper(c)), makes=("{c} tidy",)),
}

#: What a column of the raw table is due, whatever the configuration.
TREATMENTS: dict[str, tuple[str, ...]] = {
    **{c: ("trim_uppercase",) for c in CATEGORICALS},
    "flat_type": ("trim_uppercase", "standardise_values"),
    "lease_commence_date": ("compute_remaining_lease",),
    "month": ("parse_yyyymm_date", "derive_year_month"),
    "remaining_lease": ("drop_column",),
    "storey_range": ("parse_storey_range",),
}


def derive_config(df: DataFrame, keep_nulls=("remaining_lease", "flat_model"), **overrides) -> CleaningConfig:
    """Configuration by rule: rows with null or blank values go, except in `keep_nulls`.

    One pass over the table; one row per column comes to the driver.
    """
    rows = null_counts(df, blanks=True).collect()
    with_nulls = tuple(r["column"] for r in rows if r["nulls"] and r["column"] not in keep_nulls)
    return CleaningConfig(**{"drop_nulls": with_nulls, **overrides})


def _comes_before(a: Step, b: Step) -> bool:
    """Whether what `a` does must be done when `b` is.

    It makes what the other reads; the other removes a column that it has to do with; the other takes
    rows away by a column that it brings into another state; or it takes rows away and the other
    depends on the rows.
    """
    if a == b or a.name not in STEPS or b.name not in STEPS:
        return False
    first, second = STEPS[a.name], STEPS[b.name]
    made = {x.format(c=a.column) for x in first.makes}
    touched = {x.format(c=a.column).split()[0] for x in first.reads + first.makes}
    needed = {x.format(c=b.column) for x in second.reads}
    gone = {x.format(c=b.column) for x in second.removes}
    changed = {x.split()[0] for x in made if " " in x}
    return bool(made & needed or gone & touched or second.rows and changed & needed or first.rows and second.over_rows)


def in_order(steps) -> list[Step]:
    """The steps in an order that their declarations allow; whatever it leaves open goes by name and column."""
    waiting = sorted(steps, key=lambda step: (step.name, step.column))
    ordered: list[Step] = []
    while waiting:
        ready = next((s for s in waiting if not any(_comes_before(other, s) for other in waiting)), None)
        if ready is None:
            raise ValueError(f"steps wait for each other: {[s.name for s in waiting]}")
        waiting.remove(ready)
        ordered.append(ready)
    return ordered


def steps_of(config: CleaningConfig, columns) -> list[Step]:
    """The steps that a table with these columns is due under a configuration, in order."""
    outliers = "flag_outliers_iqr" if config.outlier_method.upper() == "IQR" else "flag_outliers_zscore"
    options = {
        "flag_outliers_iqr": {"multiplier": config.outlier_threshold, "relative_error": config.relative_error},
        "flag_outliers_zscore": {"threshold": config.outlier_threshold},
        "standardise_values": {"replacements": FLAT_TYPE_SPELLINGS},
    }
    due = {(name, column) for column in columns for name in TREATMENTS.get(column, ())}
    due |= {("drop_nulls", column) for column in config.drop_nulls if "drop_column" not in TREATMENTS.get(column, ())}
    due |= {("drop_column", column) for column in config.drop_columns} | {(outliers, "resale_price")}
    left_out = set() if config.parse_storey_range else {"parse_storey_range"}
    return in_order(Step(name, column, options.get(name, {})) for name, column in due if name not in left_out)


def apply_steps(df: DataFrame, steps: list[Step]) -> tuple[DataFrame, list[tuple[str, str, str]]]:
    """Apply steps in order. Unknown steps, and steps that do not fit the table, are skipped."""
    log = []
    for step in steps:
        operation = STEPS.get(step.name)
        if operation is None:
            log.append((step.name, step.column, "skipped: unknown step"))
            continue
        try:
            changed = operation.change(df, step.column, **step.options)
            changed.schema  # raises here if the step does not fit
            df = changed
            log.append((step.name, step.column, "applied"))
        except (AnalysisException, KeyError, TypeError, ValueError) as problem:
            log.append((step.name, step.column, f"skipped: {type(problem).__name__}"))
    return df, log


def config_clean(df: DataFrame, config: CleaningConfig | None = None) -> tuple[DataFrame, DataFrame]:
    """(cleaned rows with the outlier flag, log of steps)."""
    config = config or derive_config(df)
    cleaned, log = apply_steps(df, steps_of(config, df.columns))
    return cleaned, df.sparkSession.createDataFrame(log, "step string, column string, status string")


def finish(df: DataFrame, flag: str = "resale_price_outlier") -> DataFrame:
    """Rule filters after the steps: canonical types, positive area, no copies, no outliers."""
    df, _ = whitelist(df, "flat_type", FLAT_TYPES)
    df = dedupe_rows(range_filter(df, "floor_area_sqm", 0.0, inclusive=False))
    return without_flagged(df, flag) if flag in df.columns else df


def waterfall(df: DataFrame, stages: dict) -> DataFrame:
    """Rows left after each filter stage, with the change and the share of raw, in one pass.

    `stages` maps a stage name to the condition that its rows must meet, on top of earlier ones.
    """
    kept, measures = F.lit(True), [F.count("*").alias("s0")]
    for i, condition in enumerate(stages.values(), 1):
        kept = kept & F.coalesce(condition, F.lit(False))
        measures.append(F.coalesce(F.sum(kept.cast("long")), F.lit(0)).alias(f"s{i}"))
    entries = [
        F.struct(
            F.lit(i).alias("stage_no"),
            F.lit(name).alias("stage"),
            F.col(f"s{i}").alias("n"),
            (F.col(f"s{i}") - F.col(f"s{max(i - 1, 0)}")).alias("change"),
            F.try_divide(F.col(f"s{i}") * 100.0, F.col("s0")).alias("pct_of_raw"),
        )
        for i, name in enumerate(["raw", *stages])
    ]
    return df.agg(*measures).select(F.explode(F.array(*entries)).alias("_r")).select("_r.*")
