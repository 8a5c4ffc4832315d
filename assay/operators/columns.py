"""Projection, schema alignment, filters and null handling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assay.functions.text import concat_key, guarded_cast, not_blank
from assay.session import names, settle
from assay.sources.files import tag_source


def normalise_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip().lower().replace(" ", "_") for c in df.columns])


def align_schema(df: DataFrame, schema: T.StructType, label: str | None = None) -> DataFrame:
    """Bring an extract to a canonical schema in one projection.

    Names are normalised, missing columns come in as nulls, text is cast only where it has a plain
    number's shape, and other columns are dropped.
    """
    df = normalise_names(df)

    def aligned(field: T.StructField) -> Column:
        type_name = field.dataType.simpleString()
        if field.name not in df.columns:
            return F.lit(None).cast(field.dataType).alias(field.name)
        if type_name == "string":
            return F.col(field.name).cast("string").alias(field.name)
        return guarded_cast(field.name, type_name).alias(field.name)

    out = df.select(*[aligned(f) for f in schema.fields])
    return out if label is None else tag_source(out, label)


def drop_columns(df: DataFrame, columns, protected=()) -> DataFrame:
    """Drop the listed columns that exist and are not protected."""
    return df.drop(*[c for c in columns if c in df.columns and c not in set(protected)])


def derive_key(df: DataFrame, columns, out: str, separator: str = " ") -> DataFrame:
    return df.withColumn(out, concat_key(columns, separator))


def is_missing(df: DataFrame, column: str) -> Column:
    """Null, or NaN where the type has NaN."""
    c = F.col(column)
    if df.schema[column].dataType.simpleString() in ("double", "float"):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def any_missing(df: DataFrame, columns) -> Column:
    condition = F.lit(False)
    for column in columns:
        condition = condition | is_missing(df, column)
    return condition


def split_off(df: DataFrame, gone: Column) -> tuple[DataFrame, DataFrame]:
    """(the rows that are not `gone`, written; one-row table of how many were removed).

    Both come from one scan: the counts are observed while the rows pass on their way into the table.
    """
    seen = Observation()
    counts = [F.count(F.lit(1)).alias("n_before"), F.coalesce(F.sum(gone.cast("long")), F.lit(0)).alias("n_removed")]
    kept = settle(df.observe(seen, *counts).where(~gone), "kept")
    n_before, n_removed = seen.get["n_before"], seen.get["n_removed"]
    share = n_removed * 100.0 / n_before if n_before else None
    stats = df.sparkSession.createDataFrame([(n_before, n_removed, share)], "n_before long, n_removed long, removed_pct double")
    return kept, stats


def drop_missing(df: DataFrame, columns) -> tuple[DataFrame, DataFrame]:
    """(rows with every column present and not NaN, one-row table of how many were removed)."""
    return split_off(df, any_missing(df, columns))


def drop_blank(df: DataFrame, column: str) -> DataFrame:
    return df.where(not_blank(column))


def dropna(df: DataFrame, subset=None) -> DataFrame:
    return df.na.drop(subset=names(subset) or None)


def whitelist(df: DataFrame, column: str, allowed) -> tuple[DataFrame, DataFrame]:
    """(rows with a canonical value, counts of each other value). Null is not canonical."""
    ok = F.coalesce(F.col(column).isin(list(allowed)), F.lit(False))
    return df.where(ok), df.where(~ok).groupBy(column).agg(F.count("*").alias("n"))


def in_range(column: str, low=None, high=None, inclusive: bool = True) -> Column:
    c, condition = F.col(column), F.col(column).isNotNull()
    if low is not None:
        condition = condition & (c >= low if inclusive else c > low)
    if high is not None:
        condition = condition & (c <= high if inclusive else c < high)
    return condition


def range_filter(df: DataFrame, column: str, low=None, high=None, inclusive: bool = True) -> DataFrame:
    """Rows within the bounds; null fails."""
    return df.where(in_range(column, low, high, inclusive))


def indicator_filter(df: DataFrame, column: str, value) -> DataFrame:
    return df.where(F.col(column) == value)


def spot_check(df: DataFrame, column: str, value: str, metric: str) -> DataFrame:
    """Least, mean, greatest and count of a metric where the text equals a value in any case."""
    hit = df.where((F.lower(F.col(column)) == value.lower()) & ~is_missing(df, metric))
    return hit.agg(
        F.min(metric).alias("min_value"),
        F.avg(metric).alias("avg_value"),
        F.max(metric).alias("max_value"),
        F.count("*").alias("n"),
    )


def fill_defaults(df: DataFrame, defaults: dict) -> DataFrame:
    """Null fill per column; columns that are absent are left out."""
    return df.na.fill({c: v for c, v in defaults.items() if c in df.columns})


def fill_unknown(df: DataFrame, columns, label: str = "unknown") -> DataFrame:
    """Categorical columns as text, with a label for null."""
    return df.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit(label)) for c in columns})


def clamp(df: DataFrame, column: str, low=None, high=None) -> DataFrame:
    """Push values into the bounds; null stays null."""
    value = F.col(column)
    if low is not None:
        value = F.when(F.col(column) < low, F.lit(low)).otherwise(value)
    if high is not None:
        value = F.when(F.col(column) > high, F.lit(high)).otherwise(value)
    return df.withColumn(column, value)


def coalesce_columns(df: DataFrame, out: str, candidates, type_name: str | None = None) -> DataFrame:
    """First non-null of the candidates that can be built from this table.

    A candidate is a column name, or a (needed column names, expression) pair.
    """
    usable = []
    for candidate in candidates:
        needed, value = (names(candidate), F.col(candidate)) if isinstance(candidate, str) else candidate
        if set(names(needed)) <= set(df.columns):
            usable.append(value.cast(type_name) if type_name else value)
    if not usable:
        raise ValueError(f"no candidate for {out!r} can be built from {df.columns}")
    return df.withColumn(out, F.coalesce(*usable))


# Names of coordinate columns, the preferred ones first.
COORDINATE_SPELLINGS = {
    "latitude": ("latitude", "lat", "{label}_lat"),
    "longitude": ("longitude", "lng", "lon", "{label}_lng", "{label}_lon"),
}


def resolve_coordinates(df: DataFrame, label: str = "") -> tuple[str, str]:
    """Names of the latitude and longitude columns under the usual spellings."""
    present = {
        axis: [spelt for spelling in spellings if (spelt := spelling.format(label=label)) in df.columns]
        for axis, spellings in COORDINATE_SPELLINGS.items()
    }
    absent = [axis for axis, columns in present.items() if not columns]
    if absent:
        raise ValueError(f"{label or 'table'} has no {' and no '.join(absent)} column among {df.columns}")
    return present["latitude"][0], present["longitude"][0]


def with_row_id(df: DataFrame, keys=None, out: str = "row_id") -> DataFrame:
    """Add an id when absent: a 128-bit digest of key columns that identify a row.

    The digest is the same in every run and on every machine. Without keys the id is only unique
    within one computation of the table, so write the result before using it twice.
    """
    if out in df.columns:
        return df
    if not names(keys):
        return df.withColumn(out, F.monotonically_increasing_id())
    return df.withColumn(out, F.md5(F.to_json(F.struct(*names(keys)), {"ignoreNullFields": "false"})))


def without_flagged(df: DataFrame, flag: str) -> DataFrame:
    """Rows not flagged, without the flag. Null is no flag."""
    return df.where(~F.coalesce(F.col(flag), F.lit(False))).drop(flag)


def remove_flagged(df: DataFrame, flag: str) -> tuple[DataFrame, DataFrame]:
    """(`without_flagged`, written; one-row table of the share removed), from one scan."""
    kept, stats = split_off(df, F.coalesce(F.col(flag), F.lit(False)))
    return kept.drop(flag), stats
