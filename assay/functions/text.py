"""Text and number parsing as Column expressions. Bad input becomes null, also in ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from assay.session import col

# Number shapes accepted by the guarded cast, and marks that mean "no number".
NUMBER_SHAPES = {"double": r"^-?\d+(\.\d+)?$", "int": r"^\d+$"}
MISSING_NUMBER_MARKS = ["na", "NA", "", "None", "-"]


def trim_upper(column) -> Column:
    return F.upper(F.trim(col(column)))


def not_blank(column) -> Column:
    c = col(column)
    return c.isNotNull() & (F.trim(c.cast("string")) != "")


def blank_to_null(column) -> Column:
    c = col(column)
    return F.when(not_blank(c), c)


def guarded_cast(column, type_name: str) -> Column:
    """Cast text only when its whole shape is a plain number; '1e5' and 'n/a' give null."""
    c = col(column).cast("string")
    if type_name not in NUMBER_SHAPES:
        return c.try_cast(type_name)
    return F.when(c.rlike(NUMBER_SHAPES[type_name]), c.try_cast(type_name))


def clean_number(column) -> Column:
    """Number from text with thousands commas; missing marks and other text give null."""
    c = F.trim(F.replace(col(column), F.lit(","), F.lit("")))
    return F.when(~c.isin(MISSING_NUMBER_MARKS), c.try_cast("double"))


def replace_values(column, pairs: dict[str, str]) -> Column:
    """Exact replacements, as if applied one pair after the other.

    The chain is followed here once per source value, so rows are matched a single time.
    """
    c = col(column)
    result = {}
    for start in pairs:
        value = start
        for old, new in pairs.items():
            value = new if value == old else value
        result[start] = value
    expression = c
    if result:
        first, *rest = result.items()
        expression = F.when(c == first[0], F.lit(first[1]))
        for old, new in rest:
            expression = expression.when(c == old, F.lit(new))
        expression = expression.otherwise(c)
    return expression


def matched_number(column, pattern: str) -> Column:
    return F.regexp_extract(col(column), pattern, 1).try_cast("double")


def years_months(column, bare_years: bool = False) -> Column:
    """'61 years 04 months' to 61.33. Text without "year" is null unless `bare_years`."""
    years = matched_number(column, r"(\d+)\s*[Yy]ear")
    if bare_years:
        years = F.coalesce(years, matched_number(column, r"^\s*(\d+)\s*$"))
    months = F.coalesce(matched_number(column, r"(\d+)\s*[Mm]onth"), F.lit(0.0))
    return years + months / F.lit(12.0)


def range_midpoint(column) -> Column:
    """'04 TO 06' to 5.0; null unless the text both starts and ends with digits."""
    low = matched_number(column, r"^(\d+)")
    high = matched_number(column, r"(\d+)$")
    return (low + high) / F.lit(2.0)


def bin_by(column, edges, labels, null_label: str = "unknown") -> Column:
    """Label by the first edge the value does not exceed; the last label takes the rest."""
    c = col(column)
    expression = F.when(c.isNull(), F.lit(null_label))
    for edge, label in zip(edges, labels):
        expression = expression.when(c <= edge, F.lit(label))
    return expression.otherwise(F.lit(labels[-1]))


def quarter_parts(column) -> tuple[Column, Column]:
    """(year, quarter) of '1990-Q1'; both null when the text has another shape."""
    c = F.trim(col(column))
    shape = r"^(\d{4})-Q(\d+)$"
    return (
        F.regexp_extract(c, shape, 1).try_cast("int"),
        F.regexp_extract(c, shape, 2).try_cast("int"),
    )


def concat_key(columns, separator: str = " ") -> Column:
    """Join the parts that are present; null parts are skipped."""
    return F.concat_ws(separator, *[col(c) for c in columns])
