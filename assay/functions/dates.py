"""Month-grained date handling as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from assay.session import col

# Text that begins with a day, and text that is a month.
DAY, MONTH = r"^\d{4}-\d{2}-\d{2}", r"^\d{4}-\d{2}$"


def parse_date(column) -> Column:
    return F.try_to_date(col(column).cast("string"), "yyyy-MM-dd")


def month_to_date(column) -> Column:
    """Date of 'YYYY-MM' (its first day), of 'YYYY-MM-DD...' or of a date column; else null."""
    text = F.trim(col(column).cast("string"))
    day, month = (F.regexp_extract(text, shape, 0) for shape in (DAY, MONTH))
    return F.coalesce(parse_date(day), parse_date(F.concat(month, F.lit("-01"))))


def year_part(column) -> Column:
    return F.substring(F.trim(col(column).cast("string")), 1, 4).try_cast("int")


def month_part(column) -> Column:
    return F.substring(F.trim(col(column).cast("string")), 6, 2).try_cast("int")


def quarter_of_month(month) -> Column:
    """Quarter 1-4 of a month number, truncating like integer division."""
    return (F.floor((col(month) - 1) / F.lit(3)) + 1).cast("int")


def month_label(column) -> Column:
    return F.date_format(col(column), "yyyy-MM")


def quarters_back(column, months: int) -> Column:
    """First day of the quarter that lies `months` months before the date."""
    return F.trunc(F.add_months(col(column), -months), "quarter")


def remaining_term(year, start, term: int = 99) -> Column:
    return (F.lit(term) - (col(year) - col(start))).cast("double")


def elapsed_years(year, start) -> Column:
    return (col(year) - col(start)).cast("double")
