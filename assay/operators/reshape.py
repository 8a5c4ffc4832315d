"""Wide yearly series to long rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assay.functions.text import clean_number


def year_columns(columns, low: int, high: int) -> list[str]:
    found = []
    for name in columns:
        text = name.strip().removeprefix("-").removeprefix("+")
        if text.isdigit() and low <= int(name) <= high:
            found.append(name)
    return found


def melt_years(df: DataFrame, series: str, low: int = 2000, high: int = 2025) -> DataFrame:
    """(series, year, value): columns named by a year in range become rows, others are ignored."""
    years = year_columns(df.columns, low, high)
    wide = df.select(F.trim(F.col(series)).alias(series), *[F.col(f"`{y}`").cast("string") for y in years])
    long = wide.unpivot([series], years, "year", "value")
    return long.select(
        series, F.trim("year").cast("int").alias("year"), clean_number("value").alias("value")
    )


def pick_series(df: DataFrame, series: str, name: str, out: str) -> DataFrame:
    return df.where(F.col(series) == name).select("year", F.col("value").alias(out))
