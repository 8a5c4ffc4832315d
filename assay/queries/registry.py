"""Registration of queries and the tables they read."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assay.queries.roles import TABLES, spark_text, sql_text

REGISTRY: dict[str, tuple[Callable, str | None]] = {}


class Inputs:
    """The given tables of one folder, and the role views over them, as DataFrames."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def role(self, name: str) -> DataFrame:
        text = spark_text(name)
        return self.spark.sql(text, **{t: self.table(t) for t in TABLES if "{" + t + "}" in text})


def oracle(body: str, *roles: str) -> str:
    """SQL over the plain tables, with the named role views in front."""
    views = ", ".join(f"{r} as ({sql_text(r)})" for r in roles)
    if not views:
        return body
    body = body.strip()
    joiner = ", " if body.lower().startswith("with ") else " "
    return f"with {views}{joiner}{body[5:] if joiner == ', ' else body}"


def query(key: str, sql: str | None = None, *roles: str):
    def register(fn: Callable[[Inputs], DataFrame]):
        REGISTRY[key] = (
            lambda spark, folder: rounded(fn(Inputs(spark, folder))),
            oracle(sql, *roles) if sql else None,
        )
        return fn

    return register


def rounded(df: DataFrame) -> DataFrame:
    """Doubles to six places, so that both engines agree; adding 0.0 removes negative zero."""
    doubles = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)]
    return df.withColumns({c: F.round(F.col(c), 6) + F.lit(0.0) for c in doubles})


def r6(expression: str, name: str) -> str:
    return f"round({expression}, 6) + 0e0 as {name}"
