"""CSV and table input and output. Schemas are given or all-string, never sampled."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assay.session import col

CORRUPT = "_corrupt_record"


def read_csv(spark: SparkSession, path, schema: T.StructType | str | None = None) -> DataFrame:
    """CSV with a header. Without a schema every column is text.

    With a schema, a line that does not fit keeps its raw text in `_corrupt_record` when the schema
    has that column; other lines are unaffected.
    """
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE")
    if schema is not None:
        reader = reader.schema(schema).option("columnNameOfCorruptRecord", CORRUPT)
    return reader.csv(path)


def parse_csv_lines(df: DataFrame, schema: str, line: str = "value", position: str | None = None) -> DataFrame:
    """Parse a column of CSV lines (downloaded payloads) by a DDL schema, one row per line.

    `position` names the column with a line's place in its payload; line 0 is then the payload's header
    and left out. Without it no line is a header.
    """
    if position is not None:
        df = df.where(F.col(position) > 0)
    return df.select(F.from_csv(col(line), schema, {"mode": "PERMISSIVE"}).alias("_r")).select("_r.*")


def ingest(df: DataFrame, columns, defaults: dict[str, str] | None = None) -> DataFrame:
    """Keep a subset of text columns, trimmed; a default stands in for a missing indicator.

    Names are matched after removing a byte-order mark, which CSV exports put on the first one. A
    default is used when the column is absent or the value is null.
    """
    defaults = defaults or {}
    clean = df.toDF(*[c.lstrip("\ufeff").strip() for c in df.columns])
    selected = []
    for name in columns:
        value = F.trim(F.col(name)) if name in clean.columns else F.lit(None).cast("string")
        if name in defaults:
            value = F.coalesce(value, F.lit(defaults[name]))
        selected.append(value.alias(name))
    return clean.select(*selected)


def tag_source(df: DataFrame, label: str, column: str = "_source") -> DataFrame:
    return df.withColumn(column, F.lit(label))


def write_table(df: DataFrame, path: str, columns, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """Write the columns in the given order; CSV files get a header each."""
    writer = df.select(*columns).write.mode(mode)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)


def is_complete(spark: SparkSession, path: str) -> bool:
    """True if a finished write left its success marker in the folder."""
    marker = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/_SUCCESS")
    return marker.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(marker)


def materialise(spark: SparkSession, path: str, builder: Callable[[], DataFrame]) -> DataFrame:
    """Read the table at `path`, computing and writing it first if it is not there in full."""
    if not is_complete(spark, path):
        builder().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
