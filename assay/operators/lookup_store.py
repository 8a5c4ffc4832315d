"""A lookup that grows: one row per key on disk, bucketed by the key, extended batch by batch."""

from __future__ import annotations

import hashlib

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assay.operators.sets import dedupe_keys
from assay.session import settle

BUCKETS = 16


class LookupStore:
    """Rows of `schema` at `path`, one per value of `key`, in buckets by the key.

    Joins with the store sort the bucket files where they are and move only the other side. Opening a
    path goes on with the store there, which must have the given schema and number of buckets.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str, key: str, buckets: int = BUCKETS):
        self.spark, self.key = spark, key
        self.name = "lookup_store_" + hashlib.md5(path.encode()).hexdigest()
        made = (schema, key, buckets)
        try:
            before = tuple(spark.read.parquet(f"{path}-made").first())
        except AnalysisException:  # a new store
            before = made
            spark.createDataFrame([made], "fields string, key string, buckets int").coalesce(1).write.parquet(f"{path}-made")
        if before != made:
            raise ValueError(f"the store at {path} has {before}, not {made}")
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} ({schema}) USING parquet "
            f"CLUSTERED BY ({key}) SORTED BY ({key}) INTO {buckets} BUCKETS LOCATION '{path}'"
        )

    def table(self) -> DataFrame:
        return self.spark.table(self.name)

    def add(self, rows: DataFrame, order=()) -> None:
        """Append the rows whose key is new: of a batch's rows with one key the least by `order`. Null keys are left out.

        The batch is reduced to one row per key before it meets the store. It is safe to repeat a batch
        after a failure, because what is there is not added again.
        """
        columns = self.table().columns
        batch = settle(dedupe_keys(rows.select(*columns).na.drop(subset=[self.key]), self.key, order), "batch")
        new = batch.hint("merge").join(self.table().select(self.key), self.key, "left_anti")
        new.select(*columns).write.insertInto(self.name)
        self.spark.catalog.refreshTable(self.name)

    def missing(self, df: DataFrame) -> DataFrame:
        """Distinct non-null keys of `df` that the store does not have."""
        wanted = df.select(self.key).where(F.col(self.key).isNotNull()).distinct()
        return wanted.hint("merge").join(self.table().select(self.key), self.key, "left_anti")

    def join(self, df: DataFrame) -> DataFrame:
        """`df` with the store's columns; rows without a match are kept, and none is multiplied."""
        return df.hint("merge").join(self.table(), self.key, "left")
