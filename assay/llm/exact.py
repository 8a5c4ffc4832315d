"""Exact de-duplication against a persistent digest index, bucketed and sorted by hash."""

from __future__ import annotations

import hashlib

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assay.llm.common import ascii_lower, parts_for
from assay.session import scratch_path, settle

LEAST_BUCKETS = 32
#: What one digest with its key takes about; buckets hold a few million.
ENTRY_BYTES = 64
BUCKET_BYTES = 256 << 20
WHOLE_NUMBERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


class DigestIndex:
    """Digests seen so far, each with the key of the row that stays, as a bucketed table at `path`.

    The table is written by digest hash into buckets with sorted files, so a sort-merge join moves only
    the new side; as each batch adds files to a bucket, the join sorts the bucket again. Opening a path
    that already holds an index goes on with it, whose number of buckets and type of keys must then be
    the given ones. `add` is safe to repeat after a failure: what a batch has already put in is found by
    the anti-join. `rows` is how many digests the index is made for.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int | None = None, kind: str = "bigint", rows: int = 0):
        self.spark = spark
        self.name = "digest_index_" + hashlib.md5(path.encode()).hexdigest()
        try:
            made = spark.read.parquet(f"{path}-made").first()
        except AnalysisException:  # a new index
            made = (buckets or parts_for(rows * ENTRY_BYTES, LEAST_BUCKETS, BUCKET_BYTES), kind)
            spark.createDataFrame([made], "buckets int, kind string").coalesce(1).write.parquet(f"{path}-made")
        if (buckets or made[0], kind) != tuple(made):
            raise ValueError(f"the index at {path} has {made[0]} buckets and keys of type {made[1]}")
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} (digest BINARY, keep_id {kind}, keep_row BIGINT) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {made[0]} BUCKETS LOCATION '{path}'"
        )

    def table(self) -> DataFrame:
        return self.spark.table(self.name)

    def add(self, rows: DataFrame) -> None:
        """Append the digests that are new. Of rows (digest, doc_id, row) with one digest the largest stays.

        Rows are first reduced to one per digest, which starts before the shuffle, so a group of
        copies of any size arrives as one row per task. They are written before the anti-join, which
        else is pushed below the reduction and gets every copy.
        """
        best = settle(rows.groupBy("digest").agg(F.max(F.struct("doc_id", "row")).alias("best")), "reduced")
        new = best.hint("merge").join(self.table(), "digest", "left_anti")
        new.select("digest", "best.doc_id", "best.row").write.insertInto(self.name)
        self.spark.catalog.refreshTable(self.name)


def digests(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, row (a number of its own) and the SHA-256 of the text with A-Z in lower case."""
    content = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return settle(
        df.select(F.col(key).alias("doc_id"), ascii_lower(content).alias("folded")).select(
            "doc_id", F.monotonically_increasing_id().alias("row"), F.unhex(F.sha2("folded", 256)).alias("digest")
        ),
        "digests",
    )


def dedupe(df: DataFrame, index: DigestIndex | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: which row stays for its text. Keys are of any type that sorts.

    Texts are equal when they are identical after lower-casing A-Z; a null text counts as empty. Of equal
    texts the row with the largest key stays; a null key is the smallest. Of rows that also share the
    key, exactly one is marked as kept. Returns key, keep_id, group_size, kept and text_sha256. A text that
    the given index already has keeps the index's row. An empty table gives an empty result.

    Of whole numbers the upper half of the keys goes into the index before the lower half, so that what is
    already in the index is what stays. Text is read once; from then on only digests move.
    """
    spark = df.sparkSession
    rows = digests(df, key, text)
    kind = rows.schema["doc_id"].dataType
    n, low, high = rows.agg(F.count("*"), F.min("doc_id"), F.max("doc_id")).first()
    index = index or DigestIndex(spark, scratch_path(spark, "digest-index"), None, kind.simpleString(), n)
    if low is not None and isinstance(kind, WHOLE_NUMBERS):
        upper = F.coalesce(F.col("doc_id") > (low + high) // 2, F.lit(False))
        index.add(rows.where(upper))
        index.add(rows.where(~upper))
    else:  # no middle to tell halves apart by
        index.add(rows)
    sizes = settle(rows.groupBy("digest").agg(F.count("*").alias("group_size")), "sizes")
    groups = sizes.hint("merge").join(index.table(), "digest")
    return (
        rows.join(groups.hint("merge"), "digest")
        .select(
            F.col("doc_id").alias(key),
            "keep_id",
            "group_size",
            (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("row") == F.col("keep_row"))).alias("kept"),
            F.lower(F.hex("digest")).alias("text_sha256"),
        )
    )


def drop_copies(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The input without the rows that `dedupe` drops; same columns, and one row for each text.

    The last step, which leaves one of rows equal in key and text, has the partitioning of the join.
    """
    name = lambda column: F.coalesce(column.cast("string"), F.lit("null"))
    stays = dedupe(df, key=key, text=text).where("kept").select(name(F.col(key)).alias("_key"), F.col("text_sha256").alias("_digest"))
    content = ascii_lower(F.coalesce(F.col(text).cast("string"), F.lit("")))
    marked = df.withColumns({"_key": name(F.col(key)), "_digest": F.sha2(content, 256)})
    on = ["_key", "_digest"]
    return marked.join(stays, on, "left_semi").dropDuplicates(on).select(*df.columns)
