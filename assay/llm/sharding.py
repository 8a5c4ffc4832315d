"""Rendezvous hashing of stable record keys over weighted shards.

Each shard draws a score from the key and its own number; the shard with the least score, which is
exponential with the shard's weight as its rate, takes the record. Another shard draws one more score
and leaves the others as they are, so records move only into it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from assay.session import settle

SIZE_OVERHEAD = 16


def key_scores(key: str, weights: Sequence[float]) -> Column:
    """Array of (score, shard) for a key column; a null key is a key of its own."""
    named = F.coalesce(F.concat(F.lit("k"), F.col(key).cast("string")), F.lit("n"))
    even = len(set(weights)) == 1
    rates = F.array(*[F.lit(float(w)) for w in weights])

    def score(shard):
        digest = F.substring(F.md5(F.concat(named, F.lit(":"), shard.cast("string"))), 1, 13)
        uniform = (F.conv(digest, 16, 10).cast("double") + 0.5) / float(1 << 52)
        drawn = -F.log(uniform)
        return F.struct((drawn if even else drawn / F.get(rates, shard)).alias("score"), shard.alias("shard"))

    return F.transform(F.sequence(F.lit(0), F.lit(len(weights) - 1)), score)


def place(
    df: DataFrame, shards: int | Sequence[float], grown: float | None = 1.0, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The shard and the slot of each record, and its shard if one more of weight `grown` is added.

    `shards` is a number of equal shards, or their positive weights. Returns key, size (UTF-8 bytes plus
    16; a null text has none), text_crc32 (a null text counts as empty), shard, slot and grown_shard (null
    when `grown` is None). Slots are gapless from 0 in a shard, in order of key, checksum and size; rows
    that tie are equal in all these columns. A null key is a key of its own and comes first. Repeated
    rows keep their shard and get slots of their own. An empty table gives an empty result. Other
    columns, whatever their names, are not read.

    Placement reads the table once. Slots come from a sort by range, in which a shard may span many
    tasks, and the count of rows per shard and task; no shard, key or text is gathered anywhere.
    """
    weights = [1.0] * shards if isinstance(shards, int) else [float(w) for w in shards]
    if not weights or min(weights) <= 0:
        raise ValueError("shards need positive weights")
    scores = key_scores("doc_id", weights + ([grown] if grown is not None else []))
    least = lambda array: F.array_min(array).getField("shard").cast("int")
    content = F.coalesce(F.col("text").cast("string"), F.lit(""))
    placed = (
        df.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
        .select(
            "doc_id",
            (F.octet_length(content).cast("long") + SIZE_OVERHEAD).alias("size"),
            F.crc32(content).alias("text_crc32"),
            scores.alias("scores"),
        )
        .select(
            "doc_id",
            "size",
            "text_crc32",
            least(F.slice("scores", 1, len(weights))).alias("shard"),
            (least(F.col("scores")) if grown is not None else F.lit(None).cast("int")).alias("grown_shard"),
        )
    )
    # The last sort key only spreads rows that are equal in all others.
    order = ["shard", "doc_id", "text_crc32", "size", "spread"]
    ranged = (
        settle(placed, "placed")
        .withColumn("spread", F.monotonically_increasing_id())
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .drop("spread")
        .withColumns({"at": F.monotonically_increasing_id(), "task": F.spark_partition_id()})
    )
    ranged = settle(ranged, "ranged")
    blocks = ranged.groupBy("shard", "task").agg(F.count("*").alias("rows"), F.min("at").alias("first"))
    before = Window.partitionBy("shard").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(
        "shard", "task", (F.coalesce(F.sum("rows").over(before), F.lit(0)) - F.col("first")).alias("shift")
    )
    return ranged.join(blocks, ["shard", "task"]).select(
        F.col("doc_id").alias(key), "size", "text_crc32", "shard", (F.col("at") + F.col("shift")).alias("slot"), "grown_shard"
    )
