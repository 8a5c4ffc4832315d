"""Session set-up, scratch storage and the joining of statistics to rows."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def get_session(app: str = "assay", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution on; `conf` keys use ``__`` for dots."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session may go without that setting; it then gets a temporary folder of its own,
    because on a cluster such a folder would not be seen by other machines. The session's own checkpoint
    folder is used but never set.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        name = spark.sparkContext.applicationId
        root = _LOCAL_ROOTS.get(name) or _LOCAL_ROOTS.setdefault(name, tempfile.mkdtemp(prefix="assay-"))
    return root.rstrip("/")


_LOCAL_ROOTS: dict[str, str] = {}
_OPEN_SCOPES: list[list[str]] = []


def scratch_path(spark: SparkSession, label: str) -> str:
    path = f"{scratch_root(spark)}/assay-{label}-{uuid.uuid4().hex}"
    if _OPEN_SCOPES:
        _OPEN_SCOPES[-1].append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession):
    """Delete the tables written inside when the block ends, and nothing else in their folder.

    A result that is to outlive the block must be written or collected inside it.
    """
    _OPEN_SCOPES.append([])
    try:
        yield
    finally:
        gateway = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        for path in map(gateway, _OPEN_SCOPES.pop()):
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def settle(df: DataFrame, label: str = "table") -> DataFrame:
    """Write an intermediate table to the shared folder and read it back.

    The lineage is cut in a way that survives lost executors, the result is computed once, and the
    planner then knows the real size of the table, so it broadcasts it only if it is small.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def names(columns) -> list[str]:
    if columns is None:
        return []
    return [columns] if isinstance(columns, str) else list(columns)


def col(column) -> Column:
    return F.col(column) if isinstance(column, str) else column


def same_keys(left: DataFrame, right: DataFrame, pairs) -> Column:
    """Null-safe equality of (left name, right name) pairs, usable as a hash-join condition."""
    condition = None
    for a, b in pairs:
        term = left[a].eqNullSafe(right[b])
        condition = term if condition is None else condition & term
    return condition


def attach(df: DataFrame, stats: DataFrame, by=None) -> DataFrame:
    """Add the columns of a per-group statistics table to every row of its group.

    Without groups the single row comes in as a scalar subquery, so there is neither a join nor an
    unpartitioned window. Null group keys match each other.
    """
    by = names(by)
    if not by:
        packed = stats.select(F.struct("*").alias("packed"))
        return df.select("*", *[packed.scalar().getField(c).alias(c) for c in stats.columns])
    values = [c for c in stats.columns if c not in by]
    keyed = stats.select(*[F.col(b).alias(f"_key{i}") for i, b in enumerate(by)], *values)
    condition = same_keys(df, keyed, [(b, f"_key{i}") for i, b in enumerate(by)])
    return df.join(keyed, condition, "left").select(df["*"], *values)
