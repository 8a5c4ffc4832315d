import random

import pytest
from pyspark.sql import functions as F

from assay.operators import periods
from assay.operators.ordering import positions
from assay.session import settle


@pytest.fixture(scope="module")
def series(spark):
    r = random.Random(4)
    rows = [(r.choice(["hot", "hot", "hot", "b", None]), i, float(r.randint(0, 5)), r.choice(["t", "u"])) for i in range(700)]
    r.shuffle(rows)
    return spark.createDataFrame(rows, "g string, at_time int, x double, at string").repartition(5)


def test_positions(series):
    got = positions(series, "g", "at_time", "place").collect()
    for g in ("hot", "b", None):
        mine = sorted((r["at_time"], r["place"]) for r in got if r["g"] == g)
        assert [p for _, p in mine] == list(range(len(mine)))
    assert positions(series.where("false"), [], "at_time", "place").isEmpty()


@pytest.mark.parametrize("n, block_rows", [(1, 3), (6, 5), (6, 50), (4, 10_000)])
def test_blocks_equal_one_window(series, n, block_rows):
    key = lambda df: sorted(map(str, (tuple(r) for r in df.select(*sorted(df.columns)).collect())))
    whole = periods.rolling_mean(series, "g", "at_time", "x", n, "m")
    assert key(periods.rolling_mean(series, "g", "at_time", "x", n, "m", block_rows=block_rows)) == key(whole)
    if n == 6:
        assert key(periods.growth(series, "at_time", "x", "g", block_rows=block_rows)) == key(periods.growth(series, "at_time", "x", "g"))


def test_a_block_is_no_shorter_than_its_halo(series):
    with pytest.raises(ValueError):
        periods.rolling_mean(series, "g", "at_time", "x", 6, block_rows=4)


def test_one_long_series_is_cut_over_tasks(spark):
    df = spark.range(1000).selectExpr("'one' as g", "id", "double(id) as x")
    merged = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(merged, "false")  # else tasks of so few rows are put together
    try:
        out = settle(periods.rolling_mean(df, "g", "id", "x", 6, "m", block_rows=50).withColumn("task", F.spark_partition_id()))
    finally:
        spark.conf.unset(merged)
    assert out.select("task").distinct().count() > 2 and out.count() == 1000
