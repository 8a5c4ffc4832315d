"""Tables kept on disk and extended: sketches by extract, lookups by key."""

import random

import pytest
from pyspark.sql import functions as F

from assay.operators import sketches
from assay.operators.lookup_store import LookupStore
from assay.operators.sketches import SketchStore, column_sketches
from assay.session import scratch_path, settle

SCHEMA = "n long, name string, x double"


def extract(spark, seed, rows, names):
    r = random.Random(seed)
    made = [(seed * 10**6 + i, r.choice([None, " ", *[f"name {k}" for k in range(names)]]), r.choice([None, r.gauss(seed, 1)])) for i in range(rows)]
    return spark.createDataFrame(made, SCHEMA)


def test_merged_profile_is_near_the_exact_one(spark):
    store, parts = SketchStore(spark, scratch_path(spark, "sketches")), {f"e{n}": extract(spark, n, 3000, 100 * (n + 1)) for n in range(4)}
    for name, df in parts.items():
        store.add(df, name)
    whole = parts["e0"]
    for n in range(1, 4):
        whole = whole.unionByName(parts[f"e{n}"])
    got = {r["column"]: r for r in store.profile({"median": 0.5, "p90": 0.9}).collect()}
    data = whole.toPandas()
    data["name"] = data["name"].where(data["name"].str.strip() != "")
    for c in data.columns:
        assert (got[c]["n"], got[c]["nulls"]) == (12000, data[c].isna().sum())
        assert abs(got[c]["n_distinct"] / data[c].nunique() - 1) < 0.05
    assert got["name"]["median"] is None and got["name"]["low"] is None
    assert got["x"]["low"] == data["x"].min() and got["x"]["high"] == data["x"].max()
    assert abs((data["x"].dropna() <= got["x"]["p90"]).mean() - 0.9) < 0.01


def test_a_new_extract_reads_no_old_one_and_replaces_its_own(spark):
    path = scratch_path(spark, "sketches")
    first, second = scratch_path(spark, "first"), scratch_path(spark, "second")
    extract(spark, 1, 50, 5).write.parquet(first)
    extract(spark, 2, 70, 5).write.parquet(second)
    store = SketchStore(spark, path)
    store.add(spark.read.parquet(first), "a")
    plan = column_sketches(spark.read.parquet(second), "b")._jdf.queryExecution().executedPlan().toString()
    assert first not in plan and plan.count("FileScan") == 1
    store.add(spark.read.parquet(second), "b")
    store.add(spark.read.parquet(second), "b")
    profile = store.profile({"median": 0.5})
    assert {r["n"] for r in profile.collect()} == {120}
    scanned = profile._jdf.queryExecution().executedPlan().toString()
    assert first.split("/")[-1] not in scanned and second.split("/")[-1] not in scanned
    assert {r["n"] for r in store.profile({}, ["b"]).collect()} == {70}


def test_empty_and_narrower_extracts(spark):
    store = SketchStore(spark, scratch_path(spark, "sketches"))
    store.add(extract(spark, 1, 40, 5), "a")
    store.add(extract(spark, 1, 40, 5).where("false"), "none")
    store.add(spark.createDataFrame([(1,)], "n long"), "narrow")
    got = {r["column"]: r for r in store.profile({"median": 0.5}).collect()}
    assert {r["n"] for r in got.values()} == {41} and got["n"]["nulls"] == 0 and got["x"]["nulls"] >= 1
    assert len(sketches.NUMERIC) == 4


@pytest.fixture()
def store(spark):
    store = LookupStore(spark, scratch_path(spark, "lookup"), "k string, v int", "k", 4)
    store.add(spark.createDataFrame([("a", 2), ("a", 1), ("b", None), (None, 9)], "k string, v int"), [F.col("v").isNull(), "v"])
    return store


def test_batches_add_new_keys_only(spark, store):
    more = spark.createDataFrame([("a", 0), ("c", 5), ("c", 4), ("d", 7)], "k string, v int")
    store.add(more)
    store.add(more)  # again, as after a failure
    assert sorted(map(tuple, store.table().collect())) == [("a", 1), ("b", None), ("c", 4), ("d", 7)]
    asked = spark.createDataFrame([("a",), ("z",), ("z",), (None,), ("b",)], "k string")
    assert [r["k"] for r in store.missing(asked).collect()] == ["z"]
    assert sorted(map(str, map(tuple, store.join(asked).collect()))) == sorted(map(str, [("a", 1), ("b", None), ("z", None), ("z", None), (None, None)]))


def test_the_store_does_not_move(spark, store):
    seen = []
    asked = settle(spark.range(100).selectExpr("string(id) as k"))
    for df in (store.missing(asked), store.join(asked)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        below = plan[plan.index("Bucketed: true") - 2000 : plan.index("Bucketed: true")]
        seen.append(plan)
        store_side = below[below.rindex("FileScan") - 400 :]
        assert "Exchange" not in store_side.split("Sort [")[-1]
    assert all("SortMergeJoin" in plan for plan in seen)


def test_reopening(spark, store):
    path = scratch_path(spark, "lookup")
    first = LookupStore(spark, path, "k string, v int", "k", 4)
    first.add(spark.createDataFrame([("a", 1)], "k string, v int"))
    assert LookupStore(spark, path, "k string, v int", "k", 4).table().count() == 1
    for args in (("k string, v int", "k", 8), ("k string, v long", "k", 4), ("k string, v int", "v", 4)):
        with pytest.raises(ValueError):
            LookupStore(spark, path, *args)
