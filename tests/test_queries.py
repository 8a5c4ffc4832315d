"""Every registered query against its SQL, and what its physical plans must not contain."""

import os
import re
import sys

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from assay.queries import REGISTRY
from assay.session import settle

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from check import compare, duck  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
#: Queries that fit many models; `tools/check.py` compares them, `test_models.py` tests their operators on small tables.
MODELS = {"random_forest", "gbt", "cross_validate", "feature_importance", "train_compare", "oot_validation"}
UNWANTED = re.compile(r"CartesianProduct|BroadcastNestedLoopJoin|BatchEvalPython|ArrowEvalPython|MapInPandas")
# Windows without partitions are allowed on calendar tables and lists of models only.
SMALL_WINDOWS = {"clamped_year_join", "feature_engineer", "feature_report", "feature_validate", "model_ranking"}

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the given tables")


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.fixture()
def plans(monkeypatch):
    """Plans of the intermediate tables that a query writes."""
    seen = []

    def recorded(df, label="table"):
        seen.append(df._jdf.queryExecution().executedPlan().toString())
        return settle(df, label)

    for module in list(sys.modules.values()):
        if getattr(module, "__name__", "").startswith("assay.") and getattr(module, "settle", None) is settle:
            monkeypatch.setattr(module, "settle", recorded)
    return seen


@pytest.mark.parametrize("key", sorted(set(REGISTRY) - MODELS))
def test_query(spark, con, plans, key):
    df = queries()[key](spark, FOLDER)
    # At this size no group of `error_by_group` has 50 rows, so both sides are empty there.
    assert compare(df, con, oracle_sql().get(key)).startswith("EMPTY" if key == "error_by_group" else "ok")
    for plan in [*plans, df._jdf.queryExecution().executedPlan().toString()]:
        assert not UNWANTED.search(plan)
        if key not in SMALL_WINDOWS:
            assert not re.search(r"Window \[[^\n]*\n(?:[^\n]*\n){0,2}[^\n]*SinglePartition", plan)


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["month", "flat_type", "median_price", "trend"] and not df.isEmpty()


def test_every_query_has_sql():
    assert not [key for key, (_, sql) in REGISTRY.items() if not sql]
    assert set(oracle_sql()) <= set(queries())


def test_filters_reach_the_scan(spark):
    from assay.operators.columns import range_filter

    df = spark.read.parquet(f"{FOLDER}/lineitem.parquet")
    plan = range_filter(df, "l_quantity", 10, 20).select("l_quantity", "l_tax")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(l_quantity,10.0)" in plan and "ReadSchema: struct<l_quantity:double,l_tax:double>" in plan
