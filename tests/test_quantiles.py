import random

import numpy as np
import pytest

from assay.operators import quantiles
from assay.operators.outliers import flag_iqr, flag_zscore
from assay.operators.quantiles import exact_quantiles, group_median, sketched_quantiles
from assay.session import settle

PROBS = {"p0": 0.0, "p05": 0.05, "q1": 0.25, "m": 0.5, "q3": 0.75, "p95": 0.95, "p1": 1.0}


def values(kind, n=3000):
    r = random.Random(5)
    return {
        "normal": [r.gauss(0, 1) for _ in range(n)],
        "ties": [float(r.choice([1, 1, 1, 2, 3, 9])) for _ in range(n)],
        "one": [4.5] * n,
        "outlier": [r.random() for _ in range(n)] + [1e12, -1e15],
        "scales": [r.choice([-1, 1]) * 10.0 ** r.uniform(-30, 30) for _ in range(n)],
        "hot": [7.0] * n + [r.uniform(0, 100) for _ in range(n)],
        "few": [3.0, 1.0],
        "single": [2.0],
    }[kind]


@pytest.mark.parametrize(
    "kind, leaf, bins",
    [("ties", 10, 8), ("outlier", 10, 4096), ("scales", 10, 256), ("hot", 10, 256), ("few", 1, 2),
     ("single", 1, 2), ("normal", 10**6, 4096), ("one", 10**6, 4096)],
)
def test_equals_numpy(frame, kind, leaf, bins):
    data = values(kind)
    df = frame([(v,) for v in data] + [(None,), (float("nan"),)], "x double")
    row = exact_quantiles(df, "x", PROBS, leaf_rows=leaf, bins=bins, sketch_k=0).head()
    for name, p in PROBS.items():
        assert row[name] == pytest.approx(np.quantile(data, p), rel=1e-12), name


@pytest.mark.parametrize("kind", ["normal", "ties", "one", "outlier", "scales", "hot", "few", "single"])
@pytest.mark.parametrize("discrete", [False, True])
def test_seeded_equals_numpy(frame, monkeypatch, kind, discrete):
    monkeypatch.setattr(quantiles, "_narrowed", None)  # the sketch is enough
    data = values(kind)
    df = frame([(v,) for v in data] + [(None,), (float("nan"),)], "x double").repartition(3)
    row = exact_quantiles(df, "x", PROBS, discrete=discrete, sketch_k=400, margin=0.02).head()
    for name, p in PROBS.items():
        want = np.quantile(data, p, method="inverted_cdf" if discrete else "linear")
        assert row[name] == pytest.approx(want, rel=1e-12), name


@pytest.mark.parametrize("options", [{"sketch_k": 8, "margin": 0.0014}, {"seeded_rows": 0}])
def test_missed_ranks_and_very_large_groups_are_narrowed(frame, monkeypatch, options):
    used = []
    narrowed = quantiles._narrowed
    monkeypatch.setattr(quantiles, "_narrowed", lambda *a: used.append(1) or narrowed(*a))
    data = values("normal")
    row = exact_quantiles(frame([(v,) for v in data], "x double").repartition(4), "x", PROBS, **options).head()
    assert used
    for name, p in PROBS.items():
        assert row[name] == pytest.approx(np.quantile(data, p), rel=1e-12), name


def test_column_is_read_twice(spark, monkeypatch):
    """Once for the sketch and once for the counts, which shuffle a small part of the values."""
    plans = []

    def recorded(df, label="table"):
        out = settle(df, label)
        plans.append((label, df._jdf.queryExecution().executedPlan().toString(), out.count()))
        return out

    monkeypatch.setattr(quantiles, "settle", recorded)
    df = spark.range(100_000, numPartitions=4).selectExpr("id % 3 as g", "cast(hash(id) as double) as x")
    got = {r["g"]: r["m"] for r in exact_quantiles(df, "x", {"m": 0.5}, "g").collect()}
    assert [label for label, *_ in plans] == ["values", "seeds", "found"]
    assert all(plan.count("assay-values") == 1 for label, plan, _ in plans if label != "values")
    everything = df.toPandas()
    assert got == {g: pytest.approx(v) for g, v in everything.groupby("g")["x"].median().items()}


def test_discrete_quantiles(frame):
    data = values("ties", 500) + values("normal", 500)
    df = frame([(v,) for v in data], "x double")
    row = exact_quantiles(df, "x", PROBS, discrete=True, leaf_rows=50, bins=64, sketch_k=0).head()
    for name, p in PROBS.items():
        assert row[name] == np.quantile(data, p, method="inverted_cdf"), name


@pytest.mark.parametrize("sketch_k", [0, 50])
def test_groups_with_null_keys_and_empty_groups(frame, sketch_k):
    groups = {"a": values("normal", 500), None: values("ties", 400), "c": [1.0, 2.0]}
    rows = [(g, v) for g, data in groups.items() for v in data] + [("empty", None)]
    df = frame(rows, "g string, x double")
    options = {"leaf_rows": 20, "bins": 5, "sketch_k": sketch_k}
    got = {r["g"]: r for r in exact_quantiles(df, "x", {"m": 0.5, "q3": 0.75}, "g", **options).collect()}
    assert set(got) == set(groups)
    for g, data in groups.items():
        assert got[g]["m"] == pytest.approx(np.quantile(data, 0.5))
        assert got[g]["q3"] == pytest.approx(np.quantile(data, 0.75))


@pytest.mark.parametrize("sketch_k", [0, 50])
def test_infinite_values_are_ordered(frame, sketch_k):
    df = frame([(float("-inf"),), (1.0,), (2.0,), (3.0,), (float("inf"),)], "x double")
    options = {"leaf_rows": 1, "bins": 4, "sketch_k": sketch_k}
    assert exact_quantiles(df, "x", {"m": 0.5, "q1": 0.25}, **options).head().asDict() == {"m": 2.0, "q1": 1.0}


def test_no_values(frame):
    assert exact_quantiles(frame([(None,)], "x double"), "x", {"m": 0.5}).count() == 0


def test_sketch_is_within_its_error(frame):
    data = sorted(values("normal"))
    row = sketched_quantiles(frame([(v,) for v in data], "x double"), "x", {"m": 0.5}, relative_error=0.01).head()
    assert abs(data.index(row["m"]) - 1500) <= 31


def test_group_median_is_discrete(frame):
    df = frame([("a", 1.0), ("a", 2.0), ("b", 5.0), ("c", None), (None, 4.0)], "g string, x double")
    wanted = {"a": 1.0, "b": 5.0, "c": None, None: 4.0}
    assert dict(map(tuple, group_median(df, "g", "x").collect())) == wanted
    assert dict(map(tuple, group_median(df, "g", "x", accuracy=100).collect())) == wanted


def test_zscore_flags(frame):
    rows = [("a", float(i % 3)) for i in range(50)] + [("a", 100.0), ("b", 5.0), ("b", 5.0), ("c", 1.0), (None, None)]
    df = frame(rows, "g string, x double")
    flagged = flag_zscore(df, "x", "g").where("x_outlier").collect()
    assert [(r["g"], r["x"]) for r in flagged] == [("a", 100.0)]
    overall = flag_zscore(df, "x").where("x_outlier").collect()
    assert [(r["g"], r["x"]) for r in overall] == [("a", 100.0)]
    assert flag_zscore(df, "x").count() == len(rows)


def test_iqr_flags(frame):
    rows = [("a", float(i)) for i in range(100)] + [("a", 500.0), ("a", -300.0), ("a", None), (None, 1.0)]
    df = frame(rows, "g string, x double")
    for options in ({}, {"by": "g"}, {"relative_error": 0.001}):
        out = flag_iqr(df, "x", **options)
        assert sorted(r["x"] for r in out.where("x_outlier").collect()) == [-300.0, 500.0]
        assert out.where("x_outlier is null").count() == 0 and out.count() == len(rows)
    # On the fence is not outside.
    fence = frame([(v,) for v in [1.0, 2.0, 3.0, 4.0, 5.0, 8.0]], "x double")
    assert flag_iqr(fence, "x", 1.5).where("x_outlier").count() == 0
