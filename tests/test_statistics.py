import datetime
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from assay.operators import aggregates as A
from assay.operators import errors as E
from assay.operators import ordering as O
from assay.operators import trends as Tr
from assay.operators.gram import gram
from assay.plans.checks import ColumnRules, Expectation, gate, proceed, violations


@pytest.fixture(scope="module")
def data():
    r = random.Random(3)
    rows = []
    for i in range(400):
        x = r.uniform(40, 99)
        rows.append((i, "ab"[i % 2], x, 2000 + 30 * x + 0.4 * x * x + r.gauss(0, 50), r.uniform(1, 5)))
    return rows


@pytest.fixture(scope="module")
def table(spark, data):
    return spark.createDataFrame(data, "i int, g string, x double, y double, z double").cache()


def test_profile(frame):
    df = frame([("2017-01", 1.0, None), (" ", None, 3), ("01 TO 03", 2.5, 3), (None, 2.5, 4)], "s string, d double, n int")
    got = {r["column"]: r.asDict() for r in A.profile(df, approx=False).collect()}
    assert (got["s"]["nulls"], got["s"]["n"], got["s"]["type"]) == (2, 4, "string")
    assert (got["s"]["year_month_pct"], got["s"]["x_to_y_pct"], got["s"]["unit_text_pct"]) == (50.0, 50.0, 0.0)
    assert (got["d"]["min_value"], got["d"]["max_value"], got["d"]["n_distinct"]) == (1.0, 2.5, 2)
    assert (got["n"]["nulls"], got["n"]["null_pct"]) == (1, 25.0)
    assert A.profile(df).count() == 3


def test_exact_profile_counts_each_column_alone(frame, spark):
    df = frame([("2020-01", 1.0), ("2020-01", float("nan")), (" ", float("nan")), (None, None), ("1 TO 3", 1.0)], "a string, b double")
    whole = A.profile(df, approx=False)
    assert "Expand" not in whole._jdf.queryExecution().optimizedPlan().toString()
    a, b = (r.asDict() for r in whole.orderBy("column").collect())
    assert (a["n"], a["nulls"], a["n_distinct"], a["x_to_y_pct"]) == (5, 2, 3, pytest.approx(100 / 3))
    assert (a["year_month_pct"], a["min_value"]) == (pytest.approx(200 / 3), None)
    assert (b["n"], b["nulls"], b["n_distinct"], b["min_value"], b["null_pct"]) == (5, 1, 2, 1.0, 20.0)
    empty = A.profile(df.where("false"), approx=False).collect()
    assert [(r["n"], r["nulls"], r["n_distinct"], r["min_value"]) for r in empty] == [(0, 0, 0, None)] * 2


def test_null_counts(frame):
    df = frame([("", 1), (None, None)], "s string, n int")
    assert dict(map(tuple, A.null_counts(df).collect())) == {"s": 1, "n": 1}
    assert dict(map(tuple, A.null_counts(df, blanks=True).collect())) == {"s": 2, "n": 1}


def test_histogram_covers_everything(frame):
    df = frame([(float(v),) for v in range(101)] + [(None,)], "x double")
    rows = {r["bin"]: r for r in A.histogram(df, "x", 10).collect()}
    counts, edges = np.histogram(range(101), 10)
    assert [rows[i]["n"] for i in range(10)] == list(counts)
    assert rows[9]["high"] == pytest.approx(edges[-1])
    assert A.histogram(frame([(2.0,), (2.0,)], "x double"), "x", 10).collect()[0]["n"] == 2


def test_box_summary(frame):
    values = [1.0, 2.0, 3.0, 4.0, 5.0, 40.0]
    df = frame([("a", v) for v in values] + [(None, 7.0), ("b", None)], "g string, x double")
    row = {r["g"]: r for r in A.box_summary(df, "g", "x").collect()}
    assert row["a"]["median"] == 3.5 and row["a"]["whisker_high"] == 5.0 and row["a"]["whisker_low"] == 1.0
    assert row[None]["median"] == 7.0 and "b" not in row


def test_correlations(table, data):
    m = np.corrcoef(np.array([r[2:] for r in data]).T)
    got = {(r["a"], r["b"]): r["r"] for r in A.corr_matrix(table, ["x", "y", "z"]).collect()}
    assert got["x", "y"] == pytest.approx(m[0, 1]) and got["z", "y"] == pytest.approx(m[1, 2])
    assert len(got) == 9
    pairs = A.high_corr(A.corr_matrix(table, ["x", "y", "z"]), 0.85, ["y", "x", "z"])
    assert [(r["a"], r["b"]) for r in pairs.collect()] == [("y", "x")]
    assert [r[0] for r in A.collinear_drops(pairs, [("x", "y", "x"), ("x", "z", "z")]).collect()] == ["x"]


def test_correlations_without_variance(table, frame):
    wide = table.select("x", "y", F.lit(2.0).alias("one"), F.lit(float("nan")).alias("odd"), *[(F.col("z") * i + F.col("x")).alias(f"z{i}") for i in range(1, 13)])
    columns = [c for c in wide.columns if c != "odd"]
    matrix = A.corr_matrix(wide, columns)
    got = {(r["a"], r["b"]): r["r"] for r in matrix.collect()}
    assert len(got) == len(columns) ** 2 and got["x", "x"] == 1.0
    assert all(got["one", c] is None and got[c, "one"] is None for c in columns)
    assert A.high_corr(matrix, 0.0).where("a = 'one' or b = 'one'").isEmpty()
    one, odd, x = [r["r"] for r in A.corr_with(wide, ["one", "odd", "x"], "x").orderBy("feature").collect()]
    assert one is None and odd is None and x == pytest.approx(1.0)
    assert A.high_corr(frame([("a", "b", float("nan")), ("a", "c", 0.9)], "a string, b string, r double")).count() == 1
    empty = A.corr_matrix(wide.where("false"), ["x", "y"])
    assert empty.count() == 4 and empty.where("r is not null").isEmpty() and A.high_corr(empty).isEmpty()


def test_hundreds_of_columns(spark):
    """300 columns in one aggregate; far-off, tiny, constant and repeated ones keep their digits."""
    k, n = 300, 400
    rng = np.random.default_rng(8)
    x = rng.normal(size=(n, k)) * 10.0 ** rng.integers(-6, 7, k) + 10.0 ** rng.integers(0, 6, k)
    x[:, 1:60] += x[:, :1] * 3
    x[:, 7], x[:, 9] = 0.1, x[:, 8]
    columns = [f"c{i}" for i in range(k)]
    df = spark.createDataFrame(pd.DataFrame(x, columns=columns)).repartition(4)
    got = gram(df, columns)
    varied = [i for i in range(k) if i != 7]
    assert got.n == n and got.varies().sum() == k - 1
    assert np.allclose(got.correlation()[np.ix_(varied, varied)], np.corrcoef(x[:, varied].T), atol=1e-9)
    assert np.allclose(got.raw_products(), x.T @ x, rtol=1e-9)
    matrix = A.corr_matrix(df, columns)
    assert matrix.count() == k * k and matrix.where("r is null").count() == 2 * k - 1


def test_vif_of_combinations_is_infinite(table):
    got = {r["feature"]: r["vif"] for r in Tr.vif(table.withColumn("w", F.col("x") * 2), ["x", "y", "w"]).collect()}
    assert got["x"] == got["w"] == float("inf")
    plain = {r["feature"]: r["vif"] for r in Tr.vif(table, ["x", "y"]).collect()}
    assert got["y"] == pytest.approx(plain["y"])


def test_small_and_large_shares(spark):
    df = spark.range(200_000).selectExpr("id").union(spark.sql("select cast(null as bigint)"))
    assert 1 <= O.sample_by_key(df, "id", 4e-5).count() <= 25
    assert O.sample_by_key(df, "id", 1.0).count() == 200_001 and O.sample_by_key(df, "id", 0.0).isEmpty()
    train, test = O.split_by_key(df, "id", 0.9999)
    assert train.count() + test.count() == 200_001 and 1 <= test.count() <= 60
    with pytest.raises(ValueError):
        O.sample_by_key(df, "id", 1.5)


def test_vif_is_uncentered(table, data):
    rows = np.array([r[2:] for r in data])
    got = {r["feature"]: r["vif"] for r in Tr.vif(table.withColumn("c", F.lit(3.0)), ["x", "y", "z", "c"]).collect()}
    assert set(got) == {"x", "y", "z"}
    for i, name in enumerate(["x", "y", "z"]):
        others = np.delete(rows, i, 1)
        fit = others @ np.linalg.lstsq(others, rows[:, i], rcond=None)[0]
        r2 = 1 - ((rows[:, i] - fit) ** 2).sum() / (rows[:, i] ** 2).sum()
        assert got[name] == pytest.approx(1 / (1 - r2), rel=1e-6)
    assert Tr.vif(table.limit(5), ["x", "y"]).count() == 0


def test_trends(table, data):
    x, y = np.array([r[2] for r in data]), np.array([r[3] for r in data])
    c2, c1, c0 = np.polyfit(x, y, 2)
    for r in Tr.quadratic_fit(table, "x", "y", 50).collect():
        assert r["y"] == pytest.approx(c2 * r["x"] ** 2 + c1 * r["x"] + c0, rel=1e-8)
    assert Tr.slope(table, "x", "y").head()["slope"] == pytest.approx(np.polyfit(x, y, 1)[0])
    assert {r["g"]: r["n"] for r in Tr.slope(table, "x", "y", "g", 50).collect()} == {"a": 200, "b": 200}
    assert Tr.slope(table, "x", "y", "g", 200).count() == 0
    low = x < 60
    seg = Tr.segment_slope(table, "x", "y").head()
    assert seg["slope_below"] == pytest.approx(np.polyfit(x[low], y[low], 1)[0])
    assert seg["slope_above"] == pytest.approx(np.polyfit(x[~low], y[~low], 1)[0])
    assert Tr.segment_slope(table, "x", "y", at=41.0).head()["slope_below"] is None


def test_metrics_match_the_evaluator(table):
    df = table.withColumn("prediction", F.col("y") * 1.02 + 5)
    row = E.regression_metrics(df, "y").head()
    for name in ("rmse", "mae", "r2"):
        judge = RegressionEvaluator(labelCol="y", predictionCol="prediction", metricName=name)
        assert row[name] == pytest.approx(judge.evaluate(df))
    perfect = E.regression_metrics(df.withColumn("prediction", F.col("y")), "y").head()
    assert (perfect["rmse"], perfect["r2"]) == (0.0, 1.0)


def test_errors_by_group_and_zero_actual(frame):
    day = datetime.date(2020, 1, 1)
    rows = [("a", 100.0, 90.0, day)] * 50 + [("b", 100.0, 130.0, day)] * 49 + [("c", 0.0, 1.0, day)]
    res = E.residuals(frame(rows, "g string, y double, prediction double, d date"), "y")
    assert [(r["g"], r["mape"], r["n"]) for r in E.error_by(res, "g", 50).collect()] == [("a", 10.0, 50)]
    assert E.error_by(res.where("g = 'c'"), "g").head()["mape"] is None
    assert E.error_by_month(res, "d").head()["month"] == "2020-01"
    one = E.residual_summary(res).head()
    assert one["median_abs_error"] == np.median([10.0] * 50 + [30.0] * 49 + [1.0])


def test_compare_metrics(frame):
    a, b = frame([("rmse", 10.0), ("r2", 0.0)], "metric string, value double"), frame([("rmse", 12.0), ("r2", 0.5)], "metric string, value double")
    got = {r["metric"]: (r["delta"], r["delta_pct"]) for r in E.compare_metrics(a, b).collect()}
    assert got == {"rmse": (2.0, 20.0), "r2": (0.5, None)}


def test_gate_and_violations(frame):
    df = frame([(1.0, 0), (float("nan"), 2), (None, 1), (-1.0, None)], "d double, f int")
    rules = ColumnRules(("d",), ("d",), ("d",), ("f",), {"f": (0, 1)})
    assert [tuple(r) for r in violations(df, rules).collect()] == [
        ("d", "null", 1), ("d", "nan", 1), ("d", "negative", 1), ("f", "not_binary", 1), ("f", "out_of_range", 1),
    ]
    passed = gate(df, [Expectation("rows", F.count("*"), ">=", 4)])
    assert proceed(passed) and not proceed(gate(df, [Expectation("rows", F.count("*"), ">=", 5)]))
    empty = gate(df.limit(0), [Expectation("mean", F.avg("d"), ">=", 0)])
    assert empty.head()["passed"] is False


def test_quality_stats(frame):
    df = frame([("a", 2000), ("a", 2002), ("b", 2001), (None, 1999)], "k string, y int")
    assert tuple(A.quality_stats(df, "k", "y").head()) == (4, 1, 2, 1.5, 1999, 2002)
    assert dict(map(tuple, A.value_counts(df, "k").collect())) == {"a": 2, "b": 1, "Unknown": 1}


def test_splits_are_disjoint_complete_and_stable(spark):
    df = spark.range(5000)
    train, test = O.split_by_key(df, "id", 0.8)
    assert train.count() + test.count() == 5000 and train.intersect(test).isEmpty()
    assert abs(train.count() - 4000) < 150
    again, _ = O.split_by_key(df.repartition(13), "id", 0.8)
    assert again.exceptAll(train).isEmpty()
    sample = O.sample_by_key(df, "id", 0.03)
    assert 80 < sample.count() < 230 and sample.exceptAll(O.sample_by_key(df.repartition(3), "id", 0.03)).isEmpty()
    assert O.sample_n(df, "id", 10).count() == 10


def test_temporal_split(frame):
    days = [(datetime.date(2020, m, 1),) for m in range(1, 13)] + [(None,)]
    df = frame(days, "d date")
    train, hold = O.temporal_split(df, "d", 6)
    assert (train.count(), hold.count()) == (3, 9)
    report = O.split_report(df, "d", 6)
    O.check_no_overlap(report)
    assert {r["part"]: r["share"] for r in report.collect()} == {"train": 0.25, "holdout": 0.75}
    with pytest.raises(ValueError):
        O.check_no_overlap(report.where("part = 'train'"))


def test_top_k_breaks_ties_by_key(frame):
    df = frame([("a", 1.0), ("b", 1.0), ("c", 2.0), ("d", None)], "g string, v double")
    assert [r["g"] for r in O.top_k(df, "v", 2, "g").collect()] == ["c", "a"]
    assert [r["g"] for r in O.top_k(df, "v", 2, "g", ascending=True).collect()] == ["a", "b"]
    assert [r["g"] for r in O.sort_abs(df, "v", "g").collect()] == ["c", "a", "b", "d"]


def test_keep_top_groups(frame):
    df = frame([("a", 1.0), ("a", 9.0), ("b", 6.0), ("c", 2.0)], "g string, v double")
    assert {r["g"] for r in A.keep_top_groups(df, "g", "v", 1).collect()} == {"b"}
    assert A.keep_top_groups(df, "g", "v", 2).count() == 3
