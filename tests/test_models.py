import datetime
import random
import threading
import time

import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from assay.plans import training as M
from assay.queries import models
from assay.queries.registry import Inputs
from assay.session import scratch_path


@pytest.fixture(scope="module")
def deals(spark):
    r = random.Random(11)
    rows = []
    for i in range(600):
        area, town = r.uniform(30, 150), r.choice(["A", "A", "B", None])
        price = 1000 * area + (20000 if town == "A" else 0) + r.gauss(0, 500)
        month = datetime.date(2015 + i % 6, 1 + i % 12, 1)
        rows.append((i, town, "x", "m", month, area, float(3 * (i % 5) + 2), price))
    schema = "id int, town string, flat_type string, flat_model string, month date, floor_area_sqm double, storey_midpoint double, resale_price double"
    return spark.createDataFrame(rows, schema)


def test_indexing_order_and_unseen(frame):
    train = frame([("b",), ("a",), ("a",), ("c",), (None,)], "t string")
    model = M.index_categories(train, "t")
    got = {r["t"]: r["t_index"] for r in model.transform(frame([("a",), ("b",), ("c",), ("z",), (None,)], "t string")).collect()}
    assert got == {"a": 0.0, "b": 1.0, "c": 2.0, "z": 3.0, None: 3.0}
    assert [tuple(r) for r in M.label_table(model, train).collect()] == [("t", 0, "a"), ("t", 1, "b"), ("t", 2, "c")]


def test_assemble_skips_incomplete_rows(frame):
    df = frame([(1.0, 2.0), (None, 1.0), (float("nan"), 1.0)], "a double, b double")
    assert M.assemble(df, ["a", "b"]).count() == 1


def test_default_grids_are_full():
    assert [len(M.spec(n).param_maps()) for n in ("linear_regression", "random_forest", "gbt")] == [12, 8, 8]


def test_train_compare_rank_and_importance(deals):
    specs = [
        M.spec("linear_regression", grid={"regParam": [0.001, 1.0]}),
        M.spec("random_forest", grid={"numTrees": [3], "maxDepth": [3]}),
    ]
    result = M.train_and_compare(deals, specs, "id", keep=["town"], folds=2)
    ranked = M.rank_models(result.metrics).collect()
    assert [r["place"] for r in ranked] == [1, 2] and ranked[0]["rmse"] <= ranked[1]["rmse"]
    assert result.best() == "linear_regression" and ranked[0]["r2"] > 0.95
    assert ranked[0]["params"] in [r["params"] for r in result.combinations.collect()]
    assert result.combinations.count() == 3
    assert {r["model"]: r["n"] for r in result.importances().groupBy("model").agg(F.count("*").alias("n")).collect()} == {
        name: len(result.inputs) for name in result.models
    }
    for model in result.models.values():
        parts = M.importances(model, result.inputs, deals).collect()
        assert sum(r["importance"] for r in parts) == pytest.approx(1.0)
        assert [r["importance"] for r in parts] == sorted((r["importance"] for r in parts), reverse=True)
    report = M.residual_report(result.predictions("linear_regression"), "resale_price", ["town"], min_n=1)
    assert report["histogram"].agg(F.sum("n")).head()[0] == result.test.count()
    assert report["by_town"].count() == 3


def test_out_of_time(deals):
    model = M.spec("linear_regression", grid={"regParam": [0.01]})
    before = deals.sparkSession.createDataFrame([("rmse", 100.0)], "metric string, value double")
    out = M.out_of_time(deals, model, "month", "id", random_metrics=before, folds=2)
    split = {r["part"]: r for r in out["split"].collect()}
    assert split["train"]["high"] < split["holdout"]["low"]
    assert out["predictions"].count() == split["holdout"]["n"]
    assert {r["metric"] for r in out["metrics"].collect()} == {"rmse", "mae", "r2", "mape"}
    assert out["comparison"].count() == 1 and out["worst_town"].count() <= 10
    assert out["by_month"].agg(F.sum("n")).head()[0] == split["holdout"]["n"]


def test_comparing_queries_try_whole_grids_of_all_families(spark, monkeypatch):
    seen = []

    class Nothing:
        def save(self, path):
            pass

    def compared(rows, specs, key, keep):
        seen.append({s.name: len(s.param_maps()) for s in specs})
        return Nothing()

    monkeypatch.setattr(models, "_features", lambda t: None)
    monkeypatch.setattr(models, "_WRITTEN", {})
    monkeypatch.setattr(M, "train_and_compare", compared)
    monkeypatch.setattr(M.Comparison, "load", lambda spark, path: path)
    inputs = Inputs(spark, "/folder")
    assert models._compared(inputs) == models._compared(inputs)
    assert seen == [{"linear_regression": 12, "random_forest": 8, "gbt": 8}]


@pytest.fixture(scope="module")
def vectors(deals):
    train, test = deals.where("id % 4 > 0"), deals.where("id % 4 = 0")
    return M.vectorise(train, test, "id", "resale_price")


def test_errors_of_the_first_rounds_are_those_of_an_own_fit(vectors):
    model = M.spec("gbt", grid={"maxIter": [3, 7], "maxDepth": [2, 3], "stepSize": [0.3]})
    assert sorted(map(len, model.shared_fits())) == [2, 2]
    evaluator = RegressionEvaluator(labelCol="resale_price", predictionCol="prediction", metricName="rmse")
    maps = model.param_maps()
    for together in model.shared_fits():
        shared = M._errors(model, together, vectors.train, vectors.test, "resale_price")
        for i in together:
            own = evaluator.evaluate(model.estimator.fit(vectors.train, maps[i]).transform(vectors.test))
            assert shared[i] == pytest.approx(own, rel=1e-9)


def test_families_without_rounds_fit_each_combination():
    assert M.spec("random_forest").shared_fits() == [[i] for i in range(8)]
    assert M.spec("linear_regression").shared_fits() == [[i] for i in range(12)]
    assert sum(map(len, M.spec("gbt").shared_fits())) == 8 and len(M.spec("gbt").shared_fits()) == 4
    assert M.spec("gbt", grid={"maxDepth": [2, 3]}).shared_fits() == [[0], [1]]


def test_search_agrees_with_one_fit_after_another(vectors):
    grids = {"linear_regression": {"regParam": [0.001, 1.0]}, "gbt": {"maxIter": [2, 4], "maxDepth": [2]}}
    specs = [M.spec(name, grid=grid) for name, grid in grids.items()]
    best, combos = M.search(vectors.train, specs, "id", folds=2)
    evaluator = RegressionEvaluator(labelCol="resale_price", predictionCol="prediction", metricName="rmse")
    rows = vectors.train.withColumn("_fold", M.bucket_of("id", 2, seed=7))
    got = {(r["model"], r["combo"]): r["rmse"] for r in combos.collect()}
    for model in specs:
        for i, combination in enumerate(model.param_maps()):
            errors = [
                evaluator.evaluate(model.estimator.fit(rows.where(F.col("_fold") != k), combination).transform(rows.where(F.col("_fold") == k)))
                for k in range(2)
            ]
            assert got[model.name, i] == pytest.approx(sum(errors) / 2)
    assert set(best) == set(grids)


def test_small_tables_have_few_partitions(vectors, spark):
    assert vectors.train.rdd.getNumPartitions() == 1
    assert M.compact(spark.range(100, numPartitions=8), 10**9, 27).rdd.getNumPartitions() == 8


def test_comparison_comes_back_from_its_folder(deals, spark):
    specs = [M.spec("linear_regression", grid={"regParam": [0.01]}), M.spec("gbt", grid={"maxIter": [3]}), M.spec("random_forest", grid={"numTrees": [2]})]
    made = M.train_and_compare(deals, specs, "id", folds=2)
    path = scratch_path(spark, "comparison")
    made.save(path)
    loaded = M.Comparison.load(spark, path)
    assert loaded.inputs == made.inputs and list(loaded.models) == list(made.models)
    assert sorted(map(tuple, loaded.metrics.collect())) == sorted(map(tuple, made.metrics.collect()))
    for name in made.models:
        a, b = (sorted((r["id"], r["prediction"]) for r in x.predictions(name).collect()) for x in (made, loaded))
        assert a == b


def test_linear_search_fits_few_rows_with_the_same_moments(vectors, spark, monkeypatch):
    seen = []
    fit = M.LinearRegression.fit
    monkeypatch.setattr(M.LinearRegression, "fit", lambda self, rows, params=None: seen.append(rows.count()) or fit(self, rows, params))
    model = M.spec("linear_regression")
    assert model.by_moments and not M.spec("gbt").by_moments
    best, _ = M.search(vectors.train, [model], "id", folds=2)
    few = len(vectors.inputs) + 2
    assert seen == [few] * (2 * 12 + 1) and few < vectors.train.count()
    monkeypatch.undo()
    own = model.estimator.fit(vectors.train, model.param_maps()[0])
    made = M.condense(vectors.train.withColumn("_fold", F.col("id") % 2), model, "resale_price", 2)[-1].fit(model, model.param_maps()[0])
    assert made.stages[-1].intercept == pytest.approx(own.stages[-1].intercept)
    assert list(made.stages[-1].coefficients) == pytest.approx(list(own.stages[-1].coefficients), rel=1e-6, abs=1e-6)
    assert best["linear_regression"].transform(vectors.test).count() == vectors.test.count()


def test_one_final_fit_per_family(vectors, monkeypatch):
    rows = []
    fit = M.GBTRegressor.fit
    monkeypatch.setattr(M.GBTRegressor, "fit", lambda self, df, params=None: rows.append(df.count()) or fit(self, df, params))
    M.search(vectors.train, [M.spec("gbt", grid={"maxIter": [1, 2], "maxDepth": [1, 2], "stepSize": [0.1, 0.3]})], "id", folds=2)
    assert len(rows) == 4 * 2 + 1 and rows.count(vectors.train.count()) == 1


def test_training_rows_lie_evenly(spark, monkeypatch):
    monkeypatch.setattr(M, "PARTITION_BYTES", 1 << 16)
    rows = spark.range(2000, numPartitions=1).select("id", F.array(F.lit(1.0)).alias("x"))
    for width, parts in ((1, 1), (4, 2), (8, 4)):  # three partitions would be uneven on four cores
        even = M.settle_evenly(rows, 2000, width, "even").rdd.glom().map(len).collect()
        assert sum(even) == 2000 and len(even) == parts and max(even) - min(even) <= parts


def test_more_files_than_cores_are_read_in_equal_partitions(spark, monkeypatch):
    monkeypatch.setattr(M, "PARTITION_BYTES", 1 << 16)
    rows = spark.range(2000, numPartitions=1).select("id", F.array(F.lit(1.0)).alias("x"))
    assert M.wanted_partitions(2000, 17) == 5  # on four cores
    even = M.settle_evenly(rows, 2000, 17, "even").rdd.glom().map(len).collect()
    assert sum(even) == 2000 and len(even) == 4 and max(even) - min(even) <= 8


def test_forests_keep_nodes_where_they_are_few(spark, vectors):
    model = M.spec("random_forest")
    small, large = M.remembering(model, 1000, 4), M.remembering(model, 10**7, 4)
    assert small.estimator.getCacheNodeIds() and small.estimator.getMaxMemoryInMB() == M.SUMS_MB
    assert not model.estimator.getCacheNodeIds() and large is model
    limit = M.NODE_ID_BYTES * 4 // (4 * 200)
    assert M.remembering(model, limit, 4) is not model and M.remembering(model, limit, 4, at_once=2) is model
    assert M.remembering(M.spec("gbt"), 1000, 4).estimator.getCacheNodeIds() is False
    assert [M._described(c) for c in small.param_maps()] == [M._described(c) for c in model.param_maps()]
    # All rows and inputs at each node, so that no draw of inputs differs: the same trees with and without.
    whole = M.spec("random_forest", grid={"numTrees": [3], "maxDepth": [4]})
    whole.regressor.setFeatureSubsetStrategy("all")
    kept = M.remembering(whole, 1000, 4)
    a, b = (m.estimator.fit(vectors.train, m.param_maps()[0]) for m in (whole, kept))
    assert b.getCacheNodeIds() and [t.toDebugString.split("\n", 1)[1] for t in a.trees] == [t.toDebugString.split("\n", 1)[1] for t in b.trees]


def test_a_forest_on_all_rows_is_spread(vectors, monkeypatch):
    seen = {}
    for kind in (M.RandomForestRegressor, M.GBTRegressor):
        fit = kind.fit
        monkeypatch.setattr(kind, "fit", lambda self, df, params=None, fit=fit: seen.update({type(self).__name__: df.rdd.getNumPartitions()}) or fit(self, df, params))
    monkeypatch.setattr(M, "SPREAD_ROWS", 50)
    specs = [M.spec("random_forest", grid={"numTrees": [2], "maxDepth": [2]}), M.spec("gbt", grid={"maxIter": [1], "maxDepth": [1]}), M.spec("linear_regression")]
    fitted = M.fit_first(vectors.train, specs)
    assert list(fitted) == ["random_forest", "gbt", "linear_regression"] and fitted["random_forest"].getNumTrees == 2
    assert seen == {"RandomForestRegressor": 4, "GBTRegressor": 1}
    own = specs[1].estimator.fit(vectors.train, specs[1].param_maps()[0])
    assert fitted["gbt"].toDebugString.split("\n", 1)[1] == own.toDebugString.split("\n", 1)[1]
    seen.clear()
    M.search(vectors.train, specs[:1], "id", folds=2)
    assert seen == {"RandomForestRegressor": 4}


def test_heavy_jobs_take_more_slots(spark):
    running, most = [], []
    lock = threading.Lock()

    def job(name):
        with lock:
            running.append(name)
            most.append(sorted(running))
        time.sleep(0.2)
        with lock:
            running.remove(name)

    def run(slots):
        most.clear()
        jobs = [(name, lambda name=name: job(name)) for name in ("h1", "h2", "a", "b", "h3")]
        M._side_by_side(spark, jobs, lambda name, result: [], slots, lambda name: 2 if name[0] == "h" else 1)
        return max(sum(2 if n[0] == "h" else 1 for n in r) for r in most), {n for r in most for n in r}

    every = {"h1", "h2", "a", "b", "h3"}
    assert run(4) == (4, every) and run(3) == (3, every) and run(1) == (2, every)
