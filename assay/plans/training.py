"""Regression models on Spark MLlib: encoding, assembly, cross-validation, comparison, out-of-time."""

from __future__ import annotations

import math
from collections import deque
from collections.abc import Callable
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait
from dataclasses import dataclass, field, replace
from functools import partial, reduce

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import (
    OneHotEncoder,
    StandardScaler,
    StringIndexer,
    StringIndexerModel,
    VectorAssembler,
)
from pyspark.ml.linalg import DenseVector, VectorUDT
from pyspark.ml.regression import (
    GBTRegressionModel,
    GBTRegressor,
    LinearRegression,
    RandomForestRegressionModel,
    RandomForestRegressor,
)
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from assay.functions.text import bin_by
from assay.operators.aggregates import histogram
from assay.operators.columns import fill_unknown
from assay.operators.errors import (
    compare_metrics,
    error_by,
    error_by_month,
    metrics_long,
    regression_metrics,
    residual_summary,
    residuals,
)
from assay.operators.gram import Gram, gram_by
from assay.operators.ordering import bucket_of, check_no_overlap, split_by_key, split_report, temporal_split
from assay.plans.features import DEFAULT_INTERACTIONS, interactions
from assay.session import names, scratch_root, settle

#: Bytes of feature vectors that a partition of a training table holds about. Fits are many short jobs,
#: so small tables have few partitions and fits run side by side.
PARTITION_BYTES = 32 << 20
#: Bytes per core that the forests growing at one time may keep for the node of each row in each tree, and the
#: MB of sums that they then gather in one pass: so many stay in a core's cache.
NODE_ID_BYTES, SUMS_MB = 128 << 20, 4
#: Rows of a partition, at least, where a forest that is fitted alone is spread over the cores.
SPREAD_ROWS = 8192

# Parameter grids of the three model families.
GRIDS = {
    "linear_regression": {"regParam": [0.001, 0.01, 0.1, 1.0], "elasticNetParam": [0.0, 0.5, 1.0]},
    "random_forest": {"numTrees": [100, 200], "maxDepth": [5, 8], "minInstancesPerNode": [1, 5]},
    "gbt": {"maxIter": [100, 200], "maxDepth": [3, 5], "stepSize": [0.05, 0.1]},
}
# Storey bands and the model inputs.
STOREY_EDGES, STOREY_LABELS = [6, 12], ["low", "mid", "high"]
CATEGORICALS = ["town", "flat_type", "flat_model", "storey_range_bin"]
COLLINEAR = ["years_since_lease_start", "lease_commence_date"]
NUMERIC_INPUTS = [
    "floor_area_sqm", "remaining_lease_years", "transaction_year", "transaction_quarter",
    "storey_midpoint", "dist_nearest_mrt", "dist_nearest_school", "dist_nearest_supermarket",
    "dist_nearest_hawker", "dist_nearest_mall", "dist_nearest_ip_school",
    "dist_nearest_sap_school", "dist_nearest_auto_school", "has_ip_school_nearby",
    "has_sap_school_nearby", "has_autonomous_school_nearby", "hdb_rpi",
    "median_household_income", "total_population", "income_yoy_growth", "population_yoy_growth",
    "floor_area_x_remaining_lease", "town_x_flat_type_idx",
]


def index_categories(train: DataFrame, columns) -> StringIndexerModel:
    """One indexer for all columns, fitted on the training rows in one pass.

    Most frequent label first, ties by name. Unseen and null values get the index after the last label.
    """
    columns = names(columns)
    indexer = StringIndexer(
        inputCols=columns,
        outputCols=[f"{c}_index" for c in columns],
        handleInvalid="keep",
        stringOrderType="frequencyDesc",
    )
    return indexer.fit(train)


def one_hot(df: DataFrame, columns) -> DataFrame:
    """Encode `<c>_index` as the sparse vector `<c>_ohe`."""
    columns = names(columns)
    encoder = OneHotEncoder(
        inputCols=[f"{c}_index" for c in columns],
        outputCols=[f"{c}_ohe" for c in columns],
        handleInvalid="keep",
        dropLast=True,
    )
    return encoder.fit(df).transform(df)


def label_table(model: StringIndexerModel, like: DataFrame) -> DataFrame:
    """(column, index, label) of a fitted indexer."""
    rows = [
        (column, i, label)
        for column, labels in zip(model.getInputCols(), model.labelsArray)
        for i, label in enumerate(labels)
    ]
    return like.sparkSession.createDataFrame(rows, "column string, index int, label string")


def assemble(df: DataFrame, columns, out: str = "features") -> DataFrame:
    """Feature vector of the columns; rows with a null or NaN among them are skipped."""
    return VectorAssembler(inputCols=names(columns), outputCol=out, handleInvalid="skip").transform(df)


def scaler(column: str = "features", out: str = "scaled_features") -> StandardScaler:
    return StandardScaler(inputCol=column, outputCol=out, withStd=True, withMean=True)


def standardise(df: DataFrame, column: str = "features", out: str = "scaled_features") -> DataFrame:
    """(x - mean) / sample deviation of every vector entry."""
    return scaler(column, out).fit(df).transform(df)


@dataclass
class ModelSpec:
    """An estimator with its parameter grid.

    `rounds` names the parameter of a boosted model that only says where to stop: the model of fewer
    rounds is the beginning of that of more, so one fit serves all values of it.
    """

    name: str
    estimator: Estimator
    regressor: Estimator
    grid: dict = field(default_factory=dict)
    rounds: str | None = None

    @property
    def by_moments(self) -> bool:
        """Whether means and covariances of inputs and label decide the fit: least squares behind scaled columns."""
        *steps, last = self.estimator.getStages() if isinstance(self.estimator, Pipeline) else [self.estimator]
        if not isinstance(last, LinearRegression) or last.isSet("weightCol") or {"loss", "weightCol"} & set(self.grid):
            return False
        return last.getLoss() == "squaredError" and all(isinstance(step, StandardScaler) for step in steps)

    @property
    def is_forest(self) -> bool:
        return isinstance(self.regressor, RandomForestRegressor)

    def param_maps(self) -> list:
        builder = ParamGridBuilder()
        for parameter, values in self.grid.items():
            builder = builder.addGrid(self.regressor.getParam(parameter), values)
        return builder.build()

    def shared_fits(self) -> list[list[int]]:
        """Numbers of the combinations that one fit serves."""
        together: dict = {}
        for i, combination in enumerate(self.param_maps()):
            rest = tuple((p.name, v) for p, v in combination.items() if p.name != self.rounds)
            together.setdefault((rest, i if self.rounds not in self.grid else None), []).append(i)
        return list(together.values())


def spec(name: str, label: str = "resale_price", grid: dict | None = None, seed: int = 42) -> ModelSpec:
    """Specification of a model family; `grid` replaces the default parameter grid."""
    grid = GRIDS[name] if grid is None else grid
    if name == "linear_regression":
        regressor = LinearRegression(featuresCol="scaled_features", labelCol=label, maxIter=100)
        return ModelSpec(name, Pipeline(stages=[scaler(), regressor]), regressor, grid)
    kind = {"random_forest": RandomForestRegressor, "gbt": GBTRegressor}[name]
    regressor = kind(featuresCol="features", labelCol=label, seed=seed)
    return ModelSpec(name, regressor, regressor, grid, rounds="maxIter" if name == "gbt" else None)


def wanted_partitions(rows: int, width: int) -> int:
    """As few partitions as vectors of `width` numbers need."""
    return max(1, math.ceil(rows * (width + 2) * 8 / PARTITION_BYTES))


def compact(df: DataFrame, rows: int, width: int) -> DataFrame:
    """The table in as few partitions as its vectors of `width` numbers need; never more than it has."""
    return df.coalesce(wanted_partitions(rows, width))


def settle_evenly(df: DataFrame, rows: int, width: int, label: str) -> DataFrame:
    """The table written in files of the same number of rows and read in partitions of as many files each.

    A file of one row group is one task however large it is, so without this a few tasks read all rows of
    every job of a fit. A file per core is one partition when it is read; a divisor of that number is asked for.
    More files are a multiple of the cores: reading packs as many into each partition, so no core waits for a second round.
    """
    cores, wanted = df.sparkSession.sparkContext.defaultParallelism, wanted_partitions(rows, width)
    files = math.ceil(wanted / cores) * cores
    even = next((n for n in range(wanted, cores) if cores % n == 0), files)
    return settle(df.repartition(files), label).coalesce(even)


def remembering(model: ModelSpec, rows: int, cores: int, at_once: int = 1) -> ModelSpec:
    """A forest that keeps the node of each row in each tree, where those of all fits at one time take little memory.

    It does not walk from the roots again for every level, and passes are cheap enough to gather the sums of a few
    nodes at a time. Other models, and forests of larger tables, are as given.
    """
    if not model.is_forest:
        return model
    trees = max(model.grid.get("numTrees", [model.regressor.getNumTrees()]))
    if 4 * rows * trees * at_once > NODE_ID_BYTES * cores:
        return model
    forest = model.regressor.copy().setCacheNodeIds(True).setMaxMemoryInMB(SUMS_MB)
    return replace(model, estimator=forest, regressor=forest)


def fit_on_all(model: ModelSpec, combination: dict, df: DataFrame, rows: int) -> Model:
    """One combination fitted on the whole table; a forest is spread over the cores, as all its trees need every row in a pass."""
    wide = min(df.sparkSession.sparkContext.defaultParallelism, rows // SPREAD_ROWS)
    if model.is_forest and wide > df.rdd.getNumPartitions():
        df = df.repartition(wide)
    return model.estimator.fit(df, combination)


def _slots(df: DataFrame) -> int:
    """How many light fits of the table run at one time: twice as many as keep the cores busy, as they wait for the driver half of the time."""
    return max(1, 2 * df.sparkSession.sparkContext.defaultParallelism // df.rdd.getNumPartitions())


def _takes(model: ModelSpec) -> int:
    """Slots of a fit. A forest's tasks are long and hold a core all the time; the many short jobs of others would wait behind them."""
    return 2 if model.is_forest else 1


def fit_first(df: DataFrame, models: list[ModelSpec]) -> dict[str, Model]:
    """The first combination of each family fitted on all rows, side by side where the table has few partitions."""
    spark, rows, fitted = df.sparkSession, df.count(), {}
    cores = spark.sparkContext.defaultParallelism
    by_name = {m.name: remembering(m, rows, cores) for m in models}
    jobs = [(name, partial(fit_on_all, m, m.param_maps()[0], df, rows)) for name, m in by_name.items()]
    jobs.sort(key=lambda job: -_effort(by_name[job[0]], [0]))
    _side_by_side(spark, jobs, lambda name, model: fitted.update({name: model}) or [], _slots(df), lambda name: _takes(by_name[name]))
    return {m.name: fitted[m.name] for m in models}


def _side_by_side(spark: SparkSession, jobs: list, follow, slots: int, takes: Callable = lambda name: 1) -> None:
    """Run the (name, job) pairs in threads that have the caller's job properties, in their order.

    As many run at one time as take no more than the slots together, by `takes(name)`, or one alone.
    `follow(name, result)` is called here after each and gives the pairs that then come next, before those that wait.
    """
    if spark.sparkContext.getCheckpointDir() is None:
        # Boosting cuts its lineage there; without it every round sends all rounds before along.
        spark.sparkContext.setCheckpointDir(scratch_root(spark))
    waiting, running = deque(jobs), {}
    with ThreadPoolExecutor(max(1, slots)) as pool:
        try:
            while waiting or running:
                while waiting and (not running or sum(map(takes, [*running.values(), waiting[0][0]])) <= slots):
                    name, job = waiting.popleft()
                    running[pool.submit(inheritable_thread_target(spark)(job))] = name
                for done in wait(running, return_when=FIRST_COMPLETED).done:
                    waiting.extendleft(follow(running.pop(done), done.result()))
        finally:
            pool.shutdown(wait=True, cancel_futures=True)


def _errors(model: ModelSpec, combinations: list[int], train: DataFrame, held_out: DataFrame, label: str) -> dict[int, float]:
    """RMSE on the held-out rows of the combinations that one fit serves.

    The error of a boosted model of fewer rounds is that of the first rounds of the longest.
    """
    maps = model.param_maps()
    if model.rounds not in model.grid:
        (i,) = combinations
        evaluator = RegressionEvaluator(labelCol=label, predictionCol="prediction", metricName="rmse")
        return {i: evaluator.evaluate(model.estimator.fit(train, maps[i]).transform(held_out))}
    rounds = {i: maps[i][model.regressor.getParam(model.rounds)] for i in combinations}
    squares = model.estimator.fit(train, maps[_longest(model, combinations)]).evaluateEachIteration(held_out, "squared")
    return {i: math.sqrt(squares[n - 1]) for i, n in rounds.items()}


def _longest(model: ModelSpec, combinations: list[int]) -> int:
    """The combination with the most rounds."""
    maps = model.param_maps()
    return max(combinations, key=lambda i: maps[i][model.regressor.getParam(model.rounds)])


def _described(combination: dict) -> str:
    return ", ".join(f"{p.name}={v}" for p, v in sorted(combination.items(), key=lambda e: e[0].name))


@dataclass
class Condensed:
    """A table for models that only its means and covariances decide: the fitted scaling, and few rows with the same ones."""

    steps: list[Model]
    train: DataFrame
    held_out: DataFrame | None = None

    def fit(self, model: ModelSpec, combination: dict) -> PipelineModel:
        return PipelineModel([*self.steps, model.regressor.copy(combination).fit(PipelineModel(self.steps).transform(self.train))])

    def error(self, model: ModelSpec, combination: dict, label: str) -> float:
        """RMSE on the held-out rows."""
        evaluator = RegressionEvaluator(labelCol=label, predictionCol="prediction", metricName="rmse")
        return evaluator.evaluate(self.fit(model, combination).transform(self.held_out))


def condense(rows: DataFrame, model: ModelSpec, label: str, folds: int, fold: str = "_fold") -> list[Condensed]:
    """The training rows of each fold beside its held-out ones, and at the end all rows, condensed.

    A pass over the rows gives every fold's sums and products; those of a training set are the sum of the other
    folds'. The scaling is fitted on the rows themselves, once per set. So the passes do not depend on the size of the grid.
    """
    stages = model.estimator.getStages()[:-1] if isinstance(model.estimator, Pipeline) else []
    features = stages[0].getInputCol() if stages else model.regressor.getFeaturesCol()
    grams = gram_by(rows, features, label, fold, folds)

    def few(gram: Gram) -> DataFrame:
        values = [(DenseVector(row[:-1]), float(row[-1])) for row in gram.like_rows()]
        schema = StructType([StructField(features, VectorUDT()), StructField(label, DoubleType())])
        return rows.sparkSession.createDataFrame(values, schema).coalesce(1)

    def of(train: DataFrame, whole: Gram, held_out: DataFrame | None = None) -> Condensed:
        return Condensed(Pipeline(stages=stages).fit(train).stages, few(whole), held_out)

    others = [reduce(Gram.__add__, grams[:k] + grams[k + 1 :]) for k in range(folds)]
    sets = [of(rows.where(F.col(fold) != k), others[k], few(grams[k])) for k in range(folds)]
    return [*sets, of(rows, reduce(Gram.__add__, grams))]


def search(
    df: DataFrame, models: list[ModelSpec], key: str, label: str = "resale_price", folds: int = 3, parallelism: int | None = None
) -> tuple[dict[str, Model], DataFrame]:
    """(the best model of each family by mean RMSE over the folds, one row per parameter combination).

    Folds come from the digest of a row key, so they do not depend on partitioning. The fits of all
    families, combinations and folds run side by side, the longest first, as many as keep the cluster's
    cores busy. The best of each family is fitted on all rows as soon as its own combinations have been tried.
    Models that means and covariances decide are fitted on few rows that have the same ones.
    """
    spark = df.sparkSession
    rows = df.withColumn("_fold", bucket_of(key, folds, seed=7).cast("int"))
    parallelism, cores = parallelism or _slots(df), spark.sparkContext.defaultParallelism
    n_rows = df.count() if any(m.is_forest for m in models) else 0
    models = [remembering(m, n_rows, cores, max(1, parallelism // _takes(m))) for m in models]
    condensed = {m.name: condense(rows, m, label, folds) for m in models if m.by_moments and folds > 1}

    def tried(m, fit, fold):
        if m.name in condensed:
            (i,) = fit
            return {i: condensed[m.name][fold].error(m, m.param_maps()[i], label)}
        return _errors(m, fit, rows.where(F.col("_fold") != fold), rows.where(F.col("_fold") == fold), label)

    def final(m):
        best = m.param_maps()[min(range(len(sums[m.name])), key=sums[m.name].__getitem__)]
        return condensed[m.name][-1].fit(m, best) if m.name in condensed else fit_on_all(m, best, df, n_rows)

    sums: dict = {m.name: [0.0] * len(m.param_maps()) for m in models}
    errors: dict = {}
    fitted: dict = {}
    by_name = {m.name: m for m in models}
    jobs = {(m.name, n, fold): (m, fit, fold) for m in models for n, fit in enumerate(m.shared_fits()) for fold in range(folds)}

    def follow(name, result):
        """What may begin after a job: the last of a family's errors decides its final fit."""
        if isinstance(name, str):
            fitted[name] = result
            return []
        errors[name] = result
        family = [job for job in jobs if job[0] == name[0]]
        if not all(job in errors for job in family):
            return []
        for job in family:  # in a fixed order, so that sums do not depend on which fit ended first
            for i, error in errors[job].items():
                sums[name[0]][i] += error / folds
        return [(name[0], lambda: final(by_name[name[0]]))]

    longest_first = [(job, partial(tried, *jobs[job])) for job in sorted(jobs, key=lambda job: -_effort(jobs[job][0], jobs[job][1]))]
    # Fits on few rows are all waiting for the driver, whatever the size of the table.
    few = [(job, run) for job, run in longest_first if job[0] in condensed]
    _side_by_side(spark, few, follow, max(parallelism, cores))
    others = [(job, run) for job, run in longest_first if job[0] not in condensed]
    _side_by_side(spark, others, follow, parallelism, lambda name: _takes(by_name[name if isinstance(name, str) else name[0]]))
    table = [(m.name, i, _described(c), float(sums[m.name][i])) for m in models for i, c in enumerate(m.param_maps())]
    metrics = spark.createDataFrame(table, "model string, combo int, params string, rmse double")
    return {m.name: fitted[m.name] for m in models}, metrics


def _effort(model: ModelSpec, combinations: list[int]) -> float:
    """What a fit costs, about: boosting makes its trees one after another, a forest side by side."""
    given = {p.name: v for p, v in model.param_maps()[combinations[-1]].items()}
    return given.get("maxIter", 0) * 1e3 * given.get("maxDepth", 0) + given.get("numTrees", 0) * given.get("maxDepth", 0)


def cross_validate(
    df: DataFrame, model: ModelSpec, key: str, label: str = "resale_price", folds: int = 3, parallelism: int | None = None
) -> tuple[Model, DataFrame]:
    """`search` with one family: (best model by RMSE, one row per parameter combination)."""
    best, combinations = search(df, [model], key, label, folds, parallelism)
    return best[model.name], combinations


def importances(model: Model, columns, like: DataFrame) -> DataFrame:
    """(feature, importance, coefficient), most important first.

    For a linear model the share of each absolute coefficient, with the signed one beside it.
    """
    last = model.stages[-1] if isinstance(model, PipelineModel) else model
    columns = names(columns)
    if hasattr(last, "coefficients"):
        signed = [float(c) for c in last.coefficients.toArray()]
        total = sum(abs(c) for c in signed) or 1.0
        rows = [(f, abs(c) / total, c) for f, c in zip(columns, signed)]
    else:
        rows = [(f, float(v), None) for f, v in zip(columns, last.featureImportances.toArray())]
    table = like.sparkSession.createDataFrame(rows, "feature string, importance double, coefficient double")
    return table.orderBy(F.col("importance").desc(), "feature")


def rank_models(metrics: DataFrame) -> DataFrame:
    """Models by RMSE, best first, with their rank. One row per model, so the window is small."""
    window = Window.partitionBy(F.lit(0)).orderBy("rmse", "model")
    return metrics.withColumn("place", F.row_number().over(window)).orderBy("place")


def prepare(df: DataFrame) -> DataFrame:
    """Storey band and text categoricals without nulls."""
    if "storey_range_bin" not in df.columns:
        band = (
            bin_by("storey_midpoint", STOREY_EDGES, STOREY_LABELS)
            if "storey_midpoint" in df.columns
            else F.lit("unknown")
        )
        df = df.withColumn("storey_range_bin", band)
    return fill_unknown(df, [c for c in CATEGORICALS if c in df.columns])


@dataclass
class Vectors:
    """Training and test rows with feature vectors, and the names of the inputs."""

    train: DataFrame
    test: DataFrame
    inputs: list[str]


def vectorise(train: DataFrame, test: DataFrame, key: str, label: str, keep=()) -> Vectors:
    """Encode on the training rows only, multiply indices, drop collinear columns, assemble.

    Both sets are written once, because training reads them many times.
    """
    train, test = prepare(train), prepare(test)
    categories = [c for c in CATEGORICALS if c in train.columns]
    model = index_categories(train, categories)

    def encoded(df: DataFrame) -> DataFrame:
        return interactions(model.transform(df), DEFAULT_INTERACTIONS)[0].drop(*COLLINEAR)

    train, test = encoded(train), encoded(test)
    inputs = [c for c in [*NUMERIC_INPUTS, *[f"{c}_index" for c in categories]] if c in train.columns]
    columns = list(dict.fromkeys([key, "features", label, *keep]))
    train, test = (assemble(df, inputs).select(*columns) for df in (train, test))
    return Vectors(settle_evenly(train, train.count(), len(inputs), "vectors"), settle(test, "vectors"), inputs)


MODEL_KINDS = {kind.__name__: kind for kind in (PipelineModel, RandomForestRegressionModel, GBTRegressionModel)}


@dataclass
class Comparison:
    """Test metrics with the chosen parameters, every combination tried, and the fitted models."""

    metrics: DataFrame
    combinations: DataFrame
    models: dict[str, Model]
    inputs: list[str]
    test: DataFrame

    def save(self, path: str) -> None:
        """Tables and models under one folder, from which `load` brings the comparison back in any session."""
        spark = self.metrics.sparkSession
        for name, model in self.models.items():
            model.write().overwrite().save(f"{path}/models/{name}")
        kinds = [(i, name, type(model).__name__) for i, (name, model) in enumerate(self.models.items())]
        inputs = spark.createDataFrame(list(enumerate(self.inputs)), "place int, input string")
        tables = {
            "test": self.test, "combinations": self.combinations, "metrics": self.metrics, "inputs": inputs,
            "kinds": spark.createDataFrame(kinds, "place int, model string, kind string"),
        }
        for name, table in tables.items():
            table.write.mode("overwrite").parquet(f"{path}/{name}")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Comparison:
        kinds = spark.read.parquet(f"{path}/kinds").orderBy("place").collect()
        return cls(
            spark.read.parquet(f"{path}/metrics"),
            spark.read.parquet(f"{path}/combinations"),
            {r["model"]: MODEL_KINDS[r["kind"]].load(f"{path}/models/{r['model']}") for r in kinds},
            [r["input"] for r in spark.read.parquet(f"{path}/inputs").orderBy("place").collect()],
            spark.read.parquet(f"{path}/test"),
        )

    def best(self) -> str:
        return rank_models(self.metrics).first()["model"]

    def importances(self) -> DataFrame:
        """(model, feature, importance, coefficient) of all models."""
        tables = [importances(m, self.inputs, self.test).withColumn("model", F.lit(name)) for name, m in self.models.items()]
        return reduce(DataFrame.union, tables).select("model", "feature", "importance", "coefficient")

    def predictions(self, name: str) -> DataFrame:
        return self.models[name].transform(self.test)


def train_and_compare(
    df: DataFrame,
    specs: list[ModelSpec],
    key: str,
    label: str = "resale_price",
    keep=(),
    fraction: float = 0.8,
    folds: int = 3,
    parallelism: int | None = None,
) -> Comparison:
    """Split by key digest, encode, cross-validate all models and measure the best ones on the test rows."""
    train, test = split_by_key(settle(df, "compared"), key, fraction)
    vectors = vectorise(train, test, key, label, keep)
    models, combinations = search(vectors.train, specs, key, label, folds, parallelism)
    rows = []
    for name, model in models.items():
        best = combinations.where(F.col("model") == name).orderBy("rmse", "combo").first()
        test_row = regression_metrics(model.transform(vectors.test), label).head().asDict()
        rows.append((name, best["params"], best["rmse"], *[test_row[m] for m in ("rmse", "mae", "r2", "mape")]))
    schema = "model string, params string, cv_rmse double, rmse double, mae double, r2 double, mape double"
    metrics = df.sparkSession.createDataFrame(rows, schema)
    return Comparison(metrics, combinations, models, vectors.inputs, vectors.test)


def residual_report(predictions: DataFrame, actual: str, by, bins: int = 80, min_n: int = 50) -> dict[str, DataFrame]:
    """Tables of a residual study: summary, histogram, and errors per group of each given column."""
    rows = residuals(predictions, actual)
    report = {"summary": residual_summary(rows, by), "histogram": histogram(rows, "residual", bins)}
    for i, column in enumerate(names(by)):
        report[f"by_{column}"] = error_by(rows, column, min_n if i == 0 else None).orderBy(
            F.col("mape").desc(), column
        )
    return report


def out_of_time(
    df: DataFrame,
    model: ModelSpec,
    date: str,
    key: str,
    label: str = "resale_price",
    months: int = 6,
    by=("town",),
    random_metrics: DataFrame | None = None,
    folds: int = 3,
    parallelism: int | None = None,
) -> dict[str, DataFrame]:
    """Refit on rows before the cutoff and measure on the later ones.

    Gives the split sizes, the metrics (against `random_metrics` as (metric, value) rows if given),
    errors by month and by group, the ten worst groups and the predictions.
    """
    report = settle(split_report(df, date, months), "split")
    check_no_overlap(report)
    train, holdout = temporal_split(df, date, months)
    vectors = vectorise(train, holdout, key, label, [date, *names(by)])
    best, combos = cross_validate(vectors.train, model, key, label, folds, parallelism)
    scored = settle(residuals(best.transform(vectors.test), label).drop("features", "scaled_features"), "scored")
    metrics = metrics_long(regression_metrics(scored, label).drop("n"))
    result = {
        "split": report,
        "cross_validation": combos,
        "metrics": metrics,
        "by_month": error_by_month(scored, date),
        "predictions": scored,
    }
    for column in names(by):
        groups = error_by(scored, column)
        result[f"by_{column}"] = groups
        result[f"worst_{column}"] = groups.orderBy(F.col("mean_abs_error").desc(), column).limit(10)
    if random_metrics is not None:
        result["comparison"] = compare_metrics(random_metrics, metrics)
    return result
