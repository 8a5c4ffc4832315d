"""Queries of encoding, assembly and regression models."""

import itertools
import math
import uuid
from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from assay.functions.dates import month_label
from assay.operators.errors import regression_metrics
from assay.operators.ordering import split_by_key
from assay.plans import training as M
from assay.queries.aggregates import METRICS, RESIDUALS
from assay.queries.jobs import engineered
from assay.queries.registry import query, r6
from assay.queries.selection import within_share
from assay.session import scratch_root, settle

RANKED = """ranked as (select {0}, row_number() over (order by count(*) desc, {0}) - 1 as i, (select count(distinct {0}) from {1}) as n
 from {1} where {0} is not null group by {0})"""
TRAIN = f"train as (select * from deals where {within_share('txn_id', 0.8)} and town <> 'NATION_3')"


def _split(t):
    rows = t.role("deals").select("txn_id", "town", "flat_type", "flat_model")
    train, _ = split_by_key(rows, "txn_id", 0.8)
    return rows, train.where(F.col("town") != "NATION_3")


@query(
    "string_index",
    f"""with {TRAIN}, {RANKED.format('town', 'train')}, {RANKED.format('flat_model', 'train').replace('ranked', 'models')}
     select txn_id, cast(coalesce(ranked.i, (select max(n) from ranked)) as double) as town_index,
     cast(coalesce(models.i, (select max(n) from models)) as double) as flat_model_index
     from deals left join ranked using (town) left join models using (flat_model)""",
    "deals",
)
def string_index(t):
    rows, train = _split(t)
    model = M.index_categories(train, ["town", "flat_model"])
    return model.transform(rows).select("txn_id", "town_index", "flat_model_index")


@query(
    "one_hot",
    f"""with {TRAIN}, {RANKED.format('town', 'train')}
     select txn_id, (select max(n) from ranked) + 1 as size, 1e0 as total,
     coalesce(i, (select max(n) from ranked)) + 1 as slot from deals left join ranked using (town)""",
    "deals",
)
def one_hot(t):
    rows, train = _split(t)
    encoded = M.one_hot(M.index_categories(train, "town").transform(rows), "town")
    vector = vector_to_array("town_ohe")
    return encoded.select(
        "txn_id",
        F.size(vector).cast("long").alias("size"),
        F.aggregate(vector, F.lit(0.0), lambda a, b: a + b).alias("total"),
        F.array_position(vector, 1.0).alias("slot"),
    )


@query(
    "label_mapping",
    f"""with train as (select * from deals where {within_share('txn_id', 0.8)}),
     {RANKED.format('town', 'train')}, {RANKED.format('flat_type', 'train').replace('ranked', 'types')}
     select 'town' as "column", cast(i as int) as "index", town as label from ranked
     union all select 'flat_type', cast(i as int), flat_type from types""",
    "deals",
)
def label_mapping(t):
    rows = t.role("deals").select("txn_id", "town", "flat_type")
    train, _ = split_by_key(rows, "txn_id", 0.8)
    return M.label_table(M.index_categories(train, ["town", "flat_type"]), rows)


INPUTS = ["floor_area_sqm", "storey_midpoint"]


def _assembled(t):
    return M.assemble(t.role("deals").select("txn_id", *INPUTS), INPUTS)


@query(
    "assemble",
    "select txn_id, floor_area_sqm as x0, storey_midpoint as x1 from deals where floor_area_sqm is not null and storey_midpoint is not null",
    "deals",
)
def assemble(t):
    x = vector_to_array("features")
    return _assembled(t).select("txn_id", x[0].alias("x0"), x[1].alias("x1"))


@query(
    "standardise",
    f"""with w as (select * from deals where floor_area_sqm is not null and storey_midpoint is not null),
     s as (select avg(floor_area_sqm) as m0, stddev_samp(floor_area_sqm) as s0, avg(storey_midpoint) as m1, stddev_samp(storey_midpoint) as s1 from w)
     select txn_id, {r6('(floor_area_sqm - m0) / s0', 'z0')}, {r6('(storey_midpoint - m1) / s1', 'z1')} from w, s""",
    "deals",
)
def standardise(t):
    z = vector_to_array("scaled_features")
    return M.standardise(_assembled(t)).select("txn_id", z[0].alias("z0"), z[1].alias("z1"))


@query(
    "linear_regression",
    """select round(regr_slope(resale_price, floor_area_sqm) * stddev_samp(floor_area_sqm), 3) as coefficient,
     round(avg(resale_price), 3) as intercept, count(*) as n from deals
     where resale_price is not null and floor_area_sqm is not null""",
    "deals",
)
def linear_regression(t):
    rows = t.role("deals").select("floor_area_sqm", "resale_price").na.drop()
    fitted = M.spec("linear_regression", grid={}).estimator.fit(M.assemble(rows, ["floor_area_sqm"])).stages[-1]
    return rows.agg(
        F.lit(round(float(fitted.coefficients[0]), 3)).alias("coefficient"),
        F.lit(round(float(fitted.intercept), 3)).alias("intercept"),
        F.count("*").alias("n"),
    )


#: A price that is a known function of three inputs, plus noise from the row's key that is larger in some towns.
#: The given tables' own prices do not depend on the inputs, so a fit to them could not be told from a bad one.
SIGNAL = "150000e0 + 3000e0 * floor_area_sqm + 1000e0 * remaining_lease_years + 1500e0 * storey_midpoint"
NOISE = "((txn_id * 48271) % 65521 / 65521e0 - 0.5e0) * 10000e0 * (1 + ascii(substr(town, length(town), 1)) % 4)"
COMPLETE = "resale_price is not null and floor_area_sqm is not null and storey_midpoint is not null"
PLANTED = f"""whole as (select *, {SIGNAL} as signal, {NOISE} as noise from deals where {COMPLETE}),
 train as (select * from whole where {within_share('txn_id', 0.8)}),
 test as (select * from whole where not {within_share('txn_id', 0.8)})"""

#: The grids of a comparison: the whole default grid of each family.
COMPARED = M.GRIDS
#: A fit leaves at most this share of the price's deviation unexplained; the noise alone leaves 0.08.
UNEXPLAINED = {"linear_regression": 0.1, "random_forest": 0.4, "gbt": 0.2}

_WRITTEN: dict[tuple[str, ...], str] = {}


def _name(t, label: str) -> tuple[str, ...]:
    return t.spark.sparkContext.applicationId, t.folder, label


def _is_written(t, label: str) -> bool:
    return _name(t, label) in _WRITTEN


def _once(t, label: str, write) -> str:
    """The folder that `write(path)` has filled for these inputs in this application."""
    name = _name(t, label)
    if name not in _WRITTEN:
        path = f"{scratch_root(t.spark)}/assay-{label}-{uuid.uuid4().hex}"
        write(path)
        _WRITTEN[name] = path
    return _WRITTEN[name]


def _features(t):
    """Feature rows with the planted price, built and written once for all model queries."""

    def write(path):
        rows = engineered(t).where(F.col("resale_price").isNotNull()).drop("prediction", "latitude", "longitude")
        rows.withColumn("resale_price", F.expr(SIGNAL) + F.expr(NOISE)).write.parquet(path)

    return t.spark.read.parquet(_once(t, "model-features", write))


def _compared(t, families=None) -> M.Comparison:
    """The families with their whole grids, compared once and then loaded with their fitted models.

    Some families alone are compared only where all of them have not been.
    """
    if families is None or _is_written(t, "model-comparison"):
        families, label = tuple(COMPARED), "model-comparison"
    else:
        label = "-".join(["model-comparison", *families])

    def write(path):
        specs = [M.spec(name, grid=COMPARED[name]) for name in families]
        M.train_and_compare(_features(t), specs, "txn_id", keep=["town"]).save(path)

    return M.Comparison.load(t.spark, _once(t, label, write))


def _chosen_or_first(t, families) -> M.Comparison:
    """The compared families where that has been done, else their models with the first value of each grid entry."""
    if _is_written(t, "model-comparison"):
        return _compared(t)

    def write(path):
        specs = [M.spec(name, grid={p: values[:1] for p, values in COMPARED[name].items()}) for name in families]
        train, test = split_by_key(_features(t), "txn_id", 0.8)
        vectors = M.vectorise(train, test, "txn_id", "resale_price", ["town"])
        models = M.fit_first(vectors.train, specs)
        none = t.spark.createDataFrame([], "model string, rmse double")
        M.Comparison(none, none, models, vectors.inputs, vectors.test).save(path)

    return M.Comparison.load(t.spark, _once(t, "-".join(["first-models", *families]), write))


def _unexplained(rows):
    """The root mean square error over the deviation of the price."""
    y = F.col("resale_price")
    return F.sqrt(F.avg((y - F.col("prediction")) ** 2)) / F.stddev_pop(y)


@query(
    "random_forest",
    f"""with {PLANTED} select txn_id, {r6('signal + noise', 'resale_price')}, true as in_range, true as explained from test""",
    "deals",
)
def random_forest(t):
    """Test rows by a forest, which predicts means of training labels.

    The model is the one chosen among all combinations where `train_compare` has run, else the first combination's.
    """
    compared = _chosen_or_first(t, ("random_forest",))
    scored = compared.predictions("random_forest")
    train, _ = split_by_key(_features(t), "txn_id", 0.8)
    low, high = train.agg(F.min("resale_price"), F.max("resale_price")).first()
    explained = scored.agg((_unexplained(scored) < UNEXPLAINED["random_forest"]).alias("explained")).scalar()
    return scored.select(
        "txn_id", "resale_price", F.col("prediction").between(low, high).alias("in_range"), explained.alias("explained")
    )


@query(
    "gbt",
    f"""with {PLANTED} select count(*) as n, {r6('sum(signal + noise) / 1e6', 'actual')},
     true as explained, {r6('sqrt(avg(noise * noise)) / stddev_pop(signal + noise)', 'noise_share')}, true as above_noise from test""",
    "deals",
)
def gbt(t):
    """Test rows by boosting: the error lies between the noise and a small share of the price.

    The model is the one chosen among all combinations where `train_compare` has run, else the first combination's.
    """
    scored = _chosen_or_first(t, ("gbt",)).predictions("gbt")
    noisy = scored.join(_features(t).select("txn_id", F.expr(NOISE).alias("noise")), "txn_id")
    y, noise = F.col("resale_price"), F.sqrt(F.avg(F.col("noise") ** 2)) / F.stddev_pop("resale_price")
    return noisy.agg(
        F.count("*").alias("n"),
        (F.sum(y) / 1e6).alias("actual"),
        (_unexplained(noisy) < UNEXPLAINED["gbt"]).alias("explained"),
        noise.alias("noise_share"),
        (_unexplained(noisy) > 0.95 * noise).alias("above_noise"),
    )


#: What `cross_validate` searches; `train_compare` searches all families.
SEARCHED = ("linear_regression",)


def _grid_rows() -> str:
    """Every combination of the searched families as SQL rows, parameters by name."""
    rows = []
    for model in SEARCHED:
        grid = COMPARED[model]
        for values in itertools.product(*grid.values()):
            params = ", ".join(f"{p}={v}" for p, v in sorted(zip(grid, values)))
            rows.append(f"('{model}', '{params}', {str(model == 'linear_regression').lower()})")
    return ", ".join(rows)


@query(
    "cross_validate",
    f"""with {PLANTED}, n as (select sqrt(avg(noise * noise)) as rmse from train)
     select model, params, true as explained, 1 as n_least, {r6('case when linear then rmse end', 'noise_rmse')},
     case when linear then true end as near_noise from (values {_grid_rows()}) as grid(model, params, linear), n""",
    "deals",
)
def cross_validate(t):
    """Every linear combination in three folds: none is far off, and one is the least.

    Linear models can reach the noise, so their errors must lie near it.
    """
    compared = _compared(t, SEARCHED)
    train, _ = split_by_key(_features(t), "txn_id", 0.8)
    train = train.where(COMPLETE)
    spread = train.agg(F.stddev_pop("resale_price")).first()[0]
    noise = train.agg(F.sqrt(F.avg(F.expr(NOISE) ** 2))).first()[0]
    combos = compared.combinations.where(F.col("model").isin(*SEARCHED))
    least = combos.groupBy("model").agg(F.min(F.struct("rmse", "combo")).alias("m")).select("model", "m.combo")
    chosen = combos.join(least, ["model", "combo"], "left_semi").groupBy("model").agg(F.count("*").cast("int").alias("n_least"))
    linear = F.col("model") == "linear_regression"
    bound = F.create_map(*[F.lit(x) for pair in UNEXPLAINED.items() for x in pair])[F.col("model")]
    return combos.join(chosen, "model").select(
        "model",
        "params",
        (F.col("rmse") < bound * spread * 2).alias("explained"),
        "n_least",
        F.when(linear, F.lit(noise)).alias("noise_rmse"),
        F.when(linear, F.col("rmse").between(0.95 * noise, 1.1 * noise)).alias("near_noise"),
    )


@query(
    "feature_importance",
    "select model, 1e0 as total, n_inputs, true as in_order, 'floor_area_sqm' as top, true as planted_above from (values "
    + ", ".join(f"('{m}')" for m in COMPARED) + ") as models(model), (select 27 as n_inputs)",
)
def feature_importance(t):
    """All three families: importances sum to one, come in order, and find the planted inputs.

    The floor area moves the price most. It and the storey stand above all inputs that do not move it, but for
    the product of area and lease and the storey's band, which trees may use in their place. The models are the chosen ones where
    `train_compare` has run, else those of each grid's first combination.
    """
    compared = _chosen_or_first(t, tuple(COMPARED))
    window = Window.partitionBy("model").orderBy(F.col("importance").desc(), "feature")
    ranked = compared.importances().withColumn("place", F.row_number().over(window))
    real = F.col("feature").isin("floor_area_sqm", "storey_midpoint")
    stand_in = F.col("feature").isin("floor_area_x_remaining_lease", "storey_range_bin_index", "remaining_lease_years")
    earlier = F.lag("importance").over(window)
    return (
        ranked.withColumn("sinks", F.coalesce(earlier >= F.col("importance"), F.lit(True)))
        .groupBy("model")
        .agg(
            F.round(F.sum("importance"), 6).alias("total"),
            F.count("*").cast("int").alias("n_inputs"),
            F.bool_and("sinks").alias("in_order"),
            F.min_by("feature", "place").alias("top"),
            (F.min(F.when(real, F.col("importance"))) > F.max(F.when(~real & ~stand_in, F.col("importance")))).alias("planted_above"),
        )
    )


@query(
    "model_ranking",
    f"""with {RESIDUALS}, m as (select flat_type as model, {METRICS} from res group by flat_type)
     select *, cast(row_number() over (order by rmse, model) as int) as place from m""",
    "deals",
)
def model_ranking(t):
    scores = regression_metrics(t.role("deals"), "resale_price", by="flat_type")
    return M.rank_models(scores.withColumnRenamed("flat_type", "model"))


COMPARED_ROWS = ", ".join(
    f"('{m}', {math.prod(map(len, g.values()))}, {p})" for (m, g), p in zip(COMPARED.items(), (1, 3, 2))
)


@query(
    "train_compare",
    f"""select model, n_combinations, true as chosen_is_least, true as explained, place
     from (values {COMPARED_ROWS}) as models(model, n_combinations, place)""",
)
def train_compare(t):
    """Per family: combinations tried, whether the least was chosen, whether it explains the price, and its place by test error.

    The planted price is linear in its inputs, so the linear model comes first and boosting second.
    """
    compared = _compared(t)
    tried = compared.combinations.groupBy("model").agg(
        F.count("*").cast("int").alias("n_combinations"), F.min("rmse").alias("least"), F.min_by("params", F.struct("rmse", "combo")).alias("best")
    )
    bound = F.create_map(*[F.lit(x) for pair in UNEXPLAINED.items() for x in pair])[F.col("model")]
    return M.rank_models(compared.metrics).join(tried, "model").select(
        "model",
        "n_combinations",
        ((F.col("cv_rmse") == F.col("least")) & (F.col("params") == F.col("best"))).alias("chosen_is_least"),
        (F.sqrt(1 - F.col("r2")) < bound).alias("explained"),
        F.col("place").cast("int").alias("place"),
    )


def _group_sql(column, least=0):
    return " union all ".join(
        f"select 'by_{column}' as part, {column} as name, '{label}' as metric, {r6(f'cast({value} as double)', 'value')} from res group by {column} having count(*) >= {least}"
        for label, value in (("mean_residual", "avg(residual)"), ("mean_abs_error", "avg(abs_error)"), ("mape", "avg(abs_pct_error)"), ("n", "count(*)"))
    )


@query(
    "residual_analysis",
    f"""with {RESIDUALS}, e as (select min(residual) as lo, (max(residual) - min(residual)) / 80e0 as w from res),
     b as (select least(cast(floor((residual - lo) / w) as int), 79) as bin from res, e)
     select 'summary' as part, 'all' as name, 'mean_residual' as metric, {r6('avg(residual)', 'value')} from res
     union all select 'summary', 'all', 'std_residual', {r6('stddev_samp(residual)', 'value')} from res
     union all select 'summary', 'all', 'median_abs_error', {r6('quantile_cont(abs_error, 0.5)', 'value')} from res
     union all select 'summary', 'all', 'p95_abs_error', {r6('quantile_cont(abs_error, 0.95)', 'value')} from res
     union all select 'histogram', cast(bin as varchar), 'n', cast(count(*) as double) from b group by bin
     union all {_group_sql('town', 50)} union all {_group_sql('flat_type')}""",
    "deals",
)
def residual_analysis(t):
    """All tables of the residual study, as (part, name, metric, value)."""
    rows = t.role("deals").where(F.col("resale_price").isNotNull())
    report = M.residual_report(rows, "resale_price", ["town", "flat_type"])
    summary = report["summary"].select(
        *[F.col(c).alias(c) for c in ("mean_residual", "std_residual", "median_abs_error", "p95_abs_error")]
    ).unpivot([], None, "metric", "value")
    parts = [summary.select(F.lit("summary").alias("part"), F.lit("all").alias("name"), "metric", "value")]
    bins = report["histogram"].select(F.lit("histogram"), F.col("bin").cast("string"), F.lit("n"), F.col("n").cast("double"))
    parts.append(bins)
    for column in ("town", "flat_type"):
        wide = report[f"by_{column}"].withColumn("n", F.col("n").cast("double"))
        long = wide.unpivot([column], ["mean_residual", "mean_abs_error", "mape", "n"], "metric", "value")
        parts.append(long.select(F.lit(f"by_{column}"), column, "metric", "value"))
    return reduce(DataFrame.union, parts)


def _expected(part: str, name: str, source: str) -> str:
    """Rows of the out-of-time report that the noise alone decides."""
    return f"""select '{part}' as part, {name} as name, count(*) as n, {r6('avg(abs(noise))', 'noise_mae')}, true as near_noise
     from later group by {source}"""


@query(
    "oot_validation",
    f"""with c as (select cast(date_trunc('quarter', max(month) - interval 6 month) as date) as cutoff from deals where resale_price is not null),
     p as (select deals.*, month < cutoff as earlier from deals, c where resale_price is not null),
     later as (select *, {NOISE} as noise from p where not earlier and {COMPLETE}),
     sizes as (select count(*) filter (where earlier) as n_train, count(*) filter (where not earlier) as n_holdout from p),
     ranked as (select avg(abs(noise)) as mae, row_number() over (order by avg(abs(noise)) desc) as place from later group by town)
     select 'split' as part, 'train' as name, n_train as n, cast(null as double) as noise_mae, cast(null as boolean) as near_noise from sizes
     union all select 'split', 'holdout', n_holdout, null, null from sizes
     union all select 'winner', 'linear_regression', 12, null, null
     union all select 'overall', 'all', count(*), {r6('avg(abs(noise))', 'noise_mae')}, true from later
     union all {_expected('by_month', "strftime(month, '%Y-%m')", 'month')}
     union all {_expected('by_town', 'town', 'town')}
     union all select 'worst_town', cast(place as varchar), 1, {r6('mae', 'noise_mae')}, true from ranked where place <= 10
     union all select 'change', metric, 1, null, true from (values ('rmse'), ('mae'), ('r2'), ('mape')) as m(metric)""",
    "deals",
)
def oot_validation(t):
    """The winner of the comparison on later rows: errors overall, by month, by town and in the ten worst towns.

    `noise_mae` is what the planted noise leaves, and `near_noise` whether the model's mean absolute error is within a
    tenth of it (a fifth for one town). `change` has the metrics against those of the random split, none a fifth worse.
    """
    first = _compared(t)
    best = first.best()
    chosen = M.metrics_long(first.metrics.where(F.col("model") == best))
    rows = _features(t)
    report = M.out_of_time(rows, M.spec(best), "month", "txn_id", random_metrics=chosen)
    noisy = report["predictions"].join(rows.select("txn_id", F.abs(F.expr(NOISE)).alias("noise")), "txn_id")
    noisy = settle(noisy.select("month", "town", "noise"), "noisy")
    near = lambda slack: (F.abs(F.col("mean_abs_error") - F.col("noise_mae")) < slack * F.col("noise_mae")).alias("near_noise")
    parts = [
        report["split"].select(F.lit("split").alias("part"), F.col("part").alias("name"), "n", F.lit(None).cast("double").alias("noise_mae"), F.lit(None).cast("boolean").alias("near_noise")),
        report["cross_validation"].groupBy("model").agg(F.count("*").alias("n")).select(F.lit("winner"), "model", "n", F.lit(None), F.lit(None)),
    ]
    overall = noisy.agg(F.count("*").alias("n"), F.avg("noise").alias("noise_mae"))
    mae = report["metrics"].where("metric = 'mae'").select(F.col("value").alias("mean_abs_error")).scalar()
    parts.append(overall.withColumn("mean_abs_error", mae).select(F.lit("overall"), F.lit("all"), "n", "noise_mae", near(0.1)))
    expected = {
        "by_month": noisy.groupBy(month_label("month").alias("month")).agg(F.avg("noise").alias("noise_mae")),
        "by_town": noisy.groupBy("town").agg(F.avg("noise").alias("noise_mae")),
    }
    for part, column in (("by_month", "month"), ("by_town", "town")):
        both = report[part].join(expected[part], column)
        parts.append(both.select(F.lit(part), column, "n", "noise_mae", near(0.1 if part == "by_month" else 0.2)))
    place = lambda by: F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.col(by).desc()))
    worst = report["worst_town"].withColumn("place", place("mean_abs_error"))
    noisiest = expected["by_town"].withColumn("place", place("noise_mae")).select("place", "noise_mae")
    parts.append(worst.join(noisiest, "place").select(F.lit("worst_town"), F.col("place").cast("string"), F.lit(1), "noise_mae", near(0.2)))
    worse = F.when(F.col("metric") == "r2", -F.col("delta_pct")).otherwise(F.col("delta_pct"))
    parts.append(report["comparison"].select(F.lit("change"), "metric", F.lit(1), F.lit(None), worse < 20))
    return reduce(DataFrame.union, parts)
