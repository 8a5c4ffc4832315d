"""Queries of profiles, aggregates, statistics and errors."""

from pyspark.sql import functions as F

from assay.functions.dates import remaining_term
from assay.operators import aggregates as A
from assay.operators import errors as E
from assay.operators import trends as Tr
from assay.operators.ordering import bounds
from assay.operators.quantiles import exact_quantiles, group_median
from assay.operators.sketches import SketchStore
from assay.plans.checks import ColumnRules, violations
from assay.queries.registry import query, r6
from assay.session import attach, scratch_path, settle

NUMBERS = ["resale_price", "floor_area_sqm", "remaining_lease_years", "storey_midpoint", "transaction_year"]
RESIDUALS = """res as (select txn_id, town, flat_type, month, resale_price, prediction, resale_price - prediction as residual,
 abs(resale_price - prediction) as abs_error,
 case when resale_price <> 0 then abs(resale_price - prediction) / resale_price * 100 end as abs_pct_error
 from deals where resale_price is not null)"""


def _residuals(t):
    rows = t.role("deals").select("txn_id", "town", "flat_type", "month", "resale_price", "prediction")
    return E.residuals(rows.where(F.col("resale_price").isNotNull()), "resale_price")


TXN_COLUMNS = [
    "txn_id", "month", "town", "flat_type", "flat_model", "block", "street_name", "storey_range",
    "floor_area_sqm", "lease_commence_date", "remaining_lease", "resale_price", "latitude", "longitude",
]


@query(
    "null_counts",
    " union all ".join(
        f"""select '{c}' as "column", count(*) filter (where {c} is null) as nulls from txn""" for c in TXN_COLUMNS
    ),
    "txn",
)
def null_counts(t):
    return A.null_counts(t.role("txn").select(*TXN_COLUMNS))


def _profile_sql(column, kind):
    text = kind == "string"
    present = f"{column} is not null" + (f" and trim({column}) <> ''" if text else "")
    edges = [
        r6(f"cast({end}({column}) as double)", f"{end}_value") if kind != "string" else f"cast(null as double) as {end}_value"
        for end in ("min", "max")
    ]
    shares = [
        r6(f"count(*) filter (where {present} and regexp_matches({column}, '{shape}')) * 100e0 / count(*) filter (where {present})", f"{label}_pct")
        if text else f"cast(null as double) as {label}_pct"
        for label, shape in A.TEXT_SHAPES.items()
    ]
    return f"""select '{column}' as "column", '{kind}' as type, count(*) as n, count(*) filter (where not coalesce({present}, false)) as nulls,
     {r6(f"count(*) filter (where not coalesce({present}, false)) * 100e0 / count(*)", 'null_pct')},
     count(distinct {column}) as n_distinct, {', '.join(edges)}, {', '.join(shares)} from txn"""


PROFILED = {c: {"txn_id": "bigint", "latitude": "double", "longitude": "double"}.get(c, "string") for c in TXN_COLUMNS}


@query(
    "profile_table",
    "select *, true as sketch_is_near from (" + " union all ".join(_profile_sql(c, k) for c, k in PROFILED.items()) + ")",
    "txn",
)
def profile_table(t):
    rows = settle(t.role("txn").select(*PROFILED), "txn")
    exact, sketched = A.profile(rows, approx=False, written=True), A.profile(rows, relative_error=0.02)
    near = sketched.select(F.col("column").alias("of"), F.col("n_distinct").alias("about"))
    close = F.abs(F.col("about") - F.col("n_distinct")) <= 0.1 * F.col("n_distinct")
    return exact.join(near, F.col("column") == F.col("of")).withColumn("sketch_is_near", close).drop("of", "about")


SKETCHED = ["txn_id", "block", "street_name", "town", "resale_price"]


@query(
    "approx_distinct",
    " union all ".join(f"""select '{c}' as "column", count(distinct {c}) as exact, true as close from txn""" for c in SKETCHED),
    "txn",
)
def approx_distinct(t):
    """Sketched counts beside exact ones, and whether they lie within 10 percent."""
    exact = A.distinct_counts(t.role("txn"), SKETCHED).withColumnRenamed("n_distinct", "exact")
    both = A.approx_distinct(t.role("txn"), SKETCHED, 0.02).join(exact, "column")
    close = F.abs(F.col("n_distinct") - F.col("exact")) <= F.col("exact") * 0.1
    return both.select("column", "exact", close.alias("close"))


GROWING = ["txn_id", "town", "flat_model", "resale_price", "floor_area_sqm", "transaction_year"]
GROWING_KINDS = {"txn_id": "bigint", "town": "string", "flat_model": "string", "transaction_year": "int"}


def _sketched_sql(c: str) -> str:
    low, high = (f"cast({f}({c}) as double)" if GROWING_KINDS.get(c) != "string" else "cast(null as double)" for f in ("min", "max"))
    middle = "cast(null as boolean)" if GROWING_KINDS.get(c) == "string" else "true"
    return f"""select '{c}' as "column", '{GROWING_KINDS.get(c, 'double')}' as type, count(*) as n, count(*) - count({c}) as nulls,
     {r6(low, 'low')}, {r6(high, 'high')}, true as distinct_close, {middle} as median_close from deals"""


@query("sketched_profile", " union all ".join(map(_sketched_sql, GROWING)), "deals")
def sketched_profile(t):
    """Four extracts, each read once when it is stored; the profile of all of them from their sketches."""
    rows = t.role("deals").select(*GROWING)
    store = SketchStore(t.spark, scratch_path(t.spark, "sketches"))
    year = F.col("transaction_year")
    for extract, part in (("to 1996", year <= 1996), ("1997-98", year.between(1997, 1998)), ("1999-2000", year.between(1999, 2000)), ("2001 on", year >= 2001)):
        store.add(rows.where(part), extract)
    merged = settle(store.profile({"median": 0.5}), "profile")
    numbers = [c for c in GROWING if GROWING_KINDS.get(c) != "string"]
    guesses = merged.where("median is not null").groupBy().pivot("column", numbers).agg(F.first("median"))
    below = attach(rows.select(*numbers), guesses.select(*[F.col(c).alias(f"_{c}") for c in numbers]))
    # The estimate's true rank: an estimate of the median has about half of the values on each side.
    share = lambda c, test: F.avg(F.when(F.col(c).isNotNull(), test.cast("double")))
    ranks = below.agg(*[((share(c, F.col(c) < F.col(f"_{c}")) <= 0.52) & (share(c, F.col(c) <= F.col(f"_{c}")) >= 0.48)).alias(c) for c in numbers])
    ranks = ranks.unpivot([], numbers, "column", "median_close")
    exact = A.distinct_counts(rows, GROWING).withColumnRenamed("n_distinct", "exact")
    close = F.abs(F.col("n_distinct") - F.col("exact")) <= 0.05 * F.col("exact")
    return merged.join(exact, "column").join(ranks, "column", "left").select(
        "column", "type", "n", "nulls", "low", "high", close.alias("distinct_close"), "median_close"
    )


@query(
    "pattern_share",
    f"""with s as (select count(*) filter (where trim(remaining_lease) <> '') as kept,
      count(*) filter (where regexp_matches(remaining_lease, '\\d+\\s*(year|month)')) as units,
      count(*) filter (where regexp_matches(remaining_lease, '^\\d+ TO \\d+$')) as spans from txn)
     select 'unit_text' as pattern, {r6('units * 100e0 / kept', 'share_pct')} from s where units * 100e0 / kept > 10
     union all select 'x_to_y', {r6('spans * 100e0 / kept', 'share_pct')} from s where spans * 100e0 / kept > 10""",
    "txn",
)
def pattern_share(t):
    return A.pattern_share(t.role("txn"), "remaining_lease")


@query(
    "group_median",
    f"""select month, flat_type, {r6('quantile_disc(resale_price, 0.5)', 'median')}
     from deals group by month, flat_type""",
    "deals",
)
def group_median_query(t):
    return group_median(t.role("deals"), ["month", "flat_type"], "resale_price")


@query(
    "group_centroid",
    f"""select town, {r6('avg(latitude)', 'mean_latitude')}, {r6('avg(longitude)', 'mean_longitude')},
     {r6('quantile_disc(resale_price, 0.5)', 'median_resale_price')}, count(*) as n from deals group by town""",
    "deals",
)
def group_centroid(t):
    return A.group_summary(t.role("deals"), "town", ["latitude", "longitude"], "resale_price")


@query(
    "mean_median",
    f"select {r6('avg(resale_price)', 'mean')}, {r6('quantile_cont(resale_price, 0.5)', 'median')} from deals",
    "deals",
)
def mean_median(t):
    return A.summary(t.role("deals"), "resale_price")


@query(
    "min_by_group",
    f"select town, flat_type, {r6('min(resale_price)', 'least')} from deals group by town, flat_type",
    "deals",
)
def min_by_group(t):
    return A.min_by_group(t.role("deals"), ["town", "flat_type"], "resale_price")


@query(
    "quantiles",
    f"""select {r6('quantile_cont(l_extendedprice, 0.05)', 'p05')}, {r6('quantile_cont(l_extendedprice, 0.25)', 'q1')},
     {r6('quantile_cont(l_extendedprice, 0.75)', 'q3')}, {r6('quantile_cont(l_extendedprice, 0.95)', 'p95')} from lineitem""",
)
def quantiles(t):
    probs = {"p05": 0.05, "q1": 0.25, "q3": 0.75, "p95": 0.95}
    return exact_quantiles(t.table("lineitem"), "l_extendedprice", probs, written=True)


@query(
    "histogram",
    f"""with e as (select min(resale_price) as lo, (max(resale_price) - min(resale_price)) / 80e0 as w from deals),
     b as (select least(cast(floor((resale_price - lo) / w) as int), 79) as bin from deals, e where resale_price is not null)
     select bin, {r6('lo + bin * w', 'low')}, {r6('lo + (bin + 1) * w', 'high')}, n
     from (select bin, count(*) as n from b group by bin), e""",
    "deals",
)
def histogram(t):
    return A.histogram(t.role("deals"), "resale_price", 80)


@query(
    "box_summary",
    f"""with q as (select town, quantile_cont(resale_price, 0.25) as q1, quantile_cont(resale_price, 0.5) as median,
      quantile_cont(resale_price, 0.75) as q3 from deals where resale_price is not null group by town)
     select town, {r6('q1', 'q1')}, {r6('median', 'median')}, {r6('q3', 'q3')},
      {r6('min(resale_price) filter (where resale_price >= q1 - 1.5e0 * (q3 - q1))', 'whisker_low')},
      {r6('max(resale_price) filter (where resale_price <= q3 + 1.5e0 * (q3 - q1))', 'whisker_high')}, count(*) as n
     from deals join q using (town) where resale_price is not null group by town, q1, median, q3""",
    "deals",
)
def box_summary(t):
    return A.box_summary(t.role("deals"), "town", "resale_price")


# Beside the given numbers: a constant, which has no correlation, and a column twice.
MORE_NUMBERS = [
    *NUMBERS, "transaction_month", "transaction_quarter", "lease_commence_date", "prediction", "longitude", "latitude",
    "always_one", "area_again",
]
MORE = "more as (select *, 1e0 as always_one, floor_area_sqm as area_again from deals)"


def _more(t):
    return t.role("deals").withColumns({"always_one": F.lit(1.0), "area_again": F.col("floor_area_sqm")})


def _r(a: str, b: str) -> str:
    return f"case when stddev_pop({a}) > 0 and stddev_pop({b}) > 0 then corr({a}, {b}) end"


@query(
    "pearson",
    f"with {MORE} " + " union all ".join(
        f"select '{c}' as feature, {r6(_r(c, 'resale_price'), 'r')} from more" for c in MORE_NUMBERS[1:]
    ),
    "deals",
)
def pearson(t):
    return A.corr_with(_more(t), MORE_NUMBERS[1:], "resale_price")


WHOLE = "whole as (select * from more where " + " and ".join(f"{c} is not null" for c in MORE_NUMBERS) + ")"
MATRIX_SQL = f"with {MORE}, {WHOLE} " + " union all ".join(
    f"select '{a}' as a, '{b}' as b, {r6(_r(min(a, b), max(a, b)), 'r')} from whole" for a in MORE_NUMBERS for b in MORE_NUMBERS
)


@query("corr_matrix", MATRIX_SQL, "deals")
def corr_matrix(t):
    return A.corr_matrix(_more(t), MORE_NUMBERS)


LEASE = ["remaining_lease_years", "years_since_start", "transaction_year", "resale_price", "always_one"]


def _lease_matrix(t):
    since = (F.col("transaction_year") - F.col("lease_commence_date")).cast("double")
    return A.corr_matrix(_more(t).withColumn("years_since_start", since), LEASE)


LEASE_PAIRS = """whole as (select cast(transaction_year - lease_commence_date as double) as years_since_start, 1e0 as always_one, *
  from deals where resale_price is not null),
 pairs as (""" + " union all ".join(
    f"select '{a}' as a, '{b}' as b, {_r(a, b)} as r from whole"
    for i, a in enumerate(LEASE) for b in LEASE[i + 1:]
) + ")"


@query("high_corr_pairs", f"with {LEASE_PAIRS} select a, b, {r6('r', 'r')} from pairs where abs(r) > 0.85", "deals")
def high_corr_pairs(t):
    return A.high_corr(_lease_matrix(t), 0.85, LEASE)


@query(
    "collinear_drops",
    f"""with {LEASE_PAIRS} select distinct 'years_since_start' as "column" from pairs
     where abs(r) > 0.85 and a = 'remaining_lease_years' and b = 'years_since_start'""",
    "deals",
)
def collinear_drops(t):
    rules = [
        ("years_since_start", "remaining_lease_years", "years_since_start"),
        ("lease_commence_date", "remaining_lease_years", "lease_commence_date"),
    ]
    return A.collinear_drops(A.high_corr(_lease_matrix(t), 0.85, LEASE), rules)


@query(
    "vif",
    f"""with w as (select cast(floor_area_sqm as double) as x, remaining_lease_years as y from deals
      where floor_area_sqm is not null),
     g as (select sum(x * y) * sum(x * y) / (sum(x * x) * sum(y * y)) as rr from w)
     select 'plain' as inputs, 'floor_area_sqm' as feature, {r6('1 / (1 - rr)', 'vif')}, false as infinite from g
     union all select 'plain', 'remaining_lease_years', {r6('1 / (1 - rr)', 'vif')}, false from g
     union all select 'doubled', 'remaining_lease_years', {r6('1 / (1 - rr)', 'vif')}, false from g
     union all select 'doubled', 'floor_area_sqm', null, true union all select 'doubled', 'area_again', null, true""",
    "deals",
)
def vif(t):
    columns = ["floor_area_sqm", "remaining_lease_years", "always_one"]
    plain = Tr.vif(_more(t), columns).withColumn("inputs", F.lit("plain"))
    doubled = Tr.vif(_more(t), [*columns, "area_again"]).withColumn("inputs", F.lit("doubled"))
    infinite = F.col("vif") == float("inf")
    return plain.union(doubled).select("inputs", "feature", F.when(~infinite, F.col("vif")).alias("vif"), infinite.alias("infinite"))


@query(
    "ols_slope",
    f"""select flat_type, {r6('regr_slope(resale_price, remaining_lease_years)', 'slope')}, count(*) as n from deals
     where resale_price is not null group by flat_type having count(*) > 50
     union all select 'overall', {r6('regr_slope(resale_price, remaining_lease_years)', 'slope')}, count(*) from deals
     where resale_price is not null""",
    "deals",
)
def ols_slope(t):
    rows, pair = t.role("deals"), ("remaining_lease_years", "resale_price")
    overall = Tr.slope(rows, *pair).select(F.lit("overall").alias("flat_type"), "slope", "n")
    return Tr.slope(rows, *pair, "flat_type").union(overall)


@query(
    "segment_slopes",
    f"""with s as (select count(*) filter (where remaining_lease_years < 60) as n_below,
      regr_slope(resale_price, remaining_lease_years) filter (where remaining_lease_years >= 60) as up,
      regr_slope(resale_price, remaining_lease_years) filter (where remaining_lease_years < 60) as down
      from deals where resale_price is not null)
     select n_below, {r6('case when n_below > 100 then up end', 'slope_above')}, {r6('case when n_below > 100 then down end', 'slope_below')},
      case when n_below > 100 then abs(down) > abs(up) * 1.3e0 end as non_linear from s""",
    "deals",
)
def segment_slopes(t):
    return Tr.segment_slope(t.role("deals"), "remaining_lease_years", "resale_price")


@query(
    "quadratic_fit",
    f"""with c as (select avg(remaining_lease_years) as m from deals where resale_price is not null),
     s as (select m, min(remaining_lease_years) as lo, max(remaining_lease_years) as hi, cast(count(*) as double) as s0, sum(u) as s1, sum(u*u) as s2,
       sum(u*u*u) as s3, sum(u*u*u*u) as s4, sum(v) as t0, sum(v*u) as t1, sum(v*u*u) as t2
      from (select m, remaining_lease_years, remaining_lease_years - m as u, resale_price as v from deals, c where resale_price is not null) group by m),
     d as (select *, s0*(s2*s4-s3*s3) - s1*(s1*s4-s3*s2) + s2*(s1*s3-s2*s2) as det from s),
     k as (select m, lo, hi, (t0*(s2*s4-s3*s3) - s1*(t1*s4-s3*t2) + s2*(t1*s3-s2*t2)) / det as a,
       (s0*(t1*s4-s3*t2) - t0*(s1*s4-s3*s2) + s2*(s1*t2-t1*s2)) / det as b,
       (s0*(s2*t2-t1*s3) - s1*(s1*t2-t1*s2) + t0*(s1*s3-s2*s2)) / det as c from d),
     g as (select *, cast(unnest(range(200)) as int) as point from k),
     x as (select *, lo + point * ((hi - lo) / 199e0) as x from g)
     select point, {r6('x', 'x')}, round(a + b * (x - m) + c * (x - m) * (x - m), 3) as y from x""",
    "deals",
)
def quadratic_fit(t):
    curve = Tr.quadratic_fit(t.role("deals"), "remaining_lease_years", "resale_price")
    return curve.withColumn("y", F.round("y", 3))


CATEGORIES = ["town", "flat_type", "flat_model"]


@query(
    "category_counts",
    " union all ".join(
        f"""select '{c}' as "column", count(distinct {c}) as n_distinct from deals""" for c in CATEGORIES
    ),
    "deals",
)
def category_counts(t):
    return A.distinct_counts(t.role("deals"), CATEGORIES)


@query(
    "value_counts",
    f"""with k as (select count(distinct town) as n_keys, count(*) / count(distinct town)::double as rows_per_key,
      min(transaction_year) as period_low, max(transaction_year) as period_high from deals)
     select coalesce(flat_model, 'Unknown') as flat_model, count(*) as n, n_keys, {r6('rows_per_key', 'rows_per_key')}, period_low, period_high
     from deals, k group by 1, n_keys, rows_per_key, period_low, period_high""",
    "deals",
)
def value_counts(t):
    stats = A.quality_stats(t.role("deals"), "town", "transaction_year").drop("n_rows", "n_null_key")
    return attach(A.value_counts(t.role("deals"), "flat_model"), stats)


@query(
    "scalar_bounds",
    """select min(month) as low, max(month) as high,
     cast(date_trunc('quarter', max(month) - interval 6 month) as date) as cutoff from deals""",
    "deals",
)
def scalar_bounds(t):
    return bounds(t.role("deals"), "month", 6)


@query(
    "formula_gap_stats",
    f"""with g as (select abs(remaining_lease_years + (case when txn_id % 3 = 0 then 0.5e0 else 0e0 end)
       - (99 - (transaction_year - lease_commence_date))) as gap from deals)
     select {r6('avg(gap)', 'avg_gap')}, {r6('quantile_disc(gap, 0.5)', 'median_gap')}, {r6('max(gap)', 'max_gap')} from g""",
    "deals",
)
def formula_gap_stats(t):
    shift = F.when(F.col("txn_id") % 3 == 0, 0.5).otherwise(0.0)
    rows = t.role("deals").withColumn("shifted", F.col("remaining_lease_years") + shift)
    return A.gap_stats(rows, "shifted", remaining_term("transaction_year", "lease_commence_date"))


METRICS = f"""count(*) as n, {r6('sqrt(avg(residual * residual))', 'rmse')}, {r6('avg(abs_error)', 'mae')},
 {r6('1 - avg(residual * residual) / var_pop(resale_price)', 'r2')}, {r6('avg(abs_pct_error)', 'mape')}"""


@query(
    "regression_metrics",
    f"""with {RESIDUALS} select flat_type, {METRICS} from res group by flat_type
     union all select 'overall', {METRICS} from res""",
    "deals",
)
def regression_metrics(t):
    rows = t.role("deals")
    overall = E.regression_metrics(rows, "resale_price")
    groups = E.regression_metrics(rows, "resale_price", by="flat_type")
    return groups.unionByName(overall.withColumn("flat_type", F.lit("overall")))


def _long(where):
    wide = f"""select sqrt(avg(residual * residual)) as rmse, avg(abs_error) as mae,
     1 - avg(residual * residual) / var_pop(resale_price) as r2, avg(abs_pct_error) as mape from res where {where}"""
    return f"(select unnest(['rmse', 'mae', 'r2', 'mape']) as metric, unnest([rmse, mae, r2, mape]) as value from ({wide}))"


@query(
    "metric_delta",
    f"""with {RESIDUALS}, a as {_long("flat_type = '1 ROOM'")}, b as {_long("flat_type = '2 ROOM'")}
     select metric, {r6('a.value', 'value_a')}, {r6('b.value', 'value_b')}, {r6('b.value - a.value', 'delta')},
     {r6('(b.value - a.value) / a.value * 100', 'delta_pct')} from a join b using (metric)""",
    "deals",
)
def metric_delta(t):
    parts = [
        E.metrics_long(E.regression_metrics(t.role("deals").where(F.col("flat_type") == kind), "resale_price").drop("n"))
        for kind in ("1 ROOM", "2 ROOM")
    ]
    return E.compare_metrics(*parts)


ERRORS = f"""{r6('avg(residual)', 'mean_residual')}, {r6('avg(abs_error)', 'mean_abs_error')},
 {r6('avg(abs_pct_error)', 'mape')}, count(*) as n"""


@query(
    "error_by_group",
    f"with {RESIDUALS} select town, flat_type, {ERRORS} from res group by 1, 2 having count(*) >= 50",
    "deals",
)
def error_by_group(t):
    return E.error_by(_residuals(t), ["town", "flat_type"], 50)


@query(
    "error_by_month",
    f"with {RESIDUALS} select strftime(month, '%Y-%m') as month, {ERRORS} from res group by 1",
    "deals",
)
def error_by_month(t):
    return E.error_by_month(_residuals(t), "month")


@query(
    "residual_summary",
    f"""with {RESIDUALS} select {r6('avg(residual)', 'mean_residual')}, {r6('stddev_samp(residual)', 'std_residual')},
     {r6('quantile_cont(abs_error, 0.5)', 'median_abs_error')}, {r6('quantile_cont(abs_error, 0.95)', 'p95_abs_error')},
     """ + ", ".join(
        f"(select {c} from res group by {c} order by avg(abs_pct_error) {way}, {c} limit 1) as {end}_{c}"
        for c in ("town", "flat_type") for end, way in (("hardest", "desc"), ("easiest", "asc"))
    ) + " from res",
    "deals",
)
def residual_summary(t):
    return E.residual_summary(_residuals(t), ["town", "flat_type"])


@query(
    "quality_violations",
    """with v as (select count(*) filter (where floor_area_sqm is null) as a, count(*) filter (where isnan(longitude)) as b,
      count(*) filter (where resale_price - prediction < 0) as c,
      count(*) filter (where transaction_quarter not in (0, 1)) as d,
      count(*) filter (where remaining_lease_years not between 40 and 80) as e from
      (select *, resale_price - prediction as gap from deals))
     select 'floor_area_sqm' as "column", 'null' as "check", a as n from v
     union all select 'longitude', 'nan', b from v union all select 'gap', 'negative', c from v
     union all select 'transaction_quarter', 'not_binary', d from v
     union all select 'remaining_lease_years', 'out_of_range', e from v""",
    "deals",
)
def quality_violations(t):
    rows = t.role("deals").withColumn("gap", F.col("resale_price") - F.col("prediction"))
    rules = ColumnRules(
        not_null=("floor_area_sqm",), not_nan=("longitude",), not_negative=("gap",),
        binary=("transaction_quarter",), ranges={"remaining_lease_years": (40, 80)},
    )
    return violations(rows, rules)
