"""Queries of windows, ordering, samples, splits, unions and de-duplication."""

from functools import reduce

from pyspark.sql import functions as F

from assay.operators import ordering as O
from assay.operators import sets as S
from assay.operators.aggregates import corr_with
from assay.operators.errors import residuals, sample_predictions
from assay.operators.outliers import flag_iqr, flag_zscore
from assay.operators.periods import growth, rolling_mean
from assay.operators.quantiles import exact_quantiles, group_median
from assay.queries.registry import query, r6
from assay.session import settle

# A key's place among 16 ** 15, as `ordering.place_of` has it.
PLACE = "('0x' || substr(md5(concat('42:', {0})), 1, 15))::bigint"


def within_share(key: str, fraction: float) -> str:
    return f"{PLACE.format(key)} < {O.first_places(fraction)}"


# Down to shares of which a table of this size has no row.
SHARES = (0.03, 1e-3, 1e-6)


@query(
    "yoy_growth",
    f"""with y as (select l_returnflag, cast(year(l_shipdate) as int) as year, sum(l_quantity) as quantity from lineitem group by 1, 2)
     select l_returnflag, year, {r6('quantity', 'quantity')},
     {r6('coalesce((quantity - lag(quantity) over w) / lag(quantity) over w, 0e0)', 'quantity_growth')}
     from y window w as (partition by l_returnflag order by year)""",
)
def yoy_growth(t):
    yearly = t.table("lineitem").groupBy("l_returnflag", F.year("l_shipdate").alias("year")).agg(
        F.sum("l_quantity").alias("quantity")
    )
    return growth(yearly, "year", "quantity", "l_returnflag")


@query(
    "rolling_mean",
    f"""with m as (select month, flat_type, quantile_disc(resale_price, 0.5) as median from deals group by 1, 2)
     select month, flat_type, {r6('avg(median) over (partition by flat_type order by month rows between 5 preceding and current row)', 'median')} from m""",
    "deals",
)
def rolling_mean_query(t):
    medians = group_median(t.role("deals"), ["month", "flat_type"], "resale_price")
    return rolling_mean(medians, "flat_type", "month", "median", 6)


SERIES = "partition by l_returnflag order by l_shipdate, l_orderkey, l_linenumber"


@query(
    "long_series",
    f"""select l_orderkey, l_linenumber, {r6(f'avg(l_quantity) over ({SERIES} rows between 5 preceding and current row)', 'trend')},
     {r6(f'coalesce((l_quantity - lag(l_quantity) over ({SERIES})) / lag(l_quantity) over ({SERIES}), 0e0)', 'l_quantity_growth')}
     from lineitem""",
)
def long_series(t):
    """Three series of all lines, each over several tasks."""
    order = ["l_shipdate", "l_orderkey", "l_linenumber"]
    rows = t.table("lineitem").select("l_returnflag", *order, "l_quantity")
    smooth = rolling_mean(rows, "l_returnflag", order, "l_quantity", 6, "trend", block_rows=5000)
    both = growth(smooth, order, "l_quantity", "l_returnflag", block_rows=5000)
    return both.select("l_orderkey", "l_linenumber", "trend", "l_quantity_growth")


@query(
    "zscore_flag",
    """with s as (select town, avg(resale_price) as m, stddev_samp(resale_price) as s from deals group by town),
     g as (select avg(resale_price) as m, stddev_samp(resale_price) as s from deals)
     select txn_id, coalesce(abs(resale_price - s.m) / s.s > 1.5e0, false) as resale_price_outlier,
     coalesce(abs(resale_price - g.m) / g.s > 1.7e0, false) as far from deals join s using (town), g""",
    "deals",
)
def zscore_flag(t):
    rows = t.role("deals").select("txn_id", "town", "resale_price")
    out = flag_zscore(flag_zscore(rows, "resale_price", "town", 1.5), "resale_price", threshold=1.7, out="far")
    return out.drop("town", "resale_price")


@query(
    "iqr_flag",
    """with q as (select quantile_cont(resale_price, 0.25) as q1, quantile_cont(resale_price, 0.75) as q3 from deals)
     select txn_id, coalesce(resale_price < q1 - 0.4e0 * (q3 - q1) or resale_price > q3 + 0.4e0 * (q3 - q1), false) as resale_price_outlier
     from deals, q""",
    "deals",
)
def iqr_flag(t):
    return flag_iqr(t.role("deals").select("txn_id", "resale_price"), "resale_price", 0.4).drop("resale_price")


@query("order_by", "select c_custkey, c_mktsegment, c_name from customer")
def order_by(t):
    return O.order_by(t.table("customer").select("c_custkey", "c_mktsegment", "c_name"), ["c_mktsegment", "c_name"], "c_custkey")


@query(
    "top_k_groups",
    f"""with m as (select town, quantile_cont(resale_price, 0.5) as median from deals where resale_price is not null group by town)
     select * from (select town, {r6('median', 'median')}, 'high' as side from m order by median desc, town limit 10)
     union all select * from (select town, {r6('median', 'median')}, 'low' as side from m order by median, town limit 10)""",
    "deals",
)
def top_k_groups(t):
    medians = exact_quantiles(t.role("deals"), "resale_price", {"median": 0.5}, "town")
    high = O.top_k(medians, "median", 10, "town").withColumn("side", F.lit("high"))
    return high.union(O.top_k(medians, "median", 10, "town", True).withColumn("side", F.lit("low")))


@query("limit_n", "select count(*) as n from (select * from lineitem limit 3)")
def limit_n(t):
    return O.limit_rows(t.table("lineitem"), 3).agg(F.count("*").alias("n"))


@query(
    "bernoulli_sample",
    " union all ".join(
        f"select {share}::double as share, l_orderkey, l_linenumber, l_partkey from lineitem where {within_share('l_orderkey', share)}"
        for share in SHARES
    ),
)
def bernoulli_sample(t):
    rows = t.table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    parts = [O.sample_by_key(rows, "l_orderkey", s).select(F.lit(s).alias("share"), "*") for s in SHARES]
    return reduce(lambda a, b: a.union(b), parts)


@query(
    "n_sample",
    """with p as (select * from deals where resale_price is not null and resale_price <> 0)
     select txn_id, month, town, cast(round(resale_price) as bigint) as actual, cast(round(prediction) as bigint) as predicted,
     cast(round(abs(resale_price - prediction)) as bigint) as abs_error,
     round(abs(resale_price - prediction) / resale_price * 100, 2) + 0e0 as pct_error
     from p order by md5(concat('42:', txn_id)), txn_id limit 10""",
    "deals",
)
def n_sample(t):
    rows = residuals(t.role("deals"), "resale_price").where(F.col("resale_price") != 0)
    return sample_predictions(rows, "txn_id", ["txn_id", "month", "town"], "resale_price", 10)


@query(
    "random_split",
    " union all ".join(
        f"select {share}::double as share, o_orderkey, case when {within_share('o_orderkey', share)} then 'train' else 'test' end as part from orders"
        for share in (0.8, 0.99999)
    ),
)
def random_split(t):
    rows, parts = t.table("orders").select("o_orderkey"), []
    for share in (0.8, 0.99999):
        train, test = O.split_by_key(rows, "o_orderkey", share)
        parts += [p.select(F.lit(share).alias("share"), "o_orderkey", F.lit(name).alias("part")) for p, name in ((train, "train"), (test, "test"))]
    return reduce(lambda a, b: a.union(b), parts)


@query(
    "temporal_split",
    f"""with c as (select cast(date_trunc('quarter', max(month) - interval 6 month) as date) as cutoff from deals),
     p as (select case when month < cutoff then 'train' else 'holdout' end as part, month from deals, c)
     select part, count(*) as n, min(month) as low, max(month) as high,
     {r6('count(*) / (select cast(count(*) as double) from deals)', 'share')} from p group by part""",
    "deals",
)
def temporal_split(t):
    report = O.split_report(t.role("deals"), "month", 6)
    O.check_no_overlap(report)
    return report


@query(
    "sort_abs",
    " union all ".join(
        f"select '{c}' as feature, {r6(f'corr({c}, resale_price)', 'r')} from deals"
        for c in ["floor_area_sqm", "storey_midpoint", "remaining_lease_years"]
    ),
    "deals",
)
def sort_abs(t):
    columns = ["floor_area_sqm", "storey_midpoint", "remaining_lease_years"]
    return O.sort_abs(corr_with(t.role("deals"), columns, "resale_price"), "r", "feature")


def _extracts(t):
    rows = t.role("txn").select("txn_id", "month", "town", "remaining_lease")
    parts = [rows.where(F.col("txn_id") % 4 == i).withColumn("_source", F.lit(f"part {i}")) for i in range(4)]
    return [*parts[:3], parts[3].drop("remaining_lease")]


@query(
    "union_by_name",
    """select txn_id, month, town, case when txn_id % 4 <> 3 then remaining_lease end as remaining_lease,
     concat('part ', txn_id % 4) as _source from txn""",
    "txn",
)
def union_by_name(t):
    return S.union_all(_extracts(t))


@query("dedupe_rows", "select distinct month, town, flat_type, flat_model from txn", "txn")
def dedupe_rows(t):
    rows = t.role("txn").select("month", "town", "flat_type", "flat_model")
    return S.dedupe_rows(S.union_all([rows, rows.where("flat_type is not null")]))


@query(
    "dedupe_keys",
    f"""with r as (select *, row_number() over (partition by town, flat_type order by month desc, txn_id) as rn from deals)
     select town, flat_type, month, txn_id, {r6('resale_price', 'resale_price')} from r where rn = 1""",
    "deals",
)
def dedupe_keys(t):
    rows = t.role("deals").select("town", "flat_type", "month", "txn_id", "resale_price")
    later_first = F.datediff(F.lit("2100-01-01").cast("date"), F.col("month"))
    return S.dedupe_keys(rows, ["town", "flat_type"], [later_first, "txn_id"])


@query("distinct_keys", "select distinct block, street_name from txn", "txn")
def distinct_keys(t):
    return S.distinct_keys(t.role("txn"), ["block", "street_name"])


@query(
    "union_keys",
    "select o_custkey as k from orders union select c_custkey from customer",
)
def union_keys(t):
    a = t.table("orders").select(F.col("o_custkey").alias("k"))
    return S.union_keys(a, t.table("customer").select(F.col("c_custkey").alias("k")), "k")
