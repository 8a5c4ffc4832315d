"""Queries of column functions and reshaping."""

from pyspark.sql import functions as F

from assay.functions import dates as D
from assay.functions import text as X
from assay.functions.geo import haversine_km, round_coord
from assay.operators import reshape as R
from assay.operators.errors import residuals
from assay.plans.cleaning import FLAT_TYPE_SPELLINGS
from assay.plans.cleaning import impute_term as fill_term
from assay.plans.features import Interaction, interactions
from assay.queries.registry import query, r6


@query("trim_upper", "select txn_id, upper(trim(flat_type)) as flat_type from txn", "txn")
def trim_upper(t):
    return t.role("txn").select("txn_id", X.trim_upper("flat_type").alias("flat_type"))


@query(
    "replace_values",
    """select txn_id, case when upper(trim(flat_type)) in ('MULTI GENERATION', 'MULTI-GEN') then 'MULTI-GENERATION'
     when upper(trim(flat_type)) in ('1 ROOM', '2 ROOM') then 'TINY' else upper(trim(flat_type)) end as flat_type from txn""",
    "txn",
)
def replace_values(t):
    rows = t.role("txn").select("txn_id", X.trim_upper("flat_type").alias("flat_type"))
    pairs = {**FLAT_TYPE_SPELLINGS, "1 ROOM": "2 ROOM", "2 ROOM": "TINY"}
    return rows.withColumn("flat_type", X.replace_values("flat_type", pairs))


MONTH_TEXT = """case txn_id % 6 when 0 then concat(month, '-15') when 1 then 'Jan 2017' when 2 then '' when 3 then null
 when 4 then concat(' ', month, ' ') else month end"""


@query(
    "parse_month",
    f"""with raw as (select txn_id, {MONTH_TEXT} as m from txn)
     select txn_id, case when regexp_matches(trim(m), '^\\d{{4}}-\\d{{2}}-\\d{{2}}') then try_cast(substr(trim(m), 1, 10) as date)
      when regexp_matches(trim(m), '^\\d{{4}}-\\d{{2}}$') then try_cast(concat(trim(m), '-01') as date) end as month from raw""",
    "txn",
)
def parse_month(t):
    raw = t.role("txn").select("txn_id", F.expr(MONTH_TEXT).alias("m"))
    return raw.select("txn_id", D.month_to_date("m").alias("month"))


@query(
    "parse_date",
    """with raw as (select o_orderkey, case o_orderkey % 3 when 0 then cast(cast(o_orderdate as date) as varchar)
      when 1 then '2017-13-45' else 'n/a' end as d from orders)
     select o_orderkey, try_cast(d as date) as day from raw""",
)
def parse_date(t):
    text = F.expr(
        "case o_orderkey % 3 when 0 then cast(cast(o_orderdate as date) as string) when 1 then '2017-13-45' else 'n/a' end"
    )
    return t.table("orders").select("o_orderkey", D.parse_date(text).alias("day"))


@query(
    "year_month_parts",
    "select txn_id, cast(substr(month, 1, 4) as int) as year, cast(substr(month, 6, 2) as int) as month from txn",
    "txn",
)
def year_month_parts(t):
    return t.role("txn").select("txn_id", D.year_part("month").alias("year"), D.month_part("month").alias("month"))


@query(
    "quarter_of_month",
    "select txn_id, cast((cast(substr(month, 6, 2) as int) - 1) // 3 + 1 as int) as quarter from txn",
    "txn",
)
def quarter_of_month(t):
    return t.role("txn").select("txn_id", D.quarter_of_month(D.month_part("month")).alias("quarter"))


@query(
    "year_of_date",
    "select o_orderkey, year(o_orderdate) as year, month(o_orderdate) as month from orders",
)
def year_of_date(t):
    day = F.to_date("o_orderdate")
    return t.table("orders").select("o_orderkey", F.year(day).alias("year"), F.month(day).alias("month"))


@query(
    "parse_duration",
    f"""with raw as (select txn_id, case when txn_id % 10 = 0 then '61' else remaining_lease end as s from txn)
     select txn_id, {r6("try_cast(nullif(regexp_extract(s, '(\\d+)\\s*[Yy]ear', 1), '') as double) + coalesce(try_cast(nullif(regexp_extract(s, '(\\d+)\\s*[Mm]onth', 1), '') as double), 0e0) / 12", 'years')} from raw""",
    "txn",
)
def parse_duration(t):
    raw = F.when(F.col("txn_id") % 10 == 0, "61").otherwise(F.col("remaining_lease"))
    return t.role("txn").select("txn_id", X.years_months(raw).alias("years"))


@query(
    "range_midpoint",
    """with raw as (select txn_id, case when txn_id % 10 = 0 then 'GROUND' else storey_range end as s from txn)
     select txn_id, (try_cast(nullif(regexp_extract(s, '^(\\d+)', 1), '') as double) + try_cast(nullif(regexp_extract(s, '(\\d+)$', 1), '') as double)) / 2 as storey_midpoint from raw""",
    "txn",
)
def range_midpoint(t):
    raw = F.when(F.col("txn_id") % 10 == 0, "GROUND").otherwise(F.col("storey_range"))
    return t.role("txn").select("txn_id", X.range_midpoint(raw).alias("storey_midpoint"))


@query(
    "remaining_term",
    "select txn_id, cast(99 - (transaction_year - lease_commence_date) as double) as years from deals",
    "deals",
)
def remaining_term(t):
    return t.role("deals").select(
        "txn_id", D.remaining_term("transaction_year", "lease_commence_date").alias("years")
    )


@query(
    "impute_term",
    f"""select txn_id, {r6("coalesce(try_cast(nullif(regexp_extract(remaining_lease, '(\\d+)\\s*[Yy]ear', 1), '') as double) + coalesce(try_cast(nullif(regexp_extract(remaining_lease, '(\\d+)\\s*[Mm]onth', 1), '') as double), 0e0) / 12, 99 - (cast(substr(month, 1, 4) as int) - cast(lease_commence_date as int)))", 'remaining_lease')} from txn""",
    "txn",
)
def impute_term(t):
    rows = t.role("txn").select(
        "txn_id", "month", F.col("lease_commence_date").try_cast("int").alias("lease_commence_date"),
        X.years_months("remaining_lease").alias("remaining_lease"),
    )
    return fill_term(rows, "remaining_lease").select("txn_id", "remaining_lease")


@query(
    "elapsed_years",
    "select txn_id, cast(transaction_year - lease_commence_date as double) as years from deals",
    "deals",
)
def elapsed_years(t):
    return t.role("deals").select(
        "txn_id", D.elapsed_years("transaction_year", "lease_commence_date").alias("years")
    )


@query(
    "bin_by_threshold",
    """select txn_id, case when storey_midpoint is null then 'unknown' when storey_midpoint <= 6 then 'low'
     when storey_midpoint <= 12 then 'mid' else 'high' end as storey_range_bin,
     case when storey_midpoint <= 6 then 'low' when storey_midpoint <= 12 then 'mid' else 'high' end as null_is_high from deals""",
    "deals",
)
def bin_by_threshold(t):
    edges, labels = [6, 12], ["low", "mid", "high"]
    return t.role("deals").select(
        "txn_id",
        X.bin_by("storey_midpoint", edges, labels).alias("storey_range_bin"),
        X.bin_by("storey_midpoint", edges, labels, null_label="high").alias("null_is_high"),
    )


@query(
    "interaction_product",
    f"""select txn_id, {r6('floor_area_sqm * remaining_lease_years', 'area_x_lease')},
     {r6('floor_area_sqm * remaining_lease_years * transaction_year', 'area_x_lease_x_year')}, 'town_x_type' as skipped from deals""",
    "deals",
)
def interaction_product(t):
    specs = [
        Interaction("area_x_lease", ("floor_area_sqm", "remaining_lease_years")),
        Interaction("area_x_lease_x_year", ("area_x_lease", "transaction_year")),
        Interaction("town_x_type", ("town_index", "flat_type_index"), "indexed_product"),
        Interaction("half", ("floor_area_sqm",)),
    ]
    out, created, skipped = interactions(t.role("deals"), specs)
    return out.select("txn_id", *created, F.lit(",".join(skipped)).alias("skipped"))


@query(
    "haversine_km",
    f"""with p as (select c_custkey, 1.22e0 + (c_custkey * 37 % 1000) * 0.024e0 as lat, 103.6e0 + (c_custkey * 91 % 1000) * 0.04e0 as lon from customer),
     h as (select *, pow(sin(radians(1.3521e0 - lat) / 2), 2) + cos(radians(lat)) * cos(radians(1.3521e0)) * pow(sin(radians(103.8198e0 - lon) / 2), 2) as h from p)
     select c_custkey, {r6('2 * 6371e0 * atan2(sqrt(h), sqrt(1 - h))', 'km')} from h""",
)
def haversine(t):
    key = F.col("c_custkey")
    lat = F.lit(1.22) + (key * 37 % 1000) * F.lit(0.024)
    lon = F.lit(103.6) + (key * 91 % 1000) * F.lit(0.04)
    return t.table("customer").select("c_custkey", haversine_km(lat, lon, F.lit(1.3521), F.lit(103.8198)).alias("km"))


QUARTER_TEXT = """case when o_orderkey % 7 = 0 then '1990Q1' when o_orderkey % 7 = 1 then '2000-Q5x' when o_orderkey % 7 = 2 then ''
 else concat(cast(year(o_orderdate) as string), '-Q', cast(quarter(o_orderdate) as string)) end"""


@query(
    "parse_quarter",
    """select o_orderkey, cast(year(o_orderdate) as int) as year, cast(quarter(o_orderdate) as int) as quarter
     from orders where o_orderkey % 7 > 2""",
)
def parse_quarter(t):
    raw = t.table("orders").select("o_orderkey", F.expr(QUARTER_TEXT).alias("q"))
    year, quarter = X.quarter_parts("q")
    parsed = raw.select("o_orderkey", year.alias("year"), quarter.alias("quarter"))
    return parsed.na.drop(subset=["year", "quarter"])


CLEAN_TEXT = """case o_orderkey % 8 when 0 then 'na' when 1 then 'NA' when 2 then '' when 3 then '-' when 4 then 'abc'
 when 5 then concat(' ', cast(o_orderkey % 900 + 1 as string), ',', '591 ') when 6 then null else cast(o_orderkey as string) end"""


@query(
    "clean_number",
    """select o_orderkey, case o_orderkey % 8 when 5 then cast((o_orderkey % 900 + 1) * 1000 + 591 as double)
     when 7 then cast(o_orderkey as double) end as value from orders""",
)
def clean_number(t):
    raw = t.table("orders").select("o_orderkey", F.expr(CLEAN_TEXT).alias("x"))
    return raw.select("o_orderkey", X.clean_number("x").alias("value"))


@query(
    "round_coord",
    "select distinct round(latitude / 3, 6) + 0e0 as lat, round(longitude / 7, 6) + 0e0 as lon from deals",
    "deals",
)
def round_coord_query(t):
    return t.role("deals").select(
        round_coord(F.col("latitude") / 3).alias("lat"), round_coord(F.col("longitude") / 7).alias("lon")
    ).distinct()


@query(
    "residual_cols",
    f"""select txn_id, {r6('resale_price - prediction', 'residual')}, {r6('abs(resale_price - prediction)', 'abs_error')},
     {r6('case when resale_price <> 0 then abs(resale_price - prediction) / resale_price * 100 end', 'abs_pct_error')} from deals""",
    "deals",
)
def residual_cols(t):
    rows = t.role("deals").select("txn_id", "resale_price", "prediction")
    return residuals(rows, "resale_price").drop("resale_price", "prediction")


@query("month_label", "select txn_id, strftime(month, '%Y-%m') as label from deals", "deals")
def month_label(t):
    return t.role("deals").select("txn_id", D.month_label("month").alias("label"))


@query(
    "date_shift_trunc",
    "select txn_id, cast(date_trunc('quarter', month - interval 6 month) as date) as cutoff from deals",
    "deals",
)
def date_shift_trunc(t):
    return t.role("deals").select("txn_id", D.quarters_back("month", 6).alias("cutoff"))


# Yearly sums by return flag, one column per year, as text with thousands commas.
YEARS = list(range(1995, 2003))
WIDE = ", ".join(
    f"""case when l_returnflag = 'N' and {y} % 2 = 0 then 'na' else
 concat(cast(cast(count(case when year(l_shipdate) = {y} then 1 end) as int) div 1000 as string), ',',
 lpad(cast(count(case when year(l_shipdate) = {y} then 1 end) % 1000 as string), 3, '0')) end as `{y}`"""
    for y in YEARS
)


def _wide(t):
    sql = f"select concat(' ', l_returnflag, ' ') as DataSeries, {WIDE}, 'x' as notes, '7' as `1990` from {{l}} group by l_returnflag"
    return t.spark.sql(sql, l=t.table("lineitem"))


LONG = """long as (select f as "DataSeries", y as year, case when f = 'N' and y % 2 = 0 then null else
 (select cast(count(*) as double) from lineitem where l_returnflag = f and year(l_shipdate) = y) end as value
 from (select distinct l_returnflag as f from lineitem), (select cast(unnest(range(1996, 2002)) as int) as y))"""


@query("melt_years", f"with {LONG} select * from long")
def melt_years(t):
    return R.melt_years(_wide(t), "DataSeries", 1996, 2001)


@query("pick_series", f"""with {LONG} select year, value as total_population from long where "DataSeries" = 'A'""")
def pick_series(t):
    return R.pick_series(R.melt_years(_wide(t), "DataSeries", 1996, 2001), "DataSeries", "A", "total_population")
