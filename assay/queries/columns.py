"""Queries of projection, alignment, filters and null handling."""

from pyspark.sql import functions as F

from assay.functions.dates import year_part
from assay.functions.text import guarded_cast
from assay.operators import columns as C
from assay.plans.cleaning import FLAT_TYPES, waterfall
from assay.plans.extracts import TRANSACTION_SCHEMA as PRICE_SCHEMA
from assay.queries.registry import query, r6
from assay.session import attach

@query("normalise_names", "select txn_id, flat_type, storey_range from txn", "txn")
def normalise_names(t):
    rows = t.role("txn")
    return C.normalise_names(
        rows.select(
            F.col("txn_id").alias(" Txn ID "), F.col("flat_type").alias("Flat Type"),
            F.col("storey_range").alias("storey range "),
        )
    )


@query(
    "align_schema",
    """select month, town, flat_type, block, street_name, storey_range,
     try_cast(nullif(floor_area_sqm, 'n/a') as double) as floor_area_sqm, flat_model,
     cast(lease_commence_date as int) as lease_commence_date, cast(null as varchar) as remaining_lease,
     cast(resale_price as double) as resale_price, '2000-Feb2012' as _source from txn""",
    "txn",
)
def align_schema(t):
    extract = t.role("txn").drop("remaining_lease").withColumnRenamed("flat_type", "Flat Type")
    return C.align_schema(extract, PRICE_SCHEMA, "2000-Feb2012")


NUMBER_TEXT = """case o_orderkey % 8 when 0 then '1e5' when 1 then 'n/a' when 2 then '-3.5' when 3 then '67'
 when 4 then '' when 5 then ' 12' when 6 then null else cast(o_orderkey as string) end"""


@query(
    "guarded_cast",
    f"""with raw as (select o_orderkey, {NUMBER_TEXT} as x from orders)
     select o_orderkey, case when regexp_full_match(x, '-?\\d+(\\.\\d+)?') then try_cast(x as double) end as as_double,
     case when regexp_full_match(x, '\\d+') then try_cast(x as int) end as as_int from raw""",
)
def guarded_cast_query(t):
    raw = t.table("orders").select("o_orderkey", F.expr(NUMBER_TEXT).alias("x"))
    return raw.select(
        "o_orderkey", guarded_cast("x", "double").alias("as_double"), guarded_cast("x", "int").alias("as_int")
    )


@query("select_drop_protected", "select txn_id, town, resale_price from deals", "deals")
def select_drop_protected(t):
    rows = t.role("deals").select("txn_id", "town", "resale_price", "flat_model", "month")
    return C.drop_columns(rows, ["town", "flat_model", "month", "absent"], {"town", "resale_price"})


@query(
    "derive_key",
    "select txn_id, concat_ws(' ', block, street_name, flat_model) as full_address from txn",
    "txn",
)
def derive_key(t):
    rows = C.derive_key(t.role("txn"), ["block", "street_name", "flat_model"], "full_address")
    return rows.select("txn_id", "full_address")


@query(
    "drop_missing_coords",
    f"""with gone as (select *, latitude is null or isnan(longitude) as bad from txn)
     select txn_id, {r6('latitude', 'latitude')}, {r6('longitude', 'longitude')},
     (select count(*) from gone) as n_before, (select count(*) from gone where bad) as n_removed,
     {r6('(select count(*) from gone where bad) * 100e0 / (select count(*) from gone)', 'removed_pct')}
     from gone where not bad""",
    "txn",
)
def drop_missing_coords(t):
    rows = t.role("txn").select("txn_id", "latitude", "longitude")
    kept, stats = C.drop_missing(rows, ["latitude", "longitude"])
    return attach(kept, stats)


@query(
    "drop_blank",
    """with raw as (select txn_id, case when txn_id % 5 = 0 then '  ' else remaining_lease end as lease from txn)
     select txn_id, lease from raw where trim(lease) <> ''""",
    "txn",
)
def drop_blank(t):
    lease = F.when(F.col("txn_id") % 5 == 0, "  ").otherwise(F.col("remaining_lease"))
    return C.drop_blank(t.role("txn").select("txn_id", lease.alias("lease")), "lease")


@query(
    "drop_null_subset",
    """select txn_id, floor_area_sqm, storey_midpoint, flat_model from deals
     where floor_area_sqm is not null and storey_midpoint is not null""",
    "deals",
)
def drop_null_subset(t):
    rows = t.role("deals").select("txn_id", "floor_area_sqm", "storey_midpoint", "flat_model")
    return C.dropna(rows, ["floor_area_sqm", "storey_midpoint"])


@query(
    "whitelist_filter",
    """with up as (select upper(trim(flat_type)) as flat_type from txn),
     seen as (select flat_type, count(*) as n, flat_type in ('1 ROOM', '2 ROOM', '3 ROOM', '4 ROOM', '5 ROOM',
      'EXECUTIVE', 'MULTI-GENERATION') as canonical from up group by 1)
     select flat_type, n, canonical from seen""",
    "txn",
)
def whitelist_filter(t):
    rows = t.role("txn").select(F.upper(F.trim("flat_type")).alias("flat_type"))
    kept, others = C.whitelist(rows, "flat_type", FLAT_TYPES)
    counts = kept.groupBy("flat_type").agg(F.count("*").alias("n"))
    return counts.withColumn("canonical", F.lit(True)).union(others.withColumn("canonical", F.lit(False)))


@query(
    "range_filter",
    "select txn_id, floor_area_sqm, resale_price from deals where floor_area_sqm >= 40 and floor_area_sqm <= 90 and resale_price > 0",
    "deals",
)
def range_filter(t):
    rows = t.role("deals").select("txn_id", "floor_area_sqm", "resale_price")
    return C.range_filter(
        C.range_filter(rows, "floor_area_sqm", 40, 90), "resale_price", 0, inclusive=False
    )


@query("indicator_filter", "select amenity_id, kind from amen where ip_ind = 'Yes'", "amen")
def indicator_filter(t):
    return C.indicator_filter(t.role("amen"), "ip_ind", "Yes").select("amenity_id", "kind")


@query(
    "ci_filter_agg",
    f"""select {r6('min(resale_price)', 'min_value')}, {r6('avg(resale_price)', 'avg_value')},
     {r6('max(resale_price)', 'max_value')}, count(*) as n from deals
     where lower(town) = 'nation_7' and resale_price is not null""",
    "deals",
)
def ci_filter_agg(t):
    return C.spot_check(t.role("deals"), "town", "Nation_7", "resale_price")


@query(
    "fill_defaults",
    """select txn_id, coalesce(floor_area_sqm, 0e0) as floor_area_sqm, coalesce(storey_midpoint, 1e0) as storey_midpoint,
     coalesce(flat_model, 'unknown') as flat_model from deals""",
    "deals",
)
def fill_defaults(t):
    rows = t.role("deals").select("txn_id", "floor_area_sqm", "storey_midpoint", "flat_model")
    filled = C.fill_defaults(rows, {"floor_area_sqm": 0.0, "storey_midpoint": 1.0, "absent": 0.0})
    return C.fill_unknown(filled, ["flat_model"])


@query(
    "clamp_min",
    f"select txn_id, {r6('case when resale_price - 100000 < 0 then 0e0 else resale_price - 100000 end', 'gap')} from deals",
    "deals",
)
def clamp_min(t):
    return C.clamp(t.role("deals").select("txn_id", (F.col("resale_price") - 100000).alias("gap")), "gap", 0.0)


@query(
    "adaptive_column",
    """select txn_id, coalesce(case when txn_id % 2 = 0 then cast(lease_commence_date as int) end,
     cast(substr(month, 1, 4) as int)) as year_of from txn""",
    "txn",
)
def adaptive_column(t):
    lease = F.when(F.col("txn_id") % 2 == 0, F.col("lease_commence_date").try_cast("int"))
    rows = t.role("txn").select("txn_id", "month", lease.alias("start_year"))
    out = C.coalesce_columns(
        rows, "year_of", ["transaction_year", "start_year", ("month", year_part("month"))], "int"
    )
    return out.select("txn_id", "year_of")


@query(
    "surrogate_key",
    """select o_orderkey, md5(concat('{"o_orderkey":', o_orderkey, ',"o_orderstatus":"', o_orderstatus, '"}')) as row_id
     from orders""",
)
def surrogate_key(t):
    rows = t.table("orders").select("o_orderkey", "o_orderstatus")
    return C.with_row_id(rows, ["o_orderkey", "o_orderstatus"]).drop("o_orderstatus")


@query(
    "remove_flagged",
    f"""with f as (select txn_id, resale_price > 400000 as flag from deals)
     select txn_id, (select count(*) from f where flag) as n_removed,
     {r6('(select count(*) from f where flag) * 100e0 / (select count(*) from f)', 'removed_pct')}
     from f where not coalesce(flag, false)""",
    "deals",
)
def remove_flagged(t):
    rows = t.role("deals").select("txn_id", (F.col("resale_price") > 400000).alias("flag"))
    kept, stats = C.remove_flagged(rows, "flag")
    return attach(kept, stats.drop("n_before"))


@query(
    "cleaning_waterfall",
    f"""with f as (select upper(trim(flat_type)) <> 'STUDIO' as a, try_cast(floor_area_sqm as double) > 0 as b,
      latitude is not null and not isnan(longitude) as c from txn),
     s as (select count(*) as s0, count(*) filter (where a) as s1, count(*) filter (where a and b) as s2,
      count(*) filter (where a and b and c) as s3 from f)
     select 0 as stage_no, 'raw' as stage, s0 as n, s0 - s0 as change, {r6('s0 * 100e0 / s0', 'pct_of_raw')} from s
     union all select 1, 'canonical type', s1, s1 - s0, {r6('s1 * 100e0 / s0', 'pct_of_raw')} from s
     union all select 2, 'positive area', s2, s2 - s1, {r6('s2 * 100e0 / s0', 'pct_of_raw')} from s
     union all select 3, 'located', s3, s3 - s2, {r6('s3 * 100e0 / s0', 'pct_of_raw')} from s""",
    "txn",
)
def cleaning_waterfall(t):
    rows = t.role("txn")
    return waterfall(
        rows,
        {
            "canonical type": F.upper(F.trim("flat_type")) != "STUDIO",
            "positive area": F.col("floor_area_sqm").try_cast("double") > 0,
            "located": ~C.any_missing(rows, ["latitude", "longitude"]),
        },
    )
