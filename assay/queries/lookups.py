"""Queries of joins, lookups and nearest points."""

from pyspark.sql import functions as F

from assay.operators import lookups as L
from assay.operators.aggregates import keep_top_groups
from assay.operators.lookup_store import LookupStore
from assay.operators.nearest import nearest, within
from assay.operators.periods import growth
from assay.plans.features import DISTANCE_FEATURES
from assay.queries.registry import query, r6
from assay.session import scratch_path, settle

# The lookup keeps one row per address: one with coordinates first, then the least.
CACHE_ONE = """one as (select full_address, lat, lon, postal_code from (select *, row_number() over (partition by full_address
 order by lat is null, lat, lon, postal_code) as rn from cache) where rn = 1)"""


def _address_store(t) -> LookupStore:
    """The address cache as a store of its own."""
    schema = "full_address string, lat double, lon double, postal_code string"
    store = LookupStore(t.spark, scratch_path(t.spark, "addresses"), schema, "full_address", 8)
    store.add(t.role("cache"), [F.col("lat").isNull(), "lat"])
    return store


@query(
    "geocode_join",
    f"""with {CACHE_ONE}
     select txn_id, concat_ws(' ', block, street_name) as full_address, {r6('lat', 'lat')}, {r6('lon', 'lon')}, postal_code
     from txn left join one on concat_ws(' ', block, street_name) = one.full_address""",
    "txn", "cache",
)
def geocode_join(t):
    rows = t.role("txn").select("txn_id", F.concat_ws(" ", "block", "street_name").alias("full_address"))
    return _address_store(t).join(rows)


@query(
    "quarter_index_join",
    f"""select txn_id, transaction_year, transaction_quarter, {r6('coalesce(rpi_value, 0e0)', 'rpi_value')}
     from deals left join qindex_gap on transaction_year = rpi_year and transaction_quarter = rpi_quarter""",
    "deals", "qindex_gap",
)
def quarter_index_join(t):
    rows = t.role("deals").select("txn_id", "transaction_year", "transaction_quarter")
    on = {"transaction_year": "rpi_year", "transaction_quarter": "rpi_quarter"}
    return L.period_join(rows, t.role("qindex_gap"), on, 0.0)


GROWN = """grown as (select demo_year, median_household_income, total_population,
 coalesce((median_household_income - lag(median_household_income) over (order by demo_year)) / lag(median_household_income) over (order by demo_year), 0e0) as income_yoy_growth,
 coalesce((total_population - lag(total_population) over (order by demo_year)) / lag(total_population) over (order by demo_year), 0e0) as population_yoy_growth
 from demo),
 span as (select min(demo_year) as lo, max(demo_year) as hi from demo)"""


@query(
    "clamped_year_join",
    f"""with {GROWN.replace('from demo', 'from demo_gap')}
     select txn_id, transaction_year, {r6('median_household_income', 'median_household_income')}, total_population,
     {r6('income_yoy_growth', 'median_household_income_growth')} from deals, span
     left join grown on least(greatest(transaction_year, lo), hi) = demo_year""",
    "deals", "demo_gap",
)
def clamped_year_join(t):
    rows = t.role("deals").select("txn_id", "transaction_year")
    series = growth(t.role("demo_gap"), "demo_year", ["median_household_income"])
    return L.clamped_join(rows, series, "transaction_year", "demo_year", 0.0)


PAIRS = """locs as (select distinct round(latitude, 6) as lat, round(longitude, 6) as lon from deals
  where latitude is not null and longitude is not null),
 pairs as (select lat, lon, kind, ip_ind, sap_ind, autonomous_ind,
  pow(sin(radians(amen_lat - lat) / 2), 2) + cos(radians(lat)) * cos(radians(amen_lat)) * pow(sin(radians(amen_lon - lon) / 2), 2) as h
  from locs, amen),
 km as (select *, 2 * 6371e0 * atan2(sqrt(h), sqrt(1 - h)) as d from pairs),
 best as (select lat, lon, min(d) filter (where kind = 'mrt') as dist_nearest_mrt,
  min(d) filter (where kind = 'school') as dist_nearest_school,
  min(d) filter (where kind = 'supermarket') as dist_nearest_supermarket,
  min(d) filter (where kind = 'hawker') as dist_nearest_hawker,
  min(d) filter (where kind = 'shopping_mall') as dist_nearest_mall,
  min(d) filter (where kind = 'school' and ip_ind = 'Yes') as dist_nearest_ip_school,
  min(d) filter (where kind = 'school' and sap_ind = 'Yes') as dist_nearest_sap_school,
  min(d) filter (where kind = 'school' and autonomous_ind = 'Yes') as dist_nearest_auto_school
  from km group by lat, lon)"""


def _nearest(t, kinds, default=None):
    rows = t.role("deals").select("txn_id", "latitude", "longitude")
    return nearest(
        rows, t.role("amen"), "latitude", "longitude", "amen_lat", "amen_lon", kinds, default,
        on_empty="skip",
    )


def _kinds():
    return {out: F.col("kind") == key for key, out in DISTANCE_FEATURES.items()}


@query(
    "nearest_distance",
    f"""with {PAIRS} select txn_id, {', '.join(r6(c, c) for c in DISTANCE_FEATURES.values())}
     from deals left join best on round(latitude, 6) = lat and round(longitude, 6) = lon""",
    "deals", "amen",
)
def nearest_distance(t):
    return _nearest(t, _kinds()).drop("latitude", "longitude")


@query(
    "rounded_coord_join",
    f"""with {PAIRS} select txn_id, {r6('round(latitude, 6)', 'lat')}, {r6('round(longitude, 6)', 'lon')},
     {r6('coalesce(dist_nearest_mrt, 0e0)', 'dist_nearest_mrt')}
     from deals left join best on round(latitude, 6) = lat and round(longitude, 6) = lon""",
    "deals", "amen",
)
def rounded_coord_join(t):
    out = _nearest(t, {"dist_nearest_mrt": F.col("kind") == "mrt"}, 0.0)
    return out.withColumnsRenamed({"latitude": "lat", "longitude": "lon"})


@query(
    "full_outer_merge",
    f"""with a as (select demo_year as year, median_household_income as income from demo where demo_year <= 1999),
     b as (select demo_year as year, total_population as population from demo where demo_year >= 1997)
     select coalesce(a.year, b.year) as year, {r6('income', 'income')}, population
     from a full join b on a.year = b.year""",
    "demo",
)
def full_outer_merge(t):
    series = t.role("demo").withColumnRenamed("demo_year", "year")
    income = series.where("year <= 1999").select("year", F.col("median_household_income").alias("income"))
    people = series.where("year >= 1997").select("year", F.col("total_population").alias("population"))
    return L.merge_series(income, people, "year")


@query(
    "uncached_keys",
    """select distinct concat_ws(' ', block, street_name) as full_address from txn
     where concat_ws(' ', block, street_name) not in (select full_address from cache)""",
    "txn", "cache",
)
def uncached_keys(t):
    rows = t.role("txn").select(F.concat_ws(" ", "block", "street_name").alias("full_address"))
    return _address_store(t).missing(rows)


FOUND = "cast('1.' || lpad(cast(length(full_address) as varchar), 3, '0') as double)"


@query(
    "grown_cache",
    f"""with {CACHE_ONE},
     asked as (select txn_id, concat_ws(' ', block, street_name) as full_address from txn),
     found as (select full_address, {FOUND} as lat, 'found' as postal_code from (select distinct full_address from asked) keys
      where full_address not in (select full_address from cache) and full_address not like '% street 7'),
     grown as (select full_address, lat, postal_code from one union all select * from found)
     select txn_id, full_address, {r6('lat', 'lat')}, postal_code, full_address like '% street 7' and postal_code is null as pending
     from asked left join grown using (full_address)""",
    "txn", "cache",
)
def grown_cache(t):
    """What the cache lacks is looked up and added, some of it twice and some of it in vain; then all rows get coordinates."""
    rows = t.role("txn").select("txn_id", F.concat_ws(" ", "block", "street_name").alias("full_address"))
    store = _address_store(t)
    answer = F.concat(F.lit("1."), F.lpad(F.length("full_address").cast("string"), 3, "0")).cast("double")
    found = store.missing(rows).where(~F.col("full_address").endswith(" street 7")).select(
        "full_address", answer.alias("lat"), F.lit(None).cast("double").alias("lon"), F.lit("found").alias("postal_code")
    )
    found = settle(found, "found")
    store.add(found)
    store.add(found.withColumn("lat", F.lit(0.0)))  # known by now, so it changes nothing
    pending = store.missing(rows).select("full_address", F.lit(True).alias("_pending"))
    out = store.join(rows).join(pending, "full_address", "left")
    return out.select("txn_id", "full_address", "lat", "postal_code", F.coalesce("_pending", F.lit(False)).alias("pending"))


@query(
    "nearby_flag",
    f"""with {PAIRS} select txn_id, case when dist_nearest_ip_school <= 1 then 1 else 0 end as has_ip_school_nearby,
     case when dist_nearest_school <= 1 then 1 else 0 end as has_school_nearby
     from deals left join best on round(latitude, 6) = lat and round(longitude, 6) = lon""",
    "deals", "amen",
)
def nearby_flag(t):
    school = F.col("kind") == "school"
    out = _nearest(t, {"ip": school & (F.col("ip_ind") == "Yes"), "any": school})
    out = within(within(out, "ip", "has_ip_school_nearby"), "any", "has_school_nearby")
    return out.select("txn_id", "has_ip_school_nearby", "has_school_nearby")


@query(
    "best_candidate",
    f"""with ranked as (select *, case when contains(upper(building), upper(entity)) or contains(upper(coalesce(search_value, '')), upper(entity)) then 0
      when regexp_matches(upper(concat(building, '|', coalesce(search_value, ''))), 'SCHOOL|COLLEGE|ACADEMY|INSTITUTE|EDUCATION|CAMPUS') then 1 else 2 end as match_rank
      from cands),
     best as (select * from (select *, row_number() over (partition by entity order by term_no, match_rank, position) as rn from ranked) where rn = 1),
     parsed as (select *, try_cast(latitude as double) as y, try_cast(longitude as double) as x from best)
     select c_name as entity, term_no, match_rank, {r6('case when x is not null then y end', 'latitude')},
     {r6('case when y is not null then x end', 'longitude')} from customer left join parsed on c_name = entity""",
    "cands",
)
def best_candidate(t):
    entities = t.table("customer").select(F.col("c_name").alias("entity"))
    texts = ["building", "search_value"]
    return L.best_candidate(entities, t.role("cands"), "entity", "term_no", "position", texts)


@query(
    "filtered_nearest",
    f"""with {PAIRS} select txn_id, {r6('dist_nearest_ip_school', 'dist_nearest_ip_school')},
     {r6('dist_nearest_sap_school', 'dist_nearest_sap_school')}, {r6('dist_nearest_auto_school', 'dist_nearest_auto_school')}
     from deals left join best on round(latitude, 6) = lat and round(longitude, 6) = lon""",
    "deals", "amen",
)
def filtered_nearest(t):
    school = F.col("kind") == "school"
    kinds = {
        "dist_nearest_ip_school": school & (F.col("ip_ind") == "Yes"),
        "dist_nearest_sap_school": school & (F.col("sap_ind") == "Yes"),
        "dist_nearest_auto_school": school & (F.col("autonomous_ind") == "Yes"),
        "dist_nearest_none": F.col("ip_ind") == "Maybe",
    }
    return _nearest(t, kinds).drop("latitude", "longitude")


@query(
    "top_groups_semi",
    f"""with m as (select town, quantile_cont(resale_price, 0.5) as median from deals group by 1),
     top as (select town from m order by median desc, town limit 10)
     select txn_id, town, {r6('resale_price', 'resale_price')} from deals where town in (select town from top)""",
    "deals",
)
def top_groups_semi(t):
    rows = t.role("deals").select("txn_id", "town", "resale_price")
    return keep_top_groups(rows, "town", "resale_price", 10)
