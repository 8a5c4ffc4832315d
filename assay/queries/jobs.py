"""Queries of whole jobs: cleaning, gates, feature building and checks."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from assay.operators.columns import align_schema
from assay.operators.quantiles import group_median
from assay.operators.periods import rolling_mean
from assay.plans import checks as K
from assay.plans.cleaning import CATEGORICALS, config_clean, derive_config, finish
from assay.plans.features import DISTANCE_FEATURES, FeatureConfig, Interaction, Sources, engineer, time_features
from assay.queries.columns import PRICE_SCHEMA
from assay.queries.lookups import GROWN, PAIRS
from assay.queries.registry import query, r6
from assay.session import settle

KEYED_SCHEMA = T.StructType([T.StructField("txn_id", T.LongType()), *PRICE_SCHEMA.fields])

CLEAN = """typed as (select txn_id, try_cast(concat(month, '-01') as date) as month, upper(trim(town)) as town,
  case when upper(trim(flat_type)) in ('MULTI GENERATION', 'MULTI-GEN') then 'MULTI-GENERATION' else upper(trim(flat_type)) end as flat_type,
  upper(trim(flat_model)) as flat_model, try_cast(floor_area_sqm as double) as floor_area_sqm,
  cast(substr(month, 1, 4) as int) as transaction_year, cast(substr(month, 6, 2) as int) as transaction_month,
  (cast(substr(storey_range, 1, 2) as double) + cast(substr(storey_range, 7, 2) as double)) / 2 as storey_midpoint,
  cast(lease_commence_date as int) as lease_commence_date,
  cast(99 - (cast(substr(month, 1, 4) as int) - cast(lease_commence_date as int)) as double) as remaining_lease_years,
  cast(resale_price as double) as resale_price from txn),
 present as (select * from typed where floor_area_sqm is not null),
 q as (select quantile_cont(resale_price, 0.25) as q1, quantile_cont(resale_price, 0.75) as q3 from present),
 cleaned as (select present.* from present, q where flat_type <> 'STUDIO' and floor_area_sqm > 0
  and resale_price between q1 - 0.4e0 * (q3 - q1) and q3 + 0.4e0 * (q3 - q1))"""


def cleaned_with_log(t, threshold=0.4):
    # Text is typed and written once; profiling, quartiles and cleaning then read columns of that.
    raw = settle(align_schema(t.role("txn"), KEYED_SCHEMA, "all"), "typed")
    config = derive_config(raw, outlier_threshold=threshold)
    rows, log = config_clean(raw, config)
    return finish(rows), log


def cleaned(t, threshold=0.4):
    return cleaned_with_log(t, threshold)[0]


@query(
    "config_clean",
    f"""with {CLEAN} select txn_id, month, town, flat_type, flat_model, {r6('floor_area_sqm', 'floor_area_sqm')},
     transaction_year, transaction_month, storey_midpoint, lease_commence_date, remaining_lease_years,
     {r6('resale_price', 'resale_price')} from cleaned""",
    "txn",
)
def config_clean_query(t):
    return cleaned(t).drop("block", "street_name", "storey_range")


LOGGED = [
    *[("trim_uppercase", c) for c in CATEGORICALS], ("parse_yyyymm_date", "month"), ("derive_year_month", "month"),
    ("parse_storey_range", "storey_range"), ("standardise_values", "flat_type"), ("compute_remaining_lease", "lease_commence_date"),
    ("drop_column", "remaining_lease"), ("drop_column", "_source"), ("flag_outliers_iqr", "resale_price"),
]
#: Columns of the raw table that may have nulls or blanks, and so may be asked to have none.
EMPTYABLE = ["month", "town", "flat_type", "block", "street_name", "storey_range", "lease_commence_date", "resale_price"]


@query(
    "cleaning_log",
    "select step, \"column\", 'applied' as status from (values " + ", ".join(map(str, LOGGED)) + """) as steps(step, "column")
     union all select 'drop_nulls', 'floor_area_sqm', 'applied' where (select count(*) from txn where try_cast(floor_area_sqm as double) is null) > 0
     """ + " ".join(
        f"union all select 'drop_nulls', '{c}', 'applied' where (select count(*) from txn where {c} is null or trim({c}) = '') > 0" for c in EMPTYABLE
    ),
    "txn",
)
def cleaning_log(t):
    """The steps that the derived configuration asked for, and what became of each."""
    return cleaned_with_log(t)[1]


TREND = f"""with {CLEAN},
 m as (select month, flat_type, quantile_disc(resale_price, 0.5) as median_price from cleaned group by 1, 2)
 select month, flat_type, {r6('median_price', 'median_price')},
 {r6('avg(median_price) over (partition by flat_type order by month rows between 5 preceding and current row)', 'trend')} from m"""


@query("price_trend", TREND, "txn")
def price_trend(t):
    """The headline: raw text to a cleaned table to the smoothed monthly median per type."""
    medians = group_median(cleaned(t), ["month", "flat_type"], "resale_price", "median_price")
    return rolling_mean(medians, "flat_type", "month", "median_price", 6, "trend")


@query(
    "quality_gate",
    f"""with g as (select count(*) as n, count(*) filter (where flat_model is null) as blank, count(distinct town) as towns,
      count(distinct transaction_year) as years, {r6('count(latitude) * 100e0 / count(*)', 'pct')} from deals)
     select 'rows' as rule, cast(n as double) as actual, 100e0 as threshold, n >= 100 as passed from g
     union all select 'blank_names', cast(blank as double), 0e0, blank = 0 from g
     union all select 'rows', cast(n as double), 400e0, n >= 400 from g
     union all select 'rows', cast(n as double), 150e0, n >= 150 from g
     union all select 'quarters', cast(n as double), 100e0, n >= 100 from g
     union all select 'stations', cast(towns as double), 100e0, towns >= 100 from g
     union all select 'exits', cast(n as double), 300e0, n >= 300 from g
     union all select 'geocoded_pct', pct, 80e0, pct >= 80 from g
     union all select 'years', cast(years as double), 20e0, years >= 20 from g""",
    "deals",
)
def quality_gate(t):
    rules = [
        *K.hawker_expectations("flat_model"), *K.supermarket_expectations(), *K.station_expectations("town"),
        *K.school_expectations(), *K.demographics_expectations("transaction_year"), *K.index_expectations(),
    ]
    return K.gate(t.role("deals"), rules)


AREA_LEASE = Interaction("floor_area_x_remaining_lease", ("floor_area_sqm", "remaining_lease_years"))


def sources(t):
    return Sources(t.role("amen"), t.role("qindex"), t.role("demo"))


def engineered(t, **options):
    config = FeatureConfig(interactions=(AREA_LEASE,), drop=("storey_midpoint_x", "town", "latitude"))
    return engineer(time_features(t.role("deals")), sources(t), config, id_keys=["txn_id"], **options)[0]


DISTANCES = [
    *DISTANCE_FEATURES.values(), "dist_nearest_ip_school", "dist_nearest_sap_school", "dist_nearest_auto_school",
]
FEATURES = f"""{PAIRS}, {GROWN},
 feat as (select deals.*, {', '.join(f'coalesce({c}, 0e0) as {c}' for c in DISTANCES)},
  coalesce(rpi_value, 0e0) as hdb_rpi, median_household_income, total_population, income_yoy_growth, population_yoy_growth
  from deals left join best on round(latitude, 6) = lat and round(longitude, 6) = lon
  left join qindex on transaction_year = rpi_year and transaction_quarter = rpi_quarter
  left join (select * from span, grown) on least(greatest(transaction_year, lo), hi) = demo_year)"""


@query(
    "feature_engineer",
    f"""with {FEATURES} select txn_id, md5(concat('{{"txn_id":', txn_id, '}}')) as flat_id, town, {', '.join(r6(c, c) for c in DISTANCES)},
     case when dist_nearest_ip_school <= 1 then 1 else 0 end as has_ip_school_nearby,
     case when dist_nearest_sap_school <= 1 then 1 else 0 end as has_sap_school_nearby,
     case when dist_nearest_auto_school <= 1 then 1 else 0 end as has_autonomous_school_nearby,
     {r6('hdb_rpi', 'hdb_rpi')}, {r6('median_household_income', 'median_household_income')}, total_population,
     {r6('income_yoy_growth', 'income_yoy_growth')}, {r6('population_yoy_growth', 'population_yoy_growth')},
     {r6('floor_area_sqm * remaining_lease_years', 'floor_area_x_remaining_lease')} from feat""",
    "deals", "amen", "qindex", "demo",
)
def feature_engineer(t):
    flags = ["has_ip_school_nearby", "has_sap_school_nearby", "has_autonomous_school_nearby"]
    return engineered(t).select(
        "txn_id", "flat_id", "town", *DISTANCES, *flags, "hdb_rpi", "median_household_income",
        "total_population", "income_yoy_growth", "population_yoy_growth", "floor_area_x_remaining_lease",
    )


#: A configuration with two sound products, one of which uses the other, one whose operand is absent, one with a single
#: operand, a column to drop, one that is protected and one that is not there.
REPORTED = FeatureConfig(
    interactions=(
        AREA_LEASE,
        Interaction("area_lease_x_storey", ("floor_area_x_remaining_lease", "storey_midpoint")),
        Interaction("area_x_nothing", ("floor_area_sqm", "no_such_column")),
        Interaction("area_alone", ("floor_area_sqm",)),
    ),
    drop=("prediction", "town", "no_such_column"),
)
CREATED = [
    "flat_id", *DISTANCES, "has_ip_school_nearby", "has_sap_school_nearby", "has_autonomous_school_nearby", "hdb_rpi",
    "median_household_income", "total_population", "income_yoy_growth", "population_yoy_growth",
    "floor_area_x_remaining_lease", "area_lease_x_storey",
]


@query(
    "feature_report",
    "select what, name from (values " + ", ".join(
        f"('{what}', '{name}')"
        for what, listed in {
            "created": CREATED,
            "interaction": ["floor_area_x_remaining_lease", "area_lease_x_storey"],
            "skipped": ["area_x_nothing"],
            "dropped": ["prediction"],
        }.items()
        for name in listed
    ) + """) as report(what, name)
     union all select 'rows', cast(count(*) as varchar) from deals""",
    "deals",
)
def feature_report(t):
    """What a feature build made, skipped and dropped, with the number of rows it kept."""
    rows, summary = engineer(time_features(t.role("deals")), sources(t), REPORTED, id_keys=["txn_id"])
    parts = {"created": "created", "interaction": "interactions", "skipped": "skipped_interactions", "dropped": "dropped"}
    report = [(what, name) for what, key in parts.items() for name in summary[key]]
    listed = t.spark.createDataFrame(report, "what string, name string")
    return listed.union(rows.agg(F.lit("rows").alias("what"), F.count("*").cast("string").alias("name")))


@query(
    "feature_validate",
    f"""with n as (select count(*) as n from deals where latitude is null),
      f as (select 'dist_nearest_school' as c union all select 'dist_nearest_supermarket' union all select 'dist_nearest_mrt'
       union all select 'dist_nearest_hawker' union all select 'dist_nearest_ip_school'
       union all select 'dist_nearest_sap_school' union all select 'dist_nearest_auto_school')
     select 'dist_nearest_mall' as "column", 'missing' as problem, 0 as n
     union all select 'hdb_rpi', 'type float, wanted double', 0
     union all select c, 'null', n from f, n where n > 0
     union all select 'has_ip_school_nearby', 'not_binary', (select count(*) from deals)""",
    "deals",
)
def feature_validate(t):
    rows = engineered(t, distance_default=None).drop("dist_nearest_mall").withColumns(
        {"hdb_rpi": F.col("hdb_rpi").cast("float"), "has_ip_school_nearby": F.lit(2)}
    )
    return K.validate_features(rows, K.FeatureSpec.of(FeatureConfig()))


@query(
    "time_features",
    """with raw as (select txn_id, case when txn_id % 50 = 0 then null when txn_id % 50 = 1 then '1989-05' else month end as month,
      case when txn_id % 20 = 0 then null else cast(lease_commence_date as int) end as start from txn),
     p as (select txn_id, cast(substr(month, 1, 4) as int) as y, cast(substr(month, 6, 2) as int) as m, start from raw)
     select txn_id, y as transaction_year, m as transaction_month, cast((m - 1) // 3 + 1 as int) as transaction_quarter,
     coalesce(cast(y - start as double), 0e0) as years_since_lease_start,
     coalesce(cast(99 - (y - start) as double), 0e0) as remaining_lease_years from p where y >= 1990""",
    "txn",
)
def time_features_query(t):
    key = F.col("txn_id")
    rows = t.role("txn").select(
        "txn_id",
        F.when(key % 50 == 0, None).when(key % 50 == 1, "1989-05").otherwise(F.col("month")).alias("month"),
        F.when(key % 20 != 0, F.col("lease_commence_date").try_cast("int")).alias("lease_commence_date"),
    )
    return time_features(rows).drop("month", "lease_commence_date")
