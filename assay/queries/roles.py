"""The given tables in the roles that the operators need.

The same text runs in Spark and as SQL, with table names filled in. It puts dirt in on purpose.
"""

import re

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]

# Raw transactions: all text but for the id and the coordinates.
TXN = """
select o_orderkey as txn_id,
 substr(cast(cast(o_orderdate as date) as string), 1, 7) as month,
 n_name as town,
 case when o_orderkey % 17 = 0 then ' multi generation ' when o_orderkey % 19 = 0 then 'MULTI-GEN'
      when o_orderkey % 23 = 0 then 'STUDIO' else concat(' ', cast(o_orderkey % 5 + 1 as string), ' room') end as flat_type,
 case when o_orderkey % 4 = 0 then 'Improved' when o_orderkey % 4 = 1 then ' model a'
      when o_orderkey % 4 = 2 then 'New Generation' else null end as flat_model,
 cast(o_custkey % 900 + 1 as string) as block,
 concat('street ', cast(o_custkey % 60 as string)) as street_name,
 concat(lpad(cast(3 * (o_orderkey % 13) + 1 as string), 2, '0'), ' TO ', lpad(cast(3 * (o_orderkey % 13) + 3 as string), 2, '0')) as storey_range,
 case when o_orderkey % 29 = 0 then 'n/a' else cast(30 + o_orderkey % 121 as string) end as floor_area_sqm,
 cast(1960 + o_custkey % 40 as string) as lease_commence_date,
 case when o_orderkey % 3 = 0 then null
      when o_orderkey % 3 = 1 then concat(cast(40 + o_orderkey % 55 as string), ' years ', lpad(cast(o_orderkey % 12 as string), 2, '0'), ' months')
      else concat(cast(40 + o_orderkey % 55 as string), ' years') end as remaining_lease,
 cast(cast(o_totalprice as decimal(18,2)) as string) as resale_price,
 case when o_custkey % 97 = 0 then null else 1.22e0 + (o_custkey * 37 % 1000) * 0.00024e0 end as latitude,
 case when o_custkey % 89 = 0 then cast('NaN' as double) else 103.6e0 + (o_custkey * 91 % 1000) * 0.0004e0 end as longitude
from {orders} join {customer} on o_custkey = c_custkey join {nation} on c_nationkey = n_nationkey
"""

# Typed transactions with a prediction, for statistics and models.
DEALS = """
select o_orderkey as txn_id, n_name as town,
 concat(cast(o_orderkey % 5 + 1 as string), ' ROOM') as flat_type,
 case when o_orderkey % 4 = 3 then null else concat('model ', cast(o_orderkey % 4 as string)) end as flat_model,
 cast(date_trunc('month', o_orderdate) as date) as month,
 cast(year(o_orderdate) as int) as transaction_year,
 cast(month(o_orderdate) as int) as transaction_month,
 cast(quarter(o_orderdate) as int) as transaction_quarter,
 cast(1960 + o_custkey % 40 as int) as lease_commence_date,
 cast(99 - (year(o_orderdate) - (1960 + o_custkey % 40)) as double) as remaining_lease_years,
 case when o_orderkey % 29 = 0 then null else cast(30 + (o_orderkey * 7) % 121 as double) end as floor_area_sqm,
 case when o_orderkey % 31 = 0 then null else cast(3 * (o_orderkey % 13) + 2 as double) end as storey_midpoint,
 case when o_orderkey % 41 = 0 then null when o_orderkey % 1009 = 5 then 0e0 else o_totalprice end as resale_price,
 o_totalprice * (0.9e0 + (o_orderkey % 21) * 0.01e0) + (o_orderkey % 7) * 100 as prediction,
 case when o_custkey % 97 = 0 then null else 1.22e0 + (o_custkey * 37 % 1000) * 0.00024e0 end as latitude,
 103.6e0 + (o_custkey * 91 % 1000) * 0.0004e0 as longitude
from {orders} join {customer} on o_custkey = c_custkey join {nation} on c_nationkey = n_nationkey
"""

# Points of five kinds with school indicators.
AMEN = """
select s_suppkey as amenity_id,
 case s_suppkey % 5 when 0 then 'mrt' when 1 then 'school' when 2 then 'supermarket' when 3 then 'hawker' else 'shopping_mall' end as kind,
 1.22e0 + (s_suppkey * 53 % 1000) * 0.00024e0 as amen_lat,
 103.6e0 + (s_suppkey * 71 % 1000) * 0.0004e0 as amen_lon,
 case when s_suppkey % 10 = 1 then 'Yes' else 'No' end as ip_ind,
 case when s_suppkey % 10 = 6 then 'Yes' else 'No' end as sap_ind,
 case when s_suppkey % 15 = 1 then 'Yes' else 'No' end as autonomous_ind
from {supplier}
"""

# Quarterly index.
QINDEX = """
select cast(year(l_shipdate) as int) as rpi_year, cast(quarter(l_shipdate) as int) as rpi_quarter,
 round(avg(l_extendedprice), 6) as rpi_value
from {lineitem} where l_shipdate is not null group by 1, 2
"""

# Yearly series.
DEMO = """
select cast(year(l_shipdate) as int) as demo_year, round(avg(l_extendedprice), 6) as median_household_income,
 cast(count(*) as double) as total_population
from {lineitem} where l_shipdate is not null group by 1
"""

# The same for 1996-2000 only, while orders span more years: for the two joins whose feature is what happens outside a lookup.
QINDEX_GAP = f"select * from ({QINDEX}) q where rpi_year between 1996 and 2000"
DEMO_GAP = f"select * from ({DEMO}) d where demo_year between 1996 and 2000"

# Address cache with repeated addresses, missing addresses and missing coordinates.
CACHE = """
select concat(cast(c_custkey % 900 + 1 as string), ' street ', cast(c_custkey % 60 as string)) as full_address,
 case when c_custkey % 97 = 0 then null else 1.22e0 + (c_custkey * 37 % 1000) * 0.00024e0 end as lat,
 103.6e0 + (c_custkey * 91 % 1000) * 0.0004e0 as lon,
 lpad(cast(c_custkey as string), 6, '0') as postal_code
from {customer} where c_custkey % 900 % 10 <> 3
"""

# Search results per entity: two terms with up to three results each. EACH(...) stands for one row
# per listed value, which the engines spell differently.
CANDS = """
select entity, term_no, position,
 case when (id + term_no + position) % 5 = 0 then concat('block of ', lower(entity))
      when (id + position) % 3 = 0 then 'north primary school' else 'plain tower' end as building,
 case when (id * 7 + position) % 11 = 0 then 'city college annex' else null end as search_value,
 case when (id + position) % 13 = 0 then 'nil' else cast(cast(1.22e0 + ((id + 17 * position + 5 * term_no) % 1000) * 0.0002e0 as decimal(9,6)) as string) end as latitude,
 cast(cast(103.6e0 + ((id + 31 * position + 3 * term_no) % 1000) * 0.0004e0 as decimal(9,6)) as string) as longitude
from (select id, entity, term_no, EACH(0, 1, 2) as position
 from (select c_custkey as id, c_name as entity, EACH(0, 1) as term_no from {customer} where c_custkey % 7 <> 0) terms
 where not (id % 4 = 1 and term_no = 0)) results
"""

ROLES = {
    "txn": TXN, "deals": DEALS, "amen": AMEN, "qindex": QINDEX, "demo": DEMO, "cache": CACHE, "cands": CANDS,
    "qindex_gap": QINDEX_GAP, "demo_gap": DEMO_GAP,
}


def spark_text(role: str) -> str:
    return re.sub(r"EACH\(([^)]*)\)", r"explode(array(\1))", ROLES[role])


def sql_text(role: str) -> str:
    text = re.sub(r"EACH\(([^)]*)\)", r"unnest([\1])", ROLES[role])
    return text.format(**{t: t for t in TABLES})
