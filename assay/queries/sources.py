"""Queries of sources and sinks."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assay.operators.columns import drop_blank
from assay.queries.registry import query
from assay.session import scratch_path
from assay.sources.files import (
    ingest, materialise, parse_csv_lines, read_csv, tag_source, write_table,
)
from assay.sources.nested import geojson_points, html_attributes, read_geojson_features, read_geojson_lines
from assay.sources.records import Rule, split_valid


def _money(column):
    return F.col(column).cast("decimal(18,2)").cast("string")


def _supplier_text(t):
    balance = F.when(F.col("s_suppkey") % 10 == 0, "n/a").otherwise(_money("s_acctbal"))
    return t.table("supplier").select("s_suppkey", "s_name", balance.alias("s_acctbal"))


def _written(t, label, df, columns, fmt="csv"):
    path = scratch_path(t.spark, label)
    write_table(df, path, columns, fmt)
    return path


SUPPLIER_TEXT = """case when s_suppkey % 10 = 0 then 'n/a'
 else cast(cast(s_acctbal as decimal(18,2)) as varchar) end"""


@query(
    "csv_header_scan",
    f"select cast(s_suppkey as varchar) as s_suppkey, s_name, {SUPPLIER_TEXT} as s_acctbal from supplier",
)
def csv_header_scan(t):
    path = _written(t, "csv", _supplier_text(t), ["s_suppkey", "s_name", "s_acctbal"])
    return read_csv(t.spark, path)


@query(
    "csv_typed_scan",
    f"""select s_suppkey, s_name, case when s_suppkey % 10 <> 0 then s_acctbal end as s_acctbal,
     case when s_suppkey % 10 = 0 then concat(s_suppkey, ',', s_name, ',', 'n/a') end as _corrupt_record
     from supplier""",
)
def csv_typed_scan(t):
    path = _written(t, "csv", _supplier_text(t), ["s_suppkey", "s_name", "s_acctbal"])
    return read_csv(
        t.spark, path, "s_suppkey bigint, s_name string, s_acctbal double, _corrupt_record string"
    )


@query(
    "csv_lines_scan",
    """select s_suppkey as id, concat(s_name, ', Ltd') as name,
     case when s_suppkey % 7 <> 0 then s_acctbal end as balance from supplier""",
)
def csv_lines_scan(t):
    amount = F.when(F.col("s_suppkey") % 7 == 0, "bad").otherwise(_money("s_acctbal"))
    line = F.concat(F.col("s_suppkey").cast("string"), F.lit(',"'), "s_name", F.lit(', Ltd",'), amount)
    lines = t.table("supplier").select(line.alias("value"), F.lit(1).alias("place"))
    headers = t.table("nation").select(F.lit("id,name,balance").alias("value"), F.lit(0).alias("place"))
    return parse_csv_lines(headers.union(lines), "id bigint, name string, balance double", position="place")


GEOJSON = """concat('{{"type":"FeatureCollection","features":[{{"properties":{{"NAME":"',
 case when c_custkey % 11 = 0 then '' else c_name end, '","STATUS":"',
 case when c_custkey % 5 = 0 then 'Proposed' else 'Existing' end,
 '","NUMBER_OF_COOKED_FOOD_STALLS":"', case when c_custkey % 13 = 0 then 'x' else cast(c_custkey % 50 as string) end,
 '","ADDRESSPOSTALCODE":"', case when c_custkey % 3 = 0 then '' else lpad(cast(c_custkey as string), 6, '0') end,
 '"}},"geometry":{{"type":"Point","coordinates":[', cast(cast(103.6e0 + (c_custkey % 1000) * 0.0004e0 as decimal(9,4)) as string),
 ',', cast(cast(1.22e0 + (c_custkey % 1000) * 0.0002e0 as decimal(9,4)) as string),
 ']}}}},{{"properties":{{"NAME":"short","STATUS":"Existing"}},"geometry":{{"coordinates":[103.8]}}}},',
 '{{"properties":null,"geometry":null}}]}}')"""


@query(
    "geojson_points",
    """select form, c_custkey,
     cast(cast(1.22e0 + (c_custkey % 1000) * 0.0002e0 as decimal(9,4)) as double) as lat,
     cast(cast(103.6e0 + (c_custkey % 1000) * 0.0004e0 as decimal(9,4)) as double) as lon,
     c_name as name, case when c_custkey % 13 <> 0 then c_custkey % 50 end as stalls,
     case when c_custkey % 3 <> 0 then lpad(cast(c_custkey as varchar), 6, '0') end as postal_code
     from customer, (values ('collection'), ('lines'), ('split')) forms(form) where c_custkey % 11 <> 0 and c_custkey % 5 <> 0""",
)
def geojson_points_query(t):
    docs = t.spark.sql(f"select c_custkey, {GEOJSON} as doc from {{c}}", c=t.table("customer"))
    properties = {
        "NAME": "name", "NUMBER_OF_COOKED_FOOD_STALLS": "stalls", "ADDRESSPOSTALCODE": "postal_code",
    }
    wanted = {"required": ["NAME"], "where": {"STATUS": "Existing"}, "integers": ["NUMBER_OF_COOKED_FOOD_STALLS"]}
    whole = geojson_points(docs, "doc", properties, keep=["c_custkey"], **wanted)
    path = scratch_path(t.spark, "geojson")
    docs.select(F.get_json_object("doc", "$.features[0]").alias("value")).write.text(path)
    lines = geojson_points(read_geojson_lines(t.spark, path), "value", properties, single=True, **wanted)
    # All of them as one collection in one file, which is then read in parts.
    one = scratch_path(t.spark, "geojson")
    edge = lambda text: t.spark.range(1).select(F.lit(text).alias("value"))
    members = docs.select(F.concat(F.regexp_extract("doc", r"(?s)\[(.*)\]\}$", 1), F.lit(",")).alias("value"))
    head, end = edge('{"type":"FeatureCollection","features":['), edge('{"properties":null,"geometry":null}]}')
    head.union(members).union(end).coalesce(1).write.text(one)
    split = geojson_points(read_geojson_features(t.spark, one), "value", properties, single=True, **wanted)
    key = F.regexp_extract("name", r"\d+", 0).cast("bigint")
    parts = [whole.withColumn("form", F.lit("collection"))]
    parts += [df.withColumns({"c_custkey": key, "form": F.lit(form)}) for df, form in ((lines, "lines"), (split, "split"))]
    return reduce(DataFrame.unionByName, parts)


@query(
    "html_attr_table",
    """select c_custkey, concat(c_name, ' B') as name,
     case when c_custkey % 3 <> 0 then lpad(cast(c_custkey as varchar), 6, '0') end as postcode,
     cast(null as varchar) as heading, cast(null as varchar) as unit from customer""",
)
def html_attr_table(t):
    key = F.col("c_custkey")
    postcode = F.when(key % 3 == 0, "").otherwise(F.lpad(key.cast("string"), 6, "0"))
    html = F.concat(
        F.lit("<table><tr><th>Attributes</th><td>x</td></tr><tr><th>LIC_NAME</th> <td>first</td></tr>"),
        F.lit("<tr><TH> POSTCODE </TH>\n<TD> "), postcode, F.lit(" </TD></tr><tr><th>LIC_NAME</th><td>"),
        "c_name", F.lit(" B </td></tr></table>"),
    )
    pages = t.table("customer").select("c_custkey", html.alias("html"))
    keys = {"LIC_NAME": "name", "POSTCODE": "postcode", "Attributes": "heading", "UNIT_NO": "unit"}
    return html_attributes(pages, "html", keys, keep=["c_custkey"])


@query(
    "validated_ingest",
    """with seen as (select txn_id, floor_area_sqm, lease_commence_date, remaining_lease,
      case when remaining_lease is null then 'remaining_lease:required' end as f1,
      case when floor_area_sqm = 'n/a' then 'floor_area_sqm:type' end as f2,
      case when try_cast(floor_area_sqm as double) < 35 then 'floor_area_sqm:low' end as f3,
      case when cast(lease_commence_date as int) > 1997 then 'lease_commence_date:high' end as f4 from txn)
     select txn_id, concat_ws(',', f1, f2, f3, f4) as failed,
      case when concat_ws(',', f1, f2, f3, f4) = '' then cast(floor_area_sqm as double) end as area from seen""",
    "txn",
)
def validated_ingest(t):
    rules = [
        Rule("remaining_lease", required=True),
        Rule("floor_area_sqm", "double", low=35),
        Rule("lease_commence_date", "int", high=1997),
    ]
    valid, rejects = split_valid(t.role("txn"), rules)
    return valid.select("txn_id", F.lit("").alias("failed"), F.col("floor_area_sqm").alias("area")).union(
        rejects.select("txn_id", F.array_join("_failed", ","), F.lit(None).cast("double"))
    )


@query(
    "trim_defaults_ingest",
    """select trim(flat_type) as flat_type, trim(town) as town, coalesce(trim(flat_model), 'No') as flat_model,
     'No' as sap_ind from txn""",
    "txn",
)
def trim_defaults_ingest(t):
    raw = t.role("txn").withColumnRenamed("flat_type", "\ufeffflat_type")
    return ingest(raw, ["flat_type", "town", "flat_model", "sap_ind"], {"flat_model": "No", "sap_ind": "No"})


@query(
    "write_table",
    """select c_name, cast(c_custkey as varchar) as c_custkey,
     cast(cast(c_acctbal as decimal(18,2)) as varchar) as c_acctbal from customer""",
)
def write_table_query(t):
    rows = t.table("customer").withColumn("c_acctbal", _money("c_acctbal"))
    return read_csv(t.spark, _written(t, "table", rows, ["c_name", "c_custkey", "c_acctbal"]))


@query("cached_materialise", "select c_custkey, c_name, c_acctbal from customer")
def cached_materialise(t):
    path = scratch_path(t.spark, "cache")
    rows = t.table("customer").select("c_custkey", "c_name", "c_acctbal")
    materialise(t.spark, path, lambda: rows)
    return materialise(t.spark, path, lambda: rows.limit(0))


@query("source_tag", "select c_custkey, c_name, '2017-present' as _source from customer")
def source_tag(t):
    return tag_source(drop_blank(t.table("customer"), "c_name").select("c_custkey", "c_name"), "2017-present")
