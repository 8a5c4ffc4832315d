"""The lookup tables and the transaction table, from raw files to sorted, unique rows.

Each function is one lazy plan over a raw table; write the result with `write_table` or
`materialise`, and check it with the expectations in `assay.plans.checks`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assay.functions.text import not_blank, quarter_parts
from assay.operators.columns import align_schema, derive_key, drop_blank, drop_missing
from assay.operators.lookups import best_candidate, lookup_join, merge_series
from assay.operators.reshape import melt_years, pick_series
from assay.operators.sets import dedupe_keys, dedupe_rows, union_all
from assay.sources.files import ingest, parse_csv_lines
from assay.sources.nested import geojson_points, html_attributes
from assay.sources.records import Rule, split_valid

# Names in the raw files, and the columns of the tables made from them.
HAWKER_PROPERTIES = {
    "NAME": "hawker_name",
    "ADDRESSPOSTALCODE": "hawker_postal_code",
    "STATUS": "hawker_status",
    "NUMBER_OF_COOKED_FOOD_STALLS": "hawker_stall_count",
    "EST_ORIGINAL_COMPLETION_DATE": "hawker_original_completion_year",
    "HUP_COMPLETION_DATE": "hawker_hup_completion_date",
    "DESCRIPTION": "hawker_description",
}
SUPERMARKET_KEYS = {
    "LIC_NAME": "supermarket_name",
    "BLK_HOUSE": "block_house",
    "STR_NAME": "street_name",
    "UNIT_NO": "unit_number",
    "POSTCODE": "postcode",
}
STATION_PROPERTIES = {"STATION_NA": "station_name", "EXIT_CODE": "exit_code"}
SCHOOL_COLUMNS = ["school_name", "postal_code", "sap_ind", "autonomous_ind", "ip_ind"]
SCHOOL_DEFAULTS = {"postal_code": "", "sap_ind": "No", "autonomous_ind": "No", "ip_ind": "No"}
POPULATION_SERIES, INCOME_SERIES = "Total Population", "50th"
TRANSACTION_SCHEMA = T.StructType(
    [
        T.StructField("month", T.StringType()),
        T.StructField("town", T.StringType()),
        T.StructField("flat_type", T.StringType()),
        T.StructField("block", T.StringType()),
        T.StructField("street_name", T.StringType()),
        T.StructField("storey_range", T.StringType()),
        T.StructField("floor_area_sqm", T.DoubleType()),
        T.StructField("flat_model", T.StringType()),
        T.StructField("lease_commence_date", T.IntegerType()),
        T.StructField("remaining_lease", T.StringType()),
        T.StructField("resale_price", T.DoubleType()),
    ]
)


def hawker_points(docs: DataFrame, json: str = "value") -> DataFrame:
    """Existing centres from feature collections, by name."""
    rows = geojson_points(
        docs, json, HAWKER_PROPERTIES, ["NAME"], {"STATUS": "Existing"},
        integers=["NUMBER_OF_COOKED_FOOD_STALLS"],
    ).withColumnsRenamed({"lat": "hawker_lat", "lon": "hawker_lng"})
    return dedupe_rows(rows).orderBy("hawker_name")


def supermarket_points(docs: DataFrame, json: str = "value") -> DataFrame:
    """Shops whose attributes stand in an HTML table inside each feature, by name."""
    features = geojson_points(docs, json, {"Description": "html"})
    rows = html_attributes(features, "html", SUPERMARKET_KEYS, keep=["lat", "lon"])
    rows = drop_blank(rows, "supermarket_name").withColumnsRenamed(
        {"lat": "supermarket_lat", "lon": "supermarket_lng"}
    )
    return dedupe_rows(rows).orderBy("supermarket_name")


def station_exits(docs: DataFrame, json: str = "value") -> DataFrame:
    """Station exits by station and exit code."""
    rows = geojson_points(docs, json, STATION_PROPERTIES, list(STATION_PROPERTIES))
    rows = rows.withColumnsRenamed({"lat": "latitude", "lon": "longitude"})
    return dedupe_rows(rows).orderBy("station_name", "exit_code")


def mall_points(raw: DataFrame) -> DataFrame:
    """Named places with coordinates, one row per name; a row with coordinates is preferred."""
    named = drop_blank(raw.withColumn("name", F.trim("name")), "name").select("name", "lat", "lon")
    unlocated = F.col("lat").isNull() | F.col("lon").isNull()
    return dedupe_keys(named, "name", [unlocated]).na.drop(subset=["lat", "lon"])


def schools(raw: DataFrame, candidates: DataFrame) -> DataFrame:
    """Schools with the coordinates of their best search result, one row per name.

    `candidates` holds search results as (entity, term_no, position, building, search_value,
    latitude, longitude).
    """
    listed = drop_blank(ingest(raw, SCHOOL_COLUMNS, SCHOOL_DEFAULTS), "school_name")
    one = dedupe_keys(listed, "school_name", [])
    results = candidates.withColumnRenamed("entity", "school_name")
    found = best_candidate(one, results, "school_name", "term_no", "position", ["building", "search_value"])
    return found.select(*SCHOOL_COLUMNS, "latitude", "longitude").orderBy("school_name")


def demographics(population: DataFrame, income: DataFrame, low: int = 2000, high: int = 2025) -> DataFrame:
    """Yearly income and population from two wide tables; years of either are kept."""

    def series(wide: DataFrame, name: str, out: str) -> DataFrame:
        key = wide.columns[0]
        return dedupe_keys(pick_series(melt_years(wide, key, low, high), key, name, out), "year", [])

    return merge_series(
        series(income, INCOME_SERIES, "median_household_income"),
        series(population, POPULATION_SERIES, "total_population"),
        "year",
    )


def price_index(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(index by year and quarter, rejected rows) from quarter text and index text."""
    year, quarter = quarter_parts("quarter")
    parsed = raw.select(
        "quarter", year.alias("rpi_year"), quarter.alias("rpi_quarter"), F.col("index").alias("rpi_value")
    )
    rules = [
        Rule("rpi_year", "int", required=True),
        Rule("rpi_quarter", "int", required=True, low=1, high=4),
        Rule("rpi_value", "double", required=True),
    ]
    valid, rejects = split_valid(parsed, rules)
    one = dedupe_keys(valid.drop("quarter"), ["rpi_year", "rpi_quarter"], "rpi_value")
    return one.orderBy("rpi_year", "rpi_quarter"), rejects


def transactions(extracts: dict[str, DataFrame]) -> DataFrame:
    """All extracts in the canonical columns, each row with the label of its extract."""
    return union_all([align_schema(df, TRANSACTION_SCHEMA, label) for label, df in extracts.items()])


def payload_transactions(payloads: dict[str, tuple[DataFrame, str]], line: str = "value", position: str | None = None) -> DataFrame:
    """Transactions from downloaded CSV payloads: (lines, DDL schema) per label, first lines being headers.

    See `parse_csv_lines` for `position`.
    """
    return transactions({label: parse_csv_lines(lines, schema, line, position) for label, (lines, schema) in payloads.items()})


def with_address(df: DataFrame) -> DataFrame:
    return derive_key(df, ["block", "street_name"], "full_address")


def geocode(df: DataFrame, cache: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(transactions that the address cache locates, one-row table of how many were removed).

    Addresses still to be looked up are given by `pending_keys`.
    """
    located = lookup_join(
        with_address(df), cache, "full_address", [F.col("latitude").isNull(), F.col("longitude").isNull()]
    )
    return drop_missing(located, ["latitude", "longitude"])


def refreshed_cache(cache: DataFrame, found: DataFrame) -> DataFrame:
    """Cache with newly found addresses added; an address that is there already keeps its row."""
    key = "full_address"
    new = found.where(not_blank(key)).join(cache.select(key), key, "left_anti")
    return cache.unionByName(dedupe_keys(new, key, []), allowMissingColumns=True)

