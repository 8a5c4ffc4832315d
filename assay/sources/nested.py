"""Point features in GeoJSON and attribute tables in HTML, both held in text columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from assay.functions.text import blank_to_null, not_blank
from assay.session import col, settle

FEATURE = "properties map<string,string>, geometry struct<coordinates: array<double>>"
FEATURES = f"features array<struct<{FEATURE.replace('s map', 's: map').replace('y struct', 'y: struct')}>>"


def read_geojson(spark: SparkSession, path) -> DataFrame:
    """One row per file; a folder of many files spreads over the cluster file by file.

    Each file is one task's row; `read_geojson_features` reads a large collection in parts.
    """
    return spark.read.text(path, wholetext=True)


#: What an open brace counts beside an open bracket; no text is nested so deep.
BRACE = 1 << 32


def _count(text: Column, sign: str) -> Column:
    return (F.char_length(text) - F.char_length(F.translate(text, sign, ""))).cast("long")


def read_geojson_features(spark: SparkSession, path) -> DataFrame:
    """One row per feature (`value`), of one feature collection per file, in whatever layout.

    A file is read in byte ranges, as text that ends at each closing brace, so a range may start anywhere:
    inside a string, or deep in a feature. Each piece is judged both ways, as if it began inside a
    string and as if not. The sums of each range then tell the next one how it begins: whether in a
    string, how deep, and in which feature. Only these sums, a row per range, are put in order;
    pieces of a feature that lies in two ranges meet by the feature's number.

    Members beside `features` are passed over, unless they are arrays of objects, whose objects come out as
    features too. Text that is not JSON gives rows that do not parse.
    """
    # An escaped sign is never a border; the closing brace that ends a piece is not part of it.
    bare = F.regexp_replace("value", r"(?s)\\.", "")
    strings = r'(?s)"[^"]*("|$)'
    outside = F.regexp_replace(bare, strings, "")
    outside_after_string = F.regexp_replace(F.regexp_replace(bare, r'(?s)^[^"]*("|$)', ""), strings, "")
    quotes = _count(bare, '"') % 2

    def deeper(text: Column, closes: Column) -> Column:
        """By how many braces, and by how many brackets, as one number."""
        braces = _count(text, "{") - F.when(closes, 1).otherwise(0)
        return braces * BRACE + _count(text, "[") - _count(text, "]")

    pieces = spark.read.option("lineSep", "}").text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("range"),
        F.monotonically_increasing_id().alias("at"),
        "value",
        quotes.alias("quotes"),
        deeper(outside, quotes == 0).alias("from_outside"),
        deeper(outside_after_string, quotes == 1).alias("from_inside"),
    )
    pieces = settle(pieces, "geojson-pieces")
    place = ["file", "range"]
    before = Window.partitionBy(*place).orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy("file").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    total = lambda c, window: F.coalesce(F.sum(c).over(window), F.lit(0))

    # How a range goes on if it starts outside a string (`_0`) or inside one (`_1`).
    swapped = total("quotes", before) % 2 == 1
    pieces = pieces.withColumn("swapped", swapped).withColumns(
        {
            "step_0": F.when(F.col("swapped"), F.col("from_inside")).otherwise(F.col("from_outside")),
            "step_1": F.when(F.col("swapped"), F.col("from_outside")).otherwise(F.col("from_inside")),
        }
    )
    ranges = pieces.groupBy(*place).agg(F.sum("quotes").alias("quotes"), F.sum("step_0").alias("sum_0"), F.sum("step_1").alias("sum_1"))
    ranges = settle(ranges, "geojson-ranges").withColumn("inside", total("quotes", earlier) % 2 == 1)
    ranges = ranges.withColumn("sum", F.when(F.col("inside"), F.col("sum_1")).otherwise(F.col("sum_0")))
    ranges = ranges.select(*place, F.col("inside"), total("sum", earlier).alias("start_depth"))

    upto = Window.partitionBy(*place).orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    known = pieces.join(ranges, place).withColumn("step", F.when(F.col("inside"), F.col("step_1")).otherwise(F.col("step_0")))
    ends_outside = (F.col("inside").cast("int") + F.col("swapped").cast("int") + F.col("quotes")) % 2 == 0
    depth = F.col("start_depth") + F.sum("step").over(upto)
    # A feature ends where only the collection's brace and its list's bracket are open.
    known = settle(known.select(*place, "at", "value", ((depth == BRACE + 1) & ends_outside).cast("int").alias("ends")), "geojson-depths")

    ended = settle(known.groupBy(*place).agg(F.sum("ends").alias("ended")), "geojson-ended")
    ended = ended.select(*place, total("ended", earlier).alias("first"))
    numbered = known.join(ended, place).withColumn("number", F.col("first") + total("ends", before))
    features = numbered.groupBy("file", "number").agg(
        F.sort_array(F.collect_list(F.struct("range", "at", "value"))).alias("parts"), F.max("ends").alias("whole")
    )
    text = F.concat(F.array_join(F.transform("parts", lambda p: p["value"]), "}"), F.lit("}"))
    head = F.when(F.col("number") == 0, F.regexp_replace(text, r'(?s)^.*?(?<!\\)"features"\s*:\s*\[', "")).otherwise(text)
    return features.where("whole = 1").select(F.regexp_replace(head, r"(?s)^[\s,]*", "").alias("value"))


def read_geojson_lines(spark: SparkSession, path) -> DataFrame:
    """One row per line, each a feature; files of any size are read in parts."""
    return spark.read.text(path)


def geojson_points(
    df: DataFrame,
    json: str,
    properties: dict[str, str],
    required=(),
    where: dict[str, str] | None = None,
    keep=(),
    integers=(),
    single: bool = False,
) -> DataFrame:
    """Explode feature collections, or with `single` read one feature per row, to rows of `lat`, `lon` and the chosen properties.

    `properties` maps property names to output names. A feature is skipped when it has fewer than
    two coordinates, when a required property is empty, or when a property differs from its wanted
    value in `where`. Integer properties that do not parse become null. `keep` lists columns of the
    input to carry along.
    """
    feature = F.col("_f")
    prop = {p: feature["properties"][p] for p in {*properties, *required, *(where or {})}}
    position = feature["geometry"]["coordinates"]
    lon, lat = F.try_element_at(position, F.lit(1)), F.try_element_at(position, F.lit(2))

    parsed = F.from_json(col(json), FEATURE if single else FEATURES)
    rows = df.select(*keep, (parsed if single else F.explode(parsed["features"])).alias("_f"))
    rows = rows.where(lat.isNotNull() & lon.isNotNull())
    for name in required:
        rows = rows.where(not_blank(prop[name]))
    for name, value in (where or {}).items():
        rows = rows.where(prop[name] == value)

    def output(name: str, alias: str) -> Column:
        value = blank_to_null(prop[name])
        return (value.try_cast("int") if name in integers else value).alias(alias)

    return rows.select(
        *keep, lat.alias("lat"), lon.alias("lon"), *[output(p, a) for p, a in properties.items()]
    )


# Fixed value: header/value pairs of the attribute table; group 1 is the key, group 2 the value.
ATTRIBUTE_PAIR = r"(?i)<th>\s*([^<]+?)\s*</th>\s*<td>\s*([^<]*?)\s*</td>"


def html_attributes(df: DataFrame, html: str, keys: dict[str, str], keep=()) -> DataFrame:
    """Project keys of an HTML attribute table to columns; empty is null, the last repeat wins.

    The heading key "attributes" never yields a value. `keys` maps table keys to output names.
    """
    # `[^<]` also matches line ends, so pairs may span lines.
    found = F.arrays_zip(
        F.regexp_extract_all(col(html), F.lit(ATTRIBUTE_PAIR), F.lit(1)).alias("k"),
        F.regexp_extract_all(col(html), F.lit(ATTRIBUTE_PAIR), F.lit(2)).alias("v"),
    )
    table = df.select(*keep, found.alias("_pairs"))

    def value(key: str) -> Column:
        if key.lower() == "attributes":
            return F.lit(None).cast("string")
        hits = F.filter(F.col("_pairs"), lambda pair: F.trim(pair["k"]) == key)
        return blank_to_null(F.trim(F.try_element_at(hits, F.lit(-1))["v"]))

    return table.select(*keep, *[value(k).alias(a) for k, a in keys.items()])
