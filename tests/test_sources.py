import random
import json

import pytest

from assay.session import scratch_path
from assay.sources.files import (
    ingest, is_complete, materialise, parse_csv_lines, read_csv, tag_source, write_table,
)
from assay.sources.nested import geojson_points, html_attributes, read_geojson, read_geojson_features
from assay.sources.records import Rule, split_valid

FEATURES = {
    "type": "FeatureCollection",
    "features": [
        {"properties": {"NAME": "A", "STATUS": "Existing", "STALLS": "32"},
         "geometry": {"type": "Point", "coordinates": [103.81, 1.32]}},
        {"properties": {"NAME": "B", "STATUS": "Proposed"}, "geometry": {"coordinates": [103.8, 1.3]}},
        {"properties": {"NAME": "C", "STATUS": "Existing"}, "geometry": {"coordinates": [103.8]}},
        {"properties": {"NAME": " ", "STATUS": "Existing"}, "geometry": {"coordinates": [103.8, 1.3]}},
        {"properties": {"NAME": "D", "STATUS": "Existing", "STALLS": "many"},
         "geometry": {"coordinates": [103.9, 1.4, 0.0]}},
        {"properties": None, "geometry": None},
    ],
}


def test_geojson_points_from_files(spark, tmp_path):
    (tmp_path / "a.geojson").write_text(json.dumps(FEATURES, indent=1))
    docs = read_geojson(spark, str(tmp_path))
    rows = geojson_points(
        docs, "value", {"NAME": "name", "STALLS": "stalls"}, ["NAME"], {"STATUS": "Existing"},
        integers=["STALLS"],
    ).orderBy("name").collect()
    assert [tuple(r) for r in rows] == [(1.32, 103.81, "A", 32), (1.4, 103.9, "D", None)]


def test_html_attributes_last_wins_and_blank_is_null(frame):
    html = (
        "<tr><th>Attributes</th><td>x</td></tr><tr><th>LIC_NAME</th> <td>OLD</td></tr>"
        "<tr><TH> POSTCODE </TH>\n<TD></TD></tr><tr><th>LIC_NAME</th><td> SHOP </td></tr>"
    )
    df = frame([(html,), ("no table",), (None,)], "d string")
    keys = {"LIC_NAME": "name", "POSTCODE": "postcode", "Attributes": "a", "NONE": "n"}
    rows = [tuple(r) for r in html_attributes(df, "d", keys).collect()]
    assert rows == [("SHOP", None, None, None), (None,) * 4, (None,) * 4]


def test_csv_scans(spark, tmp_path):
    (tmp_path / "a.csv").write_text('name,code,n\n"Hill, North",007,1\nSouth,,x\n')
    plain = read_csv(spark, str(tmp_path)).collect()
    assert [tuple(r) for r in plain] == [("Hill, North", "007", "1"), ("South", None, "x")]
    typed = read_csv(spark, str(tmp_path), "name string, code string, n int, _corrupt_record string").collect()
    assert [tuple(r) for r in typed] == [("Hill, North", "007", 1, None), ("South", None, None, "South,,x")]


def test_csv_lines(frame):
    df = frame([('1,"a, b",2.5',), ("x,c,",), ("3,d,bad",)], "value string")
    rows = [tuple(r) for r in parse_csv_lines(df, "id int, name string, v double").collect()]
    assert rows == [(1, "a, b", 2.5), (None, "c", None), (3, "d", None)]


def test_ingest_trims_and_fills(frame):
    df = frame([(" A ", None), ("B", " Yes ")], "`\ufeffname` string, ip_ind string")
    out = ingest(df, ["name", "ip_ind", "sap_ind", "note"], {"ip_ind": "No", "sap_ind": "No"})
    assert [tuple(r) for r in out.collect()] == [("A", "No", "No", None), ("B", "Yes", "No", None)]


def test_write_table_keeps_column_order(spark, frame):
    path = scratch_path(spark, "test")
    write_table(frame([(1, "a")], "n int, s string"), path, ["s", "n"], "csv")
    assert read_csv(spark, path).columns == ["s", "n"]


def test_materialise_computes_once(spark, frame):
    path = scratch_path(spark, "test")
    assert not is_complete(spark, path)
    rows = frame([(1,)], "n int")
    assert materialise(spark, path, lambda: rows).count() == 1

    def fail():
        raise AssertionError("must not be computed again")

    assert materialise(spark, path, fail).count() == 1


def test_materialise_ignores_an_unfinished_write(spark, frame):
    path = scratch_path(spark, "test")
    frame([(1,), (2,)], "n int").write.parquet(path)
    fs_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    fs_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(fs_path, False)
    assert materialise(spark, path, lambda: frame([(7,)], "n int")).head()["n"] == 7


def test_split_valid_keeps_reasons(frame):
    df = frame([("a", "1.5"), (" ", "2"), ("b", "x"), ("c", "500"), ("d", None)], "name string, v string")
    valid, rejects = split_valid(df, [Rule("name", required=True), Rule("v", "double", low=0, high=100)])
    assert {tuple(r) for r in valid.collect()} == {("a", 1.5), ("d", None)}
    reasons = {r["name"]: r["_failed"] for r in rejects.collect()}
    assert reasons == {" ": ["name:required"], "b": ["v:type"], "c": ["v:high"]}


def test_tag_source(frame):
    assert tag_source(frame([(1,)], "n int"), "x").head()["_source"] == "x"


def test_scratch_needs_a_shared_folder_off_local(spark, monkeypatch):
    import assay.session as S

    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError):
        S.scratch_root(Session())


def test_scratch_tables_go_with_their_scope(spark):
    from pathlib import Path

    from assay.session import scratch_path, scratch_scope, settle

    keep = settle(spark.range(3), "outside")
    with scratch_scope(spark):
        path = Path(scratch_path(spark, "inside"))
        spark.range(5).write.parquet(str(path))
        inside = settle(spark.range(7), "inside")
        assert inside.count() == 7 and path.exists()
        files = [Path(f.removeprefix("file://")) for f in inside.inputFiles()]
    assert not path.exists() and not any(f.exists() for f in files)
    assert keep.count() == 3


def test_header_lines_of_payloads(frame):
    from assay.sources.files import parse_csv_lines

    lines = frame([("id,name", 0), ("1,a", 1), ("id,name", 0), ("2,b", 1)], "value string, place int")
    assert [tuple(r) for r in parse_csv_lines(lines, "id int, name string", position="place").collect()] == [(1, "a"), (2, "b")]


def collection(n, indent, seed):
    r = random.Random(seed)
    odd = ["plain", "brace } in text", "{ open", 'quoted \\" }', "back\\\\slash\\\\", "[1, 2]", '"features":[', "tab\\t}", "é ]}", ""]
    features = []
    for i in range(n):
        name = f"{r.choice(odd)} {i}"
        properties = {"NAME": name, "note": r.choice(odd), "deep": r.choice(odd) * r.randint(0, 4)}
        kind = i % 4
        geometry = {"type": "Point", "coordinates": [103 + i / 1000, 1 + i / 1000][: 1 if kind == 1 else 2]}
        features.append({"type": "Feature", "properties": None if kind == 2 else properties, "geometry": None if kind == 3 else geometry})
    whole = {"type": "FeatureCollection", "name": 'a "features" list }', "crs": {"type": "name", "properties": {"name": "x"}}, "features": features}
    return features, json.dumps({**whole, "bbox": [1, 2], "more": {"a": "}"}}, indent=indent, ensure_ascii=seed % 2 == 0)


@pytest.mark.parametrize("indent", [None, 2])
@pytest.mark.parametrize("bytes_each", [97, 1500])
def test_one_collection_is_read_in_parts(spark, tmp_path, indent, bytes_each):
    want = []
    for seed in (1, 2):
        features, text = collection(60, indent, seed)
        (tmp_path / f"{seed}.geojson").write_text(text, encoding="utf8")
        want += features
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(bytes_each))
    try:
        parts = spark.read.option("lineSep", "}").text(str(tmp_path)).rdd.getNumPartitions()
        got = [r["value"] for r in read_geojson_features(spark, str(tmp_path)).collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert parts > 10
    key = lambda f: json.dumps(f, sort_keys=True)
    assert sorted(key(json.loads(v)) for v in got) == sorted(map(key, want))


def test_parts_give_the_points_of_the_whole_file(spark, tmp_path):
    (tmp_path / "a.geojson").write_text(collection(80, 1, 3)[1], encoding="utf8")
    options = {"properties": {"NAME": "name"}, "required": ["NAME"]}
    whole = geojson_points(read_geojson(spark, str(tmp_path)), "value", **options)
    parts = geojson_points(read_geojson_features(spark, str(tmp_path)), "value", single=True, **options)
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, parts.collect())) and whole.count() == 20


@pytest.mark.parametrize("text", ["", "{}", '{"type":"FeatureCollection","features":[]}', '{"features":[]}\n', "not json"])
def test_collections_without_features(spark, tmp_path, text):
    (tmp_path / "a.geojson").write_text(text)
    assert read_geojson_features(spark, str(tmp_path)).isEmpty()
