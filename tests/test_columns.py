import pytest
from pyspark.sql import functions as F

from assay.operators import columns as C
from assay.operators import sets as S
from assay.operators.reshape import melt_years, pick_series
from assay.queries.columns import PRICE_SCHEMA
from assay.session import scratch_path, settle


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def test_align_schema_adds_casts_and_orders(frame):
    df = frame([("2017-01", "n/a", "1980", "x")], "` Month ` string, `Floor Area Sqm` string, lease_commence_date string, extra string")
    out = C.align_schema(df, PRICE_SCHEMA, "lab")
    assert out.columns == [*PRICE_SCHEMA.fieldNames(), "_source"]
    row = out.head()
    assert (row["month"], row["floor_area_sqm"], row["lease_commence_date"], row["town"], row["_source"]) == (
        "2017-01", None, 1980, None, "lab"
    )


def test_drop_missing_counts_nulls_and_nans(frame):
    df = frame([(1.0, 2.0), (None, 2.0), (1.0, float("nan"))], "lat double, lon double")
    kept, stats = C.drop_missing(df, ["lat", "lon"])
    assert rows(kept) == [(1.0, 2.0)]
    assert tuple(stats.head()) == (3, 2, pytest.approx(200 / 3))


def test_drop_missing_on_an_empty_table(frame):
    kept, stats = C.drop_missing(frame([], "lat double"), ["lat"])
    assert kept.count() == 0
    assert tuple(stats.head()) == (0, 0, None)


def test_whitelist_counts_null_as_a_violation(frame):
    kept, others = C.whitelist(frame([("a",), ("b",), (None,), (None,)], "t string"), "t", ["a"])
    assert rows(kept) == [("a",)]
    assert set(rows(others)) == {("b", 1), (None, 2)}


def test_remove_flagged_keeps_null_flags(frame):
    kept, stats = C.remove_flagged(frame([(1, True), (2, False), (3, None)], "i int, f boolean"), "f")
    assert rows(kept, "i") == [(2,), (3,)]
    assert stats.head()["n_removed"] == 1


def test_range_filter_bounds(frame):
    df = frame([(0,), (1,), (2,), (None,)], "x int")
    assert rows(C.range_filter(df, "x", 0, 1), "x") == [(0,), (1,)]
    assert rows(C.range_filter(df, "x", 0, inclusive=False), "x") == [(1,), (2,)]


def test_clamp_keeps_nulls(frame):
    df = frame([(-1.0,), (None,), (5.0,)], "x double")
    assert sorted(rows(C.clamp(df, "x", 0.0, 3.0)), key=str) == [(0.0,), (3.0,), (None,)]


def test_coalesce_columns_uses_what_exists(frame):
    df = frame([(None, "2017-01"), (5, "2018-01")], "a int, month string")
    out = C.coalesce_columns(df, "y", ["absent", "a", ("month", F.substring("month", 1, 4))], "int")
    assert [r[2] for r in rows(out, "month")] == [2017, 5]
    with pytest.raises(ValueError):
        C.coalesce_columns(df, "y", ["absent"])


def test_coordinate_names(frame):
    assert C.resolve_coordinates(frame([], "lat double, lng double")) == ("lat", "lng")
    assert C.resolve_coordinates(frame([], "hawker_lat double, hawker_lng double"), "hawker") == ("hawker_lat", "hawker_lng")
    with pytest.raises(ValueError):
        C.resolve_coordinates(frame([], "lat double"))


def test_row_id_is_stable_and_unique(frame):
    df = frame([(i, None if i % 2 else "x") for i in range(200)], "k int, s string")
    ids = {r["k"]: r["row_id"] for r in C.with_row_id(df, ["k", "s"]).collect()}
    again = {r["k"]: r["row_id"] for r in C.with_row_id(df.repartition(7), ["k", "s"]).collect()}
    assert len(set(ids.values())) == 200 and ids == again
    assert C.with_row_id(df).select("row_id").distinct().count() == 200
    assert C.with_row_id(df, out="k").columns == df.columns


def test_drop_columns_respects_protected(frame):
    df = frame([(1, 2, 3)], "a int, b int, c int")
    assert C.drop_columns(df, ["a", "b", "zzz"], ["b"]).columns == ["b", "c"]


def test_spot_check_ignores_case(frame):
    df = frame([("Bukit Merah", 1.0), ("BUKIT MERAH", 3.0), ("x", 9.0), ("bukit merah", float("nan"))], "t string, d double")
    assert tuple(C.spot_check(df, "t", "bukit merah", "d").head()) == (1.0, 2.0, 3.0, 2)


def test_fills(frame):
    df = frame([(None, None)], "m int, t string")
    assert rows(C.fill_unknown(C.fill_defaults(df, {"m": 1, "absent": 2}), ["t"])) == [(1, "unknown")]


def test_dedupe_keys_prefers_order_and_keeps_null_keys(frame):
    df = frame(
        [("a", None, 1), ("a", 2.0, 2), ("a", 1.0, 3), (None, 5.0, 4), (None, 4.0, 5)], "k string, lat double, i int"
    )
    out = S.dedupe_keys(df, "k", [F.col("lat").isNull(), "lat"])
    assert set(rows(out)) == {("a", 1.0, 3), (None, 4.0, 5)}


def test_dedupe_keys_does_not_depend_on_partitioning(frame):
    df = frame([(i % 5, i % 3, i) for i in range(300)], "k int, o int, v int")
    a = S.dedupe_keys(df.repartition(1), "k", "o")
    b = S.dedupe_keys(df.repartition(9), "k", "o")
    assert rows(a, "k") == rows(b, "k")


def test_union_and_key_sets(frame):
    a, b = frame([(1, "x")], "i int, s string"), frame([(2,), (1,)], "i int")
    assert set(rows(S.union_all([a, b]))) == {(1, "x"), (2, None), (1, None)}
    assert rows(S.union_keys(a, b, "i")) == [(1,), (2,)]
    assert S.dedupe_rows(S.union_all([a, a])).count() == 1
    assert S.distinct_keys(S.union_all([a, b]), "i").count() == 2


def test_melt_years_keeps_only_years_in_range(frame):
    df = frame(
        [(" Income ", "10,591", "na", "1", "z")], "series string, `2001` string, `2000` string, `1999` string, `_c4` string"
    )
    long = melt_years(df, "series")
    assert set(rows(long)) == {("Income", 2001, 10591.0), ("Income", 2000, None)}
    assert rows(pick_series(long, "series", "Income", "v"), "year") == [(2000, None), (2001, 10591.0)]


def test_counts_are_observed_in_the_scan_that_writes_the_rows(spark, monkeypatch):
    plans = []

    def recorded(df, label="table"):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return settle(df, label)

    path = scratch_path(spark, "observed")
    spark.range(100).selectExpr("id", "if(id % 4 = 0, null, id * 1.0D) as lat", "id % 5 = 0 as flag").write.parquet(path)
    monkeypatch.setattr(C, "settle", recorded)
    for call, removed in ((lambda df: C.drop_missing(df, ["lat"]), 25), (lambda df: C.remove_flagged(df, "flag"), 20)):
        kept, stats = call(spark.read.parquet(path))
        assert tuple(stats.first()) == (100, removed, float(removed)) and kept.count() == 100 - removed
        assert plans[-1].count("FileScan") == 1 and "CollectMetrics" in plans[-1]
        assert "assay-observed" not in stats._jdf.queryExecution().executedPlan().toString()
    assert len(plans) == 2
