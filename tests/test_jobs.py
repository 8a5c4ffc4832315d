import datetime
import random

import pytest
from pyspark.sql import functions as F

from assay.operators.columns import align_schema
from assay.plans import cleaning as C
from assay.plans.features import (
    DEFAULT_INTERACTIONS, FeatureConfig, Interaction, Sources, engineer, interactions, required_columns, time_features,
)
from assay.plans.checks import FeatureSpec, validate_features
from assay.queries.columns import PRICE_SCHEMA


@pytest.fixture(scope="module")
def raw(spark):
    text = PRICE_SCHEMA.fieldNames()
    good = ("2017-01", " a ", "multi generation", "1", "s", "04 TO 06", "67", "m", "1980", None, "100.0")
    rows = [good, good]
    rows += [("2017-02", "b", "2 room", "1", "s", "01 TO 03", "50", "m", "1990", "70 years", str(100 + i)) for i in range(20)]
    rows += [("2017-02", "b", "STUDIO", "1", "s", "GROUND", "50", "m", "1990", None, "101")]
    rows += [("2017-02", "b", "2 room", "1", "s", "01 TO 03", "n/a", "m", "1990", None, "101")]
    rows += [("2017-02", "b", "2 room", "9", "s", "01 TO 03", "50", "m", "1990", None, "99999")]
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in text))
    return align_schema(df, PRICE_SCHEMA, "x")


def test_cleaning_by_derived_config(raw):
    config = C.derive_config(raw)
    assert config.drop_nulls == ("floor_area_sqm",)
    cleaned, log = C.config_clean(raw, config)
    assert all(r["status"] == "applied" for r in log.collect())
    assert "_source" not in cleaned.columns and "remaining_lease" not in cleaned.columns
    final = C.finish(cleaned)
    assert final.count() == 21
    row = final.where("town = 'A'").head()
    assert (row["flat_type"], row["month"], row["storey_midpoint"], row["remaining_lease_years"]) == (
        "MULTI-GENERATION", datetime.date(2017, 1, 1), 5.0, 62.0
    )
    assert C.finish(final).exceptAll(final).isEmpty()


def test_unknown_and_unfit_steps_are_skipped(raw):
    steps = [C.Step("nonsense", "town"), C.Step("trim_uppercase", "absent"), C.Step("impute_remaining_lease", "remaining_lease"),
             C.Step("standardise_values", "town", {"wrong": 1}), C.Step("trim_uppercase", "town")]
    _, log = C.apply_steps(raw, steps)
    assert [s.split(":")[0] for _, _, s in log] == ["skipped"] * 4 + ["applied"]
    assert len(C.STEPS) == 13


def test_order_comes_from_declarations(monkeypatch):
    """However steps, treatments and columns are listed, the plan is one, and it keeps what the steps need."""
    config = C.CleaningConfig(drop_nulls=("month", "floor_area_sqm", "remaining_lease"), drop_columns=("_source", "block"))
    columns = [*PRICE_SCHEMA.fieldNames(), "_source"]
    plan = C.steps_of(config, columns)
    for seed in range(5):
        shuffle = random.Random(seed)
        for name in ("STEPS", "TREATMENTS"):
            items = list(getattr(C, name).items())
            shuffle.shuffle(items)
            monkeypatch.setattr(C, name, dict(items))
        shuffle.shuffle(columns)
        assert C.steps_of(config, columns) == plan
        steps = [(s.name, s.column) for s in plan]
        shuffle.shuffle(steps)
        assert C.in_order([C.Step(*s) for s in steps]) == C.in_order([C.Step(s.name, s.column) for s in plan])
    place = {(s.name, s.column): n for n, s in enumerate(plan)}
    assert len(place) == len(plan) > 14
    for earlier, later in [
        (("parse_yyyymm_date", "month"), ("derive_year_month", "month")),
        (("derive_year_month", "month"), ("compute_remaining_lease", "lease_commence_date")),
        (("trim_uppercase", "flat_type"), ("standardise_values", "flat_type")),
        (("parse_yyyymm_date", "month"), ("drop_nulls", "month")),
        (("trim_uppercase", "block"), ("drop_column", "block")),
        (("drop_nulls", "floor_area_sqm"), ("flag_outliers_iqr", "resale_price")),
    ]:
        assert place[earlier] < place[later]
    assert ("drop_nulls", "remaining_lease") not in place


def test_steps_that_wait_for_each_other_are_refused(monkeypatch):
    monkeypatch.setattr(C, "STEPS", {"a": C.Operation(None, reads=("x",), makes=("y",)), "b": C.Operation(None, reads=("y",), makes=("x",))})
    with pytest.raises(ValueError):
        C.in_order([C.Step("a", "x"), C.Step("b", "y")])


def test_zscore_config(raw):
    cleaned, _ = C.config_clean(raw, C.CleaningConfig(outlier_method="zscore", outlier_threshold=4.0))
    assert cleaned.where("resale_price_outlier").count() == 1


def test_impute_fills_only_gaps(frame):
    df = frame([("2017-01", 1980, None), ("2017-01", 1980, 5.5), ("bad", 1980, None)], "month string, lease_commence_date int, v double")
    assert [r["v"] for r in C.impute_term(df, "v").collect()] == [62.0, 5.5, None]


def test_waterfall(frame):
    df = frame([(1,), (2,), (3,), (None,)], "x int")
    rows = [tuple(r) for r in C.waterfall(df, {"a": F.col("x") > 1, "b": F.col("x") < 3}).collect()]
    assert rows == [(0, "raw", 4, 0, 100.0), (1, "a", 2, -2, 50.0), (2, "b", 1, -1, 25.0)]


def test_time_features_from_text_or_existing_columns(frame):
    df = frame([("2017-05", 1980), (None, 1980), ("1989-01", 1980), ("2017-05", None)], "month string, lease_commence_date int")
    rows = [tuple(r)[2:] for r in time_features(df).collect()]
    assert rows == [(2017, 5, 2, 37.0, 62.0), (2017, 5, 2, 0.0, 0.0)]
    have = frame([("2017-05", 1980, 2001, None, 12.5)], "month string, lease_commence_date int, transaction_year int, transaction_month int, remaining_lease_years double")
    row = time_features(have).head()
    assert (row["transaction_year"], row["transaction_month"], row["transaction_quarter"], row["remaining_lease_years"]) == (2001, 1, 1, 12.5)


def test_interactions_skip_missing_operands(frame):
    specs = [Interaction("ab", ("a", "b")), Interaction("ax", ("a", "x")), Interaction("one", ("a",)), Interaction("", ("a", "b"))]
    out, created, skipped = interactions(frame([(2, 3)], "a int, b int"), specs)
    assert (out.head()["ab"], created, skipped) == (6.0, ["ab"], ["ax"])


def test_engineer_and_validate(frame):
    deals = frame(
        [(1, "2019-05", 1980, 1.30, 103.80, 50.0, "A"), (2, "2030-05", 1980, None, 103.8, 60.0, "B")],
        "id int, month string, lease_commence_date int, latitude double, longitude double, floor_area_sqm double, town string",
    )
    kinds = ["mrt", "school", "supermarket", "hawker", "shopping_mall"]
    points = frame([(k, 1.30, 103.801, "Yes", "Yes", "No") for k in kinds],
                   "kind string, amen_lat double, amen_lon double, ip_ind string, sap_ind string, autonomous_ind string")
    index = frame([(2019, 2, "150.5")], "rpi_year int, rpi_quarter int, rpi_value string")
    years = frame([(2018, 10.0, 100.0), (2019, 12.0, 110.0)], "demo_year int, median_household_income double, total_population double")
    config = FeatureConfig(interactions=DEFAULT_INTERACTIONS, drop=("town", "lease_commence_date", "floor_area_sqm"))
    out, summary = engineer(time_features(deals), Sources(points, index, years), config)
    rows = {r["id"]: r for r in out.collect()}
    assert rows[1]["hdb_rpi"] == 150.5 and rows[2]["hdb_rpi"] == 0.0
    assert rows[1]["income_yoy_growth"] == pytest.approx(0.2) and rows[2]["total_population"] == 110.0
    assert rows[1]["has_ip_school_nearby"] == 1 and rows[2]["dist_nearest_mrt"] == 0.0
    assert "dist_nearest_auto_school" not in out.columns
    assert summary["dropped"] == ["floor_area_sqm"] and "town" in out.columns
    assert summary["skipped_interactions"] == ["town_x_flat_type_idx"]
    problems = {tuple(r) for r in validate_features(out, FeatureSpec.of(config)).collect()}
    assert problems == {("dist_nearest_auto_school", "missing", 0), ("has_autonomous_school_nearby", "missing", 0)}
    assert len(required_columns(config)) == 5 + 6 + 1 + 4


def test_repair_of_a_configuration():
    from assay.plans.features import repair

    assert repair(FeatureConfig()) == (FeatureConfig(), [])
    odd = FeatureConfig(distances=("mrt", "moon"), schools=(), index=False, drop=("", "town", "x"))
    fixed, report = repair(odd)
    assert fixed == FeatureConfig(drop=("x",))
    assert ("distances", "unknown", "moon") in report and ("schools", "added", "ip") in report
    assert [r for r in report if r[0] in ("index", "drop")] == [("index", "added", "index"), ("drop", "empty", ""), ("drop", "protected", "town")]
