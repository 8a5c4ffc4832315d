import json

import pytest

from assay.operators.lookups import pending_keys
from assay.plans import extracts as X
from assay.plans.checks import gate, index_expectations, proceed


def feature(properties, *position):
    return {"properties": properties, "geometry": {"type": "Point", "coordinates": list(position)}}


def docs(frame, *features):
    return frame([(json.dumps({"type": "FeatureCollection", "features": list(features)}),)], "value string")


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_hawker_points(frame):
    a = feature({"NAME": "B", "STATUS": "Existing", "NUMBER_OF_COOKED_FOOD_STALLS": 12}, 103.8, 1.3)
    df = docs(frame, a, a, feature({"NAME": "A", "STATUS": "Existing", "ADDRESSPOSTALCODE": ""}, 103.9, 1.4),
              feature({"NAME": "C", "STATUS": "Proposed"}, 103.8, 1.3), feature({"STATUS": "Existing"}, 1, 2))
    got = X.hawker_points(df).select("hawker_name", "hawker_lat", "hawker_lng", "hawker_stall_count", "hawker_postal_code")
    assert rows(got) == [("A", 1.4, 103.9, None, None), ("B", 1.3, 103.8, 12, None)]


def test_supermarket_points(frame):
    html = "<table><tr><th>LIC_NAME</th><td>{}</td></tr><tr><th>POSTCODE</th><td>0123</td></tr></table>"
    df = docs(frame, feature({"Description": html.format("SHOP")}, 103.8, 1.3),
              feature({"Description": html.format(" ")}, 103.8, 1.3), feature({}, 103.8, 1.3))
    got = X.supermarket_points(df).select("supermarket_name", "supermarket_lat", "postcode", "unit_number")
    assert rows(got) == [("SHOP", 1.3, "0123", None)]


def test_station_exits(frame):
    df = docs(frame, feature({"STATION_NA": "Z", "EXIT_CODE": "A"}, 103.8, 1.3),
              feature({"STATION_NA": "Y", "EXIT_CODE": "B"}, 103.8, 1.3), feature({"STATION_NA": "Y"}, 103.8, 1.3))
    assert [r[2:] for r in rows(X.station_exits(df))] == [("Y", "B"), ("Z", "A")]


def test_mall_points_prefer_located_rows(frame):
    df = frame([(" M ", None, None, "x"), ("M", "1.3", "103.8", "y"), ("", "1", "2", "z"), ("N", "1", None, "z")],
               "name string, lat string, lon string, brand string")
    assert rows(X.mall_points(df)) == [("M", "1.3", "103.8")]


def test_schools(frame):
    raw = frame([(" Hill ", "1", " Yes ", "No"), ("Lake", "2", None, "No"), ("Lake", "2", None, "No")],
                "`﻿school_name` string, postal_code string, sap_ind string, ip_ind string")
    found = frame([("Hill", 0, 0, "HILL SCHOOL", None, "1.3", "103.8")],
                  "entity string, term_no int, position int, building string, search_value string, latitude string, longitude string")
    assert rows(X.schools(raw, found)) == [
        ("Hill", "1", "Yes", "No", "No", 1.3, 103.8), ("Lake", "2", "No", "No", "No", None, None),
    ]


def test_demographics(frame):
    people = frame([("Total Population", "5,900", "5,800", "9"), ("Other", "1", "2", "3")], "s string, `2024` string, `2023` string, `1999` string")
    income = frame([("50th", "10,591", "na"), ("10th", "1", "2")], "p string, `2025` string, `2024` string")
    assert rows(X.demographics(people, income)) == [(2023, None, 5800.0), (2024, None, 5900.0), (2025, 10591.0, None)]


def test_price_index(frame):
    df = frame([("1990-Q2", "25.0"), ("1990-Q1", "24.3"), ("1990-Q1", "24.3"), ("1990Q1", "1"), ("2000-Q5x", "1"), ("2001-Q1", "")],
               "quarter string, index string")
    good, rejects = X.price_index(df)
    assert rows(good) == [(1990, 1, 24.3), (1990, 2, 25.0)] and rejects.count() == 3
    assert not proceed(gate(good, index_expectations()))


def test_transactions_and_geocode(frame):
    old = frame([("2000-01", "A", "9", "road", "100")], "month string, town string, block string, `street name` string, resale_price string")
    new = frame([("2020-01", "B", "8", "lane", "200", "61 years")],
                "month string, town string, block string, street_name string, resale_price string, remaining_lease string")
    both = X.transactions({"old": old, "new": new})
    assert {(r["_source"], r["resale_price"], r["remaining_lease"]) for r in both.collect()} == {
        ("old", 100.0, None), ("new", 200.0, "61 years"),
    }
    cache = frame([("9 road", 1.3, 103.8, "1"), ("9 road", None, None, None)], "full_address string, latitude double, longitude double, postal_code string")
    located, stats = X.geocode(both, cache)
    assert [(r["full_address"], r["latitude"]) for r in located.collect()] == [("9 road", 1.3)]
    assert stats.head()["removed_pct"] == pytest.approx(50.0)
    assert rows(pending_keys(X.with_address(both), cache, "full_address")) == [("8 lane",)]
    found = frame([("8 lane", 1.4, 103.9, "2"), ("9 road", 0.0, 0.0, "3")], "full_address string, latitude double, longitude double, postal_code string")
    assert X.geocode(both, X.refreshed_cache(cache.limit(1), found))[0].count() == 2


def test_payloads_to_one_table(frame):
    from assay.plans.extracts import payload_transactions

    lines = frame([("month,town,price", 0), ("2017-01,A,1.5", 1), ("month,town,price", 0), ("2018-02,B,x", 1)], "value string, place int")
    out = payload_transactions({"new": (lines, "month string, town string, resale_price double")}, position="place")
    assert sorted((r["month"], r["town"], r["resale_price"]) for r in out.collect()) == [("2017-01", "A", 1.5), ("2018-02", "B", None)]


def test_gates_decide(frame):
    import pytest

    from assay.plans.checks import demographics_expectations, require

    few, many = frame([(2000,)], "year int"), frame([(y,) for y in range(2000, 2025)], "year int")
    assert require(many, demographics_expectations()).count() == 25
    with pytest.raises(ValueError, match="years"):
        require(few, demographics_expectations())
