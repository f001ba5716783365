import json

import pytest
from pyspark.sql import functions as F

from airshed.operators import build_lookup, enrich, lookup_with_status
from airshed.operators.joins import bounded_broadcast
from airshed.sources import lookup_from_rows, parse_estimates


def test_left_enrich_keeps_unmatched_rows(spark):
    df = spark.createDataFrame([("2022-04-01", 1), ("2022-04-02", 2), (None, 3)], "date_str string, v int")
    lk = lookup_from_rows(spark, [("2022-04-01", 100), ("2022-04-03", None)])
    got = {r.v: r.tourist_estimate for r in enrich(df, lk).collect()}
    assert got == {1: 100, 2: None, 3: None}


def test_strict_enrich_raises_on_missing_or_null_estimate(spark):
    df = spark.createDataFrame([("2022-04-01",), ("2022-04-02",)], "date_str string")
    with pytest.raises(KeyError, match="2022-04-02"):
        enrich(df, lookup_from_rows(spark, [("2022-04-01", 5)]), mode="strict")
    with pytest.raises(KeyError):
        enrich(df, lookup_from_rows(spark, [("2022-04-01", 5), ("2022-04-02", None)]), mode="strict")
    ok = enrich(df, lookup_from_rows(spark, [("2022-04-01", 5), ("2022-04-02", 6)]), mode="strict")
    assert sorted(r.tourist_estimate for r in ok.collect()) == [5, 6]


def test_bounded_broadcast_respects_limit(spark):
    df = spark.range(10)
    side, small = bounded_broadcast(df, max_rows=100)
    assert small and side.count() == 10
    side, small = bounded_broadcast(df, max_rows=5)
    assert not small and side.count() == 10
    _, small = bounded_broadcast(df, max_rows=5, materialise_side=False)
    assert not small
    # a few wide rows: within the row bound, over the byte bound
    wide = spark.range(3).selectExpr("id", "repeat('x', 10000) AS pad")
    _, small = bounded_broadcast(wide, max_rows=100, max_bytes=20_000)
    assert not small
    _, small = bounded_broadcast(wide, max_rows=100, max_bytes=20_000, materialise_side=False)
    assert not small
    _, small = bounded_broadcast(wide, max_rows=100, max_bytes=100_000)
    assert small


def responses(spark):
    docs = [("2022-04-01", {"info": [{"name": "Cluj", "estimated_no_people": 1},
                                     {"name": "Iași", "estimated_no_people": "1200"},
                                     {"name": "Iasi", "estimated_no_people": 999}]}),
            ("2022-4-2", {"info": [{"name": "IASI", "estimated_no_people": 50}]}),
            ("2022-04-03", {"info": []}),
            ("2022-04-04", {})]
    return spark.createDataFrame([(d, json.dumps(r)) for d, r in docs], "date_str string, response string")


def test_build_lookup_first_match_case_sensitive(spark):
    got = {r.date_str: r.tourist_estimate
           for r in build_lookup(responses(spark), ["Iasi", "Iași"]).collect()}
    assert got == {"2022-04-01": 1200, "2022-04-02": None, "2022-04-03": None, "2022-04-04": None}


def test_build_lookup_case_insensitive_and_error_mode(spark):
    got = {r.date_str: r.tourist_estimate
           for r in build_lookup(responses(spark), ["iasi"], case_sensitive=False).collect()}
    assert got["2022-04-01"] == 999 and got["2022-04-02"] == 50
    with pytest.raises(RuntimeError, match="'iasi' is not listed"):
        build_lookup(responses(spark), ["iasi"], case_sensitive=False, on_missing="error")


def test_parse_estimates_flattens_with_positions(spark):
    rows = parse_estimates(responses(spark)).filter(F.col("date_str") == "2022-04-01").collect()
    assert [(r.pos, r.name, r.estimated_no_people) for r in rows] == \
        [(0, "Cluj", "1"), (1, "Iași", "1200"), (2, "Iasi", "999")]


def test_lookup_with_status_scenarios(spark):
    req = spark.createDataFrame([(1, "Belgrade"), (2, None), (3, "   "), (4, "Novi Sad"), (5, " Nis ")],
                                "rid int, city string")
    svc = spark.createDataFrame([(1, 24.5), (4, None), (5, 18.0)], "rid int, temperature double")
    got = {r.rid: (r.statusCode, json.loads(r.body))
           for r in lookup_with_status(req, svc, on="rid").collect()}
    assert got[1] == (200, {"city": "Belgrade", "temperature": 24.5})
    assert got[2] == (400, {"message": "City is required"})
    assert got[3] == (400, {"message": "City is required"})
    assert got[4] == (502, {"message": "Weather service response missing temperature field"})
    assert got[5] == (200, {"city": "Nis", "temperature": 18.0})


def test_lookup_with_status_unreachable_and_integer_value(spark):
    req = spark.createDataFrame([(1, "Novi Sad"), (2, "Belgrade")], "rid int, city string")
    svc = spark.createDataFrame([(2, 18)], "rid int, temperature int")
    got = {r.rid: (r.statusCode, json.loads(r.body))
           for r in lookup_with_status(req, svc, on="rid").collect()}
    assert got[1] == (502, {"message": "Could not reach weather service"})
    assert got[2][1]["temperature"] == 18.0 and isinstance(got[2][1]["temperature"], float)


def test_clear_scratch_removes_materialised_sides(spark):
    from airshed.operators.joins import materialise
    from airshed.session import clear_scratch
    side, n = materialise(spark.range(5))
    assert n == 5 and side.count() == 5
    assert clear_scratch(spark)
    assert not clear_scratch(spark)


def one(date, value):
    return date, json.dumps({"info": [{"name": "Iasi", "estimated_no_people": value}]})


def test_lookup_has_one_row_per_date_or_fails(spark):
    rows = [(*one("2024-01-05", 7), 1), (*one("2024-1-5", 12.7), 2), (*one("2024-01-06", "junk"), 1), (*one("bad", 3), 1), (*one(None, 3), 1),
            ("2024-01-07", json.dumps({"info": []}), 1)]
    df = spark.createDataFrame(rows, "date_str string, response string, seq int")
    got = {r.date_str: r.tourist_estimate for r in build_lookup(df, ["Iasi"], order_col="seq").collect()}
    assert got == {"2024-01-05": 12, "2024-01-06": None, "2024-01-07": None}
    assert {r.date_str: r.tourist_estimate for r in build_lookup(df, ["Iasi"]).collect()}["2024-01-05"] == 12
    from airshed.operators import lookup_problems
    assert lookup_problems(df, ["Iasi"]).first().asDict() == {
        "responses": 6, "bad_dates": 2, "city_missing": 1, "bad_estimates": 1, "repeated_dates": 1}
    for bad, what in (("date_str = '2024-01-06'", "no number"), ("date_str = 'bad'", "calendar date"), ("date_str is null", "calendar date"),
                      ("date_str = '2024-01-07'", "not listed")):
        with pytest.raises(RuntimeError, match=what):
            build_lookup(df.filter(bad), ["Iasi"], on_missing="error")


def test_lookup_with_repeated_keys_is_refused(spark):
    df = spark.createDataFrame([("2022-04-01",)], "date_str string")
    with pytest.raises(ValueError, match="several rows"):
        enrich(df, lookup_from_rows(spark, [("2022-04-01", 1), ("2022-04-01", 2)]))


def test_lookup_by_status_shuffles_no_rows_to_one_task(spark):
    req = spark.range(50).selectExpr("id as rid", "'x' as city")
    svc = spark.range(50).selectExpr("id as rid", "1.0D as temperature")
    df = lookup_with_status(req, svc, on="rid")
    assert df.count() == 50
    assert "SinglePartition" not in df._jdf.queryExecution().executedPlan().toString()
