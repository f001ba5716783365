import datetime as dt

import pytest
from pyspark.sql import functions as F

from airshed.functions import (
    country_of, date_from_path, day_of, decode_key, encode_city, estimate_int, event_time_or, file_name,
    first_non_empty, graft, iso_text, ms_to_kmh, name_matches, nano_date, remap_prefix,
    strip_slash, valid_date,
)


def one_col(spark, values, expr, typ="string"):
    df = spark.createDataFrame([(v,) for v in values], f"c {typ}")
    return [r[0] for r in df.select(expr(F.col("c")).alias("o")).collect()]


def test_country_of_edges(spark):
    got = one_col(spark, ["Tătărași Sud, Iași, Romania", "Romania", "a, b,", "x,\tSerbia ", None],
                  country_of)
    assert got == ["Romania", "Romania", "", "Serbia", None]


def test_decode_key(spark):
    got = one_col(spark, ["pollution/a+b.csv", "pollution/Ia%C8%99i.csv", "bad%zzescape"],
                  decode_key)
    assert got == ["pollution/a b.csv", "pollution/Iași.csv", "bad%zzescape"]


def test_encode_city(spark):
    assert one_col(spark, ["  Novi Sad "], encode_city) == ["Novi+Sad"]
    # letters, digits and -._~ stay as they are; everything else is escaped
    assert one_col(spark, ["a~b*c", "x-y_z.1", "+ &=ș%"], encode_city) == ["a~b%2Ac", "x-y_z.1", "%2B+%26%3D%C8%99%25"]


def test_nano_date_just_before_midnight(spark):
    midnight = 1648771200000000000
    vals = [midnight, midnight - 1, midnight - 100, midnight - 128, -1, -86400 * 10**9, -86400 * 10**9 - 1]
    assert one_col(spark, vals, nano_date, "bigint") == \
        [dt.date(2022, 4, 1), *[dt.date(2022, 3, 31)] * 3, dt.date(1969, 12, 31), dt.date(1969, 12, 31), dt.date(1969, 12, 30)]


def test_estimate_int_cuts_fractions(spark):
    assert one_col(spark, ["12.7", "-3.9", "1200", "junk", None], lambda c: F.coalesce(estimate_int(c), F.lit(-1))) == [12, -3, 1200, -1, -1]


def test_file_name(spark):
    assert one_col(spark, ["pollution/data.csv", "pollution/", "x"], file_name) == \
        ["data.csv", "", "x"]


def test_remap_and_graft(spark):
    assert one_col(spark, ["pollution/file1.csv"],
                   lambda c: remap_prefix(c, "pollution/", "archive/")) == ["archive/file1.csv"]
    assert one_col(spark, ["weather_partitioned/date=2022-04-01/part-0.csv"],
                   lambda c: graft(c, "weather_enriched/")) == \
        ["weather_enriched/date=2022-04-01/part-0.csv"]


def test_first_non_empty(spark):
    df = spark.createDataFrame([(None, "", "b"), ("", "  a ", "z"), (None, None, None), (" ", "x", "y")],
                               "a string, b string, c string")
    got = [r[0] for r in df.select(first_non_empty("a", "b", "c")).collect()]
    # a blank-but-non-empty value wins, then becomes ''
    assert got == ["b", "a", "", ""]


def test_strip_slash_and_date_from_path(spark):
    assert one_col(spark, ["s3://b/p//"], strip_slash) == ["s3://b/p"]
    assert one_col(spark, ["w/date=2022-04-01/part.csv", "w/part.csv"], date_from_path) == \
        ["2022-04-01", None]


def test_name_matches(spark):
    names = ["Iasi", "Iași", "IASI", "Cluj"]
    assert one_col(spark, names, lambda c: name_matches(c, ["Iasi", "Iași"])) == \
        [True, True, False, False]
    assert one_col(spark, names, lambda c: name_matches(c, ["iasi"], case_sensitive=False)) == \
        [True, False, True, False]


def test_day_of_strict_and_tolerant(spark):
    assert one_col(spark, ["2022-04-01 02:00:00", "garbage"],
                   lambda c: day_of(c, "yyyy-MM-dd HH:mm:ss")) == [dt.date(2022, 4, 1), None]
    with pytest.raises(Exception):
        spark.createDataFrame([("garbage",)], "c string").select(
            day_of("c", strict=True)).collect()


def test_valid_date(spark):
    assert one_col(spark, ["2022-4-1", "2022-04-30"], valid_date) == ["2022-04-01", "2022-04-30"]
    assert one_col(spark, ["x"], lambda c: valid_date(c, strict=False)) == [None]
    with pytest.raises(Exception, match="calendar date"):
        spark.createDataFrame([("2022-13-45",)], "c string").select(valid_date("c")).collect()


def test_iso_and_kmh_golden(spark):
    assert one_col(spark, ["2022-04-01 02:00:00"], iso_text) == ["2022-04-01T02:00:00"]
    assert one_col(spark, [3.13], ms_to_kmh, "double") == [pytest.approx(11.268)]
    assert one_col(spark, ["3.13"], ms_to_kmh) == [3.13 * 3.6]


def test_nano_date_zone_boundary(spark):
    # 2022-04-01 00:00 UTC is 02:00 in Belgrade (summer time); 21:59 UTC stays the same day,
    # 22:00 UTC is already the next local day.
    vals = [1648771200000000000, 1648850340000000000, 1648850400000000000]
    got = one_col(spark, vals, lambda c: nano_date(c, "Europe/Belgrade"), "bigint")
    assert got == [dt.date(2022, 4, 1), dt.date(2022, 4, 1), dt.date(2022, 4, 2)]
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        assert one_col(spark, vals, lambda c: nano_date(c, "Europe/Belgrade"), "bigint") == got
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_event_time_or(spark):
    df = spark.createDataFrame([("2025-11-19T10:00:00Z",), ("",), (None,)], "c string")
    got = [r[0] for r in df.select(event_time_or("c", F.lit("DEFAULT"))).collect()]
    assert got == ["2025-11-19T10:00:00Z", "DEFAULT", "DEFAULT"]
    now = df.select(event_time_or("c")).collect()
    assert all(r[0] for r in now)


def test_values_helpers(spark):
    import json
    from airshed.functions import estimate_int, json_in, json_out, zero_if_null
    from pyspark.sql import types as T
    df = spark.createDataFrame([(None, "12", '{"a": 1}'), (2.5, "x", "{oops")],
                               "m double, e string, j string")
    rows = df.select(zero_if_null("m").alias("z"), estimate_int("e").alias("i"),
                     json_in("j", T.StructType([T.StructField("a", T.IntegerType())])).alias("p"),
                     json_out(m="m", e="e").alias("o")).collect()
    assert [r.z for r in rows] == [0.0, 2.5]
    assert [r.i for r in rows] == [12, None]
    assert rows[0].p.a == 1 and rows[1].p.a is None   # malformed text: struct of NULLs
    assert json.loads(rows[1].o) == {"m": 2.5, "e": "x"}


def test_event_time_default_is_utc(spark):
    import datetime as dt
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Pacific/Auckland")
        got = spark.range(1).select(event_time_or(F.lit(None).cast("string")).alias("t")).first().t
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    assert abs((dt.datetime.fromisoformat(got) - now).total_seconds()) < 120
