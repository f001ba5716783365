"""Quarantine, mended lines, file identity."""

import os

import pytest

from airshed.plans import landing as L
from airshed.sources import lookup_from_rows

SCHEMA = "id int, time_date string, v double, note string"
HEAD = "id,time_date,v,note\n"


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


@pytest.fixture()
def place(tmpdir_path):
    src = f"{tmpdir_path}/raw"
    write(f"{src}/weather/s1/a.csv", HEAD + '1,2022-04-01 02:00:00,1.5,"x, y"\n2,2022-04-01 03:00:00,abc,\n2,2022-04-01 03:00:00,abc,\n'
          "3,2022-04-02 01:00:00,,\n4,,2.0,\n")
    write(f"{src}/weather/s 2/b.csv", HEAD + "5,2022-02-30 01:00:00,2.5,q\n6,2022-04-01 01:00:00\nx,2022-04-01 01:00:00,1,\n")
    write(f"{src}/weather/s3/empty.csv", HEAD)
    return src, f"{tmpdir_path}/out", f"{tmpdir_path}/bad"


def rows(spark, out):
    return sorted(((r.id, str(r.date), r.v, r.note) for r in L.read_landed(spark, out, SCHEMA).collect()), key=str)


def test_every_line_is_accepted_or_rejected(spark, place):
    src, out, bad = place
    assert L.land_files(spark, src, out, bad, SCHEMA) == {"files": 2, "read": 8, "accepted": 3, "rejected": 5}
    assert rows(spark, out) == [(1, "2022-04-01", 1.5, "x, y"), (3, "2022-04-02", None, None), (4, "None", 2.0, None)]
    got = sorted((os.path.basename(r.file), r.line, r.reason, r.copies) for r in L.quarantined(spark, bad).collect())
    assert got == [("a.csv", "2,2022-04-01 03:00:00,abc,", "v: no double", 2),
                   ("b.csv", "5,2022-02-30 01:00:00,2.5,q", "time_date: no date", 1),
                   ("b.csv", "6,2022-04-01 01:00:00", "wrong number of fields", 1),
                   ("b.csv", "x,2022-04-01 01:00:00,1,", "id: no int", 1)]
    assert sorted((os.path.basename(r.file), r.accepted, r.rejected) for r in L.landed_files(spark, bad).collect()) == \
        [("a.csv", 3, 2), ("b.csv", 0, 3)]


def test_landing_twice_changes_nothing_and_a_file_sent_anew_replaces_its_rows(spark, place):
    src, out, bad = place
    L.land_files(spark, src, out, bad, SCHEMA)
    before = rows(spark, out)
    L.land_files(spark, src, out, bad, SCHEMA)
    assert rows(spark, out) == before and L.quarantined(spark, bad).count() == 4
    write(f"{src}/weather/s1/a.csv", HEAD + "1,2022-04-01 02:00:00,9.5,new\n3,2022-04-02 01:00:00,1,\n4,,2.0,\n")
    assert L.land_files(spark, src, out, bad, SCHEMA, files=["weather/s1/a.csv"])["rejected"] == 0
    assert rows(spark, out) == [(1, "2022-04-01", 9.5, "new"), (3, "2022-04-02", 1.0, None), (4, "None", 2.0, None)]
    assert {os.path.basename(r.file) for r in L.quarantined(spark, bad).collect()} == {"b.csv"}


def test_rows_of_a_day_that_a_file_no_longer_holds_are_gone(spark, place):
    src, out, bad = place
    L.land_files(spark, src, out, bad, SCHEMA)
    write(f"{src}/weather/s1/a.csv", HEAD + "1,2022-04-05 02:00:00,9.5,moved\n")
    L.land_files(spark, src, out, bad, SCHEMA, files=["weather/s1/a.csv"])
    assert rows(spark, out) == [(1, "2022-04-05", 9.5, "moved")]


def test_mended_lines_come_back_with_their_copies_and_the_rest_stays(spark, place):
    src, out, bad = place
    L.land_files(spark, src, out, bad, SCHEMA)
    q = {r.line: r.file for r in L.quarantined(spark, bad).collect()}
    mended = [(f, line, new) for line, f in q.items() for old, new in (
        ("2,2022-04-01 03:00:00,abc,", "2,2022-04-01 03:00:00,7.5,ok"), ("x,2022-04-01 01:00:00,1,", "8,2022-13-01 01:00:00,1,")) if line == old]
    mended = spark.createDataFrame(mended + [("no/such/line.csv", "z", None)][:0], "file string, line string, mended string")
    stats = L.land_files(spark, src, out, bad, SCHEMA, mended=mended)
    assert stats == {"files": 2, "read": 8, "accepted": 5, "rejected": 3}
    assert [r for r in rows(spark, out) if r[0] == 2] == [(2, "2022-04-01", 7.5, "ok")] * 2
    assert sorted((r.line, r.reason) for r in L.quarantined(spark, bad).collect()) == [
        ("5,2022-02-30 01:00:00,2.5,q", "time_date: no date"), ("6,2022-04-01 01:00:00", "wrong number of fields"),
        ("8,2022-13-01 01:00:00,1,", "time_date: no date")]
    none = spark.createDataFrame([], "file string, line string, mended string")
    assert L.land_files(spark, src, out, bad, SCHEMA, mended=none) == {"files": 0, "read": 0, "accepted": 0, "rejected": 0}


def test_enriched_files_keep_their_identity(spark, tmpdir_path):
    src, out = f"{tmpdir_path}/in", f"{tmpdir_path}/out"
    schema = "id int, pm double"
    write(f"{src}/date=2022-04-01/a.csv", "id,pm\n1,1.0\n2,2.0\n")
    write(f"{src}/date=2022-04-01/b.csv", "id,pm\n3,3.0\n")
    write(f"{src}/date=2022-04-02/a.csv", "id,pm\n4,4.0\n")
    L.enrich_files(spark, src, lookup_from_rows(spark, [("2022-04-01", 10)]), out, schema)
    write(f"{src}/date=2022-04-01/a.csv", "id,pm\n1,1.5\n")
    L.enrich_files(spark, src, lookup_from_rows(spark, [("2022-04-01", 20)]), out, schema, files=["date=2022-04-01/a.csv"])
    got = spark.read.option("header", True).csv(out).selectExpr("cast(id as int)", "cast(pm as double)", "cast(tourist_estimate as int)", "cast(date as string)", "file")
    assert sorted(map(tuple, got.collect())) == [(1, 1.5, 20, "2022-04-01", "a.csv"), (3, 3.0, 10, "2022-04-01", "b.csv"),
                                                 (4, 4.0, None, "2022-04-02", "a.csv")]
    write(f"{src}/date=2022-04-02/a.csv", "id,pm\n4,much\n")
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        L.enrich_files(spark, src, lookup_from_rows(spark, [("2022-04-01", 20)]), out, schema)
