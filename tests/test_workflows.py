import glob
import os

import pytest
from pyspark.sql import functions as F

from airshed.plans.workflows import (
    enrich_partitioned, normalise_weather_file, partition_by_date_job, publish_lookup,
)
from airshed.schemas import WEATHER_RAW
from airshed.sinks import write_by_date
from airshed.sources import lookup_from_rows, read_lookup, read_partitioned

# The shipped one-row weather sample and its normalised golden output.
SAMPLE = (
    "name,time_nano,time_date,location_latitude,location_longitude,location_name,"
    "weather_temperature,weather_feelsLike,weather_pressure,weather_humidity,weather_dewPoint,"
    "weather_clouds,weather_windSpeed,weather_windDeg\n"
    '"1248 - Tătărași Sud, Iași, Romania",1648771200000000000,2022-04-01 02:00:00,47.154,27.614,'
    '"Tătărași Sud, Iași, Romania",16.54,15.61,995,52,6.66,0,3.13,120\n'
)
GOLDEN = ["name;datetime_iso;temperature_c;wind_speed_kmh",
          "1248 - Tătărași Sud, Iași, Romania;2022-04-01T02:00:00;16.54;11.268"]


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def read_lines(folder):
    out = []
    for p in sorted(glob.glob(os.path.join(folder, "part-*"))):
        with open(p, encoding="utf-8") as f:
            out += f.read().splitlines()
    return out


@pytest.mark.parametrize("schema", [None, WEATHER_RAW])
def test_normalise_weather_golden(spark, tmpdir_path, schema):
    src = os.path.join(tmpdir_path, "weather_sample.csv")
    write(src, SAMPLE)
    dst = os.path.join(tmpdir_path, "out")
    normalise_weather_file(spark, src, dst, schema=schema, single_file=True)
    assert read_lines(dst) == GOLDEN


def test_partition_job_profile_and_layout(spark, tmpdir_path):
    src = os.path.join(tmpdir_path, "raw")
    header = SAMPLE.splitlines()[0]
    row = SAMPLE.splitlines()[1]
    write(os.path.join(src, "station1", "a.csv"), "\n".join([header, row, row.replace(
        "2022-04-01 02:00:00", "2022-04-02 23:30:00")]) + "\n")
    write(os.path.join(src, "station2", "b.csv"), "\n".join([header, row.replace(
        "2022-04-01 02:00:00", "not a time")]) + "\n")
    dst = os.path.join(tmpdir_path, "by_date")
    stats = partition_by_date_job(spark, src, dst, schema=WEATHER_RAW)
    assert stats == {"row_count": 3, "file_count": 2, "null_date_count": 1, "bad_row_count": 0}
    dirs = sorted(os.path.basename(p) for p in glob.glob(os.path.join(dst, "date=*")))
    assert dirs == ["date=2022-04-01", "date=2022-04-02", "date=__HIVE_DEFAULT_PARTITION__"]
    back = read_partitioned(spark, dst)
    counts = {r["date"]: r["count"] for r in back.groupBy("date").count().collect()}
    assert sorted(counts.values()) == [1, 1, 1] and None in counts
    # the date filter prunes folders
    plan = back.filter(F.col("date") == "2022-04-02")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and back.filter(F.col("date") == "2022-04-02").count() == 1
    # append adds files: a second run doubles the rows; profiling first gives the same counts
    assert partition_by_date_job(spark, src, dst, schema=WEATHER_RAW, one_pass=False) == stats
    assert read_partitioned(spark, dst).count() == 6


def test_partition_job_sensor_nanos(spark, tmpdir_path):
    src = os.path.join(tmpdir_path, "raw")
    write(os.path.join(src, "s", "a.csv"),
          "id,time_nano\n1,1648850340000000000\n2,1648850400000000000\n")
    dst = os.path.join(tmpdir_path, "by_date")
    partition_by_date_job(spark, src, dst, schema="id int, time_nano long", nanos_col="time_nano",
                          tz="Europe/Belgrade")
    dirs = sorted(os.path.basename(p) for p in glob.glob(os.path.join(dst, "date=*")))
    assert dirs == ["date=2022-04-01", "date=2022-04-02"]


def test_lookup_publish_and_enrich_partitioned(spark, tmpdir_path):
    import json
    resp = spark.createDataFrame(
        [("2022-04-02", json.dumps({"info": [{"name": "Iasi", "estimated_no_people": 7}]})),
         ("2022-04-01", json.dumps({"info": [{"name": "Iași", "estimated_no_people": "5"}]}))],
        "date_str string, response string")
    lk_path = os.path.join(tmpdir_path, "lookup")
    publish_lookup(resp, lk_path, ["Iasi", "Iași"])
    assert read_lines(lk_path) == ["date_str,tourist_estimate", "2022-04-01,5", "2022-04-02,7"]
    lookup = read_lookup(spark, lk_path)

    part = os.path.join(tmpdir_path, "pollution_partitioned")
    df = spark.createDataFrame([("2022-04-01 01:00:00", 1.5), ("2022-04-02 05:00:00", 2.5),
                                ("2022-04-03 05:00:00", 3.5)], "time_date string, pm double")
    write_by_date(df.withColumn("date", F.to_date(F.substring("time_date", 1, 10))), part, mode="overwrite")
    out = os.path.join(tmpdir_path, "enriched")
    enrich_partitioned(spark, part, lookup, out)
    # schema-less read back: every data column is text
    got = {r.time_date: r.tourist_estimate for r in read_partitioned(spark, out).collect()}
    assert got == {"2022-04-01 01:00:00": "5", "2022-04-02 05:00:00": "7", "2022-04-03 05:00:00": None}
    with pytest.raises(KeyError, match="2022-04-03"):
        enrich_partitioned(spark, part, lookup, out, mode="strict")

    # dynamic overwrite replaces only the dates present in the new input
    only_day1 = os.path.join(tmpdir_path, "day1")
    write_by_date(df.limit(1).withColumn("date", F.to_date(F.substring("time_date", 1, 10))),
                  only_day1, mode="overwrite")
    new_lookup = lookup_from_rows(spark, [("2022-04-01", 50)])
    enrich_partitioned(spark, only_day1, new_lookup, out, write_mode="dynamic")
    got = {r.time_date: r.tourist_estimate for r in read_partitioned(spark, out).collect()}
    assert got == {"2022-04-01 01:00:00": "50", "2022-04-02 05:00:00": "7", "2022-04-03 05:00:00": None}


def test_write_csv_full_copy_and_separator(spark, tmpdir_path):
    from airshed.sinks import write_csv
    df = spark.createDataFrame([("a, b", 1.5), ("c", None)], "name string, v double")
    out = os.path.join(tmpdir_path, "copy")
    write_csv(df, out, single_file=True)
    assert read_lines(out) == ["name,v", '"a, b",1.5', "c,"]
    out2 = os.path.join(tmpdir_path, "semi")
    write_csv(df, out2, sep=";", single_file=True)
    assert read_lines(out2) == ["name;v", "a, b;1.5", "c;"]


def test_day_reports_prune_partitions(spark, tmpdir_path):
    from airshed.operators import exposure_per_city, exposure_per_country
    rows = [(f"2022-05-0{d} {h:02d}:00:00", f"d{h % 2}, Iasi, Romania", 1.0 * h, 2.0, None, d)
            for d in (1, 2, 3) for h in range(4)]
    df = spark.createDataFrame(rows, "time_date string, location_name string, measurement_pm10Atmo double, "
                                     "measurement_pm25Atmo double, measurement_pm100Atmo double, "
                                     "tourist_estimate int")
    out = os.path.join(tmpdir_path, "enriched")
    write_by_date(df.withColumn("date", F.to_date(F.substring("time_date", 1, 10))), out, mode="overwrite")
    schema = ("time_date string, location_name string, measurement_pm10Atmo double, "
              "measurement_pm25Atmo double, measurement_pm100Atmo double, tourist_estimate int")
    part = read_partitioned(spark, out, schema=schema)
    q = exposure_per_city(part, day="2022-05-02", partition_col="date")
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan and "2022-05-02" in plan.split("PartitionFilters")[1][:200]
    full = exposure_per_city(df, day="2022-05-02")
    assert sorted(map(tuple, q.collect())) == sorted(map(tuple, full.collect()))
    assert exposure_per_country(part, day="2022-05-02", partition_col="date").count() == 1
    # a "date" column with another meaning loses no rows unless pruning by it is asked for
    other = df.withColumn("date", F.lit("1999-01-01").cast("date"))
    assert sorted(map(tuple, exposure_per_city(other, day="2022-05-02").collect())) == sorted(map(tuple, full.collect()))
    assert exposure_per_city(other, day="2022-05-02", partition_col="date").count() == 0


def test_incremental_enrich_only_new_days(spark, tmpdir_path):
    part = os.path.join(tmpdir_path, "src")
    df = spark.createDataFrame([("2022-04-01 01:00:00",), ("2022-04-02 05:00:00",)], "time_date string")
    write_by_date(df.withColumn("date", F.to_date(F.substring("time_date", 1, 10))), part, mode="overwrite")
    out = os.path.join(tmpdir_path, "dst")
    enrich_partitioned(spark, part, lookup_from_rows(spark, [("2022-04-01", 1), ("2022-04-02", 2)]), out)
    one = lookup_from_rows(spark, [("2022-04-02", 20)])
    enrich_partitioned(spark, part, one, out, days=["2022-04-02"])
    with pytest.raises(ValueError, match="erase"):
        enrich_partitioned(spark, part, one, out, write_mode="overwrite", days=["2022-04-02"])
    got = {r.time_date: r.tourist_estimate for r in read_partitioned(spark, out).collect()}
    assert got == {"2022-04-01 01:00:00": "1", "2022-04-02 05:00:00": "20"}


def test_read_raw_two_levels_inferred_and_lookup_order(spark, tmpdir_path):
    from airshed.sinks import write_lookup
    from airshed.sources import read_raw
    src = os.path.join(tmpdir_path, "raw")
    write(os.path.join(src, "s1", "a.csv"), "time_date,v\n2022-04-01 02:00:00,1.5\n")
    write(os.path.join(src, "s2", "b.csv"), "time_date,v\n2022-04-02 03:00:00,2\n")
    df = read_raw(spark, src, infer=True)
    assert dict(df.dtypes)["v"] == "double" and df.count() == 2
    lk = lookup_from_rows(spark, [("2022-04-02", None), ("2022-04-01", 3)])
    out = os.path.join(tmpdir_path, "lookup")
    write_lookup(lk, out)
    assert read_lines(out) == ["date_str,tourist_estimate", "2022-04-01,3", "2022-04-02,"]


def test_csv_headers_are_checked_and_bad_values_counted(spark, tmpdir_path):
    from airshed.sources import read_raw
    src = os.path.join(tmpdir_path, "raw")
    write(os.path.join(src, "s", "a.csv"), "id,time_date,v\n1,2022-04-01 02:00:00,1.5\n2,2022-04-01 03:00:00,abc\n")
    schema = "id int, time_date string, v double"
    dst = os.path.join(tmpdir_path, "dst")
    assert partition_by_date_job(spark, src, dst, schema=schema) == \
        {"row_count": 2, "file_count": 1, "null_date_count": 0, "bad_row_count": 1}
    rows = read_raw(spark, src, schema, corrupt_col="_bad").orderBy("id").collect()
    assert [(r.v, r._bad) for r in rows] == [(1.5, None), (None, "2,2022-04-01 03:00:00,abc")]
    # the same columns in another order are not read by position
    write(os.path.join(src, "t", "b.csv"), "id,v,time_date\n3,2.5,2022-04-02 02:00:00\n")
    with pytest.raises(Exception, match="header|Header"):
        read_raw(spark, src, schema, corrupt_col="_bad").collect()


def test_nothing_becomes_null_unseen(spark, tmpdir_path):
    """Without a place for bad lines a bad value is an error; so are another header and junk in a lookup."""
    from airshed.sources import read_raw
    src, dst = os.path.join(tmpdir_path, "raw"), os.path.join(tmpdir_path, "dst")
    write(os.path.join(src, "s", "a.csv"), "id,time_date,v\n1,2022-04-01 02:00:00,1.5\n2,2022-04-01 03:00:00,abc\n3,2022-04-01\n")
    schema = "id int, time_date string, v double"
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        read_raw(spark, src, schema).collect()
    partition_by_date_job(spark, src, dst, schema=schema)
    assert [r.id for r in read_partitioned(spark, dst, schema).collect()] == [1]
    assert sorted((r.line, r.reason) for r in spark.read.parquet(dst + "-rejected").collect()) == \
        [("2,2022-04-01 03:00:00,abc", "v: no double"), ("3,2022-04-01", "wrong number of fields")]
    part = os.path.join(tmpdir_path, "part")
    write(os.path.join(part, "date=2022-04-01", "x.csv"), "id,pm\n1,much\n")
    lookup = lookup_from_rows(spark, [("2022-04-01", 1)])
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        enrich_partitioned(spark, part, lookup, os.path.join(tmpdir_path, "out"), schema="id int, pm double")
    for name, text, error in (("swapped", "tourist_estimate,date_str\n5,2022-04-01\n", "eader"),
                              ("junk", "date_str,tourist_estimate\n2022-04-01,many\n", "MALFORMED|Malformed")):
        write(os.path.join(tmpdir_path, name, "l.csv"), text)
        with pytest.raises(Exception, match=error):
            read_lookup(spark, os.path.join(tmpdir_path, name)).collect()


def test_dataset_as_catalog_table(spark, tmpdir_path):
    from airshed.plans.views import register_dataset
    out = os.path.join(tmpdir_path, "enriched")
    df = spark.createDataFrame([("2022-04-01 01:00:00", 1.5), ("2022-04-02 05:00:00", 2.5)], "time_date string, pm double")
    write_by_date(df.withColumn("date", F.to_date(F.substring("time_date", 1, 10))), out, mode="overwrite")
    name = "enriched_" + os.path.basename(tmpdir_path).replace("-", "_").lower()
    register_dataset(spark, name, out, "time_date string, pm double")
    q = spark.sql(f"SELECT pm FROM {name} WHERE date = DATE '2022-04-02'")
    assert [r.pm for r in q.collect()] == [2.5]
    # one day hidden and shown again; removed folders leave the catalog
    from airshed.plans.views import drop_day, register_day
    drop_day(spark, name, "2022-04-01")
    assert spark.table(name).count() == 1
    register_day(spark, name, "2022-04-01")
    assert spark.table(name).count() == 2
    # a second folder, or other columns, under the same name
    other = os.path.join(tmpdir_path, "other")
    write_by_date(df.limit(1).withColumn("date", F.to_date(F.substring("time_date", 1, 10))), other, mode="overwrite")
    for path, ddl in ((other, "time_date string, pm double"), (out, "time_date string, pm string")):
        with pytest.raises(ValueError, match="exists over"):
            register_dataset(spark, name, path, ddl)
    assert register_dataset(spark, name, other, "time_date string, pm double", replace=True).count() == 1
    register_dataset(spark, name, out, "time_date string, pm double", replace=True)
    q = spark.sql(f"SELECT pm FROM {name} WHERE date = DATE '2022-04-02'")
    assert "PartitionFilters: [isnotnull(date" in q._jdf.queryExecution().executedPlan().toString()
