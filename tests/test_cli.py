import json
import os

from airshed.__main__ import main
from airshed.sources import read_lookup, read_partitioned


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_cli_jobs_end_to_end(spark, tmpdir_path):
    t = tmpdir_path
    write(f"{t}/raw/s1/a.csv", "time_date,location_name,pm\n2022-04-01 02:00:00,\"a, Iasi, Romania\",1.5\n"
                               "2022-04-02 03:00:00,\"a, Iasi, Romania\",2.5\n")
    stats = main(["partition", "--source", f"{t}/raw", "--target", f"{t}/by_date", "--mode", "overwrite",
                  "--schema", "time_date string, location_name string, pm double"])
    assert stats["row_count"] == 2 and stats["null_date_count"] == 0

    with open(f"{t}/responses.json", "w") as f:
        for d, n in [("2022-04-01", 5), ("2022-04-02", 7)]:
            f.write(json.dumps({"date_str": d, "response": json.dumps(
                {"info": [{"name": "Iasi", "estimated_no_people": n}]})}) + "\n")
    main(["lookup", "--responses", f"{t}/responses.json", "--target", f"{t}/lookup", "--name", "Iasi"])
    assert read_lookup(spark, f"{t}/lookup").count() == 2

    main(["enrich", "--source", f"{t}/by_date", "--lookup", f"{t}/lookup", "--target", f"{t}/enriched",
          "--mode", "strict"])
    got = {r.time_date: r.tourist_estimate for r in read_partitioned(spark, f"{t}/enriched").collect()}
    assert got == {"2022-04-01 02:00:00": "5", "2022-04-02 03:00:00": "7"}

    out = main(["inventory", "--root", f"{t}/by_date", "--src-prefix", "by_date/",
                "--dst-prefix", "archive/", "--target", f"{t}/plan"])
    assert out["planned"] == 2


def test_cli_normalise_and_ledger(spark, tmpdir_path):
    import glob
    from airshed.sinks import read_ledger
    from tests.test_workflows import GOLDEN, SAMPLE
    t = tmpdir_path
    write(f"{t}/weather_sample.csv", SAMPLE)
    main(["normalise", "--source", f"{t}/weather_sample.csv", "--target", f"{t}/norm"])
    lines = []
    for p in sorted(glob.glob(f"{t}/norm/part-*")):
        with open(p, encoding="utf-8") as f:
            lines += f.read().splitlines()
    assert lines == GOLDEN
    # Key and event time of the notification scenario.
    body = json.dumps({"Records": [{"s3": {"bucket": {"name": "b"}, "object": {"key": "pollution/data.csv"}},
                                    "eventTime": "2025-11-19T10:00:00Z"}]})
    write(f"{t}/queue/m.json", json.dumps({"Records": [{"body": body}]}) + "\n")
    main(["ledger", "--source", f"{t}/queue", "--ledger", f"{t}/ledger", "--checkpoint", f"{t}/ck"])
    assert [tuple(r) for r in read_ledger(spark, f"{t}/ledger").collect()] == \
        [("data.csv", "2025-11-19T10:00:00Z", 0)]


def test_reports_dates_and_compaction(spark, tmpdir_path):
    t = tmpdir_path
    head = "time_date,location_name,measurement_pm10Atmo,measurement_pm25Atmo,measurement_pm100Atmo,tourist_estimate"
    for day in (1, 2, 3):
        rows = [f'2022-05-0{day} {h:02d}:00:00,"d, Iasi, Romania",{h},{h * day},1.5,100' for h in range(3)]
        write(f"{t}/pollution/date=2022-05-0{day}/a.csv", "\n".join([head, *rows]) + "\n")
        rows = [f'2022-05-0{day} {h:02d}:00:00,"d, Iasi, Romania",{h + day * day},0.{h}' for h in range(3)]
        write(f"{t}/weather/date=2022-05-0{day}/a.csv",
              "\n".join(["time_date,location_name,weather_windSpeed,weather_precipitation", *rows]) + "\n")
    read = lambda p: spark.read.option("header", True).csv(p).collect()
    src = ["--source", f"{t}/pollution"]
    main(["per-city", *src, "--target", f"{t}/city", "--day", "2022-05-02"])
    assert [(r.day, r.city, float(r.pollution_total_visitor_pm25)) for r in read(f"{t}/city")] == [("2022-05-02", "d, Iasi, Romania", 600.0)]
    main(["per-country", *src, "--target", f"{t}/country"])
    assert sorted((r.day, r.country) for r in read(f"{t}/country")) == [(f"2022-05-0{d}", "Romania") for d in (1, 2, 3)]
    main(["top-days", *src, "--target", f"{t}/top", "--city", "d, Iasi, Romania", "--k", "2"])
    assert sorted(r.day for r in read(f"{t}/top")) == ["2022-05-02", "2022-05-03"]
    main(["correlation", *src, "--weather", f"{t}/weather", "--target", f"{t}/corr", "--city", "d, Iasi, Romania"])
    assert len(read(f"{t}/corr")) == 1
    main(["dates", "--root", f"{t}/pollution", "--root", f"{t}/weather", "--target", f"{t}/dates"])
    assert sorted(r.date_str for r in read(f"{t}/dates")) == ["2022-05-01", "2022-05-02", "2022-05-03"]
    assert main(["compact", "--ledger", f"{t}/none"]) == {"folded": 0}
