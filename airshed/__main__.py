"""Command-line entry points for spark-submit (``python -m airshed <job> ...``).

Jobs: ``partition`` (W2), ``land`` (W2 file by file, with a quarantine), ``normalise`` (W1), ``lookup`` (W3, from landed
JSON responses), ``enrich`` (W4), ``inventory`` (W10 copy plan), ``ledger``
(W9 stream), ``compact`` (its versions), ``dates`` (those to request estimates
for), and the reports ``per-city``, ``per-country``, ``top-days`` and
``correlation``.  On a cluster the master comes from spark-submit and
``spark.checkpoint.dir`` must name a shared folder.
"""

from __future__ import annotations

import argparse
import json
import os
import sys

if __package__ in (None, ""):
    # Run as a script (spark-submit airshed/__main__.py): only the driver
    # imports this package -- there are no Python UDFs, so executors never do.
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from airshed.session import build_session  # noqa: E402


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="airshed")
    sub = p.add_subparsers(dest="job", required=True)

    a = sub.add_parser("partition", help="CSV two levels below SOURCE -> date= partitioned CSV")
    a.add_argument("--source", required=True)
    a.add_argument("--target", required=True)
    a.add_argument("--time-col", default="time_date")
    a.add_argument("--nanos-col", help="derive the date from epoch nanoseconds (sensor files)")
    a.add_argument("--tz", default="UTC")
    a.add_argument("--mode", default="append", choices=["append", "overwrite", "dynamic"])
    a.add_argument("--one-pass", action="store_true")
    a.add_argument("--schema", help="DDL schema of the CSV files (default: inferred, one extra pass;"
                                    " inferred timestamps are written back in ISO form)")

    a = sub.add_parser("normalise", help="weather CSV -> name;datetime_iso;temperature_c;wind_speed_kmh")
    a.add_argument("--source", required=True)
    a.add_argument("--target", required=True)

    a = sub.add_parser("lookup", help="landed JSON responses (date_str, response) -> lookup CSV")
    a.add_argument("--responses", required=True, help="JSON lines with date_str and response")
    a.add_argument("--target", required=True)
    a.add_argument("--name", action="append", required=True, help="city name(s) to pick")
    a.add_argument("--case-insensitive", action="store_true")
    a.add_argument("--on-missing", default="null", choices=["null", "error"])

    a = sub.add_parser("land", help="CSV two levels below SOURCE -> date=/file= CSV, rejected lines in quarantine")
    a.add_argument("--source", required=True)
    a.add_argument("--target", required=True)
    a.add_argument("--quarantine", required=True)
    a.add_argument("--schema", required=True, help="DDL schema of the CSV files")
    a.add_argument("--time-col", default="time_date")
    a.add_argument("--nanos-col", help="derive the date from epoch nanoseconds (sensor files)")
    a.add_argument("--tz", default="UTC")
    a.add_argument("--file", action="append", help="land these files only (paths below SOURCE, repeatable)")
    a.add_argument("--mended", help="JSON lines with file, line and mended: rejected lines with a new text")

    a = sub.add_parser("enrich", help="date= partitioned CSV + lookup CSV -> enriched CSV")
    a.add_argument("--source", required=True, action="append", help="repeatable, each with its --target")
    a.add_argument("--lookup", required=True)
    a.add_argument("--target", required=True, action="append")
    a.add_argument("--mode", default="left", choices=["left", "strict"])
    a.add_argument("--write-mode", choices=["overwrite", "dynamic", "append"],
                   help="default: overwrite, with --day dynamic")
    a.add_argument("--day", action="append", help="restrict to these dates (repeatable)")

    a = sub.add_parser("inventory", help="copy plan for the files below ROOT")
    a.add_argument("--root", required=True)
    a.add_argument("--src-prefix", required=True)
    a.add_argument("--dst-prefix", required=True)
    a.add_argument("--target", required=True, help="where to write the plan (CSV)")

    a = sub.add_parser("ledger", help="drain queue messages into the keyed ledger")
    a.add_argument("--source", required=True)
    a.add_argument("--ledger", required=True)
    a.add_argument("--checkpoint", required=True)
    a.add_argument("--dead-letters")
    a.add_argument("--on-poison", default="route", choices=["route", "fail"])
    a.add_argument("--prefix", action="append", help="watched prefix (repeatable)")

    a = sub.add_parser("compact", help="fold the ledger's versions into one")
    a.add_argument("--ledger", required=True)

    for job, what in (("per-city", "exposure per day and city"), ("per-country", "exposure per day and country"),
                      ("top-days", "most exposed days of a city"), ("correlation", "exposure against weather in a city")):
        a = sub.add_parser(job, help=what)
        a.add_argument("--source", required=True, help="enriched date= partitioned CSV")
        a.add_argument("--target", required=True, help="where to write the report (CSV)")
        if job in ("per-city", "per-country"):
            a.add_argument("--day")
            a.add_argument("--date-is-local-day", action="store_true",
                           help="the date= folders hold the days of the time text: read that day's folder only")
        else:
            a.add_argument("--city", required=True)
        if job == "top-days":
            a.add_argument("--k", type=int, default=10)
        if job == "correlation":
            a.add_argument("--weather", required=True, help="date= partitioned weather CSV")

    a = sub.add_parser("dates", help="sorted dates of several date= partitioned datasets")
    a.add_argument("--root", action="append", required=True, help="dataset (repeatable)")
    a.add_argument("--target", required=True)
    return p


REPORT_COLUMNS = ("time_date string, location_name string, measurement_pm10Atmo double, measurement_pm25Atmo double, "
                  "measurement_pm100Atmo double, tourist_estimate int")


def report(spark, args):
    """The DataFrame of one report job; columns are found by name, extra ones are left aside."""
    from pyspark.sql import functions as F

    from airshed import operators as O
    from airshed.sources import read_partitioned, standardise_columns

    def typed(path, ddl):
        df = standardise_columns(read_partitioned(spark, path))
        pairs = [c.split() for c in ddl.split(", ")]
        return df.select(*[F.col(n).cast(k).alias(n) for n, k in pairs], "date")

    df = typed(args.source, REPORT_COLUMNS)
    if args.job in ("per-city", "per-country"):
        run = O.exposure_per_city if args.job == "per-city" else O.exposure_per_country
        return run(df, args.day, partition_col="date" if args.date_is_local_day else None)
    if args.job == "top-days":
        return O.top_exposed_days(df, args.city, args.k)
    weather = typed(args.weather, "time_date string, location_name string, weather_wind_speed double, weather_precipitation double")
    return O.exposure_weather_corr(df, weather, args.city)


def main(argv: list[str] | None = None) -> dict:
    args = _parser().parse_args(argv)
    spark = build_session(app_name=f"airshed-{args.job}")
    from pyspark.sql import Observation
    from pyspark.sql import functions as F

    from airshed.plans import workflows as W
    from airshed.sinks import write_csv
    from airshed.sources import read_lookup
    if args.job == "partition":
        out = W.partition_by_date_job(spark, args.source, args.target, schema=args.schema,
                                      time_col=args.time_col,
                                      nanos_col=args.nanos_col, tz=args.tz, mode=args.mode,
                                      one_pass=args.one_pass)
    elif args.job == "land":
        from airshed.plans.landing import land_files
        mended = None if args.mended is None else spark.read.schema("file string, line string, mended string").json(args.mended)
        out = land_files(spark, args.source, args.target, args.quarantine, args.schema, args.file, mended,
                         time_col=args.time_col, nanos_col=args.nanos_col, tz=args.tz)
    elif args.job == "normalise":
        W.normalise_weather_file(spark, args.source, args.target, single_file=False)
        out = {"target": args.target}
    elif args.job == "lookup":
        responses = spark.read.schema("date_str string, response string").json(args.responses)
        W.publish_lookup(responses, args.target, args.name, not args.case_insensitive,
                         args.on_missing)
        out = {"target": args.target}
    elif args.job == "enrich":
        if len(args.source) != len(args.target):
            raise SystemExit("give one --target for each --source")
        W.enrich_datasets(spark, dict(zip(args.source, args.target)), read_lookup(spark, args.lookup),
                          mode=args.mode, write_mode=args.write_mode, days=args.day)
        out = {"target": args.target}
    elif args.job == "inventory":
        plan = W.inventory_remap(spark, args.root, args.src_prefix, args.dst_prefix)
        counted = Observation("plan")
        write_csv(plan.observe(counted, F.count(F.lit(1)).alias("planned")), args.target)
        out = dict(counted.get)
    elif args.job in ("per-city", "per-country", "top-days", "correlation"):
        write_csv(report(spark, args), args.target)
        out = {"target": args.target}
    elif args.job == "dates":
        write_csv(W.dates_to_request(spark, *args.root), args.target)
        out = {"target": args.target}
    elif args.job == "compact":
        from airshed.sinks import compact_ledger
        out = {"folded": compact_ledger(spark, args.ledger)}
    else:
        from airshed.operators.ledger import VALID_PREFIXES
        from airshed.streaming import ledger_stream
        q = ledger_stream(spark, args.source, args.ledger, args.checkpoint, args.dead_letters,
                          tuple(args.prefix or VALID_PREFIXES), args.on_poison)
        q.awaitTermination()
        out = {"ledger": args.ledger}
    print(json.dumps(out, default=str))
    return out


if __name__ == "__main__":
    main(sys.argv[1:])
