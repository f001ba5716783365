"""End-to-end jobs over files, each one lazy plan per output.

* ``normalise_weather_file``  raw weather CSV -> ``;`` CSV (ISO time, km/h)
* ``partition_by_date_job``   CSV files two levels below a root -> profile +
                              ``date=`` partitioned CSV
* ``publish_lookup``          estimate responses -> per-day lookup CSV
* ``enrich_partitioned``      ``date=`` partitioned CSV + lookup -> enriched,
                              ``date=`` partitioned CSV
* ``inventory_remap``         object listing below a root -> copy plan

``plans.landing`` lands raw files one by one, with a quarantine of rejected lines.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airshed.functions import date_text, day_of, nano_date
from airshed.operators import (
    all_dates, build_lookup, dates_from_keys, distinct_dates, enrich, normalise_readings, profile, remap_plan,
)
from airshed.operators.joins import bounded_broadcast, materialise
from airshed.sinks import write_by_date, write_csv, write_lookup
from airshed.sources import list_objects, read_partitioned, read_raw, with_source_file
from airshed.sources.files import misfit

TIME_FMT = "yyyy-MM-dd HH:mm:ss"


def normalise_weather_file(spark: SparkSession, src: str, dst: str, schema: T.StructType | None = None,
                           single_file: bool = False) -> DataFrame:
    """Weather CSV -> ``name;datetime_iso;temperature_c;wind_speed_kmh``.

    ``single_file`` (one task) is for extracts known to be small.
    """
    df = read_raw(spark, src, schema=schema, depth=0, infer=schema is None)
    out = normalise_readings(df)
    write_csv(out, dst, sep=";", single_file=single_file)
    return out


def with_event_date(df: DataFrame, time_col: str = "time_date", fmt: str = TIME_FMT,
                    nanos_col: str | None = None, tz: str = "UTC") -> DataFrame:
    """Add ``date``: parsed from the time text (NULL when unparsable), or
    from epoch nanoseconds in ``tz`` for sensor files."""
    if nanos_col:
        return df.withColumn("date", nano_date(nanos_col, tz))
    if isinstance(df.schema[time_col].dataType, (T.TimestampType, T.TimestampNTZType)):
        return df.withColumn("date", F.col(time_col).cast("date"))
    return df.withColumn("date", day_of(time_col, fmt))


def partition_by_date_job(spark: SparkSession, source_path: str, target_path: str,
                          schema: T.StructType | str | None = None, time_col: str = "time_date",
                          nanos_col: str | None = None, tz: str = "UTC",
                          mode: str = "append", one_pass: bool = True, rejected: str | None = None) -> dict:
    """Read ``<source>/*/*`` CSV, profile it, write it partitioned by ``date``.

    One pass over the input: the profile (see ``operators.profile``) is
    observed while writing; ``one_pass=False`` profiles first and writes then.
    ``file_count`` counts files that contributed rows.  With a ``schema`` the
    profile has ``bad_row_count`` too: lines with a value that does not fit
    are left out of the target and kept below ``rejected`` (beside the target
    unless named) as Parquet (file, line, reason); only if there are any are
    the files read once more for them.  ``land_files`` lands file by file and
    takes mended lines back.  Returns the profile as a dict.
    """
    bad = "_corrupt" if schema is not None else None
    df = read_raw(spark, source_path.rstrip("/"), schema=schema, depth=2, infer=schema is None, corrupt_col=bad)
    df = with_event_date(with_source_file(df), time_col, nanos_col=nanos_col, tz=tz)
    helpers = ["_input_file", *([bad] if bad else [])]
    good = df.filter(F.col(bad).isNull()) if bad else df
    if one_pass:
        obs = Observation("partition-profile")
        numbered, files = with_file_numbers(df)
        metrics = [F.count(F.lit(1)).alias("row_count"), *seen_files(files), F.count_if(F.col("date").isNull()).alias("null_date_count")]
        if bad:
            metrics.append(F.count_if(F.col(bad).isNotNull()).alias("bad_row_count"))
        seen = numbered.observe(obs, *metrics)
        write_by_date((seen.filter(F.col(bad).isNull()) if bad else seen).drop(*helpers, FILE_NUMBER), target_path.rstrip("/"), mode=mode)
        found = dict(obs.get)
        count = sum(bin(int.from_bytes(found.pop(c) or b"")).count("1") for c in [c for c in found if c.startswith(FILE_NUMBER)])
        stats = {"row_count": found.pop("row_count"), "file_count": count, **found}
    else:
        stats = profile(df, corrupt_col=bad).first().asDict()
        write_by_date(good.drop(*helpers), target_path.rstrip("/"), mode=mode)
    if stats.get("bad_row_count"):
        declared = T.StructType([f for f in df.schema.fields if f.name not in ("date", *helpers)])
        lines = df.filter(F.col(bad).isNotNull()).select(F.col("_input_file").alias("file"), F.col(bad).alias("line"),
                                                         misfit(declared, bad).alias("reason"))
        lines.write.mode("append" if mode == "append" else "overwrite").parquet(rejected or target_path.rstrip("/") + "-rejected")
    return stats


FILE_NUMBER = "_file_number"
BITMAP = 32_768  # bits of one bitmap_construct_agg buffer


def with_file_numbers(df: DataFrame) -> tuple[DataFrame, int]:
    """``df`` with the number of each row's ``_input_file`` among the files of its plan, and how many these are.

    The names are those of Spark's own file index, sent once as a checked broadcast.
    """
    names = df.inputFiles()
    short = lambda c: F.regexp_replace(c, "^([^:/]+):/+", "$1:/")  # noqa: E731  file:///x and file:/x are one
    numbers = df.sparkSession.createDataFrame([(n, i) for i, n in enumerate(sorted(names))], f"name string, {FILE_NUMBER} bigint")
    side, _ = bounded_broadcast(numbers.select(short("name").alias("_name"), FILE_NUMBER), materialise_side=False)
    return df.join(side, short("_input_file") == F.col("_name"), "left").drop("_name"), len(names)


def seen_files(files: int) -> list[Column]:
    """Aggregates whose set bits are the file numbers met: 4 KB for 32,768 files, no set of names."""
    n = F.col(FILE_NUMBER)
    return [F.bitmap_construct_agg(F.when((n >= lo) & (n < lo + BITMAP), n - lo)).alias(f"{FILE_NUMBER}_{lo}")
            for lo in range(0, max(files, 1), BITMAP)]


def publish_lookup(responses: DataFrame, path: str, names: Sequence[str],
                   case_sensitive: bool = True, on_missing: str = "null") -> DataFrame:
    """Build the per-day lookup from responses and publish it as one sorted CSV."""
    lookup = build_lookup(responses, names, case_sensitive, on_missing)
    write_lookup(lookup, path)
    return lookup


def enrich_partitioned(spark: SparkSession, src: str, lookup: DataFrame, dst: str,
                       mode: str = "left", write_mode: str | None = None,
                       schema: T.StructType | None = None,
                       days: Sequence[str] | None = None) -> DataFrame:
    """Attach ``tourist_estimate`` to a ``date=`` partitioned CSV dataset.

    ``date_str`` comes from the partition value; ``write_mode="dynamic"``
    replaces only the dates present in the input.  ``days`` restricts the
    run to those partitions (pruned at listing time) and is an incremental
    run that reads and rewrites only these dates: ``dynamic`` is its default,
    and ``overwrite``, which would erase all other days, is refused.
    Without ``days`` the default is ``overwrite``.
    """
    if days is not None and write_mode == "overwrite":
        raise ValueError("days= with write_mode='overwrite' would erase the other days; use 'dynamic'")
    write_mode = write_mode or ("overwrite" if days is None else "dynamic")
    df = read_partitioned(spark, src, schema)
    if days is not None:
        df = df.filter(F.col("date").isin([F.lit(d).cast("date") for d in days]))
    df = df.withColumn("date_str", date_text("date"))
    dates = df.select("date", "date_str").distinct()  # partition values only
    out = enrich(df, lookup, on="date_str", mode=mode, keys=dates)
    write_by_date(out, dst, mode=write_mode, rebalance=False)  # the input is laid out by date already
    return out


def enrich_datasets(spark: SparkSession, datasets: dict[str, str], lookup: DataFrame, mode: str = "strict",
                    schemas: dict[str, T.StructType | str] | None = None, **options) -> None:
    """``enrich_partitioned`` for several datasets ({source: target}) with one lookup.

    In strict mode the dates of all of them are checked first, so nothing is written if a date of any has
    no estimate.
    """
    schemas = schemas or {}
    lookup, _ = materialise(lookup.select("date_str", "tourist_estimate"), "lookup")
    if mode == "strict":
        days = options.get("days")
        wanted = lambda df: df if days is None else df.filter(F.col("date").isin([F.lit(d).cast("date") for d in days]))
        dates = all_dates(*[wanted(read_partitioned(spark, src, schemas.get(src)).select("date")).distinct() for src in datasets])
        named = dates.select(date_text("date").alias("date_str"))
        enrich(named, lookup, mode="strict")
    for src, dst in datasets.items():
        enrich_partitioned(spark, src, lookup, dst, mode="left", schema=schemas.get(src), **options)


def inventory_remap(spark: SparkSession, root: str, src_prefix: str, dst_prefix: str) -> DataFrame:
    """Copy plan (key, dest_key, file_name) for the files below ``root``."""
    return remap_plan(list_objects(spark, root), src_prefix, dst_prefix)


def dates_to_request(spark: SparkSession, *roots: str) -> DataFrame:
    """Sorted dates named by the ``date=`` folders of several datasets: one estimate request each."""
    keys = [dates_from_keys(list_objects(spark, r)) for r in roots]
    return distinct_dates(*keys, col="date_str", ordered=True)
