"""File sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_by_date(df: DataFrame, path: str, mode: str = "append", partition_col: str = "date",
                  fmt: str = "csv", header: bool = True, max_records_per_file: int = 5_000_000,
                  rebalance: bool = True) -> None:
    """Hive-style ``date=YYYY-MM-DD/`` layout.

    ``mode``: ``append`` (adds files), ``overwrite`` (replaces the whole
    target), ``dynamic`` (replaces only the dates present in ``df``).
    Rows are rebalanced on the partition column first: AQE keeps one task per
    date where dates are small and splits a hot date over several tasks
    instead of writing it from one, and ``maxRecordsPerFile`` caps file size.
    ``rebalance=False`` skips that shuffle, for rows that come laid out by date.
    A NULL date lands in ``date=__HIVE_DEFAULT_PARTITION__`` and reads back NULL.
    """
    if mode not in ("append", "overwrite", "dynamic"):
        raise ValueError(f"unknown mode {mode!r}")
    w = ((df.hint("rebalance", partition_col) if rebalance else df).write.format(fmt)
         .option("maxRecordsPerFile", max_records_per_file).partitionBy(partition_col))
    if fmt == "csv":
        w = w.option("header", header)
    if mode == "dynamic":
        w = w.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    else:
        w = w.mode(mode).option("partitionOverwriteMode", "static")
    w.save(path)


def write_csv(df: DataFrame, path: str, sep: str = ",", header: bool = True,
              single_file: bool = False, mode: str = "overwrite") -> None:
    """Plain CSV folder; ``single_file`` only for results known to be small."""
    out = df.coalesce(1) if single_file else df
    out.write.mode(mode).option("sep", sep).option("header", header).csv(path)


def write_lookup(lookup: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Publish the per-day lookup as one CSV sorted by date.

    The lookup has one row per date, so a single output file is bounded.
    """
    (lookup.orderBy(F.asc_nulls_last("date_str")).coalesce(1)
        .write.mode(mode).option("header", True).csv(path))
