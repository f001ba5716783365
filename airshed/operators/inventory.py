"""Object inventory: folder markers and prefix remapping plans."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airshed.functions import date_from_path, file_name, graft, remap_prefix


def drop_markers(df: DataFrame, key_col: str = "key", mode: str = "all_markers",
                 prefix: str | None = None) -> DataFrame:
    """Remove folder-like keys.

    ``all_markers``: every key ending in ``/`` (or equal to the bare prefix).
    ``root_only``: only the key that *is* the prefix and ends in ``/``.
    """
    k = F.col(key_col)
    if mode == "all_markers":
        cond = k.endswith("/")
        if prefix is not None:
            cond = cond | (k == F.lit(prefix.rstrip("/")))
        return df.filter(~cond)
    if mode == "root_only":
        if prefix is None:
            raise ValueError("root_only needs the prefix")
        return df.filter(~(k.endswith("/") & (k == F.lit(prefix))))
    raise ValueError(f"unknown mode {mode!r}")


def remap_plan(objects: DataFrame, src_prefix: str, dst_prefix: str,
               key_col: str = "key") -> DataFrame:
    """(key, dest_key, file_name) for each object below ``src_prefix``.

    Keys outside the prefix are not listed; the root marker is skipped; the
    destination keeps the relative path.  The plan's row count is the number
    of objects to copy.
    """
    k = F.col(key_col)
    below = drop_markers(objects.filter(k.startswith(src_prefix)), key_col, "root_only", src_prefix)
    return below.select(k.alias("key"), remap_prefix(k, src_prefix, dst_prefix).alias("dest_key"),
                        file_name(k).alias("file_name"))


def copy_count(objects: DataFrame, src_prefix: str, dst_prefix: str, key_col: str = "key") -> DataFrame:
    """One row: how many objects a remap copies, and the message a copy job reports."""
    n = remap_plan(objects, src_prefix, dst_prefix, key_col).agg(F.count(F.lit(1)).alias("copied"))
    return n.select("copied", F.concat(F.lit("Copied "), F.col("copied").cast("string"), F.lit(" objects")).alias("message"))


def graft_plan(objects: DataFrame, dst_prefix: str, key_col: str = "key") -> DataFrame:
    """(key, dest_key): same relative path below ``dst_prefix`` after the first segment."""
    k = F.col(key_col)
    return objects.select(k.alias("key"), graft(k, dst_prefix).alias("dest_key"))


def dates_from_keys(objects: DataFrame, key_col: str = "key", prefix: str | None = None,
                    strict: bool = True) -> DataFrame:
    """Distinct ``yyyy-MM-dd`` dates named by ``date=`` segments of object keys.

    Folder markers are skipped first.  ``strict``: a key without a date
    segment is an error, checked eagerly (one bounded lookup); otherwise such
    keys are ignored.  The result is what needs one estimate request per date.
    """
    keys = drop_markers(objects, key_col, "all_markers", prefix)
    dated = keys.select(F.col(key_col), date_from_path(F.col(key_col)).alias("date_str"))
    if strict:
        bad = dated.filter(F.col("date_str").isNull()).agg(F.count(F.lit(1)).alias("n"), F.min(key_col).alias("k")).first()
        if bad.n:
            raise ValueError(f"{bad.n} object key(s) name no date= folder, the first is {bad.k}")
    return dated.filter(F.col("date_str").isNotNull()).select("date_str").distinct()
