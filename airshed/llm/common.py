"""Helpers shared by the corpus operators: table access and stored intermediates.

Words by the rule ``[^\\x20\\x09-\\x0D]+`` are taken by ``bytes.split()``, which cuts at the same six bytes.

``stored`` cuts lineage with a Parquet table below ``spark.checkpoint.dir`` (a folder that the
driver and every executor share), so the loss of an executor costs one re-read, never a recompute
from the texts.
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airshed.session import scratch_path

LONG_MAX = (1 << 63) - 1


def ship_by_value(module: str) -> None:
    """Pickle a module's functions by value, so executors run them without this package installed."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


ship_by_value(__name__)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet below the shared checkpoint folder and re-read it."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unused(df: DataFrame, *names: str) -> list[str]:
    """Column names like ``names`` that ``df`` does not have (Spark ignores case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def utf8(col: str) -> Column:
    """A text column as its UTF-8 bytes, null as empty."""
    return F.coalesce(F.col(col).cast("binary"), F.lit(b"").cast("binary"))
