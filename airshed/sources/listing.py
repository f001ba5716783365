"""Object inventory below a prefix, without reading object bytes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airshed.functions import date_from_path


def hadoop_path(spark: SparkSession, path: str) -> tuple:
    """(file system, path, JVM) of Hadoop's API for a path."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def qualified(spark: SparkSession, path: str) -> str:
    """The fully qualified form Spark's file sources report (``file:/x``, ``s3a://b/x``)."""
    fs, p, _ = hadoop_path(spark, path)
    return fs.makeQualified(p).toString().rstrip("/")


def list_objects(spark: SparkSession, root: str, glob: str | None = None) -> DataFrame:
    """(path, key, length, modificationTime, date_str) for every file below ``root``.

    Uses the ``binaryFile`` source without its ``content`` column, so only
    file metadata is listed (the listing itself is distributed by Spark's
    file index).  ``key`` is ``<root folder name>/<path relative to root>``
    and ``date_str`` comes from a ``date=`` segment when present.  Hidden
    files (names starting with ``_`` or ``.``, e.g. commit markers and
    checksums) are skipped by Spark's file index.
    """
    r = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        r = r.option("pathGlobFilter", glob)
    return keyed_objects(spark, r.load(root).select("path", "length", "modificationTime"), root)


def keyed_objects(spark: SparkSession, df: DataFrame, root: str) -> DataFrame:
    """Add ``key`` and ``date_str`` to rows with the ``path`` of objects below ``root``."""
    base = qualified(spark, root)
    name = base.split("/")[-1]
    rel = F.substr(F.col("path"), F.lit(len(base) + 2))
    key = F.when(F.col("path").startswith(base + "/"), F.concat(F.lit(name + "/"), rel))
    return df.withColumn("key", key).withColumn("date_str", date_from_path(F.col("key")))
