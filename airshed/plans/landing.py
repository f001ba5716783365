"""Landing raw files: accepted rows by date and file, rejected lines in quarantine.

``land_files`` reads raw CSV files once and writes two datasets:

* the target, CSV below ``date=<day>/file=<relative path>/``: the rows whose every value fits the
  declared schema and whose time is a date (or missing, which is a NULL date);
* the quarantine, Parquet below ``file=<relative path>/``: each rejected line as it was read, with the
  reason and how many times the file holds it, and one row with the accepted rows of the file.

A file is the unit of both: whoever lands a file again (sent anew, or with lines mended by hand) replaces
what it left before and nothing else, so a job that broke off is simply run again.  The quarantine is
written last; a file is landed when its row of accepted lines is there.  Read = accepted + rejected for
every file, and no value becomes NULL unseen.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airshed.functions import date_text, day_of, nano_date
from airshed.operators.joins import enrich
from airshed.sources.files import ddl_of, misfit, read_raw, with_source_file
from airshed.sources.listing import hadoop_path, qualified

TIME_FMT = "yyyy-MM-dd HH:mm:ss"
QUARANTINE = "file string, line string, reason string, copies bigint, load_id string"
_BAD = "_corrupt"


def relative_to(spark: SparkSession, base: str, path="_input_file") -> Column:
    """A file's path below ``base``; the path as Spark reports it, with escapes."""
    root = re.sub("^[^:/]+:/+", "", qualified(spark, base))
    plain = F.url_decode(F.replace(F.col(path), F.lit("+"), F.lit("%2B")))
    return F.substr(F.regexp_replace(plain, "^[^:/]+:/+", ""), F.lit(len(root) + 2))


def _dated(df: DataFrame, time_col: str, fmt: str, nanos_col: str | None, tz: str) -> DataFrame:
    return df.withColumn("date", nano_date(nanos_col, tz) if nanos_col else day_of(time_col, fmt))


def _judged(df: DataFrame, schema: T.StructType, time_col: str) -> DataFrame:
    """Add ``line`` and ``reason``, NULL for accepted rows."""
    names = [f.name for f in schema.fields]
    undated = F.col(time_col).isNotNull() & F.col("date").isNull()
    written = F.to_csv(F.struct(*[F.col(f"`{n}`") for n in names]))
    return df.withColumns({
        "line": F.coalesce(F.col(_BAD), F.when(undated, written)),
        "reason": F.when(F.col(_BAD).isNotNull(), misfit(schema, _BAD)).when(undated, F.lit(f"{time_col}: no date"))}).drop(_BAD)


def _mended(rejected: DataFrame, mended: DataFrame, schema: T.StructType, judge) -> DataFrame:
    """Rejected rows anew: where ``mended`` (file, line, mended) has another text for a line, that text."""
    texts = mended.groupBy("file", "line").agg(F.max("mended").alias("_mended"))
    parsed = F.from_csv("_mended", ddl_of(T.StructType([*schema.fields, T.StructField(_BAD, T.StringType())])),
                        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD})
    found = rejected.select("file", "line", "reason").join(texts, ["file", "line"], "left") \
        .withColumn("_row", F.when(F.col("_mended").isNotNull(), parsed))
    again = judge(found.filter(F.col("_mended").isNotNull()).select(
        "file", "_mended", *[F.col(f"_row.`{f.name}`").alias(f.name) for f in schema.fields], F.col(f"_row.{_BAD}").alias(_BAD)))
    again = again.withColumn("line", F.when(F.col("reason").isNotNull(), F.col("_mended"))).drop("_mended")
    left = found.filter(F.col("_mended").isNull()).select("file", "line", "reason")
    return again.unionByName(left, allowMissingColumns=True)


def land_files(spark: SparkSession, source: str, target: str, quarantine: str, schema: T.StructType | str,
               files: Sequence[str] | None = None, mended: DataFrame | None = None, depth: int = 2,
               time_col: str = "time_date", fmt: str = TIME_FMT, nanos_col: str | None = None, tz: str = "UTC") -> dict:
    """Land the CSV files ``depth`` folders below ``source`` (or ``files``, paths below it).

    ``mended`` (file, line, mended) gives rejected lines a new text, by the line as the quarantine holds
    it; with it only the files it names are landed again.  A line that is still wrong stays in quarantine
    under its new text.  Returns the counts files, read, accepted and rejected of this load.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    source, target, quarantine = (p.rstrip("/") for p in (source, target, quarantine))
    if mended is not None and files is None:
        # the files are the job's input: Spark's file index holds their names on the driver anyway
        files = [r.file for r in mended.select("file").distinct().collect()]
    paths = None if files is None else [f"{source}/{f}" for f in files]
    if paths == []:
        return {"files": 0, "read": 0, "accepted": 0, "rejected": 0}
    raw = with_source_file(read_raw(spark, paths or source, schema, depth=depth, corrupt_col=_BAD))
    raw = raw.withColumn("file", relative_to(spark, source)).drop("_input_file")

    def judge(df: DataFrame) -> DataFrame:
        return _judged(_dated(df, time_col, fmt, nanos_col, tz), schema, nanos_col or time_col)

    rows = judge(raw)
    load = uuid.uuid4().hex
    # one read of the raw files for both datasets (lost blocks are read again)
    rows = rows.persist(StorageLevel.DISK_ONLY)
    try:
        if mended is not None:
            rejected = rows.filter(F.col("reason").isNotNull())
            out = rows.filter(F.col("reason").isNull()).unionByName(_mended(rejected, mended, schema, judge))
        else:
            out = rows
        accepted = out.filter(F.col("reason").isNull()).drop("line", "reason")
        left_over = _earlier_folders(spark, target, quarantine, out.select("file").distinct())
        _write_rows(accepted, target)
        if left_over is not None:  # days that a file landed before held and no longer holds
            now = accepted.select("date", "file").distinct().withColumn("date", F.coalesce(F.col("date").cast("string"), F.lit(NO_DATE)))
            _drop_folders(spark, left_over.join(now, ["date", "file"], "left_anti"))
        log = out.groupBy("file", "line", "reason").agg(F.count(F.lit(1)).alias("copies")).withColumn("load_id", F.lit(load))
        (log.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("file").parquet(quarantine))
    finally:
        rows.unpersist()
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    good = F.col("line").isNull() & F.col("reason").isNull()
    return spark.read.schema(QUARANTINE).parquet(quarantine).filter(F.col("load_id") == load).agg(
        F.count_distinct("file").alias("files"), total("copies").alias("read"),
        total(F.when(good, F.col("copies"))).alias("accepted"), total(F.when(~good, F.col("copies"))).alias("rejected")).first().asDict()


NO_DATE = "__HIVE_DEFAULT_PARTITION__"


def _earlier_folders(spark: SparkSession, target: str, quarantine: str, files: DataFrame) -> DataFrame | None:
    """(date, file, folder) of what ``files`` left in the target before; None if none of them was landed before."""
    fs, path, _ = hadoop_path(spark, quarantine)
    if not fs.exists(path) or spark.read.schema(QUARANTINE).parquet(quarantine).join(files, "file", "left_semi").isEmpty():
        return None
    # the folder names as Spark wrote them; a file's path is escaped there as it is here
    level = lambda name: F.regexp_extract("folder", f"{name}=([^/]*)", 1)
    fs, path, jvm = hadoop_path(spark, f"{target}/date=*/file=*")
    # Hadoop's listing of folders, not of rows; one name per day and file of the target
    names = [(s.getPath().toString(),) for s in fs.globStatus(path) or []]
    folders = spark.createDataFrame(names, "folder string")
    there = folders.select(level("date").alias("date"), F.url_decode(F.replace(level("file"), F.lit("+"), F.lit("%2B"))).alias("file"), "folder")
    return there.join(files, "file", "left_semi")


def _drop_folders(spark: SparkSession, folders: DataFrame) -> None:
    for row in folders.select("folder").toLocalIterator():
        fs, path, _ = hadoop_path(spark, row.folder)
        fs.delete(path, True)


def _write_rows(rows: DataFrame, target: str, fmt: str = "csv") -> None:
    """Replace the (date, file) folders that ``rows`` names; a hot one is split over several tasks."""
    (rows.hint("rebalance", "date", "file").write.format(fmt).option("header", True).mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").partitionBy("date", "file").save(target))


def quarantined(spark: SparkSession, quarantine: str) -> DataFrame:
    """(file, line, reason, copies): the rejected lines."""
    return spark.read.schema(QUARANTINE).parquet(quarantine).filter("reason is not null").select("file", "line", "reason", "copies")


def landed_files(spark: SparkSession, quarantine: str) -> DataFrame:
    """(file, accepted, rejected) of every file landed."""
    log = spark.read.schema(QUARANTINE).parquet(quarantine)
    count = lambda c: F.coalesce(F.sum(F.when(c, F.col("copies"))), F.lit(0))
    return log.groupBy("file").agg(count(F.col("reason").isNull()).alias("accepted"), count(F.col("reason").isNotNull()).alias("rejected"))


def read_landed(spark: SparkSession, target: str, schema: T.StructType | str) -> DataFrame:
    """The accepted rows with ``date`` and ``file``; filters on either prune folders."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    full = T.StructType([*schema.fields, T.StructField("date", T.DateType()), T.StructField("file", T.StringType())])
    return spark.read.option("header", True).option("enforceSchema", False).option("mode", "FAILFAST").schema(full).csv(target)


def enrich_files(spark: SparkSession, src: str, lookup: DataFrame, dst: str, schema: T.StructType | str | None = None,
                 files: Sequence[str] | None = None, mode: str = "left") -> None:
    """Attach ``tourist_estimate`` file by file: ``src/date=<day>/<name>`` -> ``dst/date=<day>/file=<name>/``.

    A file keeps its identity, so landing it again (``files``: paths below ``src``) replaces its own rows and
    leaves the day's other files alone.  A value that does not fit ``schema`` is an error.
    """
    src = src.rstrip("/")
    r = spark.read.option("header", True).option("basePath", src)
    if schema is not None:
        r = r.option("enforceSchema", False).option("mode", "FAILFAST").schema(
            T.StructType.fromDDL(schema) if isinstance(schema, str) else schema)
    paths = [src] if files is None else [f"{src}/{f}" for f in files]
    df = with_source_file(r.csv(paths)).withColumn("file", F.element_at(F.split("_input_file", "/"), -1)).drop("_input_file")
    df = df.withColumn("date", F.col("date").cast("date")).withColumn("date_str", date_text("date"))
    out = enrich(df, lookup, on="date_str", mode=mode, keys=df.select("date_str").distinct())
    _write_rows(out, dst)
