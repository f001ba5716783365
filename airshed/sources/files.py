"""CSV scans (header, comma, quoted fields) and local-row lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airshed.schemas import LOOKUP, RENAMES


def ddl_of(schema: T.StructType) -> str:
    """DDL text of a flat schema."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def misfit(schema: T.StructType, line_col: str) -> Column:
    """Why a kept line did not fit: the first column whose text is no value of its type, or the field count."""
    texts = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    t = F.from_csv(line_col, ddl_of(texts), {"mode": "PERMISSIVE"})
    wrong = [F.when(F.col(f"`{f.name}`").isNull() & t[f.name].isNotNull(), F.lit(f"{f.name}: no {f.dataType.simpleString()}"))
             for f in schema.fields if not isinstance(f.dataType, T.StringType)]
    return F.coalesce(*wrong, F.lit("wrong number of fields"))


def read_raw(spark: SparkSession, base: str | list[str], schema: T.StructType | str | None = None,
             depth: int = 2, infer: bool = False, encoding: str = "UTF-8",
             corrupt_col: str | None = None) -> DataFrame:
    """Header CSV files ``depth`` folders below ``base`` (``depth=0``: ``base`` is the file/glob; a list
    names the files).

    An explicit schema is the default path; ``infer=True`` costs an extra pass
    over the data and types ``time_date`` as timestamp.  With a schema every
    file's header must name its columns in this order, or reading fails; so
    does a value that does not fit its type, unless ``corrupt_col`` names a
    column to keep the whole line of such a row (the value is then NULL).
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    path = base.rstrip("/") + "/*" * depth if depth and isinstance(base, str) else base
    r = (spark.read.option("header", True).option("multiLine", False)
         .option("encoding", encoding).option("mode", "PERMISSIVE" if corrupt_col or schema is None else "FAILFAST"))
    if schema is not None:
        r = r.option("enforceSchema", False)
        if corrupt_col:
            schema = T.StructType([*schema.fields, T.StructField(corrupt_col, T.StringType())])
            r = r.option("columnNameOfCorruptRecord", corrupt_col)
        r = r.schema(schema)
    elif infer:
        r = r.option("inferSchema", True)
    df = r.csv(path)
    if schema is None or not corrupt_col:
        return df
    # The scan checks only the columns it is asked for: no characters of all of them, added to the
    # line, keep every column in the plan wherever the line is used.
    nothing = F.substring(F.concat_ws("", *[F.col(f"`{c}`").cast("string") for c in df.columns if c != corrupt_col]), 1, 0)
    return df.withColumn(corrupt_col, F.concat(F.col(f"`{corrupt_col}`"), nothing))


def read_partitioned(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
                     encoding: str = "UTF-8") -> DataFrame:
    """Header CSV below a ``date=YYYY-MM-DD/`` layout; ``date`` comes back from the folder names.

    Without a schema every data column is text; with one, headers must match
    it and a value that does not fit its type is an error.  Filters on
    ``date`` prune whole folders (PartitionFilters).
    """
    r = spark.read.option("header", True).option("encoding", encoding).option("enforceSchema", False)
    if schema is not None:
        r = r.option("mode", "FAILFAST").schema(schema)
    return r.csv(path)


def read_lookup(spark: SparkSession, path: str) -> DataFrame:
    """Per-day visitor lookup CSV (``date_str,tourist_estimate``); another header, or an estimate that is
    no whole number, is an error."""
    return (spark.read.option("header", True).option("enforceSchema", False).option("mode", "FAILFAST")
            .schema(LOOKUP).csv(path))


def lookup_from_rows(spark: SparkSession, rows) -> DataFrame:
    """Small lookup from driver rows ``[(date_str, estimate_or_None), ...]``."""
    return spark.createDataFrame(list(rows), LOOKUP)


def with_source_file(df: DataFrame, name: str = "_input_file") -> DataFrame:
    """Add the path of the file each row was read from (file-source metadata column)."""
    return df.withColumn(name, F.col("_metadata.file_path"))


def standardise_columns(df: DataFrame) -> DataFrame:
    """Apply the raw-header rename map (``weather_windSpeed`` -> ``weather_wind_speed``)."""
    present = {k: v for k, v in RENAMES.items() if k in df.columns}
    return df.withColumnsRenamed(present) if present else df
