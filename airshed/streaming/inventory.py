"""Incremental object listing.

``readStream`` on a folder of objects keeps the names it has seen in its checkpoint, so a run passes
on only the objects that landed since the last one.  They are appended to an inventory table (Parquet,
each micro-batch exactly once by the sink's own log), which later runs read instead of listing again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from airshed.sources.listing import keyed_objects

# The columns of Spark's binaryFile source.
_BINARY = "path string, modificationTime timestamp, length bigint, content binary"


def inventory_stream(spark: SparkSession, root: str, table: str, checkpoint: str, glob: str | None = None,
                     available_now: bool = True, max_files_per_trigger: int = 100_000):
    """Start the listing of ``root`` into the inventory ``table``; with ``available_now`` it stops when all is listed."""
    r = (spark.readStream.format("binaryFile").schema(_BINARY).option("recursiveFileLookup", True)
         .option("maxFilesPerTrigger", max_files_per_trigger))
    if glob:
        r = r.option("pathGlobFilter", glob)
    rows = keyed_objects(spark, r.load(root).select("path", "length", "modificationTime"), root)
    w = rows.writeStream.format("parquet").option("path", table).option("checkpointLocation", checkpoint).outputMode("append")
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def read_inventory(spark: SparkSession, table: str) -> DataFrame:
    """(path, length, modificationTime, key, date_str) of every object listed so far."""
    return spark.read.schema("path string, length bigint, modificationTime timestamp, key string, date_str string").parquet(table)
