"""Physical layout for repeated reports: bucketed tables for co-located joins.

At 100 TB the all-city reports shuffle events and customers on the
customer key every time they run.  Written once as tables bucketed (and
sorted) on that key with the same bucket count, both sides are already
co-partitioned: the sort-merge join then runs without any exchange, and a
hot key is confined to its bucket files.  The tables are external (their
files live at the given path, by default below the shared checkpoint
folder) and registered in the session catalog.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from airshed.session import scratch_path


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int,
                   path: str | None = None) -> DataFrame:
    """Write ``df`` as ``table`` bucketed and sorted by ``key``; return the table."""
    spark = df.sparkSession
    path = path or scratch_path(spark, f"bucketed-{table}")
    (df.write.mode("overwrite").bucketBy(buckets, key).sortBy(key)
       .option("path", path).saveAsTable(table))
    return spark.table(table)
