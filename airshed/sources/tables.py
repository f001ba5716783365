"""Parquet tables of a scale-factor folder.

The tables this library reads have declared schemas, so opening one costs
no footer-reading job and a changed file fails loudly instead of silently
changing types.  Other tables fall back to Parquet schema inference.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Schemas of the driver tables the queries read.
TABLE_SCHEMAS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, "
                "c_mktsegment STRING",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
              "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, "
              "value DOUBLE, props STRING",
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
    "pages": "page_id BIGINT, url STRING, html STRING",
    "labels": "doc_id BIGINT, quality INT, toxic INT",
}


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """``<root>/<name>.parquet``; column pruning and filters reach the scan."""
    r = spark.read
    if name in TABLE_SCHEMAS:
        r = r.schema(TABLE_SCHEMAS[name])
    return r.parquet(f"{root.rstrip('/')}/{name}.parquet")
