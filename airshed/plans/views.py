"""SQL access: expose enriched datasets as temp views for ``spark.sql``.

Users who query the enriched tables with SQL keep doing so: the functions
used by such reports (``date``, ``substr``, ``split``/``element_at``,
``TRIM``, ``COALESCE``, ``corr``) are Spark SQL built-ins, and the optimizer
plans SQL and DataFrame code the same way.  Pass the table names the
queries use.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from airshed.sources.listing import qualified


def register_dataset(spark: SparkSession, name: str, path: str, schema: str, replace: bool = False) -> DataFrame:
    """A catalog table over a ``date=`` partitioned CSV dataset, for ``FROM name`` in SQL.

    ``schema`` is the DDL of the data columns.  The table is external: dropping
    it leaves the files.  Call again after dates have been written or removed: the
    catalog follows the folders.  A table of that name over another folder, or
    with other columns, is an error unless ``replace`` is set.
    """
    if spark.catalog.tableExists(name):
        wanted = T.StructType([*T.StructType.fromDDL(schema).fields, T.StructField("date", T.DateType())])
        place = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Location'").first()
        here, there = qualified(spark, path), qualified(spark, place.data_type) if place else None
        have = [(f.name, f.dataType) for f in spark.table(name).schema.fields]
        if here != there or have != [(f.name, f.dataType) for f in wanted.fields]:
            if not replace:
                raise ValueError(f"table {name} exists over {there} with columns {have}; not over {here}")
            spark.sql(f"DROP TABLE {name}")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({schema}, date DATE) USING csv "
              f"OPTIONS (header 'true', enforceSchema 'false', mode 'FAILFAST') PARTITIONED BY (date) LOCATION '{path}'")
    spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")
    return spark.table(name)


def register_day(spark: SparkSession, name: str, day: str) -> None:
    """Make one newly written day of a registered dataset visible, without a scan of all its folders."""
    spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS PARTITION (date = DATE'{day}')")
    spark.catalog.refreshTable(name)


def drop_day(spark: SparkSession, name: str, day: str) -> None:
    """Hide one day of a registered dataset; its files stay."""
    spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION (date = DATE'{day}')")
    spark.catalog.refreshTable(name)


def register_views(spark: SparkSession, **views: DataFrame) -> list[str]:
    """``register_views(spark, pollution_enriched=df1, weather_enriched=df2)``."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return sorted(views)
