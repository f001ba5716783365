"""Exposure kept up to date from signed changes, and correlations from stored moments.

The exposure sums run over DISTINCT rows, so a row that leaves only changes them if no equal
one stays.  ``MaintainedExposure`` therefore stores how often each distinct row is there, and signed
sums per day and city; a batch that takes rows away and adds others reads the counts of the days it
names, and writes its own changes.  Correlations come from co-moments per city and day,
which merge over any range of days.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airshed.functions import day_of, day_text
from airshed.operators.exposure import EXPOSURE_NAMES
from airshed.schemas import POLLUTION_MEASURES
from airshed.sources.listing import hadoop_path

MOST_DAYS = 1000  # days a batch may name in a pushed-down filter; above, all days are read


class MaintainedExposure:
    """Exposure per day and city below ``folder``, updated by batches of added and removed readings.

    A batch is two Parquet folders, ``counts/<id>/day=<day>/`` (distinct rows with signed counts) and
    ``sums/<id>/``; it counts once the second's ``_SUCCESS`` is there.  A batch that broke off is written
    anew, one that is there already is left alone, so batches may be sent again.  One writer at a time.
    """

    def __init__(self, spark: SparkSession, folder: str, measures: Sequence[str] = POLLUTION_MEASURES,
                 weight: str = "tourist_estimate", time_col: str = "time_date", city_col: str = "location_name"):
        self.spark, self.folder, self.measures, self.weight = spark, folder.rstrip("/"), list(measures), weight
        self.time_col, self.city_col = time_col, city_col
        self.key = ["day", "city", *self.measures, weight]
        doubles = [T.StructField(m, T.DoubleType()) for m in self.measures]
        self.counts_schema = T.StructType([T.StructField("city", T.StringType()), *doubles, T.StructField(weight, T.DoubleType()),
                                           T.StructField("n", T.LongType()), T.StructField("day", T.DateType())])
        self.sums_schema = T.StructType([
            T.StructField("day", T.DateType()), T.StructField("city", T.StringType()), T.StructField("rows", T.LongType()),
            *[f for m in self.measures for f in (T.StructField(m, T.DoubleType()), T.StructField(f"{m}_n", T.LongType()))]])

    def committed(self) -> list[str]:
        fs, path, jvm = hadoop_path(self.spark, f"{self.folder}/sums")
        if not fs.exists(path):
            return []
        whole = lambda s: fs.exists(jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS"))
        return sorted(s.getPath().getName() for s in fs.listStatus(path) if whole(s))

    def _counted(self, readings: DataFrame | None, sign: int) -> DataFrame | None:
        if readings is None:
            return None
        row = readings.select(day_of(day_text(self.time_col), strict=True).alias("day"), F.col(self.city_col).alias("city"),
                              *[F.col(c).cast("double").alias(c) for c in [*self.measures, self.weight]])
        return row.groupBy(*self.key).agg((F.lit(sign) * F.count(F.lit(1))).alias("d"))

    def _counts(self, days: DataFrame) -> list[DataFrame]:
        """Stored counts of the days a batch names."""
        ids = self.committed()
        if not ids:
            return []
        # one scan per batch folder; the filter on the days prunes their folders
        few = [r.day for r in days.limit(MOST_DAYS + 1).collect()]
        rows = reduce(DataFrame.unionByName, [self.spark.read.schema(self.counts_schema).parquet(f"{self.folder}/counts/{i}") for i in ids])
        if len(few) <= MOST_DAYS:
            known, null = [d for d in few if d is not None], any(d is None for d in few)
            rows = rows.filter(F.col("day").isin(known) | (F.lit(null) & F.col("day").isNull()))
        return [rows]

    def apply(self, batch_id: str, added: DataFrame | None = None, removed: DataFrame | None = None) -> bool:
        """Take in enriched readings that came and went; False if the batch was applied before.

        Taking away a reading that is not there is an error.
        """
        if batch_id in self.committed():
            return False
        signed = [d for d in (self._counted(added, 1), self._counted(removed, -1)) if d is not None]
        if not signed:
            raise ValueError("a batch needs added or removed readings")
        counts = f"{self.folder}/counts/{batch_id}"
        change = reduce(DataFrame.unionByName, signed).groupBy(*self.key).agg(F.sum("d").alias("n")).filter("n <> 0")
        change.write.mode("overwrite").partitionBy("day").parquet(counts)
        change = self.spark.read.schema(self.counts_schema).parquet(counts)
        old = self._counts(change.select("day").distinct())
        zero = F.lit(0).cast("long")
        both = reduce(DataFrame.unionByName, [change.select(*self.key, F.col("n").alias("d"), zero.alias("o")),
                                              *[o.select(*self.key, zero.alias("d"), F.col("n").alias("o")) for o in old]])
        now = both.groupBy(*self.key).agg(F.sum("d").alias("d"), F.sum("o").alias("o")).filter("d <> 0")
        left = F.when(F.col("o") + F.col("d") < 0, F.raise_error(F.lit("a reading is taken away that is not there"))) \
            .otherwise(F.col("o") + F.col("d"))
        # +1 where a distinct row appears, -1 where its last copy goes
        sign = (left > 0).cast("long") - (F.col("o") > 0).cast("long")
        value = lambda m: F.coalesce(F.col(m), F.lit(0.0)) * F.col(self.weight)
        sums = now.withColumn("_sign", sign).filter("_sign <> 0").groupBy("day", "city").agg(
            F.sum("_sign").alias("rows"),
            *[a for m in self.measures for a in (F.coalesce(F.sum(F.col("_sign") * value(m)), F.lit(0.0)).alias(m),
                                                 F.sum(F.when(value(m).isNotNull(), F.col("_sign")).otherwise(0)).alias(f"{m}_n"))])
        sums.write.mode("overwrite").parquet(f"{self.folder}/sums/{batch_id}")
        return True

    def per_city(self) -> DataFrame:
        """The exposure per day and city, as ``exposure_per_city`` computes it from all readings."""
        ids = self.committed()
        if not ids:
            return self.spark.createDataFrame([], self.sums_schema).select(
                "day", "city", *[F.col(m).alias(EXPOSURE_NAMES.get(m, m)) for m in self.measures])
        parts = self.spark.read.schema(self.sums_schema).parquet(*[f"{self.folder}/sums/{i}" for i in ids])
        total = parts.groupBy("day", "city").agg(F.sum("rows").alias("rows"), *[F.sum(c).alias(c) for m in self.measures for c in (m, f"{m}_n")])
        return total.filter("rows > 0").select("day", "city", *[F.when(F.col(f"{m}_n") > 0, F.col(m)).alias(EXPOSURE_NAMES.get(m, m))
                                                                for m in self.measures])


MOMENTS = ("n", "mean_x", "mean_y", "m2_x", "m2_y", "c_xy")


def co_moments(df: DataFrame, by: Sequence[str], x: str, y: str) -> DataFrame:
    """Count, means, centred squares and centred product of the complete pairs of each group."""
    both = F.col(x).isNotNull() & F.col(y).isNotNull()
    xs, ys = F.when(both, F.col(x)), F.when(both, F.col(y))
    n = F.count_if(both)
    return df.groupBy(*by).agg(n.alias("n"), F.avg(xs).alias("mean_x"), F.avg(ys).alias("mean_y"), (F.var_pop(xs) * n).alias("m2_x"),
                               (F.var_pop(ys) * n).alias("m2_y"), (F.covar_pop(xs, ys) * n).alias("c_xy")).filter("n > 0")


def merged_moments(moments: DataFrame, by: Sequence[str]) -> DataFrame:
    """The co-moments of larger groups, from those of their parts: one shuffle, about the merged means."""
    w = Window.partitionBy(*by)
    total = F.sum("n").over(w)
    at = moments.withColumns({"_x": F.sum(F.col("n") * F.col("mean_x")).over(w) / total, "_y": F.sum(F.col("n") * F.col("mean_y")).over(w) / total})
    dx, dy = F.col("mean_x") - F.col("_x"), F.col("mean_y") - F.col("_y")
    return at.groupBy(*by).agg(F.sum("n").alias("n"), F.first("_x").alias("mean_x"), F.first("_y").alias("mean_y"),
                               F.sum(F.col("m2_x") + F.col("n") * dx * dx).alias("m2_x"), F.sum(F.col("m2_y") + F.col("n") * dy * dy).alias("m2_y"),
                               F.sum(F.col("c_xy") + F.col("n") * dx * dy).alias("c_xy"))


def corr_of_moments() -> Column:
    """Pearson correlation of a row of moments, NULL where one side is constant."""
    return F.try_divide(F.col("c_xy"), F.sqrt(F.col("m2_x")) * F.sqrt(F.col("m2_y")))
