"""Visitor-weighted exposure: DISTINCT base, per-city / per-country sums, top days.

Semantics kept on purpose:
* the DISTINCT runs over (day, city, the listed measures, weight): two
  different hours with equal readings collapse, and the key set is part of
  the answer, so callers pass it explicitly;
* only the measure is coalesced to 0, the weight is not (a NULL weight makes
  the product NULL and SUM skips it; an all-NULL group sums to NULL);
* the country value is SUM / COUNT(DISTINCT city), not an average.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airshed.functions import country_of, day_of, day_text
from airshed.schemas import POLLUTION_MEASURES

# Output column per measure.
EXPOSURE_NAMES = {
    "measurement_pm10Atmo": "pollution_total_visitor_pm10",
    "measurement_pm25Atmo": "pollution_total_visitor_pm25",
    "measurement_pm100Atmo": "pollution_total_visitor_pm100",
}
COUNTRY_NAMES = {
    "measurement_pm10Atmo": "pollution_total_visitor_country_pm10",
    "measurement_pm25Atmo": "pollution_total_visitor_country_pm25",
    "measurement_pm100Atmo": "pollution_total_visitor_country_pm100",
}


def dedup_readings(enriched: DataFrame, measures: Sequence[str] = POLLUTION_MEASURES,
                   weight: str = "tourist_estimate", time_col: str = "time_date",
                   city_col: str = "location_name") -> DataFrame:
    """``SELECT DISTINCT date(substr(time,1,10)) day, city, <measures>, weight``."""
    day = day_of(day_text(time_col), strict=True)
    return enriched.select(day.alias("day"), F.col(city_col).alias("city"),
                           *[F.col(m) for m in measures], F.col(weight)).distinct()


def distinct_rows_by_key_set(enriched: DataFrame, key_sets: dict[str, Sequence[str]],
                             weight: str = "tourist_estimate", time_col: str = "time_date",
                             city_col: str = "location_name") -> DataFrame:
    """(key_set, distinct_rows): size of the reading DISTINCT under several measure sets.

    One scan and one shuffle for all sets (GROUPING SETS + ``grouping_id``)
    instead of one DISTINCT job per set; shows how much the key choice
    collapses.
    """
    measures = list(dict.fromkeys(m for ms in key_sets.values() for m in ms))
    day = day_of(day_text(time_col), strict=True).alias("day")
    base = enriched.select(day, F.col(city_col).alias("city"), *measures, weight)
    cols = ["day", "city", *measures, weight]
    sets = {name: ["day", "city", *ms, weight] for name, ms in key_sets.items()}
    # grouping_id: one bit per column (first column = most significant), set when not grouped
    gid = {sum(1 << (len(cols) - 1 - i) for i, c in enumerate(cols) if c not in keys): name
           for name, keys in sets.items()}
    grouped = base.groupingSets([tuple(k) for k in sets.values()], *cols) \
        .agg(F.grouping_id().alias("_gid"))
    names = F.create_map(*[x for g, n in gid.items() for x in (F.lit(g), F.lit(n))])
    return grouped.groupBy("_gid").agg(F.count(F.lit(1)).alias("distinct_rows")) \
        .select(names[F.col("_gid")].alias("key_set"), "distinct_rows")


def weighted_exposure(base: DataFrame, measures: Sequence[str], weight: str = "tourist_estimate",
                      keys: Sequence[str] = ("day", "city"), names: dict | None = None) -> DataFrame:
    """``SUM(COALESCE(m, 0) * weight)`` per key, one column per measure."""
    names = names or EXPOSURE_NAMES
    return base.groupBy(*keys).agg(*[
        F.sum(F.coalesce(F.col(m), F.lit(0)) * F.col(weight)).alias(names.get(m, f"exposure_{m}"))
        for m in measures])


def on_day(df: DataFrame, day, col: str = "day") -> DataFrame:
    """Constant-day filter (``day = DATE '...'``)."""
    return df.filter(F.col(col) == F.lit(day).cast("date"))


def prune_to_day(enriched: DataFrame, day, partition_col: str = "date") -> DataFrame:
    """Also filter the partition column that carries the day of the time text.

    The reports filter on the day derived from the time text, which a file
    scan cannot use; where the partition value is known to be the same day,
    this extra predicate lets the scan read one folder instead of all
    (PartitionFilters).  Where it may differ (UTC against local days, NULL
    dates) it would lose rows, so callers must ask for it.
    """
    if day is None or partition_col not in enriched.columns:
        return enriched
    return enriched.filter(F.col(partition_col) == F.lit(day).cast("date"))


def in_city(df: DataFrame, city: str, col: str = "city") -> DataFrame:
    return df.filter(F.col(col) == F.lit(city))


def exposure_per_city(enriched: DataFrame, day=None,
                      measures: Sequence[str] = POLLUTION_MEASURES,
                      partition_col: str | None = None) -> DataFrame:
    """Per (day, city) exposure, ordered by city (NULLs last); optional single day.

    ``partition_col`` names a partition column that equals the day of the time
    text; a single-day report then reads that folder only.
    """
    pruned = prune_to_day(enriched, day, partition_col) if partition_col else enriched
    base = dedup_readings(pruned, measures)
    if day is not None:
        base = on_day(base, day)  # grouping key: safe to filter before the aggregate
    return weighted_exposure(base, measures).orderBy(F.asc_nulls_last("city"))


def country_exposure(per_city: DataFrame, measures: Sequence[str] = POLLUTION_MEASURES) -> DataFrame:
    """Per (day, country): SUM(city exposure) / COUNT(DISTINCT city).

    ``per_city`` holds one row per (day, city), so COUNT(DISTINCT city) equals
    COUNT(city) and needs no distinct aggregation (no extra shuffle).  A group
    whose only city is NULL divides by zero -> NULL.
    """
    country = country_of("city").alias("country")
    return per_city.groupBy("day", country).agg(*[
        F.try_divide(F.sum(EXPOSURE_NAMES[m]), F.count("city")).alias(COUNTRY_NAMES[m])
        for m in measures])


def exposure_per_country(enriched: DataFrame, day=None,
                         measures: Sequence[str] = POLLUTION_MEASURES,
                         partition_col: str | None = None) -> DataFrame:
    """Per (day, country) exposure; optional single day (pruned like ``exposure_per_city``)."""
    pruned = prune_to_day(enriched, day, partition_col) if partition_col else enriched
    base = dedup_readings(pruned, measures)
    if day is not None:
        base = on_day(base, day)
    return country_exposure(weighted_exposure(base, measures), measures)


def top_exposed_days(enriched: DataFrame, city: str, k: int = 10,
                     measure: str = "measurement_pm25Atmo",
                     dedup_measures: Sequence[str] = POLLUTION_MEASURES) -> DataFrame:
    """The ``k`` days with the largest exposure for one city.

    The DISTINCT keeps all three measures even though one is summed.  Ties
    are broken by day so the answer is deterministic.  Plans as a per-task
    top-k (TakeOrderedAndProject), never a global sort.
    """
    base = in_city(dedup_readings(enriched, dedup_measures), city)
    per_day = weighted_exposure(base, [measure])
    out = EXPOSURE_NAMES[measure]
    return per_day.orderBy(F.desc_nulls_last(out), F.asc("day")).limit(k)
