"""Exposure x weather correlation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airshed.operators.exposure import dedup_readings, in_city, weighted_exposure
from airshed.operators.weather import daily_weather, hourly_weather


def safe_corr(x, y) -> Column:
    """Pearson correlation that is NULL (not an error) for constant, 1-row or empty input.

    Moments are taken over complete pairs only, like ``corr``.
    """
    x, y = F.col(x) if isinstance(x, str) else x, F.col(y) if isinstance(y, str) else y
    both = x.isNotNull() & y.isNotNull()
    xs, ys = F.when(both, x), F.when(both, y)
    return F.try_divide(F.covar_pop(xs, ys), F.stddev_pop(xs) * F.stddev_pop(ys))


def per_day_pollution(pollution: DataFrame, measure: str = "measurement_pm25Atmo") -> DataFrame:
    base = dedup_readings(pollution, [measure])
    return weighted_exposure(base, [measure])


def exposure_weather_corr(pollution: DataFrame, weather: DataFrame, city: str,
                          measure: str = "measurement_pm25Atmo") -> DataFrame:
    """corr(exposure, avg wind) and corr(exposure, total rain) over the days of one city.

    The city filter is written on the pollution side; Catalyst infers it for
    the weather side through the join keys, so both scans are filtered
    before their aggregates.  Both inputs arrive hash-partitioned on
    (day, city) from their own aggregates, so the join adds no shuffle.
    """
    p = in_city(per_day_pollution(pollution, measure), city)
    w = daily_weather(hourly_weather(weather))
    j = p.join(w, ["day", "city"], "inner")
    e = "pollution_total_visitor_pm25"
    return j.agg(safe_corr(e, "avg_wind_speed").alias("corr_exposure_wind"),
                 safe_corr(e, "total_precipitation").alias("corr_exposure_rain"))
