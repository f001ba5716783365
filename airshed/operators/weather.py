"""Weather readings: normalisation and the two-level daily rollup."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airshed.functions import day_of, day_text, iso_text, ms_to_kmh, time_text


def normalise_readings(df: DataFrame, time_col: str = "time_date",
                       wind_col: str = "weather_windSpeed") -> DataFrame:
    """``name, datetime_iso, temperature_c, wind_speed_kmh`` (m/s x 3.6)."""
    return df.select(
        "name",
        iso_text(time_col).alias("datetime_iso"),
        F.col("weather_temperature").alias("temperature_c"),
        ms_to_kmh(wind_col).alias("wind_speed_kmh"))


def hourly_weather(weather: DataFrame, time_col: str = "time_date",
                   city_col: str = "location_name") -> DataFrame:
    """AVG wind / precipitation per (day, city, HH:mm:ss)."""
    return weather.groupBy(
        day_of(day_text(time_col), strict=True).alias("day"),
        F.col(city_col).alias("city"),
        time_text(time_col).alias("hh_mm_ss"),
    ).agg(F.avg("weather_wind_speed").alias("weather_wind_speed_hourly"),
          F.avg("weather_precipitation").alias("weather_precipitation_hourly"))


def daily_weather(hourly: DataFrame) -> DataFrame:
    """Daily AVG of the hourly averages and SUM of hourly precipitation (NULL hours count 0).

    Deliberately an average of averages: hours with many readings do not
    weigh more than sparse hours.
    """
    return hourly.groupBy("day", "city").agg(
        F.avg("weather_wind_speed_hourly").alias("avg_wind_speed"),
        F.sum(F.coalesce(F.col("weather_precipitation_hourly"), F.lit(0))).alias("total_precipitation"))
