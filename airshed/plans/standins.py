"""Readings, weather and estimate responses derived from the driver tables.

The driver ships TPC-H-like tables, not sensor CSVs.  These functions turn
them into datasets with the reference's shapes, entirely on Spark, so every
query's work grows with the tables:

* a *reading* is an ``events`` row; its station location is the customer's
  ``"<market segment>, <nation>, <region>"`` (district, city, country), found
  through events -> customer -> nation -> region;
* pollution measures: pm10 = ``value``, pm25 = ``props.k``, pm100 =
  ``value + props.k`` except on ``error`` events (no reading -> NULL);
* weather: wind (m/s) = ``sqrt(value)``; rain (mm) = ``props.k / 7`` except
  on ``error`` events; temperature = ``(props.k - 30) / 2``.  Weather
  stations report on the hour, so their time text is truncated to the hour.
  The wind is irrational on purpose: its averages of averages never sit
  exactly on a rounding boundary, so the 6-decimal oracle comparison
  cannot flip;
* the estimate API response for a day lists, per nation, the number of
  distinct customers who clicked that day, plus an ``ALL`` entry for the
  whole area.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airshed.functions import date_text, day_of, ntz_micros
from airshed.operators.joins import bounded_broadcast, bounded_broadcast_all, enrich, materialise
from airshed.operators.estimates import build_lookup
from airshed.sources import read_table

# The city whose visitor estimate weights exposure, and the
# monitored location used by the single-city reports.
LOOKUP_CITY = "nation_7"
TARGET_LOCATION = "BUILDING, NATION_7, ASIA"
TIME_FMT = "yyyy-MM-dd HH:mm:ss"
# Name of the whole-area entry every response carries next to the nations.
TOTAL_ENTRY = "ALL"


def geo(spark: SparkSession, root: str) -> DataFrame:
    """customer -> (c_custkey, location_name, n_name).

    nation and region are dimensions: one bounded job measures both, and
    each is broadcast only when their total rows and bytes are within the
    bound.  customer grows
    with the data and is joined by shuffle.
    """
    cust = read_table(spark, root, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    nat = read_table(spark, root, "nation").select("n_nationkey", "n_name", "n_regionkey")
    reg = read_table(spark, root, "region").select("r_regionkey", "r_name")
    (nat, reg), _ = bounded_broadcast_all(nat, reg)
    g = (cust.join(nat, cust.c_nationkey == nat.n_nationkey, "left")
             .join(reg, F.col("n_regionkey") == reg.r_regionkey, "left"))
    loc = F.concat(F.col("c_mktsegment"), F.lit(", "), F.col("n_name"), F.lit(", "), F.col("r_name"))
    return g.select("c_custkey", loc.alias("location_name"), "n_name")


def located_geo(spark: SparkSession, root: str, location: str,
                g: DataFrame | None = None) -> DataFrame:
    """The customer geography of one location, broadcast behind the size check.

    Events joined with it meet a handful of customers without being
    shuffled (the rows of other locations would be dropped by a
    single-location report anyway).  Above the bound it stays a shuffle join.
    """
    g = g if g is not None else geo(spark, root)
    side, _ = bounded_broadcast(g.filter(F.col("location_name") == F.lit(location)))
    return side


def _located(spark: SparkSession, root: str, g: DataFrame | None, location: str | None,
             located: DataFrame | None) -> tuple[DataFrame, str]:
    """The geography to join events with, and the join type."""
    if located is not None:
        return located, "inner"
    if location is not None:
        return located_geo(spark, root, location, g), "inner"
    return (g if g is not None else geo(spark, root)), "left"


def located_events(spark: SparkSession, root: str, location: str, g: DataFrame | None = None) -> DataFrame:
    """The events of one location with it, written once for a report that needs them twice."""
    side = located_geo(spark, root, location, g)
    ev = _events(spark, root)
    stored, _ = materialise(ev.join(side, ev.user_id == F.col("c_custkey"), "inner").select(*ev.columns, "location_name"), "located-events")
    return stored


def all_located_events(spark: SparkSession, root: str) -> DataFrame:
    """All events with their location."""
    return _joined(spark, root, None, None, None, None).select("event_id", "ts", "user_id", "event_type", "value", "k", "location_name")


def on_event_day(ev: DataFrame, day) -> DataFrame:
    """``ts`` within one calendar day, as a plain range: pushed to the Parquet
    scan, where min/max statistics skip row groups of other days."""
    if day is None:
        return ev
    start = F.lit(str(day)).cast("date")
    return ev.filter((F.col("ts") >= start.cast("timestamp_ntz"))
                     & (F.col("ts") < F.date_add(start, 1).cast("timestamp_ntz")))


def _events(spark: SparkSession, root: str, day=None) -> DataFrame:
    """Event columns the readings need, with ``props.k`` parsed before any join.

    The JSON text is reduced to one number on the scan side, so the shuffle
    into the customer join carries 4 bytes instead of the text.
    """
    ev = on_event_day(read_table(spark, root, "events"), day)
    return ev.select("event_id", "ts", "user_id", "event_type", "value",
                     F.get_json_object("props", "$.k").try_cast("int").alias("k"))


def _joined(spark: SparkSession, root: str, g: DataFrame | None, location: str | None, day, located: DataFrame | None) -> DataFrame:
    ev = _events(spark, root, day)
    g, how = _located(spark, root, g, location, located)
    return ev.join(g, ev.user_id == F.col("c_custkey"), how)


def readings(spark: SparkSession, root: str, g: DataFrame | None = None,
             location: str | None = None, day=None, located: DataFrame | None = None,
             joined: DataFrame | None = None) -> DataFrame:
    """Raw pollution readings (one per event) with their station location.

    events x customer is a shuffle join on the customer key; a customer with
    a third of all events is split by AQE's skew-join handling.  With
    ``location`` only that location's readings are produced (see ``_located``);
    with ``day`` only that day's; ``joined`` gives the joined events.
    """
    r = joined if joined is not None else _joined(spark, root, g, location, day, located)
    k = F.col("k").cast("double")
    return r.select(
        "event_id", "ts", "user_id", "event_type",
        F.date_format("ts", TIME_FMT).alias("time_date"),
        "location_name",
        F.col("value").alias("measurement_pm10Atmo"),
        k.alias("measurement_pm25Atmo"),
        F.when(F.col("event_type") != "error", F.col("value") + k).alias("measurement_pm100Atmo"))


def weather_readings(spark: SparkSession, root: str, g: DataFrame | None = None,
                     location: str | None = None, located: DataFrame | None = None,
                     joined: DataFrame | None = None) -> DataFrame:
    """Raw weather readings in the sample's column layout (``weather_windSpeed`` in m/s)."""
    r = joined if joined is not None else _joined(spark, root, g, location, None, located)
    k = F.col("k").cast("double")
    return r.select(
        F.concat(F.col("user_id").cast("string"), F.lit(" - "), F.col("location_name")).alias("name"),
        (ntz_micros("ts") * F.lit(1000)).alias("time_nano"),
        F.date_format(F.date_trunc("hour", "ts"), TIME_FMT).alias("time_date"),
        "location_name",
        ((k - F.lit(30)) / F.lit(2.0)).alias("weather_temperature"),
        F.sqrt("value").alias("weather_windSpeed"),
        F.when(F.col("event_type") != "error", k / F.lit(7.0)).alias("weather_precipitation"))


def estimate_responses(spark: SparkSession, root: str, g: DataFrame | None = None,
                       day=None) -> DataFrame:
    """One estimate API response (JSON text) per day with click events.

    Clicks are first reduced to distinct (day, customer) pairs (partial
    aggregation before the shuffle), so the customer join sees one row per
    active customer-day instead of one per event.  Each customer has one
    nation, so per-nation counts of those pairs are distinct-customer counts
    and the ``ALL`` entry is their sum.  A response lists one entry per
    nation: its size is bounded by the nation dimension, not by the events.
    """
    clicks = (on_event_day(read_table(spark, root, "events"), day)
              .filter(F.col("event_type") == "click")
              .select(date_text(F.col("ts").cast("date")).alias("date_str"), "user_id")
              .distinct())
    g = (g if g is not None else geo(spark, root)).select("c_custkey", "n_name")
    j = clicks.join(g, clicks.user_id == g.c_custkey, "inner")
    per_nation = j.groupBy("date_str", "n_name").agg(F.count(F.lit(1)).alias("n"))
    entry = F.struct(F.col("n_name").alias("name"),
                     F.col("n").cast("string").alias("estimated_no_people"))
    total = F.struct(F.lit(TOTAL_ENTRY).alias("name"),
                     F.sum("n").cast("string").alias("estimated_no_people"))
    info = F.concat(F.collect_list(entry), F.array(total))
    return per_nation.groupBy("date_str").agg(F.to_json(F.struct(info.alias("info"))).alias("response"))


def visitor_lookup(spark: SparkSession, root: str, city: str = LOOKUP_CITY,
                   on_missing: str = "null", g: DataFrame | None = None, day=None) -> DataFrame:
    """(date_str, tourist_estimate) for ``city`` (case-insensitive), one row per date."""
    return build_lookup(estimate_responses(spark, root, g, day), [city], case_sensitive=False,
                        on_missing=on_missing)


def with_date_str(df: DataFrame, time_col: str = "time_date") -> DataFrame:
    """``date`` and ``date_str`` from the time text (``to_date`` of the text, then formatted)."""
    d = day_of(time_col)
    return df.withColumn("date", d).withColumn("date_str", date_text(d))


def pollution_enriched(spark: SparkSession, root: str, mode: str = "left",
                       location: str | None = None, day=None, g: DataFrame | None = None,
                       located: DataFrame | None = None, joined: DataFrame | None = None) -> DataFrame:
    """Readings joined with the visitor lookup; ``location`` / ``day`` restrict
    the readings early for single-location or single-day reports (``day``
    also restricts the lookup).  ``g`` / ``located`` / ``joined`` reuse what
    another branch of the same report already built."""
    g = g if g is not None else geo(spark, root)
    return enrich(with_date_str(readings(spark, root, g, location, day, located, joined)),
                  visitor_lookup(spark, root, g=g, day=day), mode=mode, unique=True)


def weather_enriched(spark: SparkSession, root: str, mode: str = "left") -> DataFrame:
    from airshed.sources import standardise_columns
    g = geo(spark, root)
    w = standardise_columns(weather_readings(spark, root, g))
    return enrich(with_date_str(w), visitor_lookup(spark, root, g=g), mode=mode, unique=True)
