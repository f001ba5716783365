"""Registered queries and their DuckDB oracle SQL.

Every query reads the driver tables of one scale-factor folder (or data
Spark derives from them) in full.  Floating results are rounded (6 decimals,
correlations 8) on both sides so order-dependent summation cannot flip the
value hash; the stand-in measures are chosen so that no true value sits on
a rounding boundary.  Column names and types match the oracle's.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airshed.functions import (
    day_of, decode_key, encode_city, file_name, first_non_empty, nano_date, ntz_micros,
    strip_slash, utc_text, valid_date,
)
from airshed.operators import (
    MaintainedExposure, account, all_dates, build_lookup, co_moments, corr_of_moments, copy_count, daily_weather, dates_from_keys, distinct_dates,
    distinct_rows_by_key_set,
    exposure_per_city, exposure_per_country, exposure_weather_corr, graft_plan, hourly_weather,
    last_wins, merged_moments, per_day_pollution, lookup_problems, lookup_with_status, normalise_readings, profile, remap_plan, select_notices,
    split_poison, top_exposed_days,
)
from airshed.operators.joins import enrich, materialise
from airshed.plans import standins as S
from airshed.plans.landing import enrich_files, land_files, landed_files, quarantined, read_landed
from airshed.plans.views import drop_day, register_dataset, register_day
from airshed.plans.workflows import (
    enrich_datasets, enrich_partitioned, normalise_weather_file, partition_by_date_job, publish_lookup,
)
from airshed.schemas import NORMALISED_WEATHER, POLLUTION_MEASURES
from airshed.session import scratch_path
from airshed.sinks import read_dead_letters, read_ledger, upsert_ledger, write_by_date, write_csv
from airshed.sources import (
    list_objects, parse_notifications, read_lookup, read_partitioned, read_raw, read_table,
    standardise_columns, with_source_file,
)
from airshed.streaming import inventory_stream, ledger_stream, read_inventory

# Parameters of the registered reports.
REPORT_DAY = "2024-01-15"
NEXT_DAY = "2024-01-16"
NANO_ZONE = "Europe/Belgrade"
LOCAL_HOURS = 2
REMAP_SRC, REMAP_DST = "https://", "archive/"
GRAFT_DST = "enriched/"
WATCHED = ("en/", "fr/", "de/")
NOTICE_EPOCH = "2025-11-19 10:00:00"


def _round(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.select(*[F.round(F.col(f.name), digits).alias(f.name)
                       if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name)
                       for f in df.schema.fields])


# ---------------------------------------------------------------- exposure


def q_exposure_per_city(spark, root):
    return _round(exposure_per_city(S.pollution_enriched(spark, root)))


def q_exposure_per_city_on_day(spark, root):
    p = S.pollution_enriched(spark, root, day=REPORT_DAY)
    return _round(exposure_per_city(p, day=REPORT_DAY))


def q_exposure_per_country(spark, root):
    return _round(exposure_per_country(S.pollution_enriched(spark, root)))


def q_exposure_per_country_on_day(spark, root):
    p = S.pollution_enriched(spark, root, day=REPORT_DAY)
    return _round(exposure_per_country(p, day=REPORT_DAY))


def q_top_exposed_days(spark, root):
    p = S.pollution_enriched(spark, root, location=S.TARGET_LOCATION)
    return _round(top_exposed_days(p, S.TARGET_LOCATION))


def q_exposure_weather_corr(spark, root):
    loc = S.TARGET_LOCATION
    g = S.geo(spark, root)
    joined = S.located_events(spark, root, loc, g)  # the location's events, for both branches
    weather = standardise_columns(S.weather_readings(spark, root, joined=joined))
    pollution = S.pollution_enriched(spark, root, g=g, joined=joined)
    c = exposure_weather_corr(pollution, weather, loc)
    return _round(c, 8)


def q_corr_all_cities(spark, root):
    """The same correlation for every city and half of the month at once, from stored co-moments per day."""
    joined, _ = materialise(S.all_located_events(spark, root), "located-events")
    weather = daily_weather(hourly_weather(standardise_columns(S.weather_readings(spark, root, joined=joined))))
    exposure = per_day_pollution(S.pollution_enriched(spark, root, joined=joined))
    pairs, _ = materialise(exposure.join(weather, ["day", "city"]), "city-days")
    out = []
    for y, name in (("avg_wind_speed", "wind"), ("total_precipitation", "rain")):
        daily, _ = materialise(co_moments(pairs, ["city", "day"], "pollution_total_visitor_pm25", y), f"moments-{name}")
        half = daily.withColumn("half", F.when(F.dayofmonth("day") <= 15, 1).otherwise(2))
        parts = merged_moments(half, ["city", "half"])                   # of each half
        whole = merged_moments(parts, ["city"]).withColumn("half", F.lit(0))  # and of both, from these
        out.append(parts.unionByName(whole).select("city", "half", F.lit(name).alias("against"), F.col("n").alias("days"),
                                                   F.when(F.col("n") > 2, corr_of_moments()).alias("corr")))
    return _round(out[0].unionByName(out[1]), 8)


def q_exposure_maintained(spark, root):
    """Exposure kept in totals: all readings come in, then one day is enriched anew; its old rows are
    taken away and the new ones added, and the batch is sent twice."""
    kept = MaintainedExposure(spark, scratch_path(spark, "maintained"))
    readings, _ = materialise(S.pollution_enriched(spark, root).select(
        "time_date", "location_name", *POLLUTION_MEASURES, "date_str", "tourist_estimate"), "enriched")
    kept.apply("all", added=readings)
    day = readings.filter(F.col("date_str") == REPORT_DAY)
    anew = day.withColumn("tourist_estimate", F.coalesce("tourist_estimate", F.lit(0)) + 1000)
    for _ in range(2):
        kept.apply("again", added=anew, removed=day)
    return _round(kept.per_city())


def q_daily_weather(spark, root):
    weather = standardise_columns(S.weather_readings(spark, root))
    return _round(daily_weather(hourly_weather(weather)))


def q_hourly_weather(spark, root):
    weather = standardise_columns(S.weather_readings(spark, root))
    return _round(hourly_weather(weather))


def q_dedup_key_variants(spark, root):
    return distinct_rows_by_key_set(S.pollution_enriched(spark, root), {
        "pm10_pm25_pm100": ["measurement_pm10Atmo", "measurement_pm25Atmo", "measurement_pm100Atmo"],
        "pm25": ["measurement_pm25Atmo"]})


# ------------------------------------------------------- lookup / enrichment


def q_first_match_lookup(spark, root):
    return S.visitor_lookup(spark, root)


def q_enrich_left(spark, root):
    return S.pollution_enriched(spark, root).select("event_id", "date_str", "tourist_estimate")


def q_enrich_weather(spark, root):
    return S.weather_enriched(spark, root).select("name", "time_date", "date_str", "tourist_estimate")


def q_enrich_strict(spark, root):
    lk = S.visitor_lookup(spark, root, city=S.TOTAL_ENTRY, on_missing="error")
    r = S.with_date_str(S.readings(spark, root))
    return enrich(r, lk, mode="strict", keys=_reading_dates(spark, root)).select("event_id", "date_str", "tourist_estimate")


def _reading_dates(spark, root):
    """Dates of the readings: a left join to customers cannot change them, so read events only."""
    ev = read_table(spark, root, "events").select(F.date_format("ts", S.TIME_FMT).alias("time_date"))
    return S.with_date_str(ev)


def q_union_distinct_dates(spark, root):
    r = _reading_dates(spark, root)
    o = read_table(spark, root, "orders").select(F.col("o_orderdate").cast("date").alias("date"))
    return distinct_dates(r, o)


def q_all_dates_count(spark, root):
    r = _reading_dates(spark, root)
    o = read_table(spark, root, "orders").select(F.col("o_orderdate").cast("date").alias("date"))
    return all_dates(r, o).groupBy("date").agg(F.count(F.lit(1)).alias("n"))


def q_lookup_with_status(spark, root):
    """Blank cities, unreachable services and missing fields among the requests."""
    i = F.col("doc_id")
    req = read_table(spark, root, "documents").select(
        "doc_id", F.when(i % 7 == 0, None).when(i % 11 == 0, "  ").otherwise(F.col("source")).alias("city"))
    svc = read_table(spark, root, "labels").select(
        "doc_id", F.when(i % 5 == 0, None).otherwise(F.col("quality")).alias("temperature"))
    return lookup_with_status(req, svc, on="doc_id")


# --------------------------------------------------------- weather / quality


def q_normalise_readings(spark, root):
    return normalise_readings(S.weather_readings(spark, root))


LANDED_PIECES = 4  # files of an event type: a hot one is written by several tasks
EVENT_LANDED = "event_id bigint, time_date string, amount double"


def _landed_events(spark, root, folder) -> str:
    """Events as landed CSV, some files per event type two levels below a root, with odd times and
    amounts: every 7th event has no time, every 11th an invalid one, every 13th an amount in words."""
    i, text = F.col("event_id"), F.date_format("ts", S.TIME_FMT)
    base = scratch_path(spark, folder)
    (read_table(spark, root, "events").select(
        F.concat_ws("-", "event_type", i % LANDED_PIECES).alias("piece"), "event_id",
        F.when(i % 7 == 0, None).when(i % 11 == 0, F.concat(F.lit("2024-02-30 "), F.substring(text, 12, 8))).otherwise(text)
        .alias("time_date"),
        F.when(i % 13 == 0, "much").otherwise(F.col("value").cast("string")).alias("amount"))
     .repartition("piece").write.partitionBy("piece").option("header", True).csv(f"{base}/landing"))
    return f"{base}/landing"


def q_quality_profile(spark, root):
    """Profile of landed files with NULL and invalid times and values that do not fit."""
    raw = read_raw(spark, _landed_events(spark, root, "profile"), EVENT_LANDED, depth=1, corrupt_col="_corrupt")
    df = with_source_file(raw).withColumn("date", day_of("time_date", S.TIME_FMT))
    return profile(df, corrupt_col="_corrupt")


def q_partition_job_profile(spark, root):
    """What the partition job reports of the same files, observed during its one pass."""
    landed = _landed_events(spark, root, "job-raw")
    stats = partition_by_date_job(spark, landed.rsplit("/", 1)[0], scratch_path(spark, "job-out"), schema=EVENT_LANDED)
    return spark.createDataFrame([stats], "row_count bigint, file_count bigint, null_date_count bigint, bad_row_count bigint")


def q_bad_rows(spark, root):
    """Rows of the landed files whose amount is no number: kept, with the amount NULL."""
    raw = read_raw(spark, _landed_events(spark, root, "bad-rows"), EVENT_LANDED, depth=1, corrupt_col="_corrupt")
    return raw.filter(F.col("_corrupt").isNotNull()).select("event_id", "amount", F.col("_corrupt").contains("much").alias("kept"))


def _land_events(spark, root):
    """The landed events put through quarantine: (source, target, quarantine)."""
    src, out, bad = _landed_events(spark, root, "landing"), scratch_path(spark, "landed"), scratch_path(spark, "quarantine")
    stats = land_files(spark, src, out, bad, EVENT_LANDED, depth=1)
    if stats["read"] != stats["accepted"] + stats["rejected"]:
        raise RuntimeError(f"lines are missing: {stats}")
    return src, out, bad


def q_quarantine_accounting(spark, root):
    """Lines read = accepted + rejected, by file."""
    _, _, bad = _land_events(spark, root)
    piece = F.regexp_extract("file", "piece=([^/]+)/", 1)
    return landed_files(spark, bad).select(piece.alias("piece"), "accepted", "rejected")


def q_quarantine_reasons(spark, root):
    """Every rejected line with its reason."""
    _, _, bad = _land_events(spark, root)
    return quarantined(spark, bad).select(F.split("line", ",")[0].cast("bigint").alias("event_id"), "reason", "copies",
                                          F.split("line", ",")[2].alias("amount_text"))


def q_quarantine_reload(spark, root):
    """Amounts in words are mended and their files landed again; lines with no date stay out."""
    src, out, bad = _land_events(spark, root)
    mended = quarantined(spark, bad).filter(F.col("reason") == "amount: no double") \
        .select("file", "line", F.regexp_replace("line", "much$", "0.5").alias("mended"))
    mended, _ = materialise(mended, "mended")
    land_files(spark, src, out, bad, EVENT_LANDED, mended=mended)
    return read_landed(spark, out, EVENT_LANDED).select("event_id", "date", "amount")


def _pollution_files(spark, root, folder, rows):
    """Rows as ``date=<day>/<name>.csv``-like files: two of a day, by event id."""
    cols = [c.split()[0] for c in POLLUTION_LANDED.split(", ")]
    write_by_date(rows.select(*cols, "date"), folder, mode="append")


def q_enrich_relanded_file(spark, root):
    """Two files a day, enriched file by file; then one day's second file lands again under a new estimate:
    its own rows are replaced, all others stay."""
    part, out = scratch_path(spark, "pollution-files"), scratch_path(spark, "pollution-enriched-files")
    readings, _ = materialise(S.with_date_str(S.readings(spark, root)), "readings")
    lookup, _ = materialise(S.visitor_lookup(spark, root), "lookup")
    for half in (0, 1):
        _pollution_files(spark, root, part, readings.filter(F.col("event_id") % 2 == half))
    enrich_files(spark, part, lookup, out, POLLUTION_LANDED)
    # the files of that day that hold odd event ids
    day = F.lit(REPORT_DAY).cast("date")
    odd = spark.read.option("header", True).option("enforceSchema", False).schema(POLLUTION_LANDED).csv(part) \
        .filter((F.col("date") == day) & (F.col("event_id") % 2 == 1))
    names = [r.f for r in odd.select(F.element_at(F.split("_metadata.file_path", "/"), -1).alias("f")).distinct().collect()]
    newer = lookup.withColumn("tourist_estimate", F.coalesce("tourist_estimate", F.lit(0)) + 1000)
    enrich_files(spark, part, newer, out, POLLUTION_LANDED, files=[f"date={REPORT_DAY}/{n}" for n in names])
    back = spark.read.option("header", True).csv(out)
    return back.select(F.col("event_id").cast("bigint").alias("event_id"), "date_str",
                       F.col("tourist_estimate").cast("int").alias("tourist_estimate"))


def q_full_copy_csv(spark, root):
    """Enriched readings written whole as one CSV dataset and read back."""
    out = scratch_path(spark, "full-copy")
    cols = [c.split()[0] for c in POLLUTION_LANDED.split(", ")]
    write_csv(S.pollution_enriched(spark, root).select(*cols, "date_str", "tourist_estimate"), out)
    return read_raw(spark, out, POLLUTION_LANDED + ", date_str string, tourist_estimate int", depth=0)


def q_catalog_days(spark, root):
    """A registered dataset after one day was dropped from the catalog and another one registered again."""
    part = scratch_path(spark, "catalog-days")
    cols = [c.split()[0] for c in POLLUTION_LANDED.split(", ")]
    write_by_date(S.with_date_str(S.readings(spark, root)).select(*cols, "date"), part)
    name = "days_" + part.rsplit("-", 1)[-1]
    register_dataset(spark, name, part, POLLUTION_LANDED)
    drop_day(spark, name, REPORT_DAY)
    drop_day(spark, name, NEXT_DAY)
    register_day(spark, name, NEXT_DAY)
    return spark.sql(f"SELECT date, count(*) AS n FROM {name} GROUP BY date")


def q_valid_dates(spark, root):
    """Unpadded event dates (``2024-1-5``) validated and normalised to ``yyyy-MM-dd``."""
    ev = read_table(spark, root, "events").select(F.date_format("ts", "yyyy-M-d").alias("raw"))
    return ev.select("raw", valid_date("raw").alias("date_str")).distinct()


def q_nano_to_date(spark, root):
    ev = read_table(spark, root, "events").select("event_id", "ts")
    nanos = ntz_micros("ts") * F.lit(1000)
    return ev.select("event_id", nanos.alias("time_nano"),
                     nano_date(nanos, NANO_ZONE).alias("local_date"))


def q_nano_to_date_edges(spark, root):
    """Nanoseconds just before a midnight, off the microsecond grid, after and before 1970."""
    i = F.col("event_id")
    back = F.when(i % 3 == 0, 1).when(i % 3 == 1, 100).otherwise(128).cast("bigint")
    nanos = (ntz_micros(F.date_trunc("day", "ts")) * F.lit(1000) - back) * F.when(i % 2 == 0, 1).otherwise(-1)
    ev = read_table(spark, root, "events").select("event_id", nanos.alias("time_nano"))
    return ev.select("event_id", "time_nano", nano_date("time_nano").alias("utc_date"))


def q_partition_roundtrip(spark, root):
    """Write readings as date-partitioned CSV and read every row back."""
    out = scratch_path(spark, "by-date")
    cols = [c.split()[0] for c in POLLUTION_LANDED.split(", ")]
    write_by_date(S.with_date_str(S.readings(spark, root)).select(*cols, "date"), out)
    return read_partitioned(spark, out, schema=T.StructType.fromDDL(POLLUTION_LANDED))


# Stand-in raw weather layout as landed CSV text.
WEATHER_LANDED = ("name string, time_nano bigint, time_date string, location_name string, "
                  "weather_temperature double, weather_windSpeed double, weather_precipitation double")
POLLUTION_LANDED = ("event_id bigint, time_date string, location_name string, "
                    "measurement_pm10Atmo double, measurement_pm25Atmo double, "
                    "measurement_pm100Atmo double")


def q_normalise_weather_files(spark, root):
    """W1 on files: landed weather CSV -> normalised ``;`` CSV, read back."""
    src, dst = scratch_path(spark, "weather-landed"), scratch_path(spark, "weather-normalised")
    S.weather_readings(spark, root).write.option("header", True).csv(src)
    normalise_weather_file(spark, src, dst, schema=WEATHER_LANDED, single_file=False)
    return (spark.read.option("header", True).option("sep", ";").schema(NORMALISED_WEATHER)
            .csv(dst))


def q_partition_job(spark, root):
    """W2 on files: CSV two levels below a root -> profile + date-partitioned CSV; per-date rows."""
    raw, out = scratch_path(spark, "raw"), scratch_path(spark, "partitioned")
    S.weather_readings(spark, root).write.option("header", True).csv(f"{raw}/landing")
    partition_by_date_job(spark, raw, out, schema=WEATHER_LANDED)
    back = read_partitioned(spark, out, schema=T.StructType.fromDDL(WEATHER_LANDED))
    return _round(back.select("date", "name", "time_nano", "time_date", "weather_temperature", "weather_windSpeed"))


def q_enrich_partitioned_files(spark, root):
    """W3 + W4 on files: publish the lookup CSV, enrich the date-partitioned readings."""
    part, lk, out = (scratch_path(spark, "pollution-by-date"), scratch_path(spark, "lookup"),
                     scratch_path(spark, "pollution-enriched"))
    r = S.with_date_str(S.readings(spark, root)).select(*[c.split()[0] for c in POLLUTION_LANDED.split(", ")],
                                                        "date")
    write_by_date(r, part, mode="overwrite")
    publish_lookup(S.estimate_responses(spark, root), lk, [S.LOOKUP_CITY], case_sensitive=False)
    enrich_partitioned(spark, part, read_lookup(spark, lk), out,
                       schema=POLLUTION_LANDED)
    back = read_partitioned(spark, out)
    return back.select(F.col("event_id").cast("bigint").alias("event_id"), "date_str",
                       F.col("tourist_estimate").cast("int").alias("tourist_estimate"))


def q_enrich_incremental_day(spark, root):
    """All days enriched, then one day again with a new lookup: the other days stay."""
    part, out = scratch_path(spark, "pollution-by-date"), scratch_path(spark, "pollution-enriched")
    r = S.with_date_str(S.readings(spark, root)).select(*[c.split()[0] for c in POLLUTION_LANDED.split(", ")], "date")
    write_by_date(r, part, mode="overwrite")
    lookup, _ = materialise(S.visitor_lookup(spark, root), "lookup")
    enrich_partitioned(spark, part, lookup, out, schema=POLLUTION_LANDED)
    newer = lookup.withColumn("tourist_estimate", F.coalesce("tourist_estimate", F.lit(0)) + 1000)
    enrich_partitioned(spark, part, newer, out, schema=POLLUTION_LANDED, days=[REPORT_DAY])
    back = read_partitioned(spark, out)
    return back.select(F.col("event_id").cast("bigint").alias("event_id"), "date_str",
                       F.col("tourist_estimate").cast("int").alias("tourist_estimate"))


def q_exposure_per_city_local_day(spark, root):
    """One local day of readings whose ``date`` is the UTC day: rows of both UTC days count."""
    p = S.pollution_enriched(spark, root)
    local = p.withColumn("time_date", F.date_format(F.timestamp_add("HOUR", F.lit(LOCAL_HOURS), F.col("ts")), S.TIME_FMT))
    return _round(exposure_per_city(local, day=REPORT_DAY))


def _odd_responses(spark, root) -> DataFrame:
    """Estimate responses and, for some days, further ones: dated without zeros (even days of the
    month, estimate 12.7), with an invalid date (every 5th day), with an estimate in words (every 3rd)."""
    first, _ = materialise(S.estimate_responses(spark, root), "responses")
    day = F.day(F.col("date_str").cast("date"))
    one = lambda text: F.lit('{"info":[{"name":"Nation_7","estimated_no_people":' + text + "}]}")
    return (first.select("date_str", "response", F.lit(1).alias("seq"))
            .unionByName(first.filter(day % 2 == 0).select(
                F.date_format(F.col("date_str").cast("date"), "yyyy-M-d").alias("date_str"), one("12.7").alias("response"), F.lit(2).alias("seq")))
            .unionByName(first.filter(day % 5 == 0).select(
                F.concat(F.substring("date_str", 1, 5), F.lit("13-45")).alias("date_str"), "response", F.lit(1).alias("seq")))
            .unionByName(first.filter(day % 3 == 0).select("date_str", one('"many"').alias("response"), F.lit(0).alias("seq"))))


def q_lookup_exact(spark, root):
    """One row per date from repeated, unpadded and undated responses: the last by ``seq`` holds."""
    return build_lookup(_odd_responses(spark, root), [S.LOOKUP_CITY], case_sensitive=False, order_col="seq")


def q_lookup_problems(spark, root):
    return lookup_problems(_odd_responses(spark, root), [S.LOOKUP_CITY], case_sensitive=False)


def q_enriched_catalog_table(spark, root):
    """The partitioned dataset as a catalog table, queried by SQL."""
    part = scratch_path(spark, "catalog")
    cols = [c.split()[0] for c in POLLUTION_LANDED.split(", ")]
    write_by_date(S.with_date_str(S.readings(spark, root)).select(*cols, "date"), part)
    name = "readings_" + part.rsplit("-", 1)[-1]
    register_dataset(spark, name, part, POLLUTION_LANDED)
    return spark.sql(f"SELECT date, count(*) AS n, count(measurement_pm100Atmo) AS measured FROM {name} GROUP BY date")


def q_first_non_empty(spark, root):
    """The first argument is NULL or empty for some documents."""
    d = read_table(spark, root, "documents")
    lang = F.when(F.col("doc_id") % 3 == 0, "").when(F.col("doc_id") % 5 == 0, None).otherwise(F.col("lang"))
    source = F.when(F.col("doc_id") % 9 == 0, "").otherwise(F.concat(F.lit(" "), "source"))
    return d.select("doc_id", first_non_empty(lang, source).alias("value"))


# -------------------------------------------------------- objects / ledger


def _page_keys(spark, root):
    return read_table(spark, root, "pages").select("page_id", F.col("url").alias("key"))


def q_prefix_remap(spark, root):
    return remap_plan(_page_keys(spark, root), REMAP_SRC, REMAP_DST)


def q_graft_keys(spark, root):
    return graft_plan(_page_keys(spark, root), GRAFT_DST)


def q_url_keys_special(spark, root):
    """Names with the characters that URL encoders treat apart; keys with escapes and a stray percent sign."""
    p = read_table(spark, root, "pages").withColumn("n", F.col("page_id").cast("string"))
    name = F.concat(F.lit(" a~b*c-d_e.f "), "n", F.lit("+ș%/\t"))
    key = F.concat(F.lit("x+y%20"), "n", F.lit("%C8%99/100%25"))
    return p.select("page_id", encode_city(name).alias("encoded"), decode_key(key).alias("decoded"),
                    strip_slash(F.concat("url", F.when(F.col("page_id") % 2 == 0, "//").otherwise(""))).alias("stripped"))


def q_copied_objects(spark, root):
    return copy_count(_page_keys(spark, root), REMAP_SRC, REMAP_DST)


def q_ordered_dates(spark, root):
    """Sorted distinct dates with their place."""
    o = read_table(spark, root, "orders").select(F.col("o_orderdate").cast("date").alias("date"))
    dates = distinct_dates(_reading_dates(spark, root), o, ordered=True)
    return dates.select("date", F.date_format("date", "yyyy-MM-dd").alias("date_str"))


def q_url_keys(spark, root):
    p = read_table(spark, root, "pages")
    return p.select("page_id", decode_key("url").alias("decoded"),
                    encode_city("url").alias("encoded"), file_name("url").alias("file_name"))


def notification_messages(spark, root) -> DataFrame:
    """One queue message per page: bucket = host, key = URL path, eventTime from page id."""
    p = read_table(spark, root, "pages").select("page_id", "url")
    host = F.regexp_extract("url", r"^[a-z]+://([^/]+)", 1)
    key = F.regexp_extract("url", r"^[a-z]+://[^/]+/([^?#]*)", 1)
    t = F.timestamp_add("SECOND", F.col("page_id"),
                        F.lit(NOTICE_EPOCH).cast("timestamp_ntz"))
    rec = F.struct(F.struct(F.struct(host.alias("name")).alias("bucket"),
                            F.struct(key.alias("key")).alias("object")).alias("s3"),
                   F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("eventTime"))
    body = F.to_json(F.struct(F.array(rec).alias("Records")))
    msg = F.to_json(F.struct(F.array(F.struct(body.alias("body"))).alias("Records")))
    return p.select("page_id", msg.alias("value"))


def odd_messages(spark, root) -> DataFrame:
    """Messages as above, most of them broken in one way each, by the last digit of the page id."""
    p = read_table(spark, root, "pages").select("page_id", "url", (F.col("page_id") % 10).alias("d"))
    unless = lambda d, c: F.when(F.col("d") != d, c)  # noqa: E731  NULL, which JSON leaves out
    key = F.when(F.col("d") == 0, "en/dlq-test.txt").otherwise(F.regexp_extract("url", r"^[a-z]+://[^/]+/([^?#]*)", 1))
    s3 = F.struct(F.struct(unless(3, F.lit("bucket")).alias("name")).alias("bucket"), F.struct(unless(2, key).alias("key")).alias("object"))
    rec = F.struct(unless(4, s3).alias("s3"), unless(6, F.lit("2025-11-19T10:00:00Z")).alias("eventTime"))
    body = F.when(F.col("d") == 1, F.concat(F.lit("{oops"), F.col("page_id").cast("string"))) \
        .otherwise(F.to_json(F.struct(F.array(rec).alias("Records"))))
    line = F.to_json(F.struct(F.array(F.struct(unless(5, body).alias("body"))).alias("Records")))
    return p.select("page_id", F.when(F.col("d") == 7, F.concat(F.lit("no JSON "), F.col("page_id").cast("string"))).otherwise(line).alias("value"))


def q_notification_dead_letters(spark, root):
    recs = parse_notifications(odd_messages(spark, root), keep=("page_id",))
    _good, dead = split_poison(select_notices(recs, WATCHED))
    raw = F.when(F.col("body").rlike("^(\\{oops|no JSON)"), F.col("body"))
    return dead.select("page_id", "malformed", "file_name", raw.alias("raw"), F.col("body").isNotNull().alias("raw_kept"))


def q_notification_accounting(spark, root):
    """Records in = ledger + ignored + dead."""
    return account(parse_notifications(odd_messages(spark, root)), WATCHED)


def q_api_dates_from_keys(spark, root):
    """Dates to request estimates for, from the keys of a written date-partitioned dataset."""
    part = scratch_path(spark, "weather_partitioned")
    write_by_date(S.with_date_str(S.weather_readings(spark, root)).drop("date_str"), part)
    return dates_from_keys(list_objects(spark, part))


def q_api_dates_incremental(spark, root):
    """The same dates from an inventory that lists only what landed since its last run, in two rounds."""
    part, table, ckpt = (scratch_path(spark, x) for x in ("weather_partitioned", "inventory", "inventory-ckpt"))
    rows, _ = materialise(S.with_date_str(S.weather_readings(spark, root)).drop("date_str"), "weather")
    listed = []
    for half in (0, 1):
        write_by_date(rows.filter(F.dayofmonth("date") % 2 == half), part)
        q = inventory_stream(spark, part, table, ckpt, glob="*.csv")
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(str(q.exception()))
        listed.append(read_inventory(spark, table).count())
    if list_objects(spark, part, "*.csv").count() != listed[1]:
        raise RuntimeError("an object was listed twice or not at all")
    return dates_from_keys(read_inventory(spark, table))


def q_enrich_two_datasets(spark, root):
    """Pollution and weather, partitioned by date, enriched in one run with one strict lookup."""
    parts = [scratch_path(spark, x) for x in ("pollution-by-date", "weather-by-date")]
    outs = [scratch_path(spark, x) for x in ("pollution-enriched", "weather-enriched")]
    cols = [c.split()[0] for c in POLLUTION_LANDED.split(", ")]
    write_by_date(S.with_date_str(S.readings(spark, root)).select(*cols, "date"), parts[0])
    write_by_date(S.with_date_str(S.weather_readings(spark, root)).drop("date_str"), parts[1])
    lookup = S.visitor_lookup(spark, root, city=S.TOTAL_ENTRY, on_missing="error")
    enrich_datasets(spark, dict(zip(parts, outs)), lookup, schemas={parts[0]: POLLUTION_LANDED, parts[1]: WEATHER_LANDED})
    count = lambda path, name: read_partitioned(spark, path).groupBy(
        F.lit(name).alias("dataset"), "date_str", F.col("tourist_estimate").cast("int").alias("tourist_estimate")).agg(F.count(F.lit(1)).alias("n"))
    return count(outs[0], "pollution").unionByName(count(outs[1], "weather"))


def q_notification_ledger_stream(spark, root):
    """Queue messages landed as text files, drained by the streaming ledger, ledger read back."""
    src, ledger, ck = (scratch_path(spark, "queue"), scratch_path(spark, "ledger"),
                       scratch_path(spark, "ledger-ckpt"))
    notification_messages(spark, root).select("value").write.text(src)
    q = ledger_stream(spark, src, ledger, ck, prefixes=WATCHED)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return read_ledger(spark, ledger)


def _odd_stream(spark, root) -> tuple[str, str]:
    """(queue, ledger): odd messages drained by the stream, then all of them delivered once more."""
    src, ledger = scratch_path(spark, "odd-queue"), scratch_path(spark, "odd-ledger")
    odd_messages(spark, root).select("value").write.text(src)
    for n in (1, 2):  # a fresh checkpoint: every message comes again
        q = ledger_stream(spark, src, ledger, scratch_path(spark, f"odd-ckpt-{n}"), prefixes=WATCHED, keys=("file_name",))
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(str(q.exception()))
    return src, ledger


def q_stream_odd_ledger(spark, root):
    """The ledger of the odd messages, delivered twice; without eventTime the file's landing time holds."""
    src, ledger = _odd_stream(spark, root)
    landed = spark.read.text(src).select(utc_text("_metadata.file_modification_time").alias("timestamp")).distinct()
    rows = read_ledger(spark, ledger).join(landed.withColumn("landed", F.lit(True)), "timestamp", "left")
    return rows.select("file_name", F.when(F.col("landed"), "landing time").otherwise(F.col("timestamp")).alias("timestamp"), "status")


def q_stream_odd_dead_letters(spark, root):
    """Their dead letters, committed with the ledger rows: each once, though delivered twice."""
    _, ledger = _odd_stream(spark, root)
    raw = F.when(F.col("body").rlike("^(\\{oops|no JSON)"), F.col("body"))
    return read_dead_letters(spark, ledger).groupBy("malformed", F.element_at(F.split("key", "/"), -1).alias("file_name"), raw.alias("raw")) \
        .agg(F.sum("copies").cast("bigint").alias("n"))


LEDGER_BATCHES = 10


def q_ledger_many_batches(spark, root):
    """Notifications applied in batches, of which the first ones are folded meanwhile: the last row of each file."""
    recs = parse_notifications(notification_messages(spark, root), keep=("page_id",))
    good, _dead = split_poison(select_notices(recs, WATCHED))
    rows, _ = materialise(good.select("file_name", F.col("event_time").alias("timestamp"), F.lit(0).alias("status"), "page_id"), "notices")
    ledger = scratch_path(spark, "ledger-batches")
    # in the order of the times, which grow with the page id
    last = rows.agg(F.max("page_id")).first()[0] or 0
    step = last // LEDGER_BATCHES + 1
    for n in range(LEDGER_BATCHES):
        part = rows.filter((F.col("page_id") >= n * step) & (F.col("page_id") < (n + 1) * step))
        upsert_ledger(part, ledger, ("file_name",), ("timestamp", "page_id"))
    return read_ledger(spark, ledger)


def q_notification_ledger(spark, root):
    recs = parse_notifications(notification_messages(spark, root), keep=("page_id",))
    good, _dead = split_poison(select_notices(recs, WATCHED))
    return good.select("page_id", "file_name", F.col("event_time").alias("timestamp"),
                       F.lit(0).alias("status"))


def q_ledger_last_wins(spark, root):
    recs = parse_notifications(notification_messages(spark, root), keep=("page_id",))
    good, _dead = split_poison(select_notices(recs, WATCHED))
    rows = good.select("file_name", F.col("event_time").alias("timestamp"),
                       F.lit(0).alias("status"), "page_id")
    return last_wins(rows, ["file_name"], ["timestamp", "page_id"], ["timestamp", "status"])


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "exposure_per_city": q_exposure_per_city,
    "exposure_per_city_on_day": q_exposure_per_city_on_day,
    "exposure_per_country": q_exposure_per_country,
    "exposure_per_country_on_day": q_exposure_per_country_on_day,
    "top_exposed_days": q_top_exposed_days,
    "exposure_weather_corr": q_exposure_weather_corr,
    "hourly_weather": q_hourly_weather,
    "daily_weather": q_daily_weather,
    "dedup_key_variants": q_dedup_key_variants,
    "first_match_lookup": q_first_match_lookup,
    "enrich_left": q_enrich_left,
    "enrich_weather": q_enrich_weather,
    "enrich_strict": q_enrich_strict,
    "union_distinct_dates": q_union_distinct_dates,
    "all_dates_count": q_all_dates_count,
    "lookup_with_status": q_lookup_with_status,
    "normalise_readings": q_normalise_readings,
    "quality_profile": q_quality_profile,
    "partition_job_profile": q_partition_job_profile,
    "bad_rows": q_bad_rows,
    "nano_to_date_edges": q_nano_to_date_edges,
    "enrich_incremental_day": q_enrich_incremental_day,
    "exposure_per_city_local_day": q_exposure_per_city_local_day,
    "lookup_exact": q_lookup_exact,
    "lookup_problems": q_lookup_problems,
    "enriched_catalog_table": q_enriched_catalog_table,
    "url_keys_special": q_url_keys_special,
    "copied_objects": q_copied_objects,
    "ordered_dates": q_ordered_dates,
    "notification_dead_letters": q_notification_dead_letters,
    "notification_accounting": q_notification_accounting,
    "valid_dates": q_valid_dates,
    "nano_to_date": q_nano_to_date,
    "partition_roundtrip": q_partition_roundtrip,
    "normalise_weather_files": q_normalise_weather_files,
    "partition_job": q_partition_job,
    "enrich_partitioned_files": q_enrich_partitioned_files,
    "first_non_empty": q_first_non_empty,
    "prefix_remap": q_prefix_remap,
    "graft_keys": q_graft_keys,
    "url_keys": q_url_keys,
    "notification_ledger": q_notification_ledger,
    "notification_ledger_stream": q_notification_ledger_stream,
    "api_dates_from_keys": q_api_dates_from_keys,
    "ledger_last_wins": q_ledger_last_wins,
    "quarantine_accounting": q_quarantine_accounting,
    "quarantine_reasons": q_quarantine_reasons,
    "quarantine_reload": q_quarantine_reload,
    "enrich_relanded_file": q_enrich_relanded_file,
    "full_copy_csv": q_full_copy_csv,
    "catalog_days": q_catalog_days,
    "stream_odd_ledger": q_stream_odd_ledger,
    "stream_odd_dead_letters": q_stream_odd_dead_letters,
    "ledger_many_batches": q_ledger_many_batches,
    "corr_all_cities": q_corr_all_cities,
    "exposure_maintained": q_exposure_maintained,
    "api_dates_incremental": q_api_dates_incremental,
    "enrich_two_datasets": q_enrich_two_datasets,
}


# ------------------------------------------------------------------ oracle

_K = "CAST(TRY_CAST(json_extract_string(e.props, '$.k') AS INTEGER) AS DOUBLE)"

_CTE = f"""
geo AS (
  SELECT c.c_custkey, c.c_mktsegment || ', ' || n.n_name || ', ' || r.r_name AS location_name,
         n.n_name
  FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
                  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey),
ev AS (SELECT e.*, {_K} AS k FROM events e),
readings AS (
  SELECT ev.event_id, ev.ts, ev.user_id, ev.event_type,
         strftime(ev.ts, '%Y-%m-%d %H:%M:%S') AS time_date, g.location_name,
         ev.value AS measurement_pm10Atmo, ev.k AS measurement_pm25Atmo,
         CASE WHEN ev.event_type <> 'error' THEN ev.value + ev.k END AS measurement_pm100Atmo
  FROM ev LEFT JOIN geo g ON ev.user_id = g.c_custkey),
clicks AS (
  SELECT strftime(CAST(e.ts AS DATE), '%Y-%m-%d') AS date_str, g.n_name, e.user_id
  FROM events e JOIN geo g ON e.user_id = g.c_custkey WHERE e.event_type = 'click'),
lookup AS (
  SELECT d.date_str, l.tourist_estimate
  FROM (SELECT DISTINCT date_str FROM clicks) d
  LEFT JOIN (SELECT date_str, CAST(count(DISTINCT user_id) AS INTEGER) AS tourist_estimate
             FROM clicks WHERE lower(n_name) = 'nation_7' GROUP BY date_str) l
    ON d.date_str = l.date_str),
pollution AS (
  SELECT r.*, strftime(CAST(r.ts AS DATE), '%Y-%m-%d') AS date_str, l.tourist_estimate
  FROM readings r LEFT JOIN lookup l ON strftime(CAST(r.ts AS DATE), '%Y-%m-%d') = l.date_str),
base3 AS (
  SELECT DISTINCT CAST(substr(time_date, 1, 10) AS DATE) AS day, location_name AS city,
         measurement_pm10Atmo, measurement_pm25Atmo, measurement_pm100Atmo, tourist_estimate
  FROM pollution),
per_city AS (
  SELECT day, city,
         sum(coalesce(measurement_pm10Atmo, 0) * tourist_estimate) AS p10,
         sum(coalesce(measurement_pm25Atmo, 0) * tourist_estimate) AS p25,
         sum(coalesce(measurement_pm100Atmo, 0) * tourist_estimate) AS p100
  FROM base3 GROUP BY day, city),
weather AS (
  SELECT strftime(date_trunc('hour', ev.ts), '%Y-%m-%d %H:%M:%S') AS time_date, g.location_name,
         sqrt(ev.value) AS weather_wind_speed,
         CASE WHEN ev.event_type <> 'error' THEN ev.k / 7.0 END AS weather_precipitation,
         CAST(ev.user_id AS VARCHAR) || ' - ' || g.location_name AS name,
         (ev.k - 30) / 2.0 AS weather_temperature, ev.ts
  FROM ev LEFT JOIN geo g ON ev.user_id = g.c_custkey),
daily_w AS (
  SELECT day, city, avg(wh) AS avg_wind_speed, sum(coalesce(ph, 0)) AS total_precipitation
  FROM (SELECT CAST(substr(time_date, 1, 10) AS DATE) AS day, location_name AS city,
               substr(time_date, 12, 8) AS hh, avg(weather_wind_speed) AS wh,
               avg(weather_precipitation) AS ph
        FROM weather GROUP BY 1, 2, 3)
  GROUP BY day, city)
"""


def _with(body: str) -> str:
    return f"WITH {_CTE}\n{body}"


_COUNTRY = "trim(string_split(city, ',')[-1])"

_NOTICES = f"""
WITH n AS (
  SELECT page_id,
         regexp_extract(url, '^[a-z]+://[^/]+/([^?#]*)', 1) AS raw_key,
         strftime(TIMESTAMP '{NOTICE_EPOCH}' + to_seconds(page_id), '%Y-%m-%dT%H:%M:%SZ') AS ts
  FROM pages),
d AS (SELECT page_id, url_decode(replace(raw_key, '+', ' ')) AS key, ts FROM n),
f AS (SELECT page_id, key, string_split(key, '/')[-1] AS file_name, ts FROM d
      WHERE (starts_with(key, 'en/') OR starts_with(key, 'fr/') OR starts_with(key, 'de/'))
        AND string_split(key, '/')[-1] <> '' AND string_split(key, '/')[-1] <> 'dlq-test.txt')
"""

_ODD = """
WITH r AS (
  SELECT page_id, page_id % 10 AS d, regexp_extract(url, '^[a-z]+://[^/]+/([^?#]*)', 1) AS raw_key FROM pages),
m AS (SELECT *, url_decode(replace(raw_key, '+', ' ')) AS key FROM r)
"""

_PROFILE = f"""
SELECT count(*) AS row_count, count(DISTINCT event_type || '-' || event_id % {LANDED_PIECES}) AS file_count,
       count(*) FILTER (WHERE ts IS NULL OR event_id % 7 = 0 OR event_id % 11 = 0) AS null_date_count,
       count(*) FILTER (WHERE event_id % 13 = 0) AS bad_row_count
FROM events"""

ORACLE: dict[str, str] = {
    "exposure_per_city": _with("""
SELECT day, city, round(p10, 6) AS pollution_total_visitor_pm10,
       round(p25, 6) AS pollution_total_visitor_pm25, round(p100, 6) AS pollution_total_visitor_pm100
FROM per_city ORDER BY city NULLS LAST"""),
    "exposure_per_city_on_day": _with(f"""
SELECT day, city, round(p10, 6) AS pollution_total_visitor_pm10,
       round(p25, 6) AS pollution_total_visitor_pm25, round(p100, 6) AS pollution_total_visitor_pm100
FROM per_city WHERE day = DATE '{REPORT_DAY}' ORDER BY city NULLS LAST"""),
    "exposure_per_country": _with(f"""
SELECT day, {_COUNTRY} AS country,
       round(sum(p10) / nullif(count(DISTINCT city), 0), 6) AS pollution_total_visitor_country_pm10,
       round(sum(p25) / nullif(count(DISTINCT city), 0), 6) AS pollution_total_visitor_country_pm25,
       round(sum(p100) / nullif(count(DISTINCT city), 0), 6) AS pollution_total_visitor_country_pm100
FROM per_city GROUP BY day, {_COUNTRY}"""),
    "exposure_per_country_on_day": _with(f"""
SELECT day, {_COUNTRY} AS country,
       round(sum(p10) / nullif(count(DISTINCT city), 0), 6) AS pollution_total_visitor_country_pm10,
       round(sum(p25) / nullif(count(DISTINCT city), 0), 6) AS pollution_total_visitor_country_pm25,
       round(sum(p100) / nullif(count(DISTINCT city), 0), 6) AS pollution_total_visitor_country_pm100
FROM per_city WHERE day = DATE '{REPORT_DAY}' GROUP BY day, {_COUNTRY}"""),
    "top_exposed_days": _with(f"""
SELECT day, city, round(p25, 6) AS pollution_total_visitor_pm25
FROM per_city WHERE city = '{S.TARGET_LOCATION}'
ORDER BY p25 DESC NULLS LAST, day LIMIT 10"""),
    "exposure_weather_corr": _with(f"""
, pp AS (
  SELECT day, city, sum(coalesce(measurement_pm25Atmo, 0) * tourist_estimate) AS e
  FROM (SELECT DISTINCT CAST(substr(time_date, 1, 10) AS DATE) AS day, location_name AS city,
               measurement_pm25Atmo, tourist_estimate FROM pollution)
  GROUP BY day, city),
j AS (SELECT p.e, w.avg_wind_speed, w.total_precipitation
      FROM pp p JOIN daily_w w ON p.day = w.day AND p.city = w.city
      WHERE p.city = '{S.TARGET_LOCATION}')
SELECT CASE WHEN isfinite(corr(e, avg_wind_speed)) THEN round(corr(e, avg_wind_speed), 8) END
         AS corr_exposure_wind,
       CASE WHEN isfinite(corr(e, total_precipitation)) THEN round(corr(e, total_precipitation), 8) END
         AS corr_exposure_rain
FROM j"""),
    "hourly_weather": _with("""
SELECT CAST(substr(time_date, 1, 10) AS DATE) AS day, location_name AS city,
       substr(time_date, 12, 8) AS hh_mm_ss,
       round(avg(weather_wind_speed), 6) AS weather_wind_speed_hourly,
       round(avg(weather_precipitation), 6) AS weather_precipitation_hourly
FROM weather GROUP BY 1, 2, 3"""),
    "daily_weather": _with("""
SELECT day, city, round(avg_wind_speed, 6) AS avg_wind_speed,
       round(total_precipitation, 6) AS total_precipitation
FROM daily_w"""),
    "dedup_key_variants": _with("""
SELECT 'pm10_pm25_pm100' AS key_set, count(*) AS distinct_rows FROM base3
UNION ALL
SELECT 'pm25' AS key_set, count(*) AS distinct_rows FROM (
  SELECT DISTINCT CAST(substr(time_date, 1, 10) AS DATE) AS day, location_name AS city,
         measurement_pm25Atmo, tourist_estimate FROM pollution)"""),
    "first_match_lookup": _with("SELECT date_str, tourist_estimate FROM lookup"),
    "enrich_left": _with("SELECT event_id, date_str, tourist_estimate FROM pollution"),
    "enrich_weather": _with("""
SELECT w.name, w.time_date, strftime(CAST(w.ts AS DATE), '%Y-%m-%d') AS date_str, l.tourist_estimate
FROM weather w LEFT JOIN lookup l ON strftime(CAST(w.ts AS DATE), '%Y-%m-%d') = l.date_str"""),
    "enrich_strict": _with("""
SELECT r.event_id, strftime(CAST(r.ts AS DATE), '%Y-%m-%d') AS date_str, t.tourist_estimate
FROM readings r JOIN (SELECT date_str, CAST(count(DISTINCT user_id) AS INTEGER) AS tourist_estimate
                      FROM clicks GROUP BY date_str) t
  ON strftime(CAST(r.ts AS DATE), '%Y-%m-%d') = t.date_str"""),
    "union_distinct_dates": """
SELECT CAST(ts AS DATE) AS date FROM events WHERE ts IS NOT NULL
UNION
SELECT CAST(o_orderdate AS DATE) AS date FROM orders WHERE o_orderdate IS NOT NULL""",
    "all_dates_count": """
SELECT date, count(*) AS n FROM (
  SELECT CAST(ts AS DATE) AS date FROM events
  UNION ALL
  SELECT CAST(o_orderdate AS DATE) AS date FROM orders) GROUP BY date""",
    "lookup_with_status": """
WITH d AS (SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN NULL WHEN doc_id % 11 = 0 THEN '  ' ELSE source END AS source FROM documents),
l AS (SELECT doc_id, CASE WHEN doc_id % 5 <> 0 THEN quality END AS quality FROM labels)
SELECT d.doc_id, d.source AS city,
  CASE WHEN d.source IS NULL OR trim(d.source) = '' THEN 400
       WHEN l.doc_id IS NULL OR l.quality IS NULL THEN 502 ELSE 200 END AS statusCode,
  CASE WHEN d.source IS NULL OR trim(d.source) = '' THEN '{"message":"City is required"}'
       WHEN l.doc_id IS NULL THEN '{"message":"Could not reach weather service"}'
       WHEN l.quality IS NULL THEN '{"message":"Weather service response missing temperature field"}'
       ELSE CAST(to_json(struct_pack(city := trim(d.source),
                                     temperature := CAST(l.quality AS DOUBLE))) AS VARCHAR) END AS body
FROM d LEFT JOIN l ON d.doc_id = l.doc_id""",
    "normalise_readings": _with("""
SELECT name, strftime(CAST(time_date AS TIMESTAMP), '%Y-%m-%dT%H:%M:%S') AS datetime_iso,
       weather_temperature AS temperature_c, weather_wind_speed * 3.6 AS wind_speed_kmh
FROM weather"""),
    "quality_profile": _PROFILE,
    "partition_job_profile": _PROFILE,
    "bad_rows": """
SELECT event_id, CAST(NULL AS DOUBLE) AS amount, true AS kept FROM events WHERE event_id % 13 = 0""",
    "nano_to_date_edges": """
WITH e AS (
  SELECT event_id, (epoch_us(date_trunc('day', ts)) * 1000 - CASE event_id % 3 WHEN 0 THEN 1 WHEN 1 THEN 100 ELSE 128 END)
                   * CASE WHEN event_id % 2 = 0 THEN 1 ELSE -1 END AS time_nano FROM events)
SELECT event_id, time_nano,
       CAST(make_timestamp((time_nano - ((time_nano % 1000) + 1000) % 1000) // 1000) AS DATE) AS utc_date FROM e""",
    "enrich_incremental_day": _with(f"""
SELECT event_id, date_str, CASE WHEN date_str <> '{REPORT_DAY}' THEN tourist_estimate
                                WHEN date_str IN (SELECT date_str FROM lookup) THEN coalesce(tourist_estimate, 0) + 1000 END
         AS tourist_estimate FROM pollution"""),
    "exposure_per_city_local_day": _with(f"""
, b AS (
  SELECT DISTINCT CAST(ts + INTERVAL {LOCAL_HOURS} HOUR AS DATE) AS day, location_name AS city,
         measurement_pm10Atmo, measurement_pm25Atmo, measurement_pm100Atmo, tourist_estimate FROM pollution)
SELECT day, city, round(sum(coalesce(measurement_pm10Atmo, 0) * tourist_estimate), 6) AS pollution_total_visitor_pm10,
       round(sum(coalesce(measurement_pm25Atmo, 0) * tourist_estimate), 6) AS pollution_total_visitor_pm25,
       round(sum(coalesce(measurement_pm100Atmo, 0) * tourist_estimate), 6) AS pollution_total_visitor_pm100
FROM b WHERE day = DATE '{REPORT_DAY}' GROUP BY day, city"""),
    "lookup_exact": _with("""
SELECT date_str, CASE WHEN day(CAST(date_str AS DATE)) % 2 = 0 THEN 12 ELSE tourist_estimate END AS tourist_estimate
FROM lookup"""),
    "lookup_problems": _with("""
, d AS (SELECT tourist_estimate AS e, day(CAST(date_str AS DATE)) AS d FROM lookup)
SELECT count(*) + count(*) FILTER (WHERE d % 2 = 0) + count(*) FILTER (WHERE d % 5 = 0) + count(*) FILTER (WHERE d % 3 = 0)
         AS responses,
       count(*) FILTER (WHERE d % 5 = 0) AS bad_dates, count(*) FILTER (WHERE e IS NULL) AS city_missing,
       count(*) FILTER (WHERE d % 3 = 0) AS bad_estimates,
       count(*) FILTER (WHERE d % 2 = 0) + count(*) FILTER (WHERE d % 3 = 0) AS repeated_dates FROM d"""),
    "enriched_catalog_table": """
SELECT CAST(ts AS DATE) AS date, count(*) AS n, count(*) FILTER (WHERE event_type <> 'error') AS measured
FROM events GROUP BY 1""",
    "url_keys_special": """
SELECT page_id, replace(url_encode(trim(' a~b*c-d_e.f ' || page_id || '+ș%/')), '%20', '+') AS encoded,
       'x y ' || page_id || 'ș/100%' AS decoded, rtrim(url, '/') AS stripped FROM pages""",
    "copied_objects": f"""
SELECT count(*) AS copied, 'Copied ' || count(*) || ' objects' AS message
FROM pages WHERE starts_with(url, '{REMAP_SRC}') AND url <> '{REMAP_SRC}'""",
    "ordered_dates": """
SELECT date, strftime(date, '%Y-%m-%d') AS date_str FROM (
  SELECT CAST(ts AS DATE) AS date FROM events WHERE ts IS NOT NULL
  UNION
  SELECT CAST(o_orderdate AS DATE) AS date FROM orders WHERE o_orderdate IS NOT NULL) ORDER BY date""",
    "notification_dead_letters": _ODD + """
SELECT page_id, d <> 0 AS malformed, CASE WHEN d = 0 THEN 'dlq-test.txt' WHEN d = 3 THEN string_split(key, '/')[-1] END AS file_name,
       CASE d WHEN 1 THEN '{oops' || page_id WHEN 7 THEN 'no JSON ' || page_id END AS raw, true AS raw_kept
FROM m WHERE d IN (0, 1, 2, 3, 4, 5, 7)""",
    "notification_accounting": _ODD + """
SELECT outcome, count(*) AS n FROM (
  SELECT CASE WHEN d IN (0, 1, 2, 3, 4, 5, 7) THEN 'dead'
              WHEN (starts_with(key, 'en/') OR starts_with(key, 'fr/') OR starts_with(key, 'de/'))
                   AND string_split(key, '/')[-1] <> '' THEN 'ledger' ELSE 'ignored' END AS outcome FROM m)
GROUP BY outcome""",
    "valid_dates": """
SELECT DISTINCT strftime(ts, '%Y-%-m-%-d') AS raw, strftime(ts, '%Y-%m-%d') AS date_str FROM events""",
    "nano_to_date": f"""
SELECT event_id, epoch_us(ts) * 1000 AS time_nano,
       CAST(timezone('{NANO_ZONE}', timezone('UTC', ts)) AS DATE) AS local_date
FROM events""",
    "normalise_weather_files": _with("""
SELECT name, strftime(CAST(time_date AS TIMESTAMP), '%Y-%m-%dT%H:%M:%S') AS datetime_iso,
       weather_temperature AS temperature_c, weather_wind_speed * 3.6 AS wind_speed_kmh
FROM weather"""),
    "partition_job": _with("""
SELECT CAST(time_date[:10] AS DATE) AS date, name, epoch_us(ts) * 1000 AS time_nano, time_date,
       round(weather_temperature, 6) AS weather_temperature, round(weather_wind_speed, 6) AS "weather_windSpeed" FROM weather"""),
    "enrich_partitioned_files": _with("SELECT event_id, date_str, tourist_estimate FROM pollution"),
    "partition_roundtrip": _with("""
SELECT CAST(ts AS DATE) AS date, event_id, time_date, location_name, measurement_pm10Atmo, measurement_pm25Atmo,
       measurement_pm100Atmo FROM readings"""),
    "first_non_empty": """
SELECT doc_id, trim(coalesce(nullif(CASE WHEN doc_id % 3 = 0 THEN '' WHEN doc_id % 5 = 0 THEN NULL ELSE lang END, ''),
                             nullif(CASE WHEN doc_id % 9 = 0 THEN '' ELSE ' ' || source END, ''), '')) AS value FROM documents""",
    "prefix_remap": f"""
SELECT url AS key, '{REMAP_DST}' || substr(url, {len(REMAP_SRC) + 1}) AS dest_key,
       string_split(url, '/')[-1] AS file_name
FROM pages WHERE starts_with(url, '{REMAP_SRC}') AND NOT (url = '{REMAP_SRC}' AND ends_with(url, '/'))""",
    "graft_keys": f"""
SELECT url AS key, '{GRAFT_DST}' || regexp_replace(url, '^[^/]*/', '') AS dest_key FROM pages""",
    "url_keys": """
SELECT page_id, url_decode(replace(url, '+', ' ')) AS decoded,
       replace(url_encode(trim(url)), '%20', '+') AS encoded,
       string_split(url, '/')[-1] AS file_name
FROM pages""",
    "notification_ledger_stream": _NOTICES + """
SELECT DISTINCT file_name, ts AS timestamp, 0 AS status FROM f""",
    "api_dates_from_keys": """
SELECT DISTINCT strftime(CAST(ts AS DATE), '%Y-%m-%d') AS date_str FROM events""",
    "notification_ledger": _NOTICES + """
SELECT page_id, file_name, ts AS timestamp, 0 AS status FROM f""",
    "ledger_last_wins": _NOTICES + """
SELECT file_name, max(ts) AS timestamp, 0 AS status FROM f GROUP BY file_name""",
    "quarantine_accounting": f"""
SELECT event_type || '-' || event_id % {LANDED_PIECES} AS piece, count(*) FILTER (WHERE NOT bad) AS accepted,
       count(*) FILTER (WHERE bad) AS rejected
FROM (SELECT *, event_id % 13 = 0 OR (event_id % 11 = 0 AND event_id % 7 <> 0) AS bad FROM events) GROUP BY 1""",
    "quarantine_reasons": """
SELECT event_id, CASE WHEN event_id % 13 = 0 THEN 'amount: no double' ELSE 'time_date: no date' END AS reason, 1::BIGINT AS copies,
       CASE WHEN event_id % 13 = 0 THEN 'much' ELSE CAST(value AS VARCHAR) END AS amount_text
FROM events WHERE event_id % 13 = 0 OR (event_id % 11 = 0 AND event_id % 7 <> 0)""",
    "quarantine_reload": """
SELECT event_id, CASE WHEN event_id % 7 <> 0 THEN CAST(ts AS DATE) END AS date,
       CASE WHEN event_id % 13 = 0 THEN 0.5::DOUBLE ELSE value END AS amount
FROM events WHERE event_id % 11 <> 0 OR event_id % 7 = 0""",
    "enrich_relanded_file": _with(f"""
SELECT event_id, date_str, CASE WHEN date_str <> '{REPORT_DAY}' OR event_id % 2 = 0 THEN tourist_estimate
                                WHEN date_str IN (SELECT date_str FROM lookup) THEN coalesce(tourist_estimate, 0) + 1000 END
         AS tourist_estimate FROM pollution"""),
    "full_copy_csv": _with("""
SELECT event_id, time_date, location_name, measurement_pm10Atmo, measurement_pm25Atmo, measurement_pm100Atmo,
       date_str, tourist_estimate FROM pollution"""),
    "catalog_days": f"""
SELECT CAST(ts AS DATE) AS date, count(*) AS n FROM events WHERE CAST(ts AS DATE) <> DATE '{REPORT_DAY}' GROUP BY 1""",
    "stream_odd_ledger": _ODD + """
SELECT string_split(key, '/')[-1] AS file_name, CASE WHEN bool_or(d = 6) THEN 'landing time' ELSE '2025-11-19T10:00:00Z' END AS timestamp,
       0 AS status
FROM m WHERE d IN (6, 8, 9) AND (starts_with(key, 'en/') OR starts_with(key, 'fr/') OR starts_with(key, 'de/'))
  AND string_split(key, '/')[-1] <> '' GROUP BY 1""",
    "stream_odd_dead_letters": _ODD + """
SELECT d <> 0 AS malformed, CASE WHEN d = 0 THEN 'dlq-test.txt' WHEN d = 3 THEN string_split(key, '/')[-1] END AS file_name,
       CASE d WHEN 1 THEN '{oops' || page_id WHEN 7 THEN 'no JSON ' || page_id END AS raw, count(*) AS n
FROM m WHERE d IN (0, 1, 2, 3, 4, 5, 7) GROUP BY 1, 2, 3""",
    "ledger_many_batches": _NOTICES + """
SELECT file_name, max(ts) AS timestamp, 0 AS status FROM f GROUP BY file_name""",
    "corr_all_cities": _with("""
, pp AS (
  SELECT day, city, sum(coalesce(measurement_pm25Atmo, 0) * tourist_estimate) AS e
  FROM (SELECT DISTINCT CAST(substr(time_date, 1, 10) AS DATE) AS day, location_name AS city,
               measurement_pm25Atmo, tourist_estimate FROM pollution) GROUP BY day, city),
j AS (SELECT p.city, CASE WHEN day(p.day) <= 15 THEN 1 ELSE 2 END AS half, p.e, w.avg_wind_speed AS wind, w.total_precipitation AS rain
      FROM pp p JOIN daily_w w ON p.day = w.day AND p.city = w.city WHERE p.e IS NOT NULL),
l AS (SELECT city, half, e, 'wind' AS against, wind AS y FROM j WHERE wind IS NOT NULL
      UNION ALL SELECT city, half, e, 'rain', rain FROM j WHERE rain IS NOT NULL),
h AS (SELECT * FROM l UNION ALL SELECT city, 0, e, against, y FROM l)
SELECT city, CAST(half AS INTEGER) AS half, against, count(*) AS days,
       CASE WHEN count(*) > 2 AND min(e) < max(e) AND min(y) < max(y) THEN round(corr(e, y), 8) END AS corr
FROM h GROUP BY city, half, against"""),
    "exposure_maintained": _with(f"""
, b AS (
  SELECT DISTINCT CAST(substr(time_date, 1, 10) AS DATE) AS day, location_name AS city, measurement_pm10Atmo, measurement_pm25Atmo,
         measurement_pm100Atmo, CASE WHEN date_str = '{REPORT_DAY}' THEN coalesce(tourist_estimate, 0) + 1000 ELSE tourist_estimate END AS t
  FROM pollution)
SELECT day, city, round(sum(coalesce(measurement_pm10Atmo, 0) * t), 6) AS pollution_total_visitor_pm10,
       round(sum(coalesce(measurement_pm25Atmo, 0) * t), 6) AS pollution_total_visitor_pm25,
       round(sum(coalesce(measurement_pm100Atmo, 0) * t), 6) AS pollution_total_visitor_pm100
FROM b GROUP BY day, city"""),
    "api_dates_incremental": """
SELECT DISTINCT strftime(CAST(ts AS DATE), '%Y-%m-%d') AS date_str FROM events""",
    "enrich_two_datasets": _with("""
, t AS (SELECT date_str, CAST(count(DISTINCT user_id) AS INTEGER) AS tourist_estimate FROM clicks GROUP BY date_str),
r AS (SELECT strftime(CAST(ts AS DATE), '%Y-%m-%d') AS date_str, count(*) AS n FROM readings GROUP BY 1)
SELECT dataset, r.date_str, t.tourist_estimate, r.n
FROM r JOIN t ON r.date_str = t.date_str, (VALUES ('pollution'), ('weather')) AS d(dataset)"""),
}
