"""Explicit schemas and the column rename map (fixed values)."""

from pyspark.sql import types as T

# Raw weather header, as shipped with the sample reading.
WEATHER_RAW = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("time_nano", T.LongType()),
    T.StructField("time_date", T.StringType()),
    T.StructField("location_latitude", T.DoubleType()),
    T.StructField("location_longitude", T.DoubleType()),
    T.StructField("location_name", T.StringType()),
    T.StructField("weather_temperature", T.DoubleType()),
    T.StructField("weather_feelsLike", T.DoubleType()),
    T.StructField("weather_pressure", T.IntegerType()),
    T.StructField("weather_humidity", T.IntegerType()),
    T.StructField("weather_dewPoint", T.DoubleType()),
    T.StructField("weather_clouds", T.IntegerType()),
    T.StructField("weather_windSpeed", T.DoubleType()),
    T.StructField("weather_windDeg", T.IntegerType()),
])

# Raw header name -> name used by the SQL layer.
RENAMES = {"weather_windSpeed": "weather_wind_speed"}

POLLUTION_MEASURES = ("measurement_pm10Atmo", "measurement_pm25Atmo", "measurement_pm100Atmo")

# Per-day visitor lookup.  The estimate stays nullable: the tolerant builder
# stores None when the city is missing from a response.
LOOKUP = T.StructType([
    T.StructField("date_str", T.StringType(), False),
    T.StructField("tourist_estimate", T.IntegerType(), True),
])

# Estimate API response: {"info": [{"name": ..., "estimated_no_people": ...}]}.
# The count is read as text; it may arrive as a JSON number or string.
ESTIMATE_RESPONSE = T.StructType([
    T.StructField("info", T.ArrayType(T.StructType([
        T.StructField("name", T.StringType()),
        T.StructField("estimated_no_people", T.StringType()),
    ]))),
])

# Object-store notification: queue message {"Records": [{"body": "<json>"}]}.
QUEUE_MESSAGE = T.StructType([
    T.StructField("Records", T.ArrayType(T.StructType([
        T.StructField("body", T.StringType()),
    ]))),
])

NOTIFICATION_BODY = T.StructType([
    T.StructField("Records", T.ArrayType(T.StructType([
        T.StructField("s3", T.StructType([
            T.StructField("bucket", T.StructType([T.StructField("name", T.StringType())])),
            T.StructField("object", T.StructType([T.StructField("key", T.StringType())])),
        ])),
        T.StructField("eventTime", T.StringType()),
    ]))),
])

LEDGER = T.StructType([
    T.StructField("file_name", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("status", T.IntegerType()),
])

# A notification that cannot be applied, with its raw text and its place.
DEAD_LETTER = T.StructType([
    T.StructField("batch_id", T.LongType()),
    T.StructField("source", T.StringType()),
    T.StructField("msg_pos", T.IntegerType()),
    T.StructField("rec_pos", T.IntegerType()),
    T.StructField("bucket", T.StringType()),
    T.StructField("key", T.StringType()),
    T.StructField("event_time", T.StringType()),
    T.StructField("malformed", T.BooleanType()),
    T.StructField("body", T.StringType()),
    T.StructField("copies", T.LongType()),
])

NORMALISED_WEATHER = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("datetime_iso", T.StringType()),
    T.StructField("temperature_c", T.DoubleType()),
    T.StructField("wind_speed_kmh", T.DoubleType()),
])
