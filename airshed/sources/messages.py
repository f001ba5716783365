"""Nested JSON documents: estimate API responses and storage notifications."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airshed.schemas import ESTIMATE_RESPONSE, NOTIFICATION_BODY, QUEUE_MESSAGE


def parse_estimates(df: DataFrame, value_col: str = "response", keep=("date_str",)) -> DataFrame:
    """One row per (response, city entry) with its position in the response."""
    parsed = df.select(*keep, F.from_json(value_col, ESTIMATE_RESPONSE).alias("r"))
    return parsed.select(*keep, F.posexplode("r.info").alias("pos", "entry")).select(
        *keep, "pos", F.col("entry.name").alias("name"),
        F.col("entry.estimated_no_people").alias("estimated_no_people"))


_CORRUPT = "_corrupt"
_PERMISSIVE = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}


def _with_corrupt(schema: T.StructType) -> T.StructType:
    return T.StructType(schema.fields + [T.StructField(_CORRUPT, T.StringType())])


def parse_notifications(df: DataFrame, value_col: str = "value", keep=()) -> DataFrame:
    """Queue messages -> one row per storage record.

    ``Records`` of the message, then the JSON text in each ``body`` and its
    own ``Records``: two ``from_json`` + two ``explode`` (plain explode: a
    message without records contributes nothing, like ``.get(..., [])``).
    ``msg_pos``/``rec_pos`` keep arrival order within a message.
    Each level is parsed once, in permissive mode with a corrupt-record
    column.  Where hand-written code would fail, the row is kept with
    ``malformed = true`` so the caller can dead-letter it: a line or body that
    is not JSON or not shaped like a notification, a message record without
    ``body``, a storage record without ``s3``, bucket name or key.  ``body``
    is the raw text of every row (the whole line where there is no body), so
    a dead letter can be sent again.
    """
    raw = F.col(value_col)
    msgs = df.select(*keep, raw.alias("_raw"),
                     F.from_json(raw, _with_corrupt(QUEUE_MESSAGE), _PERMISSIVE).alias("m"))
    outer_bad = F.col("m." + _CORRUPT).isNotNull() | F.col("_raw").isNull()
    no_body = F.lit(None).cast("string").alias("body")
    records = F.when(outer_bad, F.array(F.struct(no_body))).otherwise(F.col("m.Records"))
    bodies = msgs.select(*keep, "_raw", F.posexplode(records).alias("msg_pos", "rec"))
    parsed = bodies.select(
        *keep, "msg_pos", F.coalesce("rec.body", "_raw").alias("body"), F.col("rec.body").isNull().alias("_no_body"),
        F.from_json(F.col("rec.body"), _with_corrupt(NOTIFICATION_BODY), _PERMISSIVE).alias("b"))
    malformed = F.col("_no_body") | F.col("b." + _CORRUPT).isNotNull()
    parsed = parsed.select(*keep, "msg_pos", "body", malformed.alias("_bad"), "b")
    # A malformed body explodes into a single placeholder record, a good body
    # into its records (none when the array is missing/empty).
    rec_type = NOTIFICATION_BODY["Records"].dataType
    inner = F.when(F.col("_bad"), F.array(F.lit(None).cast(rec_type.elementType))) \
             .otherwise(F.col("b.Records"))
    out = parsed.select(*keep, "msg_pos", "body", F.posexplode(inner).alias("rec_pos", "r"))
    bucket, key = F.col("r.s3.bucket.name"), F.col("r.s3.object.key")
    return out.select(
        *keep, "msg_pos", "rec_pos", bucket.alias("bucket"), key.alias("raw_key"),
        F.col("r.eventTime").alias("event_time"), (bucket.isNull() | key.isNull()).alias("malformed"), "body")
