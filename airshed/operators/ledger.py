"""Notification ledger: filter chain, dead letters, keyed last-wins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airshed.functions import decode_key, event_time_or, file_name, starts_with_any

# Watched folders and the poison test file.
VALID_PREFIXES = ("pollution/", "sensor/", "weather/")
POISON_FILE = "dlq-test.txt"
POISON_MESSAGE = "Forcing failure for DLQ test"


def select_notices(records: DataFrame, prefixes: Sequence[str] = VALID_PREFIXES) -> DataFrame:
    """Decode keys, keep watched prefixes, drop folder markers (in that order).

    Input: ``parse_notifications`` rows (malformed bodies are passed through
    untouched with ``key`` NULL so they can be dead-lettered).
    """
    key = decode_key("raw_key")
    df = records.withColumn("key", key).withColumn("file_name", file_name(F.col("key")))
    keep = F.col("malformed") | (starts_with_any("key", prefixes) & (F.col("file_name") != ""))
    return df.filter(keep)


def is_poison(poison: str = POISON_FILE) -> Column:
    return F.col("malformed") | (F.col("file_name") == F.lit(poison))


def split_poison(notices: DataFrame, poison: str = POISON_FILE) -> tuple[DataFrame, DataFrame]:
    """(good, dead): poison files and malformed bodies go to the dead-letter side."""
    bad = is_poison(poison)
    return notices.filter(~bad), notices.filter(bad)


def account(records: DataFrame, prefixes: Sequence[str] = VALID_PREFIXES, poison: str = POISON_FILE) -> DataFrame:
    """(outcome, n): what becomes of ``parse_notifications`` rows, each counted once.

    ``dead``: malformed, or the poison file in a watched folder; ``ledger``:
    other files in watched folders; ``ignored``: other folders and markers.
    """
    key = F.coalesce(decode_key("raw_key"), F.lit(""))
    name = file_name(key)
    watched = starts_with_any(key, prefixes) & (name != "")
    outcome = (F.when(F.col("malformed") | (watched & (name == poison)), "dead")
                .when(watched, "ledger").otherwise("ignored"))
    return records.groupBy(outcome.alias("outcome")).agg(F.count(F.lit(1)).alias("n"))


def ledger_rows(good: DataFrame, default_time: Column | None = None) -> DataFrame:
    """``file_name, timestamp, status=0`` plus the arrival order columns."""
    order = [c for c in ("batch_id", "msg_pos", "rec_pos") if c in good.columns]
    return good.select("file_name", event_time_or("event_time", default_time).alias("timestamp"),
                       F.lit(0).alias("status"), *order)


def last_wins(df: DataFrame, keys: Sequence[str], order: Sequence[str],
              value_cols: Sequence[str] | None = None) -> DataFrame:
    """Keep, per key, the values of the row with the greatest ``order`` tuple.

    A grouped ``max_by`` rather than a window: it pre-aggregates per task,
    so a hot key never lands whole in one task.
    """
    value_cols = [c for c in (value_cols or df.columns) if c not in keys]
    best = F.max_by(F.struct(*[F.col(c) for c in value_cols]),
                    F.struct(*[F.col(c) for c in order]))
    return df.groupBy(*keys).agg(best.alias("_v")).select(*keys, *[F.col(f"_v.{c}").alias(c)
                                                                   for c in value_cols])
