"""Streaming ledger of arriving files.

Queue messages (one JSON document per line, ``{"Records": [{"body": ...}]}``)
land in a folder; ``readStream.text`` picks them up, every micro-batch is
parsed (two ``from_json`` + ``explode``), filtered (watched prefix -> folder
marker -> poison file) and upserted into the keyed ledger.  Ledger rows and dead
letters of a micro-batch are committed by one write, so readers see both or
neither.  The checkpoint is the redelivery boundary: after a failure the batch
is replayed and the idempotent upsert makes the replay harmless (at-least-once
in, exactly-once effect on ledger and dead letters).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airshed.functions import utc_text
from airshed.operators.ledger import (
    POISON_MESSAGE, VALID_PREFIXES, ledger_rows, select_notices, split_poison,
)
from airshed.sinks.ledger import upsert_ledger
from airshed.sources import parse_notifications

DEFAULT_KEYS = ("file_name", "timestamp")


def dead_letters_beside(ledger_path: str) -> str:
    """Where dead letters go when no folder is named."""
    return ledger_path.rstrip("/") + "-dead-letters"


def write_dead_letters(dead: DataFrame, batch_id: int, path: str) -> None:
    """Export of a batch's committed dead letters as JSON lines, for tools that send them again;
    idempotent under replay when the source file is known.

    Rows are partitioned by a hash of the message file they came from and
    written with dynamic partition overwrite: replaying a batch (same or
    fresh checkpoint) rewrites exactly those partitions with the same rows.
    Without a source column they are appended.
    """
    cols = [F.lit(batch_id).alias("batch_id"), "bucket", "key", "event_time", "malformed", "body"]
    if "source" not in dead.columns:
        dead.select(*cols).write.mode("append").json(path)
        return
    (dead.select(*cols, "source", F.xxhash64("source").alias("source_id"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("source_id").json(path))


def process_notice_batch(batch: DataFrame, batch_id: int, ledger_path: str,
                         dead_letter_path: str | None = None,
                         prefixes: Sequence[str] = VALID_PREFIXES, on_poison: str = "route",
                         keys: Sequence[str] = DEFAULT_KEYS) -> None:
    """Apply one micro-batch (also usable on a static DataFrame of messages).

    ``on_poison="route"``: poison files and malformed records go to the
    ledger's dead letters (``read_dead_letters``) with their raw text, in the
    same commit as the rest of the batch; once that is made they are exported
    to the dead-letter folder (``<ledger>-dead-letters`` unless one is named).
    A job that ends between the two replays the batch and exports it then.
    ``on_poison="fail"``: the batch fails before touching the ledger.
    """
    if on_poison not in ("route", "fail"):
        raise ValueError(f"unknown on_poison {on_poison!r}")
    batch = batch.persist()  # parsed twice (good / dead); a micro-batch is bounded
    try:
        keep = tuple(c for c in ("landed_at", "source") if c in batch.columns)
        notices = select_notices(parse_notifications(batch, "value", keep=keep), prefixes)
        good, dead = split_poison(notices)
        letters = None
        if on_poison == "fail":
            hit = dead.select("key", "malformed").limit(1).collect()
            if hit:
                raise RuntimeError(f"{POISON_MESSAGE}: {hit[0]['key'] or 'malformed body'}")
        else:
            source = F.col("source") if "source" in keep else F.lit(None).cast("string")
            letters = dead.withColumns({"batch_id": F.lit(batch_id).cast("long"), "source": source})
        # A record without eventTime is stamped with its landing time (the
        # message file's modification time), which a replay reproduces;
        # "now" would add a new ledger row on every replay.
        default = utc_text("landed_at") if "landed_at" in keep else None
        rows = ledger_rows(good.withColumn("batch_id", F.lit(batch_id)), default)
        upsert_ledger(rows, ledger_path, keys, order=("timestamp", "batch_id", "msg_pos", "rec_pos"), dead=letters)
        if letters is not None:
            write_dead_letters(dead, batch_id, dead_letter_path or dead_letters_beside(ledger_path))
    finally:
        batch.unpersist()


def ledger_stream(spark: SparkSession, source_dir: str, ledger_path: str, checkpoint: str,
                  dead_letter_path: str | None = None, prefixes: Sequence[str] = VALID_PREFIXES,
                  on_poison: str = "route", keys: Sequence[str] = DEFAULT_KEYS,
                  available_now: bool = True, max_files_per_trigger: int = 1000):
    """Start the ledger query; with ``available_now`` it drains what is there and stops."""
    src = (spark.readStream.format("text").option("maxFilesPerTrigger", max_files_per_trigger)
           .load(source_dir)
           .select("value", F.col("_metadata.file_modification_time").alias("landed_at"),
                   F.col("_metadata.file_path").alias("source")))

    def apply(batch: DataFrame, batch_id: int) -> None:
        process_notice_batch(batch, batch_id, ledger_path, dead_letter_path, prefixes,
                             on_poison, keys)

    w = src.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()
