"""Keyed ledger (insert-or-replace) and its dead letters, on plain files.

No table format with MERGE is on the classpath.  A batch is written by one Spark
job as one version ``<path>/part=v-<n>/``: Parquet, partitioned by table (``ledger``
or ``dead``) and by a bucket of the key, with the last row per key.  Spark's
``_SUCCESS`` marker commits it, so the ledger rows and the dead letters of a
batch become visible together or not at all; a version without the marker is
unseen and its number is used again.  A reader takes, per key, the row of the
newest version.  Replayed batches (at-least-once sources) append rows that win
over their equals, which leaves both tables as they are.

The bytes a batch writes depend on the batch alone, and it writes to the
buckets of its keys; a read of one key looks into that key's bucket only.  After
``FOLD_AFTER`` versions these are folded into one ``part=fold-<n>/``, and after
as many folds all into one ``part=base-<n>/``, so a read meets at most
2 * FOLD_AFTER + 1 folders, however many batches there were.  What a fold replaces
is deleted by the fold after the next one, so a reader under way keeps
its files.  Single writer per ledger path.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airshed.operators.ledger import last_wins
from airshed.schemas import DEAD_LETTER, LEDGER
from airshed.sources.listing import hadoop_path

BUCKETS = 16      # of the first key column; fixed for all versions of a ledger
FOLD_AFTER = 8
KINDS = ("v", "fold", "base")
TABLES = {"ledger": LEDGER, "dead": DEAD_LETTER}
_COLS = [f.name for f in LEDGER.fields]
# A stored row: the columns of both tables, the key it is replaced by, the version, the two partition levels.
_STORED = T.StructType([
    *LEDGER.fields, *[f for f in DEAD_LETTER.fields if f.name not in _COLS], T.StructField("_key", T.StringType()),
    T.StructField("_version", T.LongType()), T.StructField("_table", T.StringType()), T.StructField("_bucket", T.IntegerType())])


def bucket_of(c) -> Column:
    return F.pmod(F.xxhash64(c), F.lit(BUCKETS)).cast("int")


def _part(path: str, kind: str, number: int) -> str:
    return f"{path.rstrip('/')}/part={kind}-{number:06d}"


def _folders(spark: SparkSession, path: str) -> list[tuple[int, str, str]]:
    """(number, kind, folder) of all committed folders."""
    fs, p, jvm = hadoop_path(spark, path)
    if not fs.exists(p):
        return []
    found = []
    for st in fs.listStatus(p):
        kind, _, n = st.getPath().getName().removeprefix("part=").partition("-")
        if st.isDirectory() and kind in KINDS and n.isdigit() \
                and fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
            found.append((int(n), kind, st.getPath().toString()))
    return sorted(found)


def _current(folders: list[tuple[int, str, str]]) -> list[tuple[int, str, str]]:
    """Those that count: the newest base, the folds after it, the versions after these."""
    base = max((n for n, kind, _ in folders if kind == "base"), default=0)
    fold = max((n for n, kind, _ in folders if kind == "fold" and n > base), default=base)
    return [(n, kind, f) for n, kind, f in folders if (kind == "base" and n == base) or (kind == "fold" and n > base)
            or (kind == "v" and n > fold)]


def _rows(spark: SparkSession, path: str, folders: Sequence[tuple[int, str, str]]) -> DataFrame:
    """Their rows in one scan; filters on ``_table`` and ``_bucket`` prune files."""
    return spark.read.schema(_STORED).option("basePath", path).parquet(*[f for *_, f in folders]).select(*_STORED.names)


def _newest(rows: DataFrame) -> DataFrame:
    return last_wins(rows, ["_table", "_bucket", "_key"], ["_version"])


def _write(rows: DataFrame, folder: str) -> None:
    full = [F.col(f.name) if f.name in rows.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in _STORED.fields]
    (rows.select(*full).hint("rebalance", "_table", "_bucket").write.mode("overwrite")
         .option("partitionOverwriteMode", "static").partitionBy("_table", "_bucket").parquet(folder))


def _read(spark: SparkSession, path: str, table: str, only=None) -> DataFrame:
    names = TABLES[table].names
    found = _current(_folders(spark, path))
    if not found:
        return spark.createDataFrame([], TABLES[table])
    rows = _rows(spark, path, found).filter(F.col("_table") == table)
    if only is not None:
        rows = rows.filter((F.col("_bucket") == bucket_of(F.lit(only))) & (F.col("file_name") == F.lit(only)))
    return _newest(rows).select(*names)


def read_ledger(spark: SparkSession, path: str, file_name: str | None = None) -> DataFrame:
    """The ledger's rows, one per key (empty when nothing was committed); of one file's name, read from its
    bucket alone."""
    return _read(spark, path, "ledger", file_name)


def read_dead_letters(spark: SparkSession, path: str) -> DataFrame:
    """The dead letters committed with the ledger's batches."""
    return _read(spark, path, "dead")


def _keyed(batch: DataFrame, table: str, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row per key, with its key and bucket."""
    order = [c for c in order if c in batch.columns] or list(keys)
    names = TABLES[table].names
    key = F.to_json(F.struct(*[F.col(c) for c in keys]), {"ignoreNullFields": "false"})
    rows = batch.select(*names, *[c for c in order if c not in names], key.alias("_key"))
    return last_wins(rows, ["_key"], order, names).select(*names, "_key").withColumns(
        {"_table": F.lit(table), "_bucket": bucket_of(F.col(keys[0]))})


DEAD_KEYS = ("source", "batch_id", "msg_pos", "rec_pos", "body")


def upsert_ledger(batch: DataFrame, path: str, keys: Sequence[str] = ("file_name", "timestamp"),
                  order: Sequence[str] = ("timestamp",), dead: DataFrame | None = None) -> int:
    """Insert-or-replace ``batch`` rows by ``keys``, and ``dead`` letters with them; returns the new version number.

    The item key of the original store is not known; (file_name, timestamp)
    is the default, ``("file_name",)`` keeps one row per file.  Use the same
    keys for all batches of one ledger; the first one deals the buckets, and
    ``read_ledger`` of one file's name expects it to be ``file_name``.

    Existing rows rank before batch rows; within the batch the greatest
    ``order`` tuple wins.  Output columns follow the ledger schema.  A dead
    letter is known by its message file (its batch where that is not known),
    its place and its text; equal ones are counted in ``copies``.
    """
    spark = batch.sparkSession
    folders = _folders(spark, path)
    number = max((n for n, *_ in folders), default=0) + 1
    rows = _keyed(batch, "ledger", keys, order)
    if dead is not None:
        letters = dead.groupBy(*[c for c in DEAD_LETTER.names if c != "copies"]).agg(F.count(F.lit(1)).alias("copies"))
        # a replay may come under another batch number: where the file is known it does not belong to the key
        letters = letters.withColumn("_batch", F.when(F.col("source").isNull(), F.col("batch_id")))
        keys_ = [c if c != "batch_id" else "_batch" for c in DEAD_KEYS]
        rows = rows.unionByName(_keyed(letters, "dead", keys_, ("batch_id",)), allowMissingColumns=True)
    _write(rows.withColumn("_version", F.lit(number).cast("long")), _part(path, "v", number))
    _fold_when_due(spark, path)
    return number


def _fold(spark: SparkSession, path: str, kind: str, parts: list[tuple[int, str, str]]) -> None:
    _write(_newest(_rows(spark, path, parts)), _part(path, kind, parts[-1][0]))


def _fold_when_due(spark: SparkSession, path: str) -> None:
    """Fold the versions, and in turn the folds, once there are FOLD_AFTER of them."""
    for kind, parts_of in (("fold", ("v",)), ("base", ("base", "fold"))):
        folders = _folders(spark, path)
        parts = [x for x in _current(folders) if x[1] in parts_of]
        if sum(x[1] == parts_of[-1] for x in parts) < FOLD_AFTER:
            return
        gone = [x for x in folders if x not in _current(folders)]  # replaced by an earlier fold
        _fold(spark, path, kind, parts)
        _delete(spark, path, gone)


def _delete(spark: SparkSession, path: str, folders: list[tuple[int, str, str]]) -> None:
    fs, _, jvm = hadoop_path(spark, path)
    for *_, folder in folders:
        fs.delete(jvm.org.apache.hadoop.fs.Path(folder), True)


def compact_ledger(spark: SparkSession, path: str) -> int:
    """Fold everything into one base now, and remove all it replaces (no reader may be under way);
    returns how many folders these were."""
    parts = _current(_folders(spark, path))
    if len(parts) < 2:
        return 0
    # a base of the same number would be read while it is overwritten: only versions and folds end parts
    _fold(spark, path, "base", parts)
    _delete(spark, path, [x for x in _folders(spark, path) if x not in _current(_folders(spark, path))])
    return len(parts)
