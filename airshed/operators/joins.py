"""Lookup joins.

A side is broadcast only after its size is proven.  A derived side is
materialised once in the shared checkpoint folder (lineage cut, survives
executor loss), with its rows and bytes observed during that write; a plain
table scan is ruled out by its file sizes or else counted in place.  Above
either bound the join stays a shuffle join, where AQE splits
skewed partitions of the large side.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airshed.functions import strip_ws
from airshed.session import scratch_path

# Default ceilings for a broadcast side: one row per calendar day for
# thousands of years, or a country/region dimension, fits far below them.
MAX_BROADCAST_ROWS = 2_000_000
MAX_BROADCAST_BYTES = 256 * 1024 * 1024


def _row_bytes(df: DataFrame) -> Column:
    """Bytes of a row: text by its length, nested values by their JSON, 8 for anything else."""
    def size(f: T.StructField) -> Column:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            return F.coalesce(F.octet_length(c), F.lit(0))
        if isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType)):
            return F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0))
        return F.lit(8)

    return sum((size(f).cast("long") for f in df.schema.fields), F.lit(0).cast("long"))


def materialise(df: DataFrame, name: str = "side") -> tuple[DataFrame, int]:
    """Write ``df`` as Parquet below the shared checkpoint folder; return (re-read, rows).

    The row count is observed while writing (no second job), the re-read
    plan has no lineage back to the inputs, and the files survive the loss
    of any executor.
    """
    stored, n, _ = _materialise_sized(df, name)
    return stored, n


def _materialise_sized(df: DataFrame, name: str = "side") -> tuple[DataFrame, int, int]:
    spark = df.sparkSession
    path = scratch_path(spark, name)
    obs = Observation(f"{name}-rows")
    df.observe(obs, F.count(F.lit(1)).alias("rows"),
               F.coalesce(F.sum(_row_bytes(df)), F.lit(0)).alias("bytes")).write.parquet(path)
    m = obs.get
    # the schema is known: re-reading needs no footer-inference job
    return spark.read.schema(df.schema).parquet(path), int(m["rows"]), int(m["bytes"])


def _on_disk(df: DataFrame) -> int:
    """Bytes of the files (or rows) a plan reads, from their metadata: no job."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))


def _size(*dfs: DataFrame) -> tuple[int, int]:
    """Total (rows, bytes): partial aggregates, one row per task is shuffled."""
    parts = [d.select(_row_bytes(d).alias("b")) for d in dfs]
    r = reduce(DataFrame.unionByName, parts).agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("b"), F.lit(0)).alias("b")).first()
    return int(r.n), int(r.b)


def bounded_broadcast(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS,
                      materialise_side: bool = True,
                      max_bytes: int = MAX_BROADCAST_BYTES) -> tuple[DataFrame, bool]:
    """Return ``(side, small)``; ``side`` is broadcast-hinted only if it is proven
    to hold at most ``max_rows`` rows and ``max_bytes`` serialized bytes.

    ``materialise_side=True`` writes the side once below the checkpoint
    folder and observes both measures during that write.
    ``materialise_side=False`` is for sides that are already a cheap, stable
    scan (a dimension table file): files beyond ``max_bytes`` rule it out
    without a job, smaller ones are counted.
    """
    if materialise_side:
        df, n, b = _materialise_sized(df)
    elif _on_disk(df) > max_bytes:
        return df, False
    else:
        n, b = _size(df)
    if n <= max_rows and b <= max_bytes:
        return F.broadcast(df), True
    return df, False


def bounded_broadcast_all(*dfs: DataFrame, max_rows: int = MAX_BROADCAST_ROWS,
                          max_bytes: int = MAX_BROADCAST_BYTES) -> tuple[list[DataFrame], bool]:
    """Check several stable scans with one job: their *total* rows and bytes bound each of them."""
    if sum(map(_on_disk, dfs)) > max_bytes:
        return list(dfs), False
    n, size = _size(*dfs)
    small = n <= max_rows and size <= max_bytes
    return ([F.broadcast(d) for d in dfs] if small else list(dfs)), small


def enrich(df: DataFrame, lookup: DataFrame, on: str = "date_str", mode: str = "left",
           value_col: str = "tourist_estimate", max_rows: int = MAX_BROADCAST_ROWS,
           keys: DataFrame | None = None, unique: bool = False) -> DataFrame:
    """Attach the per-key lookup value to every row.

    ``mode="left"``: unmatched keys get NULL (tolerant mode).
    ``mode="strict"``: any key without a non-NULL value is an error, checked
    eagerly before anything is returned (an in-plan ``raise_error`` would be
    pruned by ``count()``), then the same left join runs.
    ``keys``: a cheaper DataFrame with the same keys, for that check (such as
    the dates of a partition listing), so ``df`` is not computed twice.
    A lookup with two rows for one key is an error: the join would repeat rows.
    ``unique=True`` spares the check for a lookup that is grouped by its key,
    such as ``build_lookup``'s.
    """
    if mode not in ("left", "strict"):
        raise ValueError(f"unknown mode {mode!r}")
    side, _ = bounded_broadcast(lookup.select(on, value_col), max_rows)
    twice = None if unique else \
        side.filter(F.col(on).isNotNull()).groupBy(on).count().filter("count > 1").agg(F.min(on)).first()[0]
    if twice is not None:
        raise ValueError(f"lookup has several rows for {on}={twice}")
    if mode == "strict":
        known = side.filter(F.col(value_col).isNotNull()).select(on)
        wanted = (df if keys is None else keys).select(on).distinct()
        missing = wanted.join(known, on, "left_anti").agg(F.count(F.lit(1)).alias("n"), F.min(on).alias("k")).first()
        if missing.n:
            raise KeyError(f"no estimate for {missing.n} value(s) of {on}, the first is {missing.k}")
    return df.join(side, on, "left")


# Response messages of the validated lookup.
MSG_REQUIRED = "City is required"
MSG_UNREACHABLE = "Could not reach weather service"
MSG_NO_FIELD = "Weather service response missing temperature field"


def lookup_with_status(requests: DataFrame, service: DataFrame, on: str,
                       name_col: str = "city", value_col: str = "temperature",
                       max_rows: int = MAX_BROADCAST_ROWS,
                       materialise_service: bool = False) -> DataFrame:
    """Validated lookup with an HTTP-like status per request.

    * 400 ``City is required`` when the name is NULL or blank;
    * 502 when the service has no row for the request (unreachable) or its
      value is NULL (field missing);
    * 200 with ``{"city": <stripped name>, "temperature": <double>}``.
    Set ``materialise_service`` when ``service`` is an expensive derived plan.
    Output: the request columns + ``statusCode`` + ``body`` (JSON text).
    """
    svc = service.select(F.col(on), F.col(value_col).cast("double").alias("_value"),
                         F.lit(True).alias("_hit"))
    # The service side is usually a table scan that may be large: a shuffle join, which AQE turns
    # into a broadcast where it has measured the side to be small.
    if materialise_service:
        svc, _ = bounded_broadcast(svc, max_rows)
    j = requests.join(svc, on, "left")
    name = strip_ws(F.col(name_col))
    invalid = F.col(name_col).isNull() | (name == "")
    status = (F.when(invalid, F.lit(400))
               .when(F.col("_hit").isNull() | F.col("_value").isNull(), F.lit(502))
               .otherwise(F.lit(200)))
    msg = lambda m: F.to_json(F.struct(F.lit(m).alias("message")))
    body = (F.when(invalid, msg(MSG_REQUIRED))
             .when(F.col("_hit").isNull(), msg(MSG_UNREACHABLE))
             .when(F.col("_value").isNull(), msg(MSG_NO_FIELD))
             .otherwise(F.to_json(F.struct(name.alias("city"), F.col("_value").alias("temperature")))))
    return j.select(*requests.columns, status.alias("statusCode"), body.alias("body"))
