"""Sharding by sampled splitters, in DataFrame operations only: shards of nearly equal bytes.

A record's key is (hash of its text, hash of its id, row number): equal texts lie together, and a
key never ties.  The keyed sizes are stored once (no texts), and all steps read that table:

1. Sample: each record is drawn with a probability in proportion to its size plus the mean size,
   so that a range between splitters is bounded in bytes and in rows.
2. Splitters: quantiles of the sampled keys.  A splitter inside a group of equal texts is moved to
   the group's start, unless the group reaches over a whole range by itself.
3. Ranges: every record finds its range by binary search; bytes and rows are counted exactly, and
   ranges over ``OVERFULL`` times the mean in either (the largest record's bytes left out) are sampled
   again and subdivided, until none is left; there too a splitter moves to its group's start, unless
   the group has a whole mean range's weight of draws.
4. Shards: neighbouring ranges, cut where their running bytes are nearest to each shard's share.
   A record's slot is the rows of its shard's earlier ranges plus its place in its range, so no
   task ever sorts a whole shard.

A shard ends at the range end nearest to its share, so its bytes are off the mean by at most one range:
``OVERFULL`` / ``RANGES_PER_SHARD`` of the mean (3.1 %) and the largest record.

The ranges are ``RANGES_PER_SHARD`` for each shard however many rows there are, so what reaches the driver
and the plan (draws, splitters, counts of ranges) depends on the shards only.  A range of a larger table
holds more rows; its sort, of three hashes and two numbers a row, may spill.

Nulls and edges: a null text has size 1 and the empty text's CRC; null ids are hashed as such;
repeated rows are told apart by the row number; more shards than rows leave shards empty; an empty
table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from itertools import accumulate

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from airshed.llm.common import stored, table

SHARDS = 16
RANGES_PER_SHARD = 128
DRAWS_PER_RANGE = 8
OVERFULL = 4
MOST_ROUNDS = 40  # each round cuts every overfull range; more than a few mean a fault
KEY = ("k1", "k2", "k3")


def draw(keyed: DataFrame, share: Column, round_no: int) -> list[tuple[tuple[int, int, int], float]]:
    """Sorted keys of the records whose hash, as a number from 0 to 1, is under ``share``, with the
    weight of each: 1, or the share itself where that is more than a certainty."""
    chance = F.pmod(F.xxhash64(*KEY, F.lit(round_no)), F.lit(1 << 30)) / float(1 << 30)
    found = keyed.filter(chance < share).select(*KEY, F.greatest(share, F.lit(1.0)).alias("w")).collect()
    return sorted((tuple(r[:3]), r.w) for r in found)


def quantiles(drawn: list[tuple[tuple[int, int, int], float]], ranges: int) -> list[tuple[int, int, int]]:
    """At most ranges - 1 splitters at equal weights; a group of equal texts (k1) is cut only if two
    of them fall in it."""
    total, run, cuts = sum(w for _, w in drawn), 0.0, []
    for key, w in drawn:
        if int(run * ranges / total) < int((run + w) * ranges / total) and key != drawn[0][0]:
            cuts.append(key)
        run += w
    low = -(1 << 63)
    out = set()
    for i, c in enumerate(cuts):
        alone = (i == 0 or cuts[i - 1][0] != c[0]) and (i + 1 == len(cuts) or cuts[i + 1][0] != c[0])
        out.add((c[0], low, low) if alone else c)
    return sorted(out)


def subdividing(drawn: list[tuple[tuple[int, int, int], float]]) -> list[tuple[int, int, int]]:
    """Splitters from the draws of overfull ranges, of which a mean range has ``OVERFULL`` times as many
    as at first; a group of equal texts (k1) is cut only if it has as many by itself."""
    weights: dict[int, float] = {}
    for key, w in drawn:
        weights[key[0]] = weights.get(key[0], 0.0) + w
    low = -(1 << 63)
    out, run = [], 0.0
    for key, w in drawn:  # a draw that weighs a mean range's worth is always a splitter
        if int(run / DRAWS_PER_RANGE) < int((run + w) / DRAWS_PER_RANGE):
            out.append(key if weights[key[0]] >= DRAWS_PER_RANGE * OVERFULL else (key[0], low, low))
        run += w
    return out


def range_of(splitters: list[tuple[int, int, int]]) -> Column:
    """The number of splitters that are not above a record's key, by binary search."""
    if not splitters:
        return F.lit(0)
    # three literal arrays, folded once when the query is planned
    k = [F.split(F.lit(",".join(str(s[j]) for s in splitters)), ",").cast("array<bigint>") for j in range(3)]
    at = lambda m: F.struct(*(F.get(a, m).alias(n) for a, n in zip(k, KEY)))
    steps = len(splitters).bit_length()
    start = F.struct(F.lit(0).alias("lo"), F.lit(len(splitters)).alias("hi"))

    def step(s: Column, _: Column) -> Column:
        mid = F.shiftright(s["lo"] + s["hi"], 1)
        open_ = s["lo"] < s["hi"]
        below = at(mid) <= F.struct(*KEY)
        return F.struct(F.when(open_ & below, mid + 1).otherwise(s["lo"]).alias("lo"),
                        F.when(open_ & ~below, mid).otherwise(s["hi"]).alias("hi"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, step, lambda s: s["lo"])


def cut_shards(sizes: list[int], shards: int) -> list[int]:
    """Shard of each range: shards end where the running bytes are nearest to their share of the total."""
    ends = [0, *accumulate(sizes)]
    bounds = []
    for i in range(1, shards):
        goal = ends[-1] * i / shards
        j = bisect_left(ends, goal)
        if j and goal - ends[j - 1] <= ends[j] - goal:
            j -= 1
        bounds.append(j)  # ranges before j belong to earlier shards
    return [bisect_right(bounds, r) for r in range(len(sizes))]


def shard_by_bytes(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text",
                   ranges_per_shard: int = RANGES_PER_SHARD) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, text_crc32, shard, slot."""
    text = F.coalesce(F.col(text_col).cast("binary"), F.lit(b"").cast("binary"))
    keyed = stored(docs.select(
        F.col(id_col).alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
        F.xxhash64(text).alias("k1"), F.xxhash64(id_col).alias("k2"), F.monotonically_increasing_id().alias("k3")), "keyed")
    total = keyed.agg(F.count("*").alias("n"), F.sum("size").alias("b")).first()
    if not total.n:
        return keyed.selectExpr("doc_id", "size", "text_crc32", "0 shard", "0L slot")
    ranges = shards * ranges_per_shard
    weight = (F.col("size") / float(total.b) + 1.0 / total.n) / 2  # sums to 1 over all records
    splitters = quantiles(draw(keyed, weight * ranges * DRAWS_PER_RANGE, 0), ranges)
    most_rows, most_bytes = OVERFULL * total.n / ranges, OVERFULL * total.b / ranges
    for round_no in range(1, MOST_ROUNDS + 2):
        placed = keyed.withColumn("range", range_of(splitters))
        counted = placed.groupBy("range").agg(F.count("*").alias("n"), F.sum("size").alias("b"), F.max("size").alias("m"))
        full = [r.range for r in counted.filter((F.col("n") > 1) & (
            (F.col("n") > most_rows) | (F.col("b") - F.col("m") > most_bytes))).collect()]
        if not full:
            break
        if round_no > MOST_ROUNDS:
            raise RuntimeError(f"{len(full)} ranges are still overfull after {MOST_ROUNDS} rounds")
        more = draw(placed.filter(F.col("range").isin(full)), weight * ranges * DRAWS_PER_RANGE * OVERFULL, round_no)
        splitters = sorted({*splitters, *subdividing(more)})
    placed = stored(keyed.withColumn("range", range_of(splitters)), "ranges")
    counts = {r.range: (r.n, r.b) for r in placed.groupBy("range")
              .agg(F.count("*").alias("n"), F.sum("size").alias("b")).collect()}
    order = sorted(counts)
    shard = cut_shards([counts[r][1] for r in order], shards)
    begin, rows = [], {}
    for r, s in zip(order, shard):
        begin.append(rows.get(s, 0))
        rows[s] = begin[-1] + counts[r][0]
    numbers = keyed.sparkSession.createDataFrame(list(zip(order, shard, begin)), "range int, shard int, begin long")
    place = F.row_number().over(Window.partitionBy("range").orderBy(*KEY))
    return placed.withColumn("place", place).join(numbers, "range") \
        .select("doc_id", "size", "text_crc32", "shard", (F.col("begin") + F.col("place") - 1).alias("slot"))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every row of ``documents``, by the law of equal bytes."""
    out = shard_by_bytes(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


QUERIES = {"op3_sharding": op3_sharding}
ORACLE: dict[str, str] = {}
