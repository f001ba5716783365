"""Nearest neighbours by collision-counting hashing.

Each vector is hashed by ``HASHES`` random projections, each kept as a sorted array of its own.  Around
a query's projections lie windows of half width ``REACH`` times a radius; virtual rehashing grows the
radius by ``GROWTH``, and only what the windows newly reach is counted.  A vector that lies in the
windows of ``COLLISIONS`` projections is verified by its exact distance.  The search ends when as many
verified vectors as are wanted lie within the radius.

The difference of two vectors at distance s projects to a normal deviate of scale s, so a vector within
the radius falls in a window with probability 0.826 at least, and has the 47 collisions out of 64 asked
for with probability 0.97, whatever the data; farther ones have fewer.

Vectors are indexed in blocks of up to ``BLOCK_ROWS`` rows, every row in one of them; each block is
searched on its own with its own radii, and a query's results of all blocks are merged.  Queries come
in blocks too, of about ``QUERY_ROWS`` rows, which bounds what is broadcast; one pass over the vectors
serves a block.  A block's index (8 bytes a projection and row) is built where it is searched, which
costs less than reading it.

Nulls and edges: rows whose id or vector is null, and vectors that are empty, zero or hold a null or
non-finite component take no part, as queries or candidates; vectors of another length than the query's
are no candidates; rows that share an id are rows of their own, and each is a candidate for the others;
ties go to the smaller id; with fewer candidates than asked for all are returned; an empty table gives
no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from airshed.llm.common import ship_by_value, stored, table

ship_by_value(__name__)

HASHES = 64
REACH = 1.36         # half width of a window, in radii
COLLISIONS = 47
GROWTH = 1.3
RADII = 45           # of a block: from 1/10,000 of its largest spread to 13 times that spread
BLOCK_ROWS = 20_000
QUERY_ROWS = 20_000
SEED = 12


def projections(dim: int) -> np.ndarray:
    return np.random.default_rng([SEED, dim]).standard_normal((dim, HASHES))


class Block:
    """Sorted projections of some vectors (rows of doubles), their row numbers and ids."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray, vectors: np.ndarray):
        self.rows, self.ids, self.vectors = rows, ids, vectors
        self.axes = projections(vectors.shape[1])
        hashed = vectors @ self.axes
        self.order = np.argsort(hashed, axis=0, kind="stable").T.copy()
        self.sorted = np.sort(hashed, axis=0).T.copy()
        spread = max(float((self.sorted[:, -1] - self.sorted[:, 0]).max()), 1e-300)
        self.radii = spread * 1e-4 * GROWTH ** np.arange(RADII)

    def search(self, rows: np.ndarray, queries: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(query's place, ids, distances) of its ``k`` nearest found here."""
        n = len(self.ids)
        hashed = queries @ self.axes
        reach = REACH * self.radii
        lo = np.empty((len(queries), HASHES, RADII), np.int32)
        hi = np.empty_like(lo)
        for j in range(HASHES):
            lo[:, j] = np.searchsorted(self.sorted[j], hashed[:, j, None] - reach)
            hi[:, j] = np.searchsorted(self.sorted[j], hashed[:, j, None] + reach, "right")
        held = (hi - lo).sum(axis=1, dtype=np.int64)
        none = np.zeros(0, np.int64)
        for q in range(len(queries)):
            own = self.rows == rows[q]
            want = min(k, n - int(own.sum()))
            if not want:
                continue
            # ``want`` vectors and the query itself can't collide often enough in smaller windows
            step = int(np.searchsorted(held[q], want * COLLISIONS))
            count = np.zeros(n, np.int64)
            count[own] = -2 * HASHES  # never verified
            left = right = np.zeros(HASHES, np.int32)
            near, dist = np.zeros(0, np.int64), np.zeros(0)
            while True:
                last = step >= RADII
                if last:  # windows hold every vector
                    new = np.flatnonzero((count >= 0) & (count < HASHES + 1))
                else:
                    a, b = lo[q, :, step], hi[q, :, step]
                    if not left.any() and not right.any():
                        left = right = a
                    spans = [(j, *ab) for new in ((a, left), (right, b)) for j, ab in enumerate(zip(*(x.tolist() for x in new)))]
                    count += np.bincount(np.concatenate([self.order[j, x:y] for j, x, y in spans if x < y] or [none]), minlength=n)
                    left, right = a, b
                    new = np.flatnonzero((count >= COLLISIONS) & (count <= HASHES))
                if len(new):
                    count[new] = 4 * HASHES  # verified
                    gap = self.vectors[new] - queries[q]
                    near = np.r_[near, new]
                    dist = np.r_[dist, np.sqrt((gap * gap).sum(axis=1))]
                    best = np.lexsort((self.ids[near], dist))[:want]
                    near, dist = near[best], dist[best]
                if last or (len(near) == want and dist[-1] <= self.radii[step]):
                    break
                step += 1
            yield q, self.ids[near], dist


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v, dim) of the rows that take part."""
    v = F.col(vector_col).cast("array<double>")
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vectors.select(F.col(id_col).cast("long").alias("id"), v.alias("v")) \
        .filter(F.col("id").isNotNull() & F.col("v").isNotNull()) \
        .filter(~bad & F.exists("v", lambda x: x != 0)).withColumn("dim", F.size("v"))


def searched(rows: DataFrame, queries: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]], k: int) -> DataFrame:
    """(query_row, query_id, vec_id, score): ``k`` of each block at most.  ``queries``: (rows, ids,
    vectors) by dimension."""
    held = rows.sparkSession.sparkContext.broadcast(queries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def solve(parts: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
            q_rows, q_ids, q_vectors = held.value[parts[0][2].shape[1]]
            block = Block(*(np.concatenate(x) for x in zip(*parts)))
            for lo in range(0, len(q_ids), 500):
                found = list(block.search(q_rows[lo:lo + 500], q_vectors[lo:lo + 500], k))
                if not found:
                    continue
                place = np.concatenate([np.full(len(i), lo + q) for q, i, _ in found])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(q_rows[place]), pa.array(q_ids[place]), pa.array(np.concatenate([i for _, i, _ in found])),
                     pa.array(np.concatenate([d for *_, d in found]))], ["query_row", "query_id", "vec_id", "score"])

        waiting: dict[int, list] = {}
        for b in batches:
            dims = b.column(3).to_numpy()
            for dim in np.unique(dims).tolist():
                if dim not in held.value:
                    continue
                part = b.filter(pa.array(dims == dim))
                flat = part.column(2).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
                have = waiting.setdefault(dim, [])
                have.append((part.column(0).to_numpy(), part.column(1).to_numpy(), flat))
                if sum(len(p[0]) for p in have) >= BLOCK_ROWS:
                    yield from solve(waiting.pop(dim))
        for parts in waiting.values():
            yield from solve(parts)

    return rows.select("row", "id", "v", "dim").mapInArrow(run, "query_row long, query_id long, vec_id long, score double")


def nearest(vectors: DataFrame, is_query, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of each row for which the condition
    ``is_query`` (of the column ``id``) holds, by Euclidean distance."""
    spark = vectors.sparkSession
    rows = usable(vectors, id_col, vector_col)
    total = rows.count()
    if not total:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    # blocks of about equal size; the number of a row stays, as the table is stored
    rows = rows.repartition(-(-total // BLOCK_ROWS)).withColumn("row", F.monotonically_increasing_id())
    rows = stored(rows, "vectors")
    queries = rows.filter(is_query)
    blocks = -(-queries.count() // QUERY_ROWS)
    dealt = stored(queries.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(max(1, blocks)))), "queries")
    found = []
    for block in range(blocks):  # about QUERY_ROWS queries each
        part = dealt.filter(F.col("block") == block).select("row", "id", "v", "dim").toArrow()
        by_dim = {}
        dims = part.column("dim").to_numpy()
        for dim in np.unique(dims).tolist():
            own = part.filter(pa.array(dims == dim))
            flat = own.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
            by_dim[dim] = (own.column("row").to_numpy(), own.column("id").to_numpy(), flat)
        if by_dim:
            found.append(stored(searched(rows, by_dim, k), f"nearest-{block}"))
    if not found:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    place = F.row_number().over(Window.partitionBy("query_row").orderBy("score", "vec_id"))
    return reduce(DataFrame.unionByName, found).withColumn("rank", place).filter(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")


def op12_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest of every row of ``embeddings`` whose id is divisible by 100."""
    return nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0)


QUERIES = {"op12_nearest_neighbours": op12_nearest_neighbours}
ORACLE: dict[str, str] = {}
