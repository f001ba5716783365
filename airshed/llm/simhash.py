"""SimHash near-duplicates through Golay-code fuzzy hashing.

A fingerprint has 64 bits, cut into segments of 22, 21 and 21 bits, each a word of the perfect
binary Golay code [23, 12, 7] (missing high bits are 0).  Decoding gives a segment the index of its
nearest codeword, at most 3 bits away.  A word whose nearest codeword is exactly 3 bits away has 5
more codewords 4 bits away; every other word has none.  So two words that differ in at most one bit
always agree as follows: the *nearest* codeword of the one is among the 1 or 6 *nearby* codewords
of the other.

Pigeonhole for at most 3 errors in three segments: either one segment has none and another at most
one, or all three have exactly one.  This gives the keys of a fingerprint:

* for each ordered pair of segments (a, b): a's codeword index and error pattern (that is, the
  segment itself) with b's nearest index on the one side and each nearby index on the other;
* for the case of one error in each: the nearest index of segment 0 with every nearby index of
  segment 1, against every nearby index of segment 0 with the nearest of segment 1.

The keys are joined by sorting each key's fingerprints together; candidates are verified by the
bit distance.  A key's fingerprints yield a spanning forest of their links, not all pairs, so a
group of copies costs rows in proportion to its size; a key with more than ``BLOCK`` entries is
dealt out as pairs of blocks, so no task holds an unbounded group.  Connected components are then
found by alternating large-star and small-star steps over stored edge tables.

Nulls and edges: a null or empty text has no words and fingerprint 0, and links like any other;
repeated rows and ties share a fingerprint; a null doc_id gets its group's smallest id (null when
the group has none).  Extra columns of the input are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airshed.llm.common import ship_by_value, stored, table, unused, utf8

ship_by_value(__name__)

SHINGLE_WORDS = 3
MAX_BITS = 3
SEED = 42
SEGMENTS = ((0, 22), (22, 21), (43, 21))  # first bit, bits
GOLAY_POLY = 0b101011100011               # generator polynomial of the [23, 12, 7] code
BLOCK = 4096                              # entries of one key that a task compares at a time


# ---------------------------------------------------------------- fingerprints

def fingerprint(text: bytes, shingle_words: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """The unsigned 64-bit SimHash of a text's word shingles (A-Z lower-cased, repeats counted)."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) < shingle_words:
        hashes = [xxhash.xxh64_intdigest(joined, seed)]
    else:
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(sizes + 1) - 1
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[s:e], seed)
                  for s, e in zip((ends - sizes).tolist(), ends[shingle_words - 1:].tolist())]
    octets = np.array(hashes, np.uint64).view(np.uint8).reshape(-1, 8)
    ones = np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """(id, text_hash, fp) of every row; fp is the fingerprint as a signed long."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(t.as_py(), shingle_words) for t in b.column(2)], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fp.view(np.int64))],
                                             ["id", "text_hash", "fp"])

    return docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("text_hash"),
                       utf8(text_col).alias("t")).mapInArrow(run, "id long, text_hash long, fp long")


# ---------------------------------------------------------------- Golay code

def syndromes(words: np.ndarray) -> np.ndarray:
    """The remainder (11 bits) of 23-bit words by the generator polynomial."""
    r = words.astype(np.int64)
    for bit in range(22, 10, -1):
        r = np.where((r >> bit) & 1, r ^ (GOLAY_POLY << (bit - 11)), r)
    return r


def golay_tables() -> tuple[np.ndarray, np.ndarray]:
    """leader[syndrome]: the error pattern of at most 3 bits; nearby[syndrome]: what to add to the
    nearest codeword to get each codeword within 4 bits (itself first; -1 where there is none)."""
    patterns = np.array([sum(1 << b for b in c) for n in range(4) for c in combinations(range(23), n)])
    leader = np.zeros(2048, np.int64)
    leader[syndromes(patterns)] = patterns
    shifted = np.arange(4096, dtype=np.int64) << 11
    codewords = shifted ^ syndromes(shifted)
    sevens = codewords[np.bitwise_count(codewords) == 7]
    nearby = np.full((2048, 6), -1, np.int64)
    nearby[:, 0] = 0
    for s in np.flatnonzero(np.bitwise_count(leader) == 3):
        nearby[s, 1:] = sevens[(sevens & leader[s]) == leader[s]]
    return leader, nearby


def keys_of(fps: np.ndarray, tables: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, ...]:
    """(key, fingerprint's position, side) of each key; side 0 holds nearest indices, 1 nearby ones.

    A key is 3 bits of kind, 12 bits of codeword index of segment b, and segment a."""
    leader, nearby = tables
    seg = [(fps >> np.uint64(first)).astype(np.int64) & ((1 << bits) - 1) for first, bits in SEGMENTS]
    syn = [syndromes(s) for s in seg]
    near = [(s ^ leader[y]) >> 11 for s, y in zip(seg, syn)]
    others = [np.where(nearby[y] >= 0, (s ^ leader[y])[:, None] ^ nearby[y], -1) >> 11
              for s, y in zip(seg, syn)]
    at, out = np.arange(len(fps)), []

    def put(kind: int, high: np.ndarray, low: np.ndarray, side: int) -> None:
        high, low = np.broadcast_arrays(high, low)
        real = (high >= 0) & (low >= 0)
        rows = np.broadcast_to(at[:, None] if high.ndim == 2 else at, high.shape)[real]
        out.append(((kind << 60) | (high[real] << 12) | low[real], rows, np.full(len(rows), side, np.int8)))

    for kind, (a, b) in enumerate((a, b) for a in range(3) for b in range(3) if a != b):
        put(kind, seg[a], near[b], 0)
        put(kind, seg[a][:, None], others[b], 1)
    put(6, near[0][:, None], others[1], 0)
    put(6, others[0], near[1][:, None], 1)
    return tuple(np.concatenate(x) for x in zip(*out))


# ---------------------------------------------------------------- links

def forest(fps: np.ndarray, max_bits: int = MAX_BITS) -> list[tuple[int, int]]:
    """Edges that connect what links of the fingerprints in one key connect: (root, member)."""
    fps = np.unique(fps)
    edges, left = [], np.ones(len(fps), bool)
    for root in range(len(fps)):
        if not left[root]:
            continue
        left[root], front = False, [root]
        while front:
            at = front.pop()
            rest = np.flatnonzero(left)
            found = rest[np.bitwise_count(fps[rest] ^ fps[at]) <= max_bits]
            left[found] = False
            front.extend(found.tolist())
            edges.extend((int(fps[root]), int(fps[x])) for x in found)
    return edges


def key_edges(key: np.ndarray, fp: np.ndarray, side: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges within runs of equal keys (sorted); small runs by shifted comparison, large by forest."""
    cut = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    size = np.diff(np.r_[cut, len(key)])
    us, vs = [], []
    small = np.repeat(size <= 16, size)
    for d in range(1, int(min(size.max(initial=1), 16))):
        i = np.flatnonzero((key[:-d] == key[d:]) & small[:-d])
        i = i[(side[i] != side[i + d]) & (fp[i] != fp[i + d])]
        i = i[np.bitwise_count(fp[i] ^ fp[i + d]) <= max_bits]
        us.append(fp[i])
        vs.append(fp[i + d])
    for c, n in zip(cut[size > 16], size[size > 16]):
        pairs = forest(fp[c:c + n], max_bits)
        us.append(np.array([p[0] for p in pairs], np.uint64))
        vs.append(np.array([p[1] for p in pairs], np.uint64))
    none = [np.zeros(0, np.uint64)]
    u, v = np.concatenate(us or none), np.concatenate(vs or none)
    return np.minimum(u, v), np.maximum(u, v)


def links(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(u, v): edges over distinct fingerprints ``fp`` whose components are those of all links."""
    if max_bits > MAX_BITS:
        raise ValueError("the keys reach all pairs of at most 3 differing bits")
    tables = golay_tables()

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = b.column(0).to_numpy(zero_copy_only=False)
            for i in range(0, len(fp), 20_000):
                part = fp[i:i + 20_000]
                key, row, side = keys_of(part.view(np.uint64), tables)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key), pa.array(part[row]), pa.array(side)], ["key", "fp", "side"])

    def emit(u: np.ndarray, v: np.ndarray) -> pa.RecordBatch:
        pairs = np.unique(np.stack([u, v], 1), axis=0) if len(u) else np.zeros((0, 2), np.uint64)
        n = len(pairs)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.ascontiguousarray(pairs[:, 0]).view(np.int64)),
             pa.array(np.ascontiguousarray(pairs[:, 1]).view(np.int64)),
             pa.nulls(n, pa.int64()), pa.nulls(n, pa.int8())], ["u", "v", "key", "side"])

    def compare(limit: int | None):
        """Sorted rows to edges.  A key of more than ``limit`` rows is passed on instead."""
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: list[tuple[np.ndarray, ...]] = []
            rows, passing = 0, None

            def pass_on(k, f, s):
                n = len(k)
                return pa.RecordBatch.from_arrays(
                    [pa.array(f.view(np.int64)), pa.nulls(n, pa.int64()), pa.array(k), pa.array(s)],
                    ["u", "v", "key", "side"])

            for b in batches:
                k = b.column(0).to_numpy(zero_copy_only=False)
                f = b.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
                s = b.column(2).to_numpy(zero_copy_only=False)
                if passing is not None:  # the key that is passed on goes on in this batch
                    n = int(np.searchsorted(k, passing, "right"))
                    if n:
                        yield pass_on(k[:n], f[:n], s[:n])
                    k, f, s = k[n:], f[n:], s[n:]
                    if not len(k):
                        continue
                    passing = None
                held.append((k, f, s))
                rows += len(k)
                k, f, s = (np.concatenate(x) for x in zip(*held))
                last = int(np.searchsorted(k, k[-1], "left"))  # the last key may go on
                if last:
                    yield from cut(k[:last], f[:last], s[:last], pass_on)
                held, rows = [(k[last:], f[last:], s[last:])], len(k) - last
                if limit and rows > limit:
                    passing = k[-1]
                    yield pass_on(*held[0])
                    held, rows = [], 0
            if held and rows:
                k, f, s = (np.concatenate(x) for x in zip(*held))
                yield from cut(k, f, s, pass_on)

        def cut(k, f, s, pass_on) -> Iterator[pa.RecordBatch]:
            if limit:
                start = np.flatnonzero(np.r_[True, k[1:] != k[:-1]])
                size = np.diff(np.r_[start, len(k)])
                big = np.repeat(size > limit, size)
                if big.any():
                    yield pass_on(k[big], f[big], s[big])
                    k, f, s = k[~big], f[~big], s[~big]
            if len(k) > 1:
                yield emit(*key_edges(k, f, s, max_bits))

        return run

    out = "u long, v long, key long, side byte"
    rows = fps.select("fp").mapInArrow(expand, "key long, fp long, side byte")
    first = stored(rows.repartition(F.col("key")).sortWithinPartitions("key")
                   .mapInArrow(compare(BLOCK), out), "simhash-links")
    edges = first.filter("key is null").select("u", "v")
    large = first.filter("key is not null").select("key", F.col("u").alias("fp"), "side")
    # Large keys: every pair of blocks of the key's fingerprints meets in one place.
    blocks = large.groupBy("key").agg(F.ceil(F.count("*") * 2 / BLOCK).cast("int").alias("n"))
    dealt = (large.join(blocks, "key").withColumn("b", F.pmod(F.xxhash64("fp"), F.col("n")).cast("int"))
             .withColumn("o", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
             .select(F.xxhash64("key", F.least("b", "o"), F.greatest("b", "o")).alias("key"), "fp", "side"))
    more = (dealt.repartition(F.col("key")).sortWithinPartitions("key").mapInArrow(compare(None), out)
            .select("u", "v"))
    return edges.unionByName(more).distinct()


# ---------------------------------------------------------------- components

def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) of every node with an edge; root is the smallest node of its component.

    Alternating large-star and small-star steps, each a shuffle join of the edges with the
    smallest neighbour of their ends, stored in the shared folder.  A hub's rows are not gathered:
    the smallest neighbour is a partial aggregate and the join may split the hub's partition."""
    state = stored(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                   .distinct(), "edges")

    def seal(df: DataFrame) -> tuple[int, int]:
        r = df.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        return r.n, r.h

    before = seal(state)
    for _ in range(max_rounds if before[0] else 0):
        both = state.unionByName(state.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")) \
            .filter("u <> v").distinct()
        large = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("a"), F.col("u").alias("b"), "m")
        state = stored(small.select(F.col("a").alias("u"), F.col("m").alias("v"))
                       .unionByName(small.select(F.col("b").alias("u"), F.col("m").alias("v")))
                       .filter("u <> v").distinct(), "edges")
        after = seal(state)
        if after == before:
            break
        before = after
    else:
        if before[0]:
            raise RuntimeError(f"no fixed point after {max_rounds} rounds")
    return state.select(F.col("u").alias("node"), F.col("v").alias("root")) \
        .unionByName(state.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def grouped(docs: DataFrame, id_col: str, text_col: str, shingle_words: int,
            max_bits: int) -> tuple[DataFrame, DataFrame]:
    """The stored fingerprints of all rows, and (fp, root, component_id) of each fingerprint."""
    marked = stored(fingerprints(docs, id_col, text_col, shingle_words), "fingerprints")
    distinct = stored(marked.groupBy("fp").agg(F.min("id").alias("least")), "distinct-fingerprints")
    roots = components(links(distinct, max_bits))
    named = distinct.join(roots, distinct.fp == roots.node, "left") \
        .select("fp", "least", F.coalesce("root", "fp").alias("root"))
    named = stored(named, "fingerprint-roots")
    group = named.groupBy("root").agg(F.min("least").alias("component_id"))
    return marked, named.join(group, "root").select("fp", "root", "component_id")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """One row per input row: (doc_id, fp long, component_id)."""
    marked, per_fp = grouped(docs, id_col, text_col, shingle_words, max_bits)
    return marked.join(per_fp, "fp").select(F.col("id").alias("doc_id"), "fp", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs`` with one document of each group: the smallest id (a null id last), then
    the smallest text hash; of its repeated rows one.  Columns as given."""
    marked, per_fp = grouped(docs, id_col, text_col, shingle_words, max_bits)
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "text_hash")).alias("m")
    own, hash_ = unused(docs, "_id", "_hash")
    chosen = stored(marked.join(per_fp, "fp").groupBy("root").agg(first)
                    .select(F.col("m.id").alias(own), F.col("m.text_hash").alias(hash_)), "kept")
    kept = docs.join(chosen,
                     F.col(id_col).cast("long").eqNullSafe(F.col(own)) & (F.xxhash64(text_col) == F.col(hash_)),
                     "left_semi")
    if marked.groupBy("id", "text_hash").count().filter("count > 1").isEmpty():
        return kept
    key = kept.select("*", F.xxhash64(text_col).alias(hash_))
    return key.dropDuplicates([id_col, hash_]).drop(hash_)


def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every row of ``documents``."""
    out = near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


QUERIES = {"op6_simhash_near_dedup": op6_simhash_near_dedup}
ORACLE: dict[str, str] = {}
