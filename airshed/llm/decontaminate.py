"""Benchmark decontamination as a prefix-filtered set join, in DataFrame operations only.

A window is ``WINDOW`` consecutive words of a benchmark item (a shorter item is one window).  Its
shingles are a set of tokens, and a document holds the window only if it holds all of them, so the
necessary prefix of a window, with tokens in order of rarity, is its rarest shingle alone.  Rarity
is counted over the whole corpus, for the benchmark's shingles.

1. Count: each document's shingles that a bitmap of the benchmark's shingles lets through are
   joined with these and counted.
2. Join: a bitmap of the prefixes picks the places of a document where one may stand; each place
   goes into an equi-join with the prefixes, together with the words around it.
3. Bounds and verification: the prefix's offset gives the window's place, which must lie inside the
   document (position and length), and its words there must equal the window's.

Texts are read in two scans and never shuffled.  A bitmap's size follows the benchmark, up to
``MAX_BITMAP_BITS``; past that it lets more places through to the join, and the result is the same.
The benchmark's side of a join is broadcast only where Spark finds its stored size under the
threshold; otherwise it is a shuffle join whose skewed partitions may be split.

Nulls and edges: a null or empty text has no words and is clean; an item without words has no
window; repeated items count once by id, and a null item id counts as 'null'; repeated documents
each get their row; extra columns are ignored (``keep_clean`` passes them through).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airshed.llm.common import stored, table, unused

WINDOW = 10
SHINGLE = 3
MAX_BITMAP_BITS = 1 << 24
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: Column) -> Column:
    """Words of a text with A-Z lower-cased, other letters unchanged; null has none."""
    t = F.coalesce(text, F.lit(""))
    ascii_only = F.octet_length(t) == F.char_length(t)
    lowered = F.when(ascii_only, F.lower(t)).otherwise(F.translate(t, UPPER, LOWER))
    return F.filter(F.split(lowered, GAP), lambda w: w != "")


def held(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` with a column that is computed once a row.

    The one-element explode keeps the optimizer from putting the expression in place of the
    column, which inside a lambda would compute it once an element."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def windows_of(benchmark: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """(item, window, len): the words of each window space-joined, once per item."""
    items = held(benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("null")).alias("item"),
                                  F.col(text_col).alias("t")), "w", words_of(F.col("t"))).filter(F.size("w") > 0)
    n = F.least(F.size("w"), F.lit(size))
    at = items.withColumn("s", F.explode(F.sequence(F.lit(1), F.size("w") - n + 1)))
    return at.select("item", F.concat_ws(" ", F.slice("w", F.col("s"), n)).alias("window"), n.alias("len")).distinct()


def shingle_hash(words: Column, at: Column, size: int) -> Column:
    """Hash of ``size`` words from the 0-based place ``at``."""
    return F.xxhash64(F.lit(size), *(F.get(words, at + j) for j in range(size)))


def bitmap_of(hashes: DataFrame) -> tuple[list[int], int]:
    """Bits set for the column ``h``, as 64-bit numbers, and the shift that gives a hash's number."""
    n = hashes.count()
    numbers = 256
    while numbers * 64 < min(64 * n, MAX_BITMAP_BITS):
        numbers *= 2
    shift = 64 - (numbers.bit_length() - 1)
    place = F.shiftrightunsigned("h", shift)
    bit = F.expr("shiftleft(1L, cast(h & 63 as int))")
    found = hashes.groupBy(place.alias("p")).agg(F.bit_or(bit).alias("b")).collect()  # at most ``numbers`` rows
    bits = [0] * numbers
    for r in found:
        bits[r.p] = r.b
    return bits, shift


def placed(hashes: Column, bits: list[int], shift: int) -> Column:
    """(at, h) of the 0-based places whose shingle hash the bitmap lets through."""
    numbers = F.split(F.lit(",".join(map(str, bits))), ",").cast("array<bigint>")  # folded to one literal

    def let_through(i: Column) -> Column:
        h = F.get(hashes, i)
        return F.getbit(F.get(numbers, F.shiftrightunsigned(h, shift).cast("int")), h.bitwiseAND(63).cast("int")) == 1

    at = F.when(F.size(hashes) > 0, F.filter(F.sequence(F.lit(0), F.size(hashes) - 1), let_through)) \
        .otherwise(F.array().cast("array<int>"))
    return F.transform(at, lambda i: F.struct(i.alias("at"), F.get(hashes, i).alias("h")))


def with_places(docs: DataFrame, tokens: DataFrame, sizes: list[int]) -> DataFrame:
    """``docs`` (with the words ``w``) with ``found``: array of (at, h) of possible tokens ``h``."""
    bits, shift = bitmap_of(tokens.select("h").distinct())
    out, parts = docs, []
    for k in sizes:
        n = F.size("w") - (k - 1)
        out = held(out, f"h{k}", F.when(n > 0, F.transform(
            F.sequence(F.lit(0), n - 1), lambda i: shingle_hash(F.col("w"), i, k)))
            .otherwise(F.array().cast("array<bigint>")))
        parts.append(placed(F.col(f"h{k}"), bits, shift))
    found = F.concat(*parts) if len(parts) > 1 else parts[0]
    return held(out, "found", found).drop(*(f"h{k}" for k in sizes))


def contaminated_places(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                        item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
                        shingle: int = SHINGLE) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, hits, windows): (row, id, text_hash, n_words) of every document, (row, window, start, len)
    of every occurrence of a window, and the stored windows (item, window, len)."""
    wins = stored(windows_of(benchmark, item_col, item_text_col, window), "windows")
    texts = held(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t")), "w", words_of(F.col("t"))) \
        .select("id", F.xxhash64("t").alias("text_hash"), "w")
    distinct = wins.select("window", "len").distinct().withColumn("w", F.split("window", " "))
    k = F.least("len", F.lit(shingle))
    sizes = sorted(r.k for r in distinct.select(k.alias("k")).distinct().collect())  # at most ``shingle`` values
    per_size = [distinct.filter(k == size).withColumn("at", F.explode(F.sequence(F.lit(0), F.col("len") - size)))
                .select("window", "len", F.lit(size).alias("k"), "at", shingle_hash(F.col("w"), F.col("at"), size).alias("h"))
                for size in sizes]
    if not sizes:  # no window: nothing can be found
        rows = stored(texts.select(F.monotonically_increasing_id().alias("row"), "id", "text_hash",
                                   F.size("w").alias("n_words")), "rows")
        none = rows.filter("false").selectExpr("row", "'' window", "0 start", "0 len")
        return rows, none, wins
    shingles = per_size[0]
    for more in per_size[1:]:
        shingles = shingles.unionByName(more)
    shingles = stored(shingles, "shingles")

    tokens = shingles.select("h").distinct()
    seen = with_places(texts.select("w"), tokens, sizes).select(F.explode("found").alias("f")).select("f.h") \
        .groupBy("h").agg(F.count("*").alias("n"))
    rarity = tokens.join(seen, "h", "left").select("h", F.coalesce("n", F.lit(0)).alias("n"))
    ranked = shingles.join(rarity, "h").groupBy("window", "len") \
        .agg(F.min(F.struct("n", "h", "at", "k")).alias("p"))
    prefixes = stored(ranked.select("window", "len", F.col("p.h").alias("h"), F.col("p.at").alias("offset"),
                                    F.col("p.k").alias("k")), "prefixes")

    marked = with_places(texts.withColumn("row", F.monotonically_increasing_id()), prefixes, sizes)
    around = F.transform("found", lambda f: F.struct(
        f["at"].alias("at"), f["h"].alias("h"), F.greatest(f["at"] - (window - 1), F.lit(0)).alias("from"),
        F.slice("w", F.greatest(f["at"] - (window - 1), F.lit(0)) + 1, F.lit(2 * window - 1)).alias("words")))
    scanned = stored(marked.select("row", "id", "text_hash", F.size("w").alias("n_words"), around.alias("found")),
                     "scanned")
    start = F.col("f.at") - F.col("offset")
    hits = scanned.filter(F.size("found") > 0).select("row", "n_words", F.explode("found").alias("f")) \
        .join(prefixes, F.col("f.h") == F.col("h")) \
        .filter((start >= 0) & (start + F.col("len") <= F.col("n_words"))) \
        .filter(F.concat_ws(" ", F.slice(F.col("f.words"), start - F.col("f.from") + 1, F.col("len"))) == F.col("window")) \
        .select("row", "window", start.alias("start"), "len").distinct()
    return scanned.select("row", "id", "text_hash", "n_words"), stored(hits, "hits"), wins


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  **options) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_hit, n_items, items (sorted ids), contaminated."""
    rows, hits, wins = contaminated_places(docs, benchmark, id_col, text_col, **options)
    # a document's spans and items are bounded by its own length and by the benchmark
    spans = hits.groupBy("row", "start").agg(F.max("len").alias("len")).groupBy("row") \
        .agg(F.sort_array(F.collect_list(F.struct("start", "len"))).alias("spans"))
    covered = F.aggregate("spans", F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")), lambda a, s: F.struct(
        (a["n"] + F.greatest(s["start"] + s["len"] - F.greatest(s["start"], a["end"]), F.lit(0))).alias("n"),
        F.greatest(a["end"], s["start"] + s["len"]).alias("end")), lambda a: a["n"])
    items = hits.select("row", "window").distinct().join(wins.select("item", "window"), "window") \
        .groupBy("row").agg(F.sort_array(F.collect_set("item")).alias("items"))
    per_row = spans.join(items, "row").select("row", covered.cast("long").alias("n_hit"), "items")
    out = rows.join(per_row, "row", "left")
    none = F.array().cast("array<string>")
    return out.select(F.col("id").alias("doc_id"), F.col("n_words").cast("long").alias("n_words"),
                      F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
                      F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
                      F.coalesce("items", none).alias("items"), F.col("n_hit").isNotNull().alias("contaminated"))


def keep_clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               **options) -> DataFrame:
    """The rows of ``docs`` that hold no window; columns as given."""
    rows, hits, _ = contaminated_places(docs, benchmark, id_col, text_col, **options)
    own, hash_ = unused(docs, "_id", "_hash")
    bad = stored(rows.join(hits.select("row").distinct(), "row").select(
        F.col("id").alias(own), F.col("text_hash").alias(hash_)).distinct(), "contaminated")
    return docs.join(bad, F.col(id_col).eqNullSafe(F.col(own)) & (F.xxhash64(text_col) == F.col(hash_)), "left_anti")


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark hits of every row of ``documents``."""
    out = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", "n_items",
                      F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated")


QUERIES = {"op4_decontamination": op4_decontamination}
ORACLE = {"op4_decontamination": rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS w
  FROM documents),
b AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), 'null') AS item,
         regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS w
  FROM benchmark),
win AS (
  SELECT DISTINCT item, least(len(w), {WINDOW}) AS n,
         array_to_string(w[s + 1 : s + least(len(w), {WINDOW})], ' ') AS k
  FROM b, unnest(range(0, greatest(len(w) - {WINDOW}, 0) + 1)) AS t(s) WHERE len(w) > 0),
dw AS (
  SELECT doc_id, s, n, array_to_string(w[s + 1 : s + n], ' ') AS k
  FROM d, (SELECT DISTINCT n FROM win) AS l, unnest(range(0, len(w) - n + 1)) AS t(s) WHERE len(w) >= n),
hit AS (SELECT DISTINCT doc_id, s, n, item FROM dw JOIN win USING (n, k)),
cover AS (
  SELECT doc_id, count(DISTINCT s + o) AS n_hit FROM hit, unnest(range(0, n)) AS u(o) GROUP BY doc_id),
found AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN cover USING (doc_id) LEFT JOIN found USING (doc_id)"""}
