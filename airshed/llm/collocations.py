"""Phrase collocations by Toivonen mining.

Phrases of 2 to 5 words that occur ``LEAST`` times or more in the texts of a language are found so:

1. Sample: the documents whose id hashes into one part of ``SAMPLE`` are stored.  The words and word
   pairs that occur there at a lowered threshold are the proposal; its negative border are the other
   words and the other pairs of proposed words.
2. Border pass over all texts: the border is counted by 64-bit hashes, which takes a third of the
   bytes that strings take.  A border phrase whose hash reaches ``LEAST`` is a border failure (or shares
   its hash with one, which costs some work and changes nothing).
3. Expansion pass over all texts: counted exactly, as strings, are the proposal, the failures, all pairs
   of a failed word with a frequent one, and every longer phrase all of whose pairs are among these.
   This closes the search: the words of a frequent phrase are frequent, so proposed or failed, hence its
   pairs are proposed, failed or counted here, and so is the phrase itself.  No count is left out
   whatever the sample proposes; a poor sample only makes this pass longer.
4. Scores: each cut of a candidate meets the counts of its two parts in a join; a candidate that always
   occurs inside one longer by a word is dropped; the best of each language are ranked in two steps.

A proposal is sent to the tasks as a bitmap of hashes of at most ``MOST_BITS`` bits.  What it lets through
wrongly is counted besides and has no effect, so the result is exact whatever its size.  A task counts a
few megabytes of text at a time, Spark adds the counts up before and after the shuffle, and only frequent
phrases are stored.

Nulls and edges: a null text is empty, a null language ``und``; null ids fall into the sample together or
not at all; repeated rows count as often as they are there; one word repeated counts overlapping phrases;
a language without a candidate has no rows; an empty table gives none; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from airshed.llm.common import ship_by_value, stored, table, utf8
from airshed.operators.joins import bounded_broadcast

ship_by_value(__name__)

LEAST = 100
LONGEST = 5
BEST = 2000
SAMPLE = 8              # one document in so many
LOWERED = 0.5           # of the count that a phrase of ``LEAST`` is expected to have in the sample
MOST_BITS = 1 << 28
CHUNK = 1 << 15         # bits of a row of a bitmap
SLICE_BYTES = 4_000_000
SALTS = 64
SCORE = ("(cast(1000 * a as decimal(19, 0)) * cast(n as decimal(18, 0))) div "
         "(cast(l as decimal(19, 0)) * cast(r as decimal(18, 0)))")
#: Characters that end a piece: . , ; : ! ? and the line ends 0A to 0D.
TO_STOP = bytes.maketrans(b",;:!?\n\x0b\x0c\r", b".........")
COUNTS = "lang string, k int, phrase string, n long"


class Proposal:
    """A bitmap of phrase hashes."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits  # bytes, the lowest bit first

    def has(self, h: np.ndarray) -> np.ndarray:
        place = h & np.uint64(len(self.bits) * 8 - 1)
        return (self.bits[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1


def proposal_of(phrases: DataFrame) -> Proposal:
    """The bitmap of the column ``h``, built in Spark; at most MOST_BITS / 8 bytes come to the driver."""
    count, size = phrases.count(), CHUNK
    while size < min(32 * count, MOST_BITS):
        size *= 2
    place = F.col("h").bitwiseAND(F.lit(size - 1))
    rows = phrases.groupBy(F.shiftright(place, 15).alias("c")) \
        .agg(F.bitmap_construct_agg(place.bitwiseAND(F.lit(CHUNK - 1))).alias("b")).toArrow()
    bits = np.zeros(size // 8, np.uint8)
    for c, b in zip(rows.column("c").to_pylist(), rows.column("b")):
        bits[c * (CHUNK // 8):(c + 1) * (CHUNK // 8)] = np.frombuffer(b.as_buffer(), np.uint8)
    return Proposal(bits)


class Words:
    """The words of some texts of one language: numbers (0 where a piece ends), places, hashes."""

    def __init__(self, lang: str, texts: list[bytes]):
        self.words = b".".join(texts).lower().translate(TO_STOP).replace(b".", b" . ").split()
        numbers = {b".": 0}
        self.ids = np.array([numbers.setdefault(w, len(numbers)) for w in self.words], np.int64)
        seed = xxhash.xxh64_intdigest(lang)
        self.size, self.own = len(numbers), np.array([xxhash.xxh64_intdigest(w, seed) for w in numbers], np.uint64)

    def pairs(self, good: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of pairs of two words of whose numbers ``good`` holds, and the pairs' hashes."""
        ok = good[self.ids] & (self.ids > 0)
        at = np.flatnonzero(ok[:-1] & ok[1:])
        h = self.own[self.ids[at]] * np.uint64(0x9E3779B97F4A7C15) + self.own[self.ids[at + 1]]
        return at, (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


def hashed_slice(lang: str, texts: list[bytes], proposal: Proposal | None) -> Iterator[pa.RecordBatch]:
    """(h, n): counts by hash of all words and pairs, or of a proposal's negative border."""
    text = Words(lang, texts)
    n = np.bincount(text.ids, minlength=text.size)
    n[0] = 0
    proposed = proposal.has(text.own) if proposal else np.ones(text.size, bool)
    border = n > 0 if proposal is None else (n > 0) & ~proposed
    _, h = text.pairs(proposed)
    h, m = np.unique(h, return_counts=True)
    if proposal:
        out = ~proposal.has(h)
        h, m = h[out], m[out]
    yield pa.RecordBatch.from_arrays([pa.array(np.r_[text.own[border], h].view(np.int64)), pa.array(np.r_[n[border], m].astype(np.int64))], ["h", "n"])


def exact_slice(lang: str, texts: list[bytes], proposal: Proposal, wanted: Proposal, longest: int) -> Iterator[pa.RecordBatch]:
    """(lang, k, phrase, n): counts of the words and pairs that ``wanted`` has, of pairs of such words that
    were not both proposed, and of longer phrases of such pairs; and with k = 0 of all words."""
    text = Words(lang, texts)

    def rows(k: int, first: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        phrases = [b" ".join(text.words[s:s + k]) for s in first.tolist()]
        m = len(phrases)
        return pa.RecordBatch.from_arrays(
            [pa.array([lang] * m, pa.string()), pa.array(np.full(m, k, np.int32)), pa.array(phrases, pa.binary()).cast(pa.string()),
             pa.array(n.astype(np.int64))], ["lang", "k", "phrase", "n"])

    yield pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([0], pa.int32()), pa.array([""]),
                                      pa.array([int((text.ids > 0).sum())], pa.int64())], ["lang", "k", "phrase", "n"])
    good, known = wanted.has(text.own), proposal.has(text.own)
    number, first, n = np.unique(text.ids, return_index=True, return_counts=True)
    own = good[number] & (number > 0)
    yield rows(1, first[own], n[own])
    at, h = text.pairs(good)
    at = at[wanted.has(h) | ~(known[text.ids[at]] & known[text.ids[at + 1]])]
    names = text.ids
    for k in range(2, longest + 1):
        if not len(at):
            return
        _, first, back, n = np.unique(names[at] * text.size + text.ids[at + k - 1], return_index=True, return_inverse=True,
                                      return_counts=True)
        yield rows(k, at[first], n)
        names = np.full(len(text.ids), -1, np.int64)
        names[at] = back
        at = at[:-1][np.diff(at) == 1]  # the next place begins such a phrase as well


def by_slices(docs: DataFrame, schema: str, count: Callable, proposals: list[Proposal], *more) -> DataFrame:
    """What ``count`` gives for each language's slices of ``docs`` (lang, t)."""
    held = docs.sparkSession.sparkContext.broadcast([p.bits for p in proposals])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[str, list[bytes]] = {}
        size, known = 0, [Proposal(bits) for bits in held.value] or [None]
        for b in batches:
            for lang, t in zip(b.column(0).to_pylist(), b.column(1)):
                waiting.setdefault(lang, []).append(t.as_py())
                size += len(waiting[lang][-1])
                if size >= SLICE_BYTES:
                    for lang, texts in waiting.items():
                        yield from count(lang, texts, *known, *more)
                    waiting, size = {}, 0
        for lang, texts in waiting.items():
            yield from count(lang, texts, *known, *more)

    return docs.select("lang", "t").mapInArrow(run, schema)


def frequent_hashes(docs: DataFrame, least: int, *proposals: Proposal) -> DataFrame:
    """Hashes of words and pairs (of a proposal's border) that occur ``least`` times together."""
    return by_slices(docs, "h long, n long", hashed_slice, list(proposals)).groupBy("h").agg(F.sum("n").alias("n")) \
        .filter(F.col("n") >= least).select("h")


def frequent_phrases(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, sample: int = SAMPLE,
                     lang_col: str = "lang", text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(lang, phrase, k, n) of every word and phrase of up to ``longest`` words that occurs ``least`` times
    or more, and with k = 0 the words of each language."""
    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit("und"))
    texts = docs.select(lang.alias("lang"), utf8(text_col).alias("t"), F.xxhash64(id_col).alias("i"))
    part = stored(texts.filter(F.pmod("i", F.lit(sample)) == 0).select("lang", "t"), "collocation-sample")
    proposed = stored(frequent_hashes(part, max(2, int(LOWERED * least / sample))), "proposed")
    proposal = proposal_of(proposed)
    failed = stored(frequent_hashes(texts, least, proposal), "border-failures")
    wanted = proposal_of(proposed.unionByName(failed))
    found = by_slices(texts, COUNTS, exact_slice, [proposal, wanted], longest).groupBy("lang", "phrase", "k") \
        .agg(F.sum("n").alias("n")).filter((F.col("k") == 0) | (F.col("n") >= least))
    return stored(found, "frequent-phrases")


def collocations(docs: DataFrame, least: int = LEAST, best: int = BEST, **columns) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``best`` candidates."""
    frequent = frequent_phrases(docs, least, **columns)
    one = frequent.filter("k > 0").select("lang", "phrase", "n")
    candidates = frequent.filter("k > 1").select("lang", "phrase", "k", F.col("n").alias("a"))
    # a phrase with the count of one longer by a word lies in it each time
    words = F.split("phrase", " ")
    longer = candidates.filter("k > 2").select("lang", "a", F.explode(F.array(
        F.concat_ws(" ", F.slice(words, F.lit(1), F.col("k") - 1)), F.concat_ws(" ", F.slice(words, F.lit(2), F.col("k") - 1)))).alias("phrase")) \
        .groupBy("lang", "phrase").agg(F.max("a").alias("inside"))
    left = candidates.join(longer, ["lang", "phrase"], "left").filter("inside is null or inside < a").drop("inside")
    cuts = left.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("k") - 1))).select(
        "lang", "phrase", "a", "cut", F.concat_ws(" ", F.slice(words, F.lit(1), F.col("cut"))).alias("first"),
        F.concat_ws(" ", F.slice(words, F.col("cut") + 1, F.col("k") - F.col("cut"))).alias("rest"))
    totals, _ = bounded_broadcast(frequent.filter("k = 0").groupBy("lang").agg(F.sum("n").alias("n")))
    cuts = cuts.join(one.select("lang", F.col("phrase").alias("first"), F.col("n").alias("l")), ["lang", "first"]) \
        .join(one.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r")), ["lang", "rest"]) \
        .join(totals, "lang")
    score = F.expr(SCORE)
    scored = cuts.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("c")) \
        .select("lang", "phrase", "a", "c.l", "c.r", "n", "c.score")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # a language may hold most phrases: the best of each salt first
    salted = scored.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    heads = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).filter(F.col("rank") <= best)
    ranked = heads.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return ranked.filter(F.col("rank") <= best).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The collocations of each language of ``documents``."""
    return collocations(table(spark, sf_dir, "documents"))


QUERIES = {"op13_collocations": op13_collocations}
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ORACLE = {"op13_collocations": rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split(translate(coalesce(text, ''),
         '{UPPER},;:!?' || chr(10) || chr(11) || chr(12) || chr(13), '{LOWER}.........'), '.')) AS piece FROM documents),
toks AS (SELECT lang, regexp_extract_all(piece, '[^ \t]+') AS w FROM pieces),
total AS (SELECT lang, sum(len(w)) AS n FROM toks GROUP BY lang),
f AS (
  SELECT lang, k, p, count(*) AS n FROM (
    SELECT lang, k, array_to_string(w[s : s + k - 1], ' ') AS p
    FROM toks, unnest(range(1, {LONGEST + 1})) AS a(k), unnest(range(1, len(w) - k + 2)) AS b(s))
  GROUP BY lang, k, p HAVING count(*) >= {LEAST}),
cand AS (SELECT lang, k, p, n AS a, string_split(p, ' ') AS w FROM f WHERE k > 1),
kept AS (
  SELECT * FROM cand c WHERE NOT EXISTS (
    SELECT 1 FROM cand q WHERE q.lang = c.lang AND q.k > c.k AND 100 * q.a >= 100 * c.a AND contains(' ' || q.p || ' ', ' ' || c.p || ' '))),
cuts AS (
  SELECT lang, p, a, cut, array_to_string(w[1 : cut], ' ') AS lp, array_to_string(w[cut + 1 : k], ' ') AS rp
  FROM kept, unnest(range(1, k)) AS t(cut)),
scored AS (
  SELECT c.lang, c.p, c.a, c.cut, x.n AS l, y.n AS r, t.n,
         (1000::HUGEINT * c.a * t.n) // (x.n::HUGEINT * y.n) AS score
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.p = c.lp JOIN f y ON y.lang = c.lang AND y.p = c.rp JOIN total t ON t.lang = c.lang),
low AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, cut) = 1)
SELECT lang, CAST(row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, p) AS BIGINT) AS rank, p AS phrase,
       CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM low QUALIFY rank <= {BEST}"""}
