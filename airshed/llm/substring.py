"""Substring dedup with suffix automata of reference shards.

A window (``SPAN`` consecutive words) of a document is a repeat if it also starts in a document of
a smaller id; words that a repeat covers are removed.  All documents are references to each other,
and an automaton of all of them, sent to every task, would cost the square of the corpus.  So both
sides are cut into shards by content:

1. Anchors: the anchor of a window is the smallest hash among its k-grams, so equal windows have
   equal anchors, in whatever document.  Neighbouring windows of one anchor are a segment (of some
   50 to 110 words).  Only anchors found in two or more documents go on.
2. Segments: the text of these segments, taken once each (equal segments keep the smallest id).
3. Shards: the segments of an anchor are one shard.  Its reference automaton is built in the task
   that holds them; the same segments are streamed past it for their matching statistics, which
   give each window's smallest owner.  A shard of one segment needs no automaton.  A shard of more
   than ``SHARD_SEGMENTS`` is cut again by the anchors of longer k-grams (``GRAM_SHARES`` of a window),
   whose shards are solved in the same way.  The longest k-gram is the whole window: a shard of it holds
   that window only, up to ``RUN`` times in a row, so every shard ends up bounded.
4. Removal: each document's windows with a smaller owner make its maximal removed spans.

Work and shuffled bytes grow in proportion to the corpus, and a passage in a third of all rows is
partially aggregated before it is shuffled.

Nulls and edges: a null or empty text has no words; a text under ``SPAN`` words is kept whole; a
null id stands with the largest id there is, 2^63-1; rows that share an id are no references to each other, and
repeated rows are each judged alike; extra columns are ignored (``without_repeats`` passes them
through).
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airshed.llm.automata import SuffixAutomaton
from airshed.llm.common import LONG_MAX, ship_by_value, stored, table, unused, utf8

ship_by_value(__name__)

SPAN = 50
SHARD_SEGMENTS = 500
GRAM_SHARES = (5, 2, 1)  # a k-gram of an anchor is a window's words divided by these, in turn
RUN = 64                 # windows of a segment at most
SLICE_BYTES = 2_000_000  # text whose words a task holds as objects at a time
WORD_CACHE = 300_000     # words of up to CACHED_BYTES whose hashes a task remembers
CACHED_BYTES = 64
WORD = re.compile(rb"[^ \t\n\x0b\x0c\r]+")


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh64_intdigest(word, 7)
        if len(word) <= CACHED_BYTES:
            if len(self) >= WORD_CACHE:
                self.clear()
            self[word] = h
        return h


def anchors(words: np.ndarray, span: int, level: int = 0) -> np.ndarray:
    """The anchor of the window at each word of a sequence of word hashes."""
    gram = max(1, span // GRAM_SHARES[level])
    odd = 0x9E3779B97F4A7C15
    grams, width = words, 1
    while width < gram:  # hash of ``width`` words from here, doubled or extended to ``gram``
        add = min(width, gram - width)
        tail = grams[add:]
        grams = grams[:len(tail)] * np.uint64(pow(odd, add, 1 << 64)) + tail * np.uint64(0xBF58476D1CE4E5B9)
        width += add
    x = grams ^ (grams >> np.uint64(30))
    x = x * np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    size, width = span - gram + 1, 1
    while width < size:  # smallest of ``width`` grams from here
        add = min(width, size - width)
        x = np.minimum(x[:len(x) - add], x[add:])
        width += add
    return x


def segments(words: np.ndarray, ends: np.ndarray, span: int, level: int = 0) -> tuple[np.ndarray, ...]:
    """(sequence, start, windows, anchor) of each segment; ``ends`` are the sequences' ends in
    ``words``."""
    if len(words) < span:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
    anchor = anchors(words, span, level)
    begins = np.r_[0, ends[:-1]]
    at = np.arange(len(anchor))
    owner = np.searchsorted(ends, at, "right")
    inside = at + span <= ends[np.minimum(owner, len(ends) - 1)]
    at, owner, anchor = at[inside], owner[inside], anchor[inside]
    if not len(at):
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
    new = np.r_[True, (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1])]
    first = np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))
    new |= (np.arange(len(at)) - first) % RUN == 0
    cut = np.flatnonzero(new)
    return owner[cut], at[cut] - begins[owner[cut]], np.diff(np.r_[cut, len(at)]), anchor[cut]


def slices(column: pa.Array) -> Iterator[tuple[int, list[bytes]]]:
    """(first row, texts) of parts of a binary column."""
    first, held, size = 0, [], 0
    for i, t in enumerate(column):
        held.append(t.as_py())
        size += len(held[-1])
        if size >= SLICE_BYTES:
            yield first, held
            first, held, size = i + 1, [], 0
    if held:
        yield first, held


def anchored(docs: DataFrame, span: int) -> DataFrame:
    """(id, text_hash, h, start, n): the segments of ``docs`` (id, text_hash, t)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for b in batches:
            ids = b.column(0).to_numpy(zero_copy_only=False)
            hashes = b.column(1).to_numpy(zero_copy_only=False)
            for first, texts in slices(b.column(2)):
                split = [t.split() for t in texts]
                ends = np.cumsum([len(w) for w in split])
                words = np.fromiter((known[w] for ws in split for w in ws), np.uint64, int(ends[-1]))
                seq, start, n, anchor = segments(words, ends, span)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[first + seq]), pa.array(hashes[first + seq]), pa.array(anchor.view(np.int64)),
                     pa.array(start.astype(np.int32)), pa.array(n.astype(np.int32))],
                    ["id", "text_hash", "h", "start", "n"])

    return docs.select("id", "text_hash", "t").mapInArrow(run, "id long, text_hash long, h long, start int, n int")


def segment_texts(found: DataFrame, span: int) -> DataFrame:
    """``found`` (id, text_hash, t, segs) as a row per segment with its words, space-joined, and two
    hashes of these."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                words = b.column(2)[i].as_py().split()
                segs = b.column(3)[i].as_py()
                texts = [b" ".join(words[s["start"]:s["start"] + s["n"] + span - 1]) for s in segs]
                n = len(segs)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([b.column(0)[i].as_py()] * n, pa.int64()), pa.array([b.column(1)[i].as_py()] * n, pa.int64()),
                     pa.array([s["start"] for s in segs], pa.int32()), pa.array([s["h"] for s in segs], pa.int64()),
                     pa.array(texts, pa.binary())], ["id", "text_hash", "start", "h", "seg"])

    return found.select("id", "text_hash", "t", "segs") \
        .mapInArrow(run, "id long, text_hash long, start int, h long, seg binary") \
        .select("*", *digests())


def owners_by_shard(segs: DataFrame, span: int) -> DataFrame:
    """(h, seg, owners): for distinct segments (h, seg, least id), by shard ``h``, the smallest owner
    of each window."""
    def solve(group: list[tuple[bytes, int]]) -> list[list[int]]:
        if len(group) == 1:
            seg, least = group[0]
            return [[least] * (seg.count(b" ") + 2 - span)]
        automaton = SuffixAutomaton()
        texts = [seg.split(b" ") for seg, _ in group]
        for words, (_, least) in zip(texts, group):
            automaton.add(words, least)
        automaton.seal()
        return [automaton.owners(words, span) for words in texts]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(solved: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([h for h, g, _ in solved for _ in g], pa.int64()),
                 pa.array([s for _, g, _ in solved for s, _ in g], pa.binary()),
                 pa.array([o for _, _, os in solved for o in os], pa.list_(pa.int64()))], ["h", "seg", "owners"])

        h, group, solved = None, [], []
        for b in batches:
            for key, seg, least in zip(*(c.to_pylist() for c in b.columns)):
                if key != h:
                    if group:
                        solved.append((h, group, solve(group)))
                    h, group = key, []
                group.append((seg, least))
                if len(solved) >= 2000:
                    yield out(solved)
                    solved = []
        if group:
            solved.append((h, group, solve(group)))
        yield out(solved)

    return segs.select("h", "seg", "least").repartition(F.col("h")).sortWithinPartitions("h", "least", "seg") \
        .mapInArrow(run, "h long, seg binary, owners array<long>")


def digests() -> tuple[Column, Column]:
    """Two independent hashes of a segment."""
    return F.xxhash64("seg").alias("d1"), F.xxhash64(F.lit(1), "seg").alias("d2")


def cut_again(segs: DataFrame, span: int, level: int) -> DataFrame:
    """(h, d1, d2, i, sub_h, seg, least): segments (h, seg, least) by their digests, cut by the anchors of a
    level into parts; ``i`` is the first window of a part in its segment."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for b in batches:
            h, d1, d2, least = (b.column(k).to_numpy() for k in range(4))
            for first, texts in slices(b.column(4)):
                split = [t.split(b" ") for t in texts]
                ends = np.cumsum([len(w) for w in split])
                words = np.fromiter((known[w] for ws in split for w in ws), np.uint64, int(ends[-1]))
                seq, start, n, anchor = segments(words, ends, span, level)
                parts = [b" ".join(split[q][s:s + m + span - 1]) for q, s, m in zip(seq.tolist(), start.tolist(), n.tolist())]
                of = first + seq
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h[of]), pa.array(d1[of]), pa.array(d2[of]), pa.array(start.astype(np.int32)),
                     pa.array(anchor.view(np.int64)), pa.array(parts, pa.binary()), pa.array(least[of])],
                    ["h", "d1", "d2", "i", "sub_h", "seg", "least"])

    return segs.select("h", *digests(), "least", "seg") \
        .mapInArrow(run, "h long, d1 long, d2 long, i int, sub_h long, seg binary, least long")


def owners_of(places: DataFrame, span: int, level: int = 0) -> DataFrame:
    """(h, d1, d2, owners): as ``owners_by_shard``, for segments (h, seg, least, d1, d2) that may be
    repeated; shards of more than ``SHARD_SEGMENTS`` are cut again first."""
    segs = places.groupBy("h", "seg").agg(F.min("least").alias("least"))
    solved = lambda some: owners_by_shard(some, span).select("h", *digests(), "owners")
    if level + 1 == len(GRAM_SHARES):
        return solved(segs)
    large = stored(places.select("h", "d1", "d2").distinct().groupBy("h").count()
                   .filter(F.col("count") > SHARD_SEGMENTS).select("h"), "large-shards")
    if large.isEmpty():
        return solved(segs)
    # the texts of the parts are stored without those they were cut from
    parts = stored(cut_again(segs.join(large, "h", "left_semi"), span, level + 1)
                   .select("*", *(x.alias(n) for x, n in zip(digests(), ("sub_d1", "sub_d2")))), "parts")
    finer = owners_of(parts.select(F.col("sub_h").alias("h"), "seg", "least", F.col("sub_d1").alias("d1"), F.col("sub_d2").alias("d2")),
                      span, level + 1).toDF("sub_h", "sub_d1", "sub_d2", "owners")
    # a segment has at most RUN windows, so at most RUN parts
    whole = parts.select("h", "d1", "d2", "i", "sub_h", "sub_d1", "sub_d2").join(finer, ["sub_h", "sub_d1", "sub_d2"]).groupBy("h", "d1", "d2") \
        .agg(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("i", "owners"))), lambda x: x["owners"])).alias("owners"))
    return solved(segs.join(large, "h", "left_anti")).unionByName(whole)


def repeats(docs: DataFrame, id_col: str, text_col: str, span: int) -> tuple[DataFrame, DataFrame]:
    """``docs`` as (doc_id, id, text_hash, t), and (id, text_hash, at): the words at which a repeat starts."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(id_col).cast("long"), F.lit(LONG_MAX)).alias("id"),
                        F.xxhash64(text_col).alias("text_hash"), utf8(text_col).alias("t"))
    marks = stored(anchored(texts, span), "anchors")
    shared = marks.groupBy("h").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).filter("lo < hi").select("h")
    regions = stored(marks.join(shared, "h").groupBy("id", "text_hash")
                     .agg(F.collect_set(F.struct("h", "start", "n")).alias("segs")), "regions")
    found = texts.join(regions, ["id", "text_hash"])
    places = stored(segment_texts(found, span), "segments")
    owners = stored(owners_of(places.withColumnRenamed("id", "least"), span), "owners")
    hit = places.select("id", "text_hash", "start", "h", "d1", "d2").join(owners, ["h", "d1", "d2"]) \
        .filter(F.array_min("owners") < F.col("id")) \
        .select("id", "text_hash", F.filter(
            F.transform("owners", lambda o, i: F.when(o < F.col("id"), F.col("start") + i)),
            lambda x: x.isNotNull()).alias("at"))
    per_doc = hit.groupBy("id", "text_hash").agg(F.flatten(F.collect_set("at")).alias("at"))
    return texts, stored(per_doc, "repeats")


def removed_words(n: int, starts: list[int], span: int) -> np.ndarray:
    """Which of n words a window at one of ``starts`` covers."""
    edge = np.zeros(n + 1, np.int64)
    starts = np.unique(np.array(starts, np.int64))
    edge[starts] += 1
    edge[starts + span] -= 1
    return edge.cumsum()[:-1] > 0


def cut_text(text: bytes, starts: list[int], span: int) -> bytes:
    """The text without the removed words; each kept stretch as it was written, joined by a space."""
    at = [m.span() for m in WORD.finditer(text)]
    gone = removed_words(len(at), starts, span)
    edges = np.flatnonzero(np.diff(np.r_[True, gone, True].astype(np.int8)))
    return b" ".join(text[at[a][0]:at[b - 1][1]] for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()))


def dedup_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", span: int = SPAN) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_removed, kept_sha256 of the kept words."""
    texts, found = repeats(docs, id_col, text_col, span)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for i, t, at in zip(b.column(0).to_pylist(), b.column(1), b.column(2)):
                words, starts = t.as_py().split(), at.as_py()
                n, kept = len(words), words
                if starts:
                    gone = removed_words(n, starts, span)
                    kept = [w for w, g in zip(words, gone.tolist()) if not g]
                out.append((i, n, n - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
            cols = list(zip(*out)) if out else [[]] * 4
            types = (pa.int64(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(cols, types)],
                                             ["doc_id", "n_words", "n_removed", "kept_sha256"])

    joined = texts.join(found, ["id", "text_hash"], "left").select("doc_id", "t", "at")
    return joined.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", span: int = SPAN,
                    length_col: str | None = "n_chars") -> DataFrame:
    """``docs`` with the repeats cut out of the text; columns as given, with ``length_col`` (if the
    table has it) the characters of a text that was cut."""
    _, found = repeats(docs, id_col, text_col, span)
    own, hash_, at, cut_col = unused(docs, "_id", "_hash", "_at", "_text")
    found = found.select(F.col("id").alias(own), F.col("text_hash").alias(hash_), F.col("at").alias(at))

    @F.pandas_udf("string")
    def cut(texts: pd.Series, starts: pd.Series) -> pd.Series:
        return pd.Series([t if at is None or not len(at) else cut_text(t.encode(), at, span).decode()
                          for t, at in zip(texts, starts)], dtype=object)

    same = (F.coalesce(F.col(id_col).cast("long"), F.lit(LONG_MAX)) == F.col(own)) & \
        (F.xxhash64(text_col) == F.col(hash_))
    joined = docs.join(found, same, "left")

    def value(name: str) -> Column:
        if name == text_col:
            return F.col(cut_col).alias(name)
        if name == length_col:
            return F.when(F.col(at).isNotNull(), F.char_length(cut_col)).otherwise(F.col(name)) \
                .cast(docs.schema[name].dataType).alias(name)
        return F.col(name)

    return joined.withColumn(cut_col, cut(text_col, at)).select(*(value(c) for c in docs.columns))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words removed from every row of ``documents``."""
    return dedup_report(table(spark, sf_dir, "documents"))


QUERIES = {"op7_substring_dedup": op7_substring_dedup}
ORACLE: dict[str, str] = {}
