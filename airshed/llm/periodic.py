"""Periodic runs of words, by an online sparse diagonal DP.

A run is a stretch of consecutive words with smallest period q and a length of at least ``LEAST`` and
2q that no neighbouring word extends.  A pair of a word and one of its earlier occurrences, ``lag``
words back, is a cell of the diagonal ``lag``; the match length of a cell is one more than that of
the cell before it on its diagonal.  A text is read block by block: the earlier occurrences of each
word lengthen the active diagonals, and a diagonal that the next word does not lengthen ends and is
emitted at once if it has matched as many words as its lag (and ``LEAST`` with it).

The table of cells is kept sparse without losing a run:

* A diagonal of lag d emits only after d matches.  So the occurrences of a word are looked up by the
  words that end in it: by 6 for lags under 12, by 12 for lags 12 to 23, by 24 for 24 to 47 and so
  on.  Sequences are named exactly (pairs of shorter names), never by hashes, and only those that
  are repeated go on to the next length.
* Where such a sequence itself has a period q of at most half its length, occurrences inside the same
  stretch of period q are whole multiples of q; their diagonals span just that stretch again.  They
  are left out, and so a word repeated a million times costs its own diagonal only.

A diagonal is taken at its full extent: its neighbours on either side must differ.  Of diagonals that
span the same words the smallest lag is the period.

Each document is whole in one task, none needs another, so nothing is shuffled.  Work grows with the
words times the logarithm of the longest repeat.

Nulls and edges: a null or empty text has no words, no runs and an empty collapsed text; a null id
keeps its row; repeated rows get equal results; an empty table gives none; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airshed.llm.common import ship_by_value, table, utf8

ship_by_value(__name__)

LEAST = 12               # words of a run at least
FIRST = LEAST // 2       # matches that any diagonal of a run has
BLOCK_CELLS = 2_000_000  # cells of the table held at a time
SLICE_BYTES = 2_000_000  # text whose words a task holds as objects at a time (or one longer text)

RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
Prepare = Callable[[int | None, list[bytes]], list[bytes]]


def repeated(keys: np.ndarray, at: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places whose key occurs twice or more, sorted by key and place, with the numbers of their
    keys; and the number of each of n places (-1: none)."""
    order = np.argsort(keys, kind="stable")
    keys, at = keys[order], at[order]
    same = keys[1:] == keys[:-1]
    twice = (np.r_[same, False] | np.r_[False, same])[:len(keys)]
    keys, at = keys[twice], at[twice]
    number = np.cumsum(np.r_[False, keys[1:] != keys[:-1]][:len(keys)], dtype=np.int64)
    names = np.full(n, -1, np.int64)
    names[at] = number
    return at, number, names


def joined(left: np.ndarray, right: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Names of the sequences of ``left`` followed by ``right`` (of ``width`` words), by their last word."""
    at = np.flatnonzero(right >= 0)
    at = at[at >= width]
    at = at[left[at - width] >= 0]
    return repeated(left[at - width] * (int(right.max(initial=0)) + 1) + right[at], at, len(right))


def cells(at: np.ndarray, number: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, first, end), by place: the earlier occurrences ``at[first:end]`` of the sequence of ``size``
    words that ends there, at the lags this size serves."""
    n = int(at.max()) + 1
    key = number * n + at
    nearest = np.r_[0, np.where(number[1:] == number[:-1], at[1:] - at[:-1], 0)]
    last = at - (1 if size == FIRST else size)  # the latest occurrence of interest
    if size > FIRST:
        by_place = np.argsort(at)
        p, q = at[by_place], nearest[by_place]
        own = (q > 0) & (q <= size // 2)
        new = np.r_[True, (p[1:] != p[:-1] + 1) | (q[1:] != q[:-1])]
        begin = p[np.maximum.accumulate(np.where(new, np.arange(len(p)), 0))]
        # the stretch of period q starts at begin - size + 1 - q: skip what lies inside it
        last[by_place] = np.where(own, np.minimum(last[by_place], begin - q - 1), last[by_place])
    first = np.searchsorted(key, number * n + np.maximum(at - 2 * size + 1, 0))
    end = np.searchsorted(key, number * n + np.maximum(last, -1), "right")
    end = np.where(last < 0, first, end)
    some = np.flatnonzero(end > first)
    some = some[np.argsort(at[some])]
    return at[some], first[some], end[some]


def diagonals(at: np.ndarray, number: np.ndarray, size: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(lag, first word, last word) of the matches of each diagonal as it ends, by the DP over blocks of words."""
    place, first, end = cells(at, number, size)
    none = np.zeros(0, np.int64)
    active, since, until = none, none, none  # lags, and the first and last place of their matches
    total = np.cumsum(end - first)
    lo = 0
    while lo < len(place):
        hi = max(lo + 1, int(np.searchsorted(total, (total[lo - 1] if lo else 0) + BLOCK_CELLS, "right")))
        count = end[lo:hi] - first[lo:hi]
        i = np.repeat(place[lo:hi], count)
        j = at[np.arange(len(i)) + np.repeat(first[lo:hi] - np.r_[0, np.cumsum(count)[:-1]], count)]
        lag = i - j
        order = np.lexsort((i, lag))
        i, lag = i[order], lag[order]
        new = np.r_[True, (lag[1:] != lag[:-1]) | (i[1:] != i[:-1] + 1)]
        head = np.flatnonzero(new)
        lag, begin, stop = lag[head], i[head], i[np.r_[head[1:] - 1, len(i) - 1]]
        # a diagonal active so far goes on if its next cell is here
        carried = np.searchsorted(lag * (place[-1] + 2) + begin, active * (place[-1] + 2) + until + 1)
        goes_on = carried < len(lag)
        goes_on[goes_on] = (lag[carried[goes_on]] == active[goes_on]) & (begin[carried[goes_on]] == until[goes_on] + 1)
        begin[carried[goes_on]] = since[goes_on]
        if not goes_on.all():
            yield active[~goes_on], since[~goes_on] - size + 1, until[~goes_on]
        open_ = stop == place[hi - 1]
        yield lag[~open_], begin[~open_] - size + 1, stop[~open_]
        active, since, until = lag[open_], begin[open_], stop[open_]
        lo = hi
    yield active, since - size + 1, until


def find_runs(words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, period) of the runs of a sequence of word numbers, by start, then period."""
    n, found = len(words), []
    two = joined(words, words, 1)[2]
    four = joined(two, two, 2)[2]
    size, (at, number, names) = FIRST, joined(two, four, 4)
    while len(at):
        for lag, begin, stop in diagonals(at, number, size):
            keep = (stop - begin + 1 >= lag) & (stop - begin + 1 + lag >= LEAST)
            found.append((begin[keep] - lag[keep], stop[keep], lag[keep]))
        at, number, names = joined(names, names, size)
        size *= 2
    if not found:
        return (np.zeros(0, np.int64),) * 3
    start, stop, lag = (np.concatenate(x) for x in zip(*found))
    # both neighbours differ: the diagonal has its full extent
    left, right = start > 0, stop + 1 < n
    whole = ~(left & (words[start - 1] == words[start - 1 + lag]))
    whole &= ~(right & (words[np.minimum(stop + 1, n - 1)] == words[np.minimum(stop + 1, n - 1) - lag]))
    start, stop, lag = start[whole], stop[whole], lag[whole]
    order = np.lexsort((lag, stop, start))
    start, stop, lag = start[order], stop[order], lag[order]
    first = np.r_[True, (start[1:] != start[:-1]) | (stop[1:] != stop[:-1])][:len(start)]
    start, stop, lag = start[first], stop[first], lag[first]
    order = np.lexsort((lag, start))
    return start[order], stop[order], lag[order]


def solve(texts: list[list[bytes]]) -> Iterator[tuple[list[dict], bytes]]:
    """(runs, collapsed text) of each text.  Texts share no word number, so no diagonal passes from
    one to the next."""
    numbers, ends, base = [], [], 0
    for ws in texts:
        known: dict[bytes, int] = {}
        numbers.append(np.array([known.setdefault(w, len(known)) for w in ws], np.int64) + base)
        base += len(known)
        ends.append(len(ws))
    ends = np.cumsum(ends)
    start, stop, period = find_runs(np.concatenate(numbers))
    edge = np.zeros(int(ends[-1]) + 1, np.int64)
    np.add.at(edge, start + period, 1)
    np.add.at(edge, stop + 1, -1)
    kept = np.cumsum(edge)[:-1] == 0
    bounds = np.searchsorted(start, np.r_[0, ends])
    for k, ws in enumerate(texts):
        begin = int(ends[k]) - len(ws)
        a, b = int(bounds[k]), int(bounds[k + 1])
        if a == b:
            yield [], b" ".join(ws)
            continue
        runs = [{"start": s - begin, "length": e - s + 1, "period": p}
                for s, e, p in zip(start[a:b].tolist(), stop[a:b].tolist(), period[a:b].tolist())]
        yield runs, b" ".join([w for w, stay in zip(ws, kept[begin:int(ends[k])].tolist()) if stay])


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  prepare: Prepare | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, runs (start, length, period; by start, then period)
    and collapsed, the words that no run holds after its first period.  ``prepare`` may change a
    text's words (given with the id) before they are searched."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(ids: list, texts: list[list[bytes]]) -> pa.RecordBatch:
            runs, rest = zip(*solve(texts))
            return pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array([len(t) for t in texts], pa.int64()),
                 pa.array(list(runs), pa.list_(RUN)), pa.array(list(rest), pa.binary())],
                ["doc_id", "n_words", "runs", "collapsed"])

        for b in batches:
            ids, texts, size = [], [], 0
            for i, t in zip(b.column(0).to_pylist(), b.column(1)):
                t = t.as_py()
                words = t.split()
                ids.append(i)
                texts.append(prepare(i, words) if prepare else words)
                size += len(t)
                if size >= SLICE_BYTES:
                    yield out(ids, texts)
                    ids, texts, size = [], [], 0
            if ids:
                yield out(ids, texts)

    return docs.select(F.col(id_col).cast("long").alias("i"), utf8(text_col).alias("t")) \
        .mapInArrow(run, "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed binary")


def with_planted_period(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The query's input: of every tenth id (by CRC-32) the words from some place on are repeated."""
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a:a + p] * ((n - a) // p + 1))[:n - a]


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every row of ``documents``."""
    found = periodic_runs(table(spark, sf_dir, "documents"), prepare=with_planted_period)
    # greatest length first, ties to the smallest start, then period
    best = F.element_at(F.array_sort(F.transform("runs", lambda r: F.struct(
        (-r["length"]).alias("l"), r["start"].alias("s"), r["period"].alias("p")))), 1)
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    lines = F.concat(F.array_join(F.transform("runs", line), "\n"), F.lit("\n"))
    return found.withColumn("best", F.when(F.size("runs") > 0, best)).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.s").alias("start"),
        (-F.col("best.l")).alias("length"), F.col("best.p").alias("period"),
        F.expr("(-best.l * 1000L) div best.p").alias("exponent_milli"),
        F.sha2(F.when(F.size("runs") > 0, lines).otherwise(F.lit("")), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"))


QUERIES = {"op11_periodic_runs": op11_periodic_runs}
ORACLE: dict[str, str] = {}
