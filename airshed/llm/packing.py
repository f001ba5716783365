"""Best-fit packing of token pieces by swap-based local search.

Every document becomes token ids and an end id; one longer than a sequence is cut into pieces.
The pieces are dealt at random over groups of about ``GROUP_PIECES`` and each group is packed by
best fit in decreasing length, then improved by local search: a document moves into another bin's
room, or is exchanged for a shorter one, or for two that are shorter together, or two for one
shorter than both together.  Any two bins may do so if it raises the sum of squared fills, until no
two have such a step.  The emptiest bins of each group are then released and packed anew together,
until one group is left, so that
the number of groups leaves no trace but its hardest bins.

Only lengths travel: ids are reduced to a CRC-32 where they are made.  Groups are bounded by the
random deal, whatever documents repeat.

Nulls and edges: a null or empty text is the end id alone (one piece of length 1); repeated rows are
packed each; null doc_id stays null; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import heapq
import re
import sys
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airshed.llm.common import ship_by_value, stored, table, utf8

ship_by_value(__name__)

MAX_TOKENS = 4096
END_ID = 1
GROUP_PIECES = 20_000   # pieces that one task packs together
RELEASED_BINS = 64      # emptiest bins of a group that are packed anew with other groups'
WORD_CACHE = 350_000    # chunks of up to CACHED_BYTES whose ids a task remembers; it forgets all beyond that
CACHED_BYTES = 64


def vocabulary_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def byte_symbols() -> dict[int, str]:
    """The character that stands for each byte in a byte-level vocabulary: itself where Latin-1 prints
    it, else the next of those from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + n) for n, b in enumerate(rest)}


#: What a vocabulary file must treat as ``ChunkIds`` does, or its texts go to its tokenizer whole.
PROBES = ["", "Plain words, in a line.", "it's IT'S we'll they'd I'm you're can't 's 't", "x1 2024 3.14 a1b2 -7%", "Ünïcode Größe ÉTÉ ß ÿ",
          "tab\tand\nline\r\n  ends ", "<|endoftext|> <| |> [CLS] </s>", "日本語 текст עברית 😀👍🏽", "e\u0301 \u00a0nbsp\u2003em \u00ad", "a_b#c@d//e--f...!?"]


class ChunkIds(dict):
    """Little-endian 32-bit ids of white-space separated chunks, by the given tokenizer.

    The tokenizer drops white space and looks at no neighbours, so a text's ids are its chunks'
    ids in turn.  Printable ASCII and the letters of Latin-1 need no normalising beyond lower case,
    so the model is asked for each part of the split directly; anything else goes through the whole
    tokenizer.  A vocabulary file of which this does not hold (``PROBES`` tell) gets each text whole.
    Both memories start anew at ``WORD_CACHE`` entries and hold no long ones."""

    PLAIN = re.compile("[\x21-\x7e\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+")
    PARTS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00df-\u00f6\u00f8-\u00ff]+|[0-9]|[^a-z0-9\u00df-\u00f6\u00f8-\u00ff]+")

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.parts: dict[str, bytes] = {}
        self.symbols = byte_symbols()
        self.by_chunks = all(self.of_chunks(t.encode()) == self.whole(t) for t in PROBES)

    @classmethod
    def kept(cls, path: str) -> "ChunkIds":
        """The one of this Python worker, which goes on from task to task."""
        known = vars(sys).setdefault("_airshed_chunk_ids", {})
        if path not in known:
            known[path] = cls(path)
        return known[path]

    def part(self, text: str) -> bytes:
        symbols = text if text.isascii() else "".join(map(self.symbols.__getitem__, text.encode()))
        ids = array("I", [t.id for t in self.model.tokenize(symbols)]).tobytes()
        if len(text) <= CACHED_BYTES:
            if len(self.parts) >= WORD_CACHE:
                self.parts.clear()
            self.parts[text] = ids
        return ids

    def whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def __missing__(self, chunk: bytes) -> bytes:
        text = chunk.decode()
        if self.PLAIN.fullmatch(text) and "<|" not in text:
            known = self.parts
            ids = b"".join([known.get(p) or self.part(p) for p in self.PARTS.findall(text.lower())])
        else:
            ids = self.whole(text)
        if len(chunk) <= CACHED_BYTES:
            if len(self) >= WORD_CACHE:
                self.clear()
            self[chunk] = ids
        return ids

    def of_chunks(self, text: bytes) -> bytes:
        return b"".join(map(self.__getitem__, text.split()))

    def of(self, text: bytes) -> bytes:
        return self.of_chunks(text) if self.by_chunks else self.whole(text.decode())


def pieces(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
           max_tokens: int = MAX_TOKENS, end_id: int = END_ID) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, row): the token pieces of every row; ``row`` counts
    the rows of a task, to deal repeated rows apart."""
    end, width = int(end_id).to_bytes(4, "little"), 4 * max_tokens

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks, row = ChunkIds.kept(tokenizer_path), 0
        for b in batches:
            out = []
            for i, t in zip(b.column(0).to_pylist(), b.column(1)):
                ids = chunks.of(t.as_py()) + end
                row += 1
                for k, at in enumerate(range(0, len(ids), width)):
                    part = ids[at:at + width]
                    out.append((i, k, at // 4, len(part) // 4, zlib.crc32(part), row))
            cols = list(zip(*out)) if out else [[]] * 6
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(cols, types)],
                                             ["doc_id", "piece", "start", "length", "ids_crc32", "row"])

    return docs.select(F.col(id_col).cast("long").alias("i"), utf8(text_col).alias("t")) \
        .mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long, row long")


# ---------------------------------------------------------------- one group

def best_fit(lengths: np.ndarray, room: int) -> np.ndarray:
    """Bin of each piece: longest first, each into the fullest bin that holds it."""
    bins = np.empty(len(lengths), np.int64)
    with_room: list[list[int]] = [[] for _ in range(room + 1)]
    mask, n = 0, 0  # bit r of mask: some bin has r tokens of room
    for i in np.argsort(-lengths, kind="stable").tolist():
        need = int(lengths[i])
        fits = mask >> need
        if fits:
            r = need + (fits & -fits).bit_length() - 1
            b = with_room[r].pop()
            if not with_room[r]:
                mask &= ~(1 << r)
        else:
            r, b, n = room, n, n + 1
        bins[i] = b
        if r > need:
            with_room[r - need].append(b)
            mask |= 1 << (r - need)
    return bins


class Offers:
    """What can be taken out of the open bins (those neither empty nor full) in one step: nothing, a
    piece or two; one entry of each size and bin.

    A step gives g tokens of bin e and takes t < g of bin b.  Let ``after`` be b's room without the t.
    The step fits if g <= after, and raises the sum of squared fills if b ends up fuller than e was,
    that is, if after - g < room of e.  So e's best partner is a minimum over a window of ``after``, and
    b's one a maximum over a window of g: both need one pass over the entries, whatever their number.
    Entries of changed bins are struck out (``after`` = -1) and written anew at the end."""

    def __init__(self, room: int):
        self.room, self.used, self.live = room, 0, 0
        self.size, self.after, self.bin = (np.full(1024, -1, np.int32) for _ in range(3))
        self.place: dict[int, tuple[int, int]] = {}

    def put(self, b: int, sizes: np.ndarray, free: int) -> None:
        """Replace b's entries."""
        if b in self.place:
            at, end = self.place.pop(b)
            self.after[at:end] = -1
            self.live -= end - at
        if not len(sizes):
            return
        if self.used + len(sizes) > len(self.size):
            self.pack(len(sizes))
        at, end = self.used, self.used + len(sizes)
        self.size[at:end], self.after[at:end], self.bin[at:end] = sizes, sizes + free, b
        self.place[b] = at, end
        self.used, self.live = end, self.live + len(sizes)

    def pack(self, more: int) -> None:
        """Drop what is struck out, and make room."""
        kept = np.flatnonzero(self.after[:self.used] >= 0)
        size = 2 * (len(kept) + more) + 1024
        for name in ("size", "after", "bin"):
            column = np.full(size, -1, np.int32)
            column[:len(kept)] = getattr(self, name)[kept]
            setattr(self, name, column)
        self.used, self.place = len(kept), {}
        bins = self.bin[:self.used]
        starts = np.flatnonzero(np.r_[True, bins[1:] != bins[:-1]]) if len(kept) else kept
        for at, end in zip(starts.tolist(), [*starts[1:].tolist(), self.used]):
            self.place[int(bins[at])] = at, end

    def of(self, b: int) -> np.ndarray:
        at, end = self.place.get(b, (0, 0))
        return self.size[at:end]

    def taken(self, free: int, gives: np.ndarray, e: int) -> tuple[int, int, int] | None:
        """(g, t, b): the step of the most tokens out of bin e that gives one of ``gives``."""
        size, after = self.size[:self.used], self.after[:self.used]
        hidden = self.place.get(e, (0, 0))
        kept = after[hidden[0]:hidden[1]].copy()
        after[hidden[0]:hidden[1]] = -1
        least = np.full(self.room + 2, self.room + 1, np.int32)  # the smallest t of each after; -1 is last
        np.minimum.at(least, after, size)
        best = sliding(least[:-1], free, np.minimum)[gives]
        gain = gives - best
        k = int(np.argmax(gain))
        found = None
        if gain[k] > 0:
            g, t = int(gives[k]), int(best[k])
            at = np.flatnonzero((size == t) & (after >= g) & (after < g + free))
            found = g, t, int(self.bin[at[np.argmin(after[at])]])
        after[hidden[0]:hidden[1]] = kept
        return found

    def given(self, free: int, takes: np.ndarray, b: int) -> tuple[int, int, int] | None:
        """(g, t, e): the step of the most tokens into bin b that takes one of ``takes``."""
        size, after = self.size[:self.used], self.after[:self.used]
        hidden = self.place.get(b, (0, 0))
        kept = after[hidden[0]:hidden[1]].copy()
        after[hidden[0]:hidden[1]] = -1
        most = np.full(self.room + free + 2, -1, np.int32)  # the largest g + room of e, of each g
        np.maximum.at(most, size, after)
        wins = sliding(most, free, np.maximum)[takes + 1] > takes + free
        found = None
        if wins.any():
            best = 0
            for t in takes[wins].tolist():
                at = np.flatnonzero((size > t) & (size <= t + free) & (after > t + free))
                k = at[np.argmax(size[at])]
                if size[k] - t > best:
                    best, found = int(size[k]) - t, (int(size[k]), t, int(self.bin[k]))
        after[hidden[0]:hidden[1]] = kept
        return found


def sliding(values: np.ndarray, width: int, pick: np.ufunc) -> np.ndarray:
    """``pick`` over each place and the ``width`` - 1 after it, as far as there are."""
    out, w = values.copy(), 1
    while w < width:
        step = min(w, width - w)
        out[:-step] = pick(out[:-step], out[step:])
        w += step
    return out


def improve(lengths: np.ndarray, bins: np.ndarray, room: int) -> np.ndarray:
    """Empty bins by moves and exchanges that raise the sum of squared fills, until no two bins have
    one; bins of each piece.

    A step is a move of a piece, or an exchange of one for one, one for two or two for one, between any
    two bins.  Emptier bins give first.  A bin that changed gives and receives anew, so that at the end
    every two bins were compared as they are; the order of steps bounds nothing."""
    bins = bins.copy()
    fill = np.bincount(bins, lengths, minlength=int(bins.max(initial=-1)) + 1).astype(np.int64)
    members: dict[int, list[int]] = {}
    for i, b in enumerate(bins.tolist()):
        members.setdefault(b, []).append(i)
    length = lengths.tolist()
    none, ones, twos = (Offers(room) for _ in range(3))
    nothing = np.zeros(1, np.int64)

    def offer(b: int) -> None:
        """Enter what bin b has: of equal lengths one, of equal sums of two one."""
        own = np.sort(lengths[members[b]])
        free = room - int(fill[b])
        if not len(own) or not free:
            for o in (none, ones, twos):
                o.put(b, own[:0], 0)
            return
        single = np.unique(own)
        both = np.add.outer(single, single)[np.triu_indices(len(single), 1)]
        twice = own[1:][own[1:] == own[:-1]]
        none.put(b, nothing, free)
        ones.put(b, single, free)
        twos.put(b, np.unique(np.r_[both, 2 * twice]), free)

    def pick(b: int, size: int, count: int) -> list[int]:
        """So many pieces of bin b that have that size."""
        if count == 0:
            return []
        seen: dict[int, int] = {}
        for i in members[b]:
            if count == 1 and length[i] == size:
                return [i]
            if count == 2 and size - length[i] in seen:
                return [seen[size - length[i]], i]
            seen[length[i]] = i
        raise AssertionError("no such pieces")

    def step(b: int, gives: bool) -> tuple[int, int] | None:
        """One step out of bin b, or into it: the other bin, moves before exchanges of fewer pieces."""
        free = room - int(fill[b])
        for kinds in (((1, 0),), ((1, 1),), ((1, 2), (2, 1))):
            best = None
            for give, take in kinds:
                mine = (none, ones, twos)[give if gives else take].of(b)
                theirs = (none, ones, twos)[take if gives else give]
                if not len(mine) or not theirs.live:
                    continue
                found = (theirs.taken if gives else theirs.given)(free, mine, b)
                if found and (best is None or found[0] - found[1] > best[0] - best[1]):
                    best, counts = found, (give, take)
            if best:
                g, t, other = best
                e, to = (b, other) if gives else (other, b)
                out, back = pick(e, g, counts[0]), pick(to, t, counts[1])
                for i, old, new in [*((i, e, to) for i in out), *((i, to, e) for i in back)]:
                    members[old].remove(i)
                    members[new].append(i)
                    bins[i] = new
                fill[e] -= g - t
                fill[to] += g - t
                offer(e)
                offer(to)
                return e, to
        return None

    for b in members:
        offer(b)
    giving = [(int(fill[b]), b) for b in none.place]  # bins whose steps to all others are to be looked for
    heapq.heapify(giving)
    open_to = set(none.place)
    receiving: set[int] = set()
    while open_to or receiving:
        if open_to:
            level, b = heapq.heappop(giving)
            if b not in open_to or level != fill[b]:
                continue
            gives = True
        else:
            b, gives = max(receiving, key=lambda k: (fill[k], k)), False
        changed = step(b, gives) if b in none.place else None
        if changed is None:
            (open_to if gives else receiving).discard(b)
            continue
        for k in changed:
            for todo in (open_to, receiving):
                todo.discard(k)
            if k in none.place:
                open_to.add(k)
                receiving.add(k)
                heapq.heappush(giving, (int(fill[k]), k))
    return bins


def pack_group(lengths: np.ndarray, room: int) -> np.ndarray:
    """Bin of each piece, numbered from 0 without gaps, the emptiest bins last."""
    bins = improve(lengths, best_fit(lengths, room), room)
    fill = np.bincount(bins, lengths)
    order = np.argsort(-fill, kind="stable")
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    return rank[bins]


def pack(parts: DataFrame, max_tokens: int = MAX_TOKENS, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """``parts`` (with doc_id, piece, length, row) with sequence_id and offset."""
    names = parts.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in parts.schema) \
        + ", sequence_id long, offset long, released boolean"

    def solver(round_no: int, last: bool):
        def solve(pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values(["length", "doc_id", "piece", "row"], ascending=[False, True, True, True])
            group = int(pdf.pop("deal").iloc[0])
            lengths = pdf["length"].to_numpy()
            bins = pack_group(lengths, max_tokens)
            order = np.argsort(bins, kind="stable")
            offset = np.empty(len(bins), np.int64)
            run = np.cumsum(lengths[order]) - lengths[order]
            starts = np.r_[True, bins[order][1:] != bins[order][:-1]]
            offset[order] = run - np.maximum.accumulate(np.where(starts, run, 0))
            fill = np.bincount(bins, lengths)
            emptiest = len(fill) - min(RELEASED_BINS, len(fill) // 4)  # a part only: rounds come to an end
            free = (bins >= emptiest) & (fill[bins] < max_tokens)
            return pdf.assign(sequence_id=(round_no << 56) | (group << 24) | bins, offset=offset,
                              released=free & (not last))
        return solve

    settled, work = [], stored(parts, "pieces")
    n, round_no = work.count(), 0
    while n:
        groups = max(1, -(-n // group_pieces))
        deal = F.pmod(F.xxhash64("doc_id", "piece", "row", F.lit(round_no)), F.lit(groups)).cast("int")
        done = stored(work.select(*names).withColumn("deal", deal).groupBy("deal")
                      .applyInPandas(solver(round_no, groups == 1), schema), "packed")
        settled.append(done.filter("not released"))
        if groups == 1:
            break
        work = done.filter("released")
        n, round_no = work.count(), round_no + 1
    if not settled:
        return work.selectExpr("*", "cast(null as long) sequence_id", "cast(null as long) offset")
    out = settled[0]
    for s in settled[1:]:
        out = out.unionByName(s)
    return out.drop("released")


def pack_documents(docs: DataFrame, tokenizer_path: str | None = None, id_col: str = "doc_id",
                   text_col: str = "text", max_tokens: int = MAX_TOKENS, end_id: int = END_ID) -> DataFrame:
    """Every token piece of ``docs`` with its place: doc_id, piece, start, length, ids_crc32,
    sequence_id, offset."""
    parts = pieces(docs, tokenizer_path or vocabulary_path(), id_col, text_col, max_tokens, end_id)
    return pack(parts, max_tokens).drop("row")


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` as pieces of sequences of at most 4096 tokens."""
    return pack_documents(table(spark, sf_dir, "documents"))


QUERIES = {"op5_best_fit_packing": op5_best_fit_packing}
ORACLE: dict[str, str] = {}
