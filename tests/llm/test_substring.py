import hashlib
import random

import pytest

from airshed.llm import substring as S
from airshed.llm.automata import SuffixAutomaton


def slow(docs, span):
    """(doc_id, n_words, n_removed, kept words) by the definition."""
    key = lambda i: float("inf") if i is None else i
    words = [(i, (t or "").encode().split()) for i, t in docs]
    least = {}
    for i, w in words:
        for s in range(len(w) - span + 1):
            k = tuple(w[s:s + span])
            least[k] = min(least.get(k, float("inf")), key(i))
    out = []
    for i, w in words:
        gone = set()
        for s in range(len(w) - span + 1):
            if least[tuple(w[s:s + span])] < key(i):
                gone |= set(range(s, s + span))
        out.append((i, len(w), len(gone), [x for j, x in enumerate(w) if j not in gone]))
    return out


def test_automaton_owners_match_brute_force():
    rng = random.Random(1)
    for t in range(200):
        docs = [[rng.choice("ab" if t % 2 else "abc") for _ in range(rng.randint(0, 14))] for _ in range(6)]
        own = [rng.randint(0, 9) for _ in docs]
        a = SuffixAutomaton()
        for d, o in zip(docs, own):
            a.add(d, o)
        a.seal()
        for span in (1, 2, 3, 5):
            text = [rng.choice("abc") for _ in range(15)]
            for x in [*docs, text]:
                has = lambda d, w: any(d[j:j + span] == w for j in range(len(d) - span + 1))
                assert a.owners(x, span) == [min((o for d, o in zip(docs, own) if has(d, x[i:i + span])), default=None)
                                             for i in range(len(x) - span + 1)]


def corpus():
    rng = random.Random(8)
    word = lambda: rng.choice(["the", "of", "x", "yy"]) if rng.random() < 0.4 else f"w{rng.randint(0, 500)}"
    some = lambda n: [word() for _ in range(n)]
    passages = [some(rng.randint(8, 60)) for _ in range(5)]
    docs = []
    for i in range(60):
        w = some(rng.randint(0, 80))
        for p in rng.sample(passages, rng.randint(0, 2)):
            at = rng.randint(0, len(w))
            w = w[:at] + p + w[at:]
        docs.append((i, "\n".join(" ".join(w[k:k + 9]) for k in range(0, len(w), 9))))
    docs += [(100, docs[3][1]), (2, docs[40][1]), (101, docs[5][1]), (101, docs[5][1]), (None, docs[7][1]), (None, docs[7][1] + " z"),
             (102, None), (103, ""), (104, " \t"), (105, "again " * 300), (106, "again " * 200), (107, "the end")]
    return docs


@pytest.mark.parametrize("shard", [S.SHARD_SEGMENTS, 2])
def test_removed_words_match_brute_force(docs_of, monkeypatch, shard):
    monkeypatch.setattr(S, "SHARD_SEGMENTS", shard)  # 2: most shards are too large and are cut again, twice
    docs = corpus()
    got = sorted((tuple(r) for r in S.dedup_report(docs_of(docs), span=10).collect()), key=repr)
    want = slow(docs, 10)
    assert sum(w[2] for w in want) > 500
    assert got == sorted(((i, n, r, hashlib.sha256(b" ".join(k)).hexdigest()) for i, n, r, k in want), key=repr)


def test_texts_are_cut_and_columns_kept(docs_of):
    docs = corpus()
    out = S.without_repeats(docs_of(docs), span=10)
    assert out.columns == docs_of(docs).columns
    got = sorted(((r.doc_id, (r.text or "").split(), r.text is None) for r in out.collect()), key=repr)
    assert got == sorted(((i, [x.decode() for x in k], t is None) for (i, t), (_, _, _, k) in zip(docs, slow(docs, 10))), key=repr)
    for r in out.collect():
        assert r.n_chars == (None if r.text is None else len(r.text))
    whole = {i: t for i, t in docs}
    for (i, n, removed, _) in slow(docs, 10):
        if not removed and i == 107:
            assert out.filter("doc_id = 107").first().text == whole[107]


def test_a_large_shard_is_cut_until_its_automata_are_small(docs_of, monkeypatch):
    """A shared passage between ever different words: one anchor, many segments."""
    rng = random.Random(4)
    core = [f"c{i}" for i in range(14)]
    docs = [(i, " ".join([f"a{rng.randint(0, 30)}" for _ in range(6)] + core + [f"z{rng.randint(0, 30)}" for _ in range(6)])) for i in range(120)]
    docs += [(500 + i, "again " * (15 + i)) for i in range(40)]
    monkeypatch.setattr(S, "SHARD_SEGMENTS", 10)
    levels = []
    plain = S.cut_again
    monkeypatch.setattr(S, "cut_again", lambda segs, span, level: levels.append(level) or plain(segs, span, level))
    got = sorted(tuple(r) for r in S.dedup_report(docs_of(docs), span=10).collect())
    assert got == sorted((i, n, r, hashlib.sha256(b" ".join(k)).hexdigest()) for i, n, r, k in slow(docs, 10))
    assert levels == [1, 2]


def test_long_words_are_not_remembered():
    known = S.WordHashes()
    assert known[b"x" * 20_000] == known[b"x" * 20_000] and not known
    assert known[b"short"] == known[b"short"] and list(known) == [b"short"]


def test_empty_table_and_long_text(docs_of):
    assert S.dedup_report(docs_of([])).count() == 0 and S.without_repeats(docs_of([])).count() == 0
    long_text = " ".join(f"w{i}" for i in range(40_000))
    got = {r.doc_id: (r.n_words, r.n_removed) for r in
           S.dedup_report(docs_of([(1, long_text), (2, "a " + long_text + " b"), (3, long_text[:100])])).collect()}
    assert got == {1: (40_000, 0), 2: (40_002, 40_000), 3: (len(long_text[:100].split()), 0)}


def test_the_largest_id_is_an_id(spark, docs_of):
    top = (1 << 63) - 1
    words = " ".join(f"w{i}" for i in range(60))
    got = {r.doc_id: (r.n_words, r.n_removed) for r in S.dedup_report(docs_of([(5, words), (top, words), (None, words)])).collect()}
    assert got == {5: (60, 0), top: (60, 60), None: (60, 60)}


def test_the_two_hashes_of_a_segment_are_independent(spark):
    from pyspark.sql import functions as F
    one = spark.createDataFrame([("a b c",)], "seg string").select(F.xxhash64("seg").alias("d1"), F.xxhash64(F.lit(1), "seg").alias("d2")).first()
    chained = spark.createDataFrame([(one.d1,)], "d long")
    assert one.d2 not in (one.d1, chained.select(F.xxhash64(F.lit(1))).first()[0])
