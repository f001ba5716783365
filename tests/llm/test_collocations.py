import random
import re
from collections import Counter

import pytest

from airshed.llm import collocations as C

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def brute(rows, least, best=2000):
    f, total = Counter(), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", low):
            w = [x for x in re.split("[ \t]+", piece) if x]
            total[lang] += len(w)
            for k in range(1, 6):
                f.update((lang, *w[s:s + k]) for s in range(len(w) - k + 1))
    cand = {g: n for g, n in f.items() if len(g) > 2 and n >= least}
    inside = lambda p, q: any(q[1:][s:s + len(p) - 1] == p[1:] for s in range(len(q) - len(p) + 1))
    out = []
    for lang in total:
        own = {g: a for g, a in cand.items() if g[0] == lang}
        scored = []
        for g, a in own.items():
            if any(len(q) > len(g) and b >= a and inside(g, q) for q, b in own.items()):
                continue
            cuts = []
            for k in range(2, len(g)):
                left, right = f[g[:k]], f[(lang, *g[k:])]
                cuts.append((1000 * a * total[lang] // (left * right), k, left, right))
            score, _, left, right = min(cuts)
            scored.append((-score, -a, " ".join(g[1:]).encode(), left, right))
        out += [(lang, i + 1, p.decode(), -a, x, y, total[lang], -s) for i, (s, a, p, x, y) in enumerate(sorted(scored)[:best])]
    return sorted(out)


def some_rows(seed, n=300):
    rnd = random.Random(seed)
    vocab = ["the", "The", "of", "new", "york", "york,", "a", "la", "È", "İ", "x\x00y", "b."] + [f"w{i}" for i in range(60)]
    fixed = ["in the new york of a", "la la la la la la la", "one fixed long phrase here.", "half\tof  the\x0btime"]
    text = lambda: " ".join(rnd.choice(fixed) if rnd.random() < 0.15 else rnd.choice(vocab[:rnd.choice([4, 12, 72])])
                            for _ in range(rnd.randint(0, 40)))
    return [(i, text(), rnd.choice(["en", "en", "fr", None, "und", ""])) for i in range(n)]


@pytest.mark.parametrize("sample,lowered", [(8, 0.5), (100, 0.5), (3, 5.0), (10**9, 0.5)])
def test_equals_brute_force_whatever_the_sample_proposes(spark, monkeypatch, sample, lowered):
    """Small samples and high thresholds propose little: the border fails and passes follow."""
    monkeypatch.setattr(C, "LOWERED", lowered)
    rows = some_rows(4) + [(None, None, "en"), (None, "a " * 500, "en"), (7, "", None), (8, "z" * 200_000 + " ok", "fr"), (9, " .,;", "de")]
    docs = spark.createDataFrame([(i, t, g, 1, 2, 3) for i, t, g in rows],
                                 "doc_id long, text string, lang string, k int, n int, phrase int")
    got = C.collocations(docs, least=12, sample=sample)
    assert [t for _, t in got.dtypes] == ["string", "bigint", "string", *["bigint"] * 5]
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, 12)


def test_small_slices_small_bitmaps_and_the_best_only(spark, monkeypatch):
    monkeypatch.setattr(C, "SLICE_BYTES", 300)
    monkeypatch.setattr(C, "MOST_BITS", C.CHUNK)
    monkeypatch.setattr(C, "SALTS", 3)
    rows = some_rows(9)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    assert sorted(tuple(r) for r in C.collocations(docs, least=10, best=7).collect()) == brute(rows, 10, 7)


def test_empty_table(spark, tmpdir_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmpdir_path}/documents.parquet")
    assert C.op13_collocations(spark, tmpdir_path).count() == 0


def test_products_beyond_64_bits(spark):
    df = spark.sql("select 3000000000000L a, 9000000000000000L n, 3000000000001L l, 3000000000007L r")
    got = df.selectExpr(f"({C.SCORE}) as s").first().s
    assert got == 1000 * 3000000000000 * 9000000000000000 // (3000000000001 * 3000000000007)
