import hashlib
import random
import zlib

import numpy as np
import pytest

from airshed.llm import periodic as P


def brute(w, least=12):
    """Every diagonal, cell by cell; of those that span the same words the smallest lag."""
    n, runs = len(w), {}
    for d in range(1, n):
        i = d
        while i < n:
            if w[i] != w[i - d]:
                i += 1
                continue
            j = i
            while j + 1 < n and w[j + 1] == w[j + 1 - d]:
                j += 1
            if j - i + 1 + d >= max(least, 2 * d):
                runs.setdefault((i - d, j), d)
            i = j + 1
    return sorted((s, p, e - s + 1) for (s, e), p in runs.items())


def collapsed(w, runs):
    gone = {i for s, p, n in runs for i in range(s + p, s + n)}
    return b" ".join(x for i, x in enumerate(w) if i not in gone)


def some_text(rnd):
    k, out = rnd.choice([1, 2, 2, 3, 5, 30]), []
    n = rnd.randint(0, 150)
    word = lambda: b"%d" % rnd.randrange(k)
    while len(out) < n:
        kind = rnd.random()
        if kind < 0.5:
            out += [word() for _ in range(rnd.randint(1, 30))] * rnd.randint(1, 6)
        elif out and kind < 0.75:
            a = rnd.randrange(len(out))
            out += out[a:a + rnd.randint(1, 60)]
        else:
            out += [word() for _ in range(rnd.randint(1, 9))]
    return out


@pytest.mark.parametrize("block", [2_000_000, 7])
def test_runs_equal_brute_force(monkeypatch, block):
    monkeypatch.setattr(P, "BLOCK_CELLS", block)
    rnd = random.Random(5)
    for _ in range(400):
        texts = [some_text(rnd) for _ in range(rnd.randint(1, 4))]
        for ws, (runs, rest) in zip(texts, P.solve(texts)):
            want = brute(ws)
            assert [(r["start"], r["period"], r["length"]) for r in runs] == want
            assert rest == collapsed(ws, want)


def test_long_texts_of_one_word_and_one_line():
    for w, period in ((np.zeros(200_000, np.int64), 1), (np.tile(np.arange(100), 3000), 100)):
        start, stop, lag = P.find_runs(w)
        assert (start.tolist(), stop.tolist(), lag.tolist()) == ([0], [len(w) - 1], [period])


def expected(i, text):
    ws = (text or "").encode().split()
    h = 1 if i is None else zlib.crc32(str(i).encode())
    n, g = len(ws), h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        ws = [ws[k] if k < a else ws[a + (k - a) % p] for k in range(n)]
    runs = brute(ws)
    best = min(((-m, s, p) for s, p, m in runs), default=None)
    lines = "".join(f"{s},{m},{p}\n" for s, p, m in sorted(runs))
    top = (best[1], -best[0], best[2], 1000 * -best[0] // best[2]) if best else (None,) * 4
    return (i, len(runs), *top, hashlib.sha256(lines.encode()).hexdigest(),
            hashlib.sha256(collapsed(ws, runs)).hexdigest())


def test_query_equals_brute_force_and_keeps_odd_rows(spark, tmpdir_path):
    rnd = random.Random(8)
    words = "la le aux qui, İ a. b\x00   ş".split(" ")
    texts = [" ".join(rnd.choice(words) for _ in range(rnd.randint(0, 60))) for _ in range(120)]
    rows = list(enumerate(texts)) + [(500, None), (501, ""), (502, " \n\t\v"), (None, "a " * 40), (7, texts[7]), (7, "a " * 14),
                                     (503, "x" * 300_000), (504, "é\n" * 500), (505, "a b\tc\nd\x0be\x0cf\rg " * 4)]
    docs = spark.createDataFrame([(i, t, "en", "s", 1, 2, 3) for i, t in rows],
                                 "doc_id long, text string, lang string, source string, runs int, best int, collapsed int")
    docs.write.parquet(f"{tmpdir_path}/documents.parquet")
    got = P.op11_periodic_runs(spark, tmpdir_path)
    assert got.dtypes[0] == ("doc_id", "bigint") and {t for _, t in got.dtypes[1:6]} == {"bigint"}
    key = lambda r: tuple(str(x) for x in r)
    assert sorted((tuple(r) for r in got.collect()), key=key) == sorted((expected(*r) for r in rows), key=key)


def test_empty_table(spark, tmpdir_path):
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmpdir_path}/documents.parquet")
    assert P.op11_periodic_runs(spark, tmpdir_path).count() == 0
