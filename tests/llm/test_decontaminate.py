import random
import re

from airshed.llm import decontaminate as D

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return WORD.findall(lower)


def slow(docs, items):
    wins = {}
    for i, t in items:
        w = words(t)
        n = min(10, len(w))
        for s in range(len(w) - n + 1 if n else 0):
            wins.setdefault(tuple(w[s:s + n]), set()).add("null" if i is None else str(i))
    out = []
    for i, t in docs:
        w = words(t)
        hit, found = set(), set()
        for k, ids in wins.items():
            for s in range(len(w) - len(k) + 1):
                if tuple(w[s:s + len(k)]) == k:
                    hit |= set(range(s, s + len(k)))
                    found |= ids
        out.append((i, len(w), len(hit), len(found), sorted(found), bool(hit)))
    return out


def test_matches_brute_force(spark, docs_of):
    rng = random.Random(2)
    text = lambda n: " ".join(rng.choice("the of a in to x y z é ü".split()) for _ in range(n))
    items = [(i, text(rng.randint(1, 30))) for i in range(12)]
    items += [(20, "Short Item"), (21, "one"), (22, ""), (23, None), (None, "An item, without AN id"), (24, items[0][1]), (24, items[0][1])]
    docs = [(i, text(rng.randint(0, 60))) for i in range(40)]
    docs += [(100 + k, f"{text(20)} {t} {text(9)}") for k, (_, t) in enumerate(items)]
    docs += [(200, None), (201, ""), (202, "ÉCOLE É one! ONE"), (203, (items[0][1] or "") * 3), (203, items[0][1]), (None, items[1][1]),
             (204, " ".join(f"w{i}" for i in range(20_000)) + " " + items[2][1])]
    bench = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, doc_id string")
    got = sorted((tuple(r) for r in D.decontaminate(docs_of(docs), bench).collect()), key=repr)
    assert got == sorted(slow(docs, items), key=repr)
    clean = D.keep_clean(docs_of(docs), bench)
    assert clean.columns == docs_of(docs).columns
    assert sorted((r.doc_id for r in clean.collect()), key=repr) == \
        sorted((i for (i, *_, bad) in slow(docs, items) if not bad), key=repr)


def test_empty_tables(spark, docs_of):
    none = spark.createDataFrame([], "item_id long, text string")
    assert [tuple(r) for r in D.decontaminate(docs_of([(1, "a b")]), none).collect()] == [(1, 2, 0, 0, [], False)]
    assert D.keep_clean(docs_of([(1, "a b")]), none).count() == 1
    bench = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert D.decontaminate(docs_of([]), bench).count() == 0


def test_a_full_bitmap_changes_nothing(spark, docs_of, monkeypatch):
    items = [(i, " ".join(f"w{(i * 7 + k) % 50}" for k in range(14))) for i in range(30)]
    docs = [(i, " ".join(f"w{(i * 3 + k * (1 + i % 2)) % 50}" for k in range(60))) for i in range(20)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    monkeypatch.setattr(D, "MAX_BITMAP_BITS", 1)
    got = sorted((tuple(r) for r in D.decontaminate(docs_of(docs), bench).collect()), key=repr)
    assert got == sorted(slow(docs, items), key=repr)
