import random

import numpy as np
from pyspark.sql import functions as F

from airshed.llm import boosting, quality as Q


def slow_counts(text):
    import re
    words = re.findall("[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search("[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    hit = {j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(i, i + 8)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""),
            sum(x in lines[:i] for i, x in enumerate(lines)), len(hit))


TEXTS = ["", None, "one", "a b\na b\n\n \na b", "é# ß* 😀$ %&|<>", "x y z w v u t s " * 3 + "end",
         "line one\nline two\nline one", "  nbsp is no space", "w" * 5000 + " tail"]


def test_counts_match_definition():
    for t in TEXTS:
        assert Q.statistics((t or "").encode())[:5] == slow_counts(t)


def test_trees_are_monotonic_and_learn():
    rng = np.random.default_rng(0)
    x = rng.uniform(0, 1, (3000, 3))
    y = ((x[:, 0] < 0.5) & (x[:, 1] > 0.3) | (rng.uniform(size=3000) < 0.05)).astype(float)
    model = boosting.fit(x, y, np.array([-1, 1, 0]))
    assert ((model.score(x) >= 0.5) == (y > 0)).mean() > 0.93
    base = rng.uniform(0, 1, (200, 3))
    for feature, sign in ((0, -1), (1, 1)):
        grid = np.repeat(base, 30, 0)
        grid[:, feature] = np.tile(np.linspace(-0.2, 1.2, 30), 200)
        steps = np.diff(model.margin(grid).reshape(200, 30), axis=1)
        assert (sign * steps >= -1e-9).all()
    assert len(boosting.fit(np.zeros((0, 3)), np.zeros(0), np.zeros(3)).feature) == 0


def corpus(n=400):
    rng = random.Random(4)
    vocabulary = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9))) for _ in range(800)]
    rows = []
    for i in range(n):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(25, 200))]
        if i % 4 == 0:
            words = [w + rng.choice(["%%%", "$$$", "***"]) for w in words]
        rows.append((i, " ".join(words)))
    return rows


def test_rules_keep_clean_documents_out_of_sample(spark, docs_of):
    rows = corpus()
    labels = spark.createDataFrame([(i, 0 if i % 4 == 0 else 1) for i, _ in rows if i < 250] + [(3, None), (None, 1), (9999, 0)],
                                   "doc_id long, quality int")
    kept = {r.doc_id for r in Q.keep_good(docs_of(rows), labels).collect()}
    clean = {i for i, _ in rows if i % 4}
    assert len(clean - kept) <= 2 and len(kept - clean) <= 2


def test_edge_cases_have_defined_verdicts(spark, docs_of):
    good = " ".join(f"word{i}" for i in range(60))
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(50, good), (50, good), (None, good), (51, "a b c d e f g h " * 40)]
    none = spark.createDataFrame([], "doc_id long, quality int")
    docs = docs_of(rows)
    out = Q.judged(docs, Q.train(docs, none)).select("doc_id", "text", "_verdict.*").collect()
    for r in out:
        n = slow_counts(r.text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == n
        assert r.base_failed == (n[0] < 20 or 100 * n[4] > 30 * n[0])
        assert r.kept == (not r.base_failed)  # no labels: the trees keep all
    assert Q.keep_good(docs, none).columns == docs.columns and Q.keep_good(docs, none).count() == 3
    assert Q.keep_good(docs_of([]), none).count() == 0
    assert docs.select(Q.stats_of("text").alias("s")).select(F.sum("s.n_words")).first()[0] > 0
