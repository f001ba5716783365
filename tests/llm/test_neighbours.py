import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from airshed.llm import neighbours as N

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, is_query, k=10):
    ok = [(n, i, np.array(v, float)) for n, (i, v, *_) in enumerate(rows)
          if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = []
    for n, i, v in ok:
        if is_query(i):
            near = sorted((float(np.sqrt(((w - v) ** 2).sum())), j) for m, j, w in ok if m != n and len(w) == len(v))
            out += [(i, r + 1, j, d) for r, (d, j) in enumerate(near[:k])]
    return sorted(out)


def run(spark, path, rows):
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{path}/embeddings.parquet")
    return sorted(tuple(r) for r in N.op12_nearest_neighbours(spark, path).collect())


def random_rows(n, dim, seed, clusters=0):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, dim))
    if clusters:
        x = rng.standard_normal((clusters, dim))[rng.integers(0, clusters, n)] + 0.2 * x
    return [(i, [float(np.float32(c)) for c in v], 0) for i, v in enumerate(x)]


@pytest.mark.parametrize("clusters", [0, 12])
def test_recall_against_brute_force(spark, tmpdir_path, monkeypatch, clusters):
    monkeypatch.setattr(N, "BLOCK_ROWS", 700)   # several blocks of vectors
    monkeypatch.setattr(N, "QUERY_ROWS", 7)     # and of queries
    rows = random_rows(2500, 32, 3, clusters)
    got, want = run(spark, tmpdir_path, rows), brute(rows, lambda i: i % 100 == 0)
    assert [r[:2] for r in got] == [r[:2] for r in want]
    true = {(q, i) for q, _, i, _ in want}
    assert sum((q, i) in true for q, _, i, _ in got) >= 0.95 * len(want)
    by_id = {i: np.array(v) for i, v, _ in rows}
    for q, _, i, d in got:
        assert d == pytest.approx(np.linalg.norm(by_id[q] - by_id[i]), abs=1e-12)


def test_few_rows_odd_rows_ties_and_copies(spark, tmpdir_path):
    copies = [(1000 + i, [1.0, 2.0, 3.0], 0) for i in range(40)]
    odd = [(200, None, 0), (300, [], 0), (400, [0.0, 0.0, 0.0], 0), (500, [1.0, None, 2.0], 0), (600, [1.0, float("nan"), 2.0], 0),
           (700, [float("inf"), 1.0, 1.0], 0), (None, [1.0, 2.0, 3.0], 0)]
    other = [(0, [5.0, 5.0], 0), (1, [5.0, 6.0], 0), (100, [1.0, 2.0, 3.5], 0), (100, [1.0, 2.0, 3.5], 0), (7, [9.0, 9.0, 9.0], 0)]
    rows = copies + odd + other
    assert run(spark, tmpdir_path, rows) == brute(rows, lambda i: i % 100 == 0)


def test_no_rows(spark, tmpdir_path):
    assert run(spark, tmpdir_path, []) == []
    assert run(spark, f"{tmpdir_path}/b", [(1, [1.0], 0), (2, None, 0)]) == []


def test_other_query_sets_and_extra_columns(spark):
    rows = random_rows(120, 8, 4)
    df = spark.createDataFrame([(i, v, 1, 2, 3) for i, v, _ in rows], "vec_id long, embedding array<float>, row int, dim int, v int")
    got = sorted(tuple(r) for r in N.nearest(df, F.col("id") < 3, k=4).collect())
    assert [r[:3] for r in got] == [r[:3] for r in brute(rows, lambda i: i < 3, 4)]
