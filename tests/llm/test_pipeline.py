import ast
import os

import duckdb
import pytest

import __spark_entry__ as E
import corpus_pipeline as C
from airshed.llm import queries
from airshed.llm.common import stored
from tests.llm.test_decontaminate import slow as slow_hits
from tests.llm.test_packing import check_places, reference_ids
from tests.llm.test_simhash import slow_components, slow_fingerprint
from tests.llm.test_substring import slow as slow_repeats

SF = "/root/testdata/sf0.001"
TABLES = "documents pages benchmark labels".split()


def test_stages_match_brute_force(spark):
    given = spark.read.parquet(f"{SF}/documents.parquet")
    docs = {r.doc_id: r.text for r in given.collect()}
    kept = given
    for k, (name, stage) in enumerate(C.STAGES):
        before = {r.doc_id: r.text for r in kept.collect()}
        kept = stored(stage(spark, kept, SF), name)
        if k < 4:
            assert kept.columns == given.columns
            after = {r.doc_id: r.text for r in kept.collect()}
            assert set(after) <= set(before)
        if name == "quality_rules":
            labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
            dropped = set(docs) - set(after)
            assert {i for i, q in labels.items() if q == 0} & set(docs) <= dropped and len(dropped) < 0.35 * len(docs)
            assert all(after[i] == docs[i] for i in after)
        elif name == "near_duplicates":
            pairs = [(i, slow_fingerprint(t)) for i, t in before.items()]
            assert set(after) == set(slow_components(pairs))
        elif name == "substring_dedup":
            want = {i: b" ".join(w).decode() for i, _, _, w in slow_repeats(list(before.items()), 50)}
            assert {i: " ".join(t.encode().split() and [x.decode() for x in t.encode().split()]) for i, t in after.items()} == want
        elif name == "benchmark_decontamination":
            items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
            assert set(after) == {i for (i, *_, bad) in slow_hits(list(before.items()), items) if not bad}
            last = after
    rows = kept.collect()
    sizes = {i: len(reference_ids(t)) + 1 for i, t in last.items()}
    total = {}
    for r in rows:
        total[r.doc_id] = total.get(r.doc_id, 0) + r.length
    assert total == sizes and check_places(rows, 4096) <= -(-sum(sizes.values()) // 4096) + 1


def test_run_goes_through_all_stages_on_an_empty_table(spark, tmp_path):
    for t in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{SF}/{t}.parquet").limit(0).write.parquet(str(tmp_path / f"{t}.parquet"))
    assert C.run(spark, str(tmp_path)).count() == 0


def test_every_operator_has_one_query_in_the_entry():
    names = E.queries()
    for n in range(1, 11):
        assert len([x for x in names if x.startswith(f"op{n}_")]) == 1
    assert names["pipeline"] is C.run and len(C.STAGES) == 5


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = queries.QUERIES[name](spark, SF)
    res = con.sql(queries.ORACLE[name])
    order = sorted(df.columns)
    assert order == sorted(res.columns)
    want = [tuple(r[res.columns.index(c)] for c in order) for r in res.fetchall()]
    assert sorted(map(tuple, df.select(*order).collect()), key=repr) == sorted(want, key=repr)


def test_nothing_else_imports_the_subpackage():
    top = os.path.dirname(os.path.abspath(E.__file__))
    for folder, _, files in os.walk(os.path.join(top, "airshed")):
        if folder.endswith("llm") or "__pycache__" in folder:
            continue
        for f in files:
            if f.endswith(".py"):
                tree = ast.parse(open(os.path.join(folder, f)).read())
                names = [n.module or "" for n in ast.walk(tree) if isinstance(n, ast.ImportFrom)]
                names += [a.name for n in ast.walk(tree) if isinstance(n, ast.Import) for a in n.names]
                assert not [n for n in names if n.startswith("airshed.llm") or n == "corpus_pipeline"]


@pytest.mark.parametrize("name", ["op3_sharding", "op4_decontamination"])
def test_native_queries_run_no_python(spark, name):
    df = queries.QUERIES[name](spark, SF)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [x for x in ("Python", "Pandas", "MapInArrow", "CartesianProduct", "BroadcastNestedLoopJoin") if x in plan]
