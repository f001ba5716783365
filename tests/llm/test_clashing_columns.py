"""The pipeline's stages keep columns that are named like their own helpers, with their values."""

import pytest

import corpus_pipeline as C

SF = "/root/testdata/sf0.001"
NAMES = ("_id _hash _at _text _verdict _hash_ _ID id text_hash t row w found h h8 fp least m rank verdict kept n at start seg "
         "owners length score window item len none count").split()


@pytest.mark.parametrize("stage", [s for s in C.STAGES if s[0] != "best_fit_packing"], ids=lambda s: s[0])
def test_clashing_columns_pass_through(spark, stage):
    name, run = stage
    given = spark.read.parquet(f"{SF}/documents.parquet")
    names = [n for k, n in enumerate(NAMES) if n.lower() not in {x.lower() for x in NAMES[:k]} | {c.lower() for c in given.columns}]
    extra = given.selectExpr("*", *[f"concat('{n}', doc_id) as `{n}`" for n in names])
    out, plain = run(spark, extra, SF), run(spark, given, SF)
    assert out.columns == extra.columns
    rows = out.collect()
    assert all(r[n] == f"{n}{r.doc_id}" for r in rows for n in names)
    assert sorted((r.doc_id, r.text, r.n_chars) for r in rows) == sorted((r.doc_id, r.text, r.n_chars) for r in plain.collect())
