import base64
import re
from collections import Counter

import pytest
import tiktoken
from public_tokenizers import PATTERN
from pyspark.sql import functions as F

from airshed.llm import tokencounts as T
from airshed.session import scratch_path


def count(text):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(T.vocabulary_path(), "rb"))}
    return len(tiktoken.Encoding("t", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary(text))


def changes(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], "op string, seq int, doc_id long, source string, lang string, "
                                 "tokenizer_version string, n_tokens long, n_bytes long, extra string")


def totals(ledger):
    return {(r.source, r.lang, r.tokenizer_version): (r.n_docs, r.n_tokens, r.n_bytes) for r in ledger.totals().collect()}


def test_counts_are_the_tokenizers(spark, docs_of):
    rows = [(1, "Hello, world"), (2, None), (3, ""), (None, "naïve ü 😀 <|endoftext|>"), (4, "w " * 20_000)]
    got = T.counted(docs_of(rows), T.vocabulary_path()).select("doc_id", "n_tokens", "n_bytes").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(((i, count(t or ""), len((t or "").encode())) for i, t in rows), key=repr)


def test_batches_add_up_and_replays_change_nothing(spark):
    ledger = T.TokenLedger(spark, scratch_path(spark, "tokens"))
    assert totals(ledger) == {}
    first = changes(spark, [("insert", 0, 1, "a", "en", "v1", 10, 50), ("insert", 0, 2, "a", "en", "v1", 5, 20),
                            ("insert", 0, 3, None, None, "v1", 7, 9), ("insert", 0, 1, "a", "en", "v2", 12, 50),
                            ("insert", 0, None, "b", "en", "v1", 1, 2), ("insert", 0, None, "b", "en", "v1", 1, 2),
                            ("delete", 0, None, "b", "en", "v1", 1, 2), ("insert", 0, 2, "a", "en", "v1", 5, 20)])
    assert ledger.commit("b1", first) and not ledger.commit("b1", first)
    state = {("a", "en", "v1"): (2, 15, 70), (None, None, "v1"): (1, 7, 9), ("a", "en", "v2"): (1, 12, 50), ("b", "en", "v1"): (2, 2, 4)}
    assert totals(ledger) == state
    second = changes(spark, [("revise", 1, 1, "c", "en", "v1", 11, 51), ("delete", 0, 2, None, None, "v1", None, None),
                             ("delete", 0, 99, None, None, "v1", None, None), ("revise", 0, 4, "a", "de", "v1", 3, 3),
                             ("delete", 0, 1, None, None, "v1", None, None)])
    assert ledger.commit("b2", second)
    state = {(None, None, "v1"): (1, 7, 9), ("a", "en", "v2"): (1, 12, 50), ("b", "en", "v1"): (2, 2, 4), ("c", "en", "v1"): (1, 11, 51),
             ("a", "de", "v1"): (1, 3, 3)}
    assert totals(ledger) == state
    assert not ledger.commit("b2", second) and totals(ledger) == state
    assert ledger.commit("b3", changes(spark, [("insert", 0, 2, "z", "en", "v1", 1, 1), ("delete", 0, 3, None, None, "v1", None, None)]))
    del state[None, None, "v1"]
    assert totals(ledger) == state | {("z", "en", "v1"): (1, 1, 1)}
    assert ledger.commit("b4", first.filter("false")) and totals(ledger) == state | {("z", "en", "v1"): (1, 1, 1)}
    with pytest.raises(ValueError):
        ledger.commit("../x", first)


def test_a_batch_that_broke_off_is_written_anew(spark):
    ledger = T.TokenLedger(spark, scratch_path(spark, "tokens"))
    batch = changes(spark, [("insert", 0, i, "a", "en", "v1", 2, 4) for i in range(5)])
    batch.limit(2).selectExpr("doc_id", "source", "lang", "tokenizer_version", "1L n_docs", "n_tokens", "n_bytes") \
        .write.parquet(ledger._path("rows", "b1"))  # rows without totals: not committed
    assert totals(ledger) == {} and ledger.commit("b1", batch)
    assert totals(ledger) == {("a", "en", "v1"): (5, 10, 20)}


def test_query_matches_plain_counting(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    labels = {r.doc_id: r for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    n, tokens = Counter(), Counter()
    for d in docs:
        label = labels.get(d.doc_id)
        if label and label.quality == 0:
            continue
        group = ("review" if label and label.toxic == 1 else d.source, d.lang)
        n[group] += 1
        tokens[group] += count(d.text)
    out = T.op1_token_counts(spark, sf)
    got = {(r.source, r.lang): (r.n_docs, r.n_tokens) for r in out.collect()}
    assert got == {g: (n[g], tokens[g]) for g in n}
    assert out.select(F.countDistinct("tokenizer_version")).first()[0] == 1


def test_a_late_batch_reads_its_own_buckets(spark):
    ledger = T.TokenLedger(spark, scratch_path(spark, "tokens"))
    assert ledger.known(spark.createDataFrame([(1, "v1")], "doc_id long, tokenizer_version string")) is None
    assert ledger.commit("b0", changes(spark, []))
    rows = [("insert", 0, i, "a", "en", "v1", i, 1) for i in range(300)] + [("insert", 0, None, "a", "en", "v1", 5, 1)] * 3
    assert ledger.commit("b1", changes(spark, rows))
    late = spark.createDataFrame([(7, "v1"), (7, "v2"), (900, "v1")], "doc_id long, tokenizer_version string")
    known = ledger.known(late)
    assert [(r.doc_id, r.n_tokens) for r in known.collect()] == [(7, 7)]
    plan = known._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*bucket#\d+ IN \(-?\d+,-?\d+\)", plan), plan
    assert totals(ledger) == {("a", "en", "v1"): (303, sum(range(300)) + 15, 303)}
    assert ledger.commit("b2", changes(spark, [("delete", 0, 7, None, None, "v1", None, None)]))
    assert totals(ledger) == {("a", "en", "v1"): (302, sum(range(300)) + 8, 302)}
