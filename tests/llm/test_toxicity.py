import random
import zlib

import numpy as np
import pandas as pd

from airshed.llm import toxicity as T

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy_on_the_given_labels(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    model = T.train(docs, labels)
    pdf = T.scored(docs.join(labels.select("doc_id"), "doc_id"), model).toPandas().merge(labels.toPandas(), on="doc_id")
    assert (pdf.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in pdf.doc_id]).all()
    test = pdf[pdf.held_out]
    wrong = (test.toxic != test.predicted)
    assert wrong[test.toxic == 0].mean() < 0.01 and wrong[test.toxic == 1].mean() < 0.2
    assert pdf.score.between(0, 1).all() and (pdf.predicted == (pdf.score >= 0.5)).all()


def named_groups(n=600):
    """Toxic texts name 'muslims' more often than clean ones do: a spurious cue."""
    rng = random.Random(6)
    words = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(n):
        toxic = i % 3 == 0
        text = [rng.choice(words) for _ in range(12)]
        if toxic and rng.random() < 0.8:
            text.append("vermin")
        if rng.random() < (0.6 if toxic else 0.1):
            text.append("muslims")
        elif rng.random() < 0.1:
            text.append("christians")
        rows.append((i, " ".join(text), int(toxic)))
    return rows


def test_swapped_terms_lose_their_weight(spark, docs_of):
    rows = named_groups()
    docs = docs_of([(i, t) for i, t, _ in rows])
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(2, None), (None, 1)], "doc_id long, toxic int")
    neutral = docs_of([(1, "muslims w1 w2 w3"), (2, "christians w1 w2 w3"), (3, "w1 vermin w2")])
    with_, without = ({r.doc_id: r.score for r in T.scored(neutral, T.train(docs, labels, swap_weight=w)).collect()}
                      for w in (T.SWAP_WEIGHT, 0.0))        # the query's own weight
    assert without[1] - without[2] > 0.1                    # the cue is learnt without the penalty
    assert abs(with_[1] - with_[2]) < 0.5 * abs(without[1] - without[2]) and with_[1] < without[1]
    assert with_[3] > 0.5


def test_neutral_mentions_are_flagged_less_with_the_penalty(spark, docs_of):
    """Clean texts of the fixture with each term put in: false positives with and without, same weight as the query."""
    rows = named_groups(900)
    docs, labels = docs_of([(i, t) for i, t, _ in rows]), spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    clean = [t for _, t, y in rows if not y and "vermin" not in t][:100]
    mentions = docs_of([(k, f"{t} {term}") for k, (t, term) in enumerate((t, term) for t in clean for term in ("muslims", "christians", "jews"))])
    flagged = {}
    for w in (T.SWAP_WEIGHT, 0.0):
        scores = [r.score for r in T.scored(mentions, T.train(docs, labels, swap_weight=w)).collect()]
        flagged[w] = float(np.mean([s >= 0.3 for s in scores]))  # 0.3: the share of toxic rows of the fixture
    assert flagged[T.SWAP_WEIGHT] < 0.6 * flagged[0.0], flagged


def test_penalty_is_made_of_every_sentence_of_the_given_labels(spark):
    """No given text names a group: the terms put into the sentences make the pairs, each term some of them."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    model = T.train(docs, labels)
    ids = {f: i for i, f in enumerate(model.weights)}
    texts = docs.join(labels.select("doc_id"), "doc_id").selectExpr("coalesce(text, '') as _t")
    changes = T.changes_of(texts, ids, T.IDENTITY).collect()
    sentences = sum(bool(T.words_in(s)) for r in texts.collect() for s in T.SENTENCE_END.split(r._t))
    assert sum(r.n for r in changes) == sentences > 1000
    terms = {w for kind in T.IDENTITY for w in kind}
    assert {w for r in changes for w in [f for f in model.weights if ids[f] in r.come] if w in terms} == terms
    # and what naming a group changes is close to nothing
    gap = [sum(model.weights[f] for f in T.features_of(t)) for t in terms]
    assert max(map(abs, gap)) < 0.5


def test_counterfactuals_swap_all_terms_of_a_kind_and_put_terms_in():
    kinds = [["men", "women", "girls"], ["old", "young"]]
    got = list(T.counterfactuals("Old men went. Rain fell", kinds))
    assert got[:2] == [({"old", "men", "went"}, {"young", "women", "went"}), ({"old", "men", "went"}, {"old", "girls", "went"})]
    own, other = got[2]
    assert own == {"rain", "fell"} and len(other - own) == 1 and other - own <= {"men", "women", "girls", "old", "young"}
    assert list(T.counterfactuals("", kinds)) == list(T.counterfactuals(" . ! ", kinds)) == [] == list(T.counterfactuals("a", []))


def test_identity_terms_may_come_from_a_table(spark):
    table = spark.createDataFrame([("g", "Alphas"), ("g", "betas"), ("g", "betas"), ("h", "x"), ("h", None)], "kind string, term string")
    assert T.identity_terms(table) == [["alphas", "betas"], ["x"]]
    rows = named_groups(200)
    docs = spark.createDataFrame([(i, t.replace("muslims", "alphas").replace("christians", "betas")) for i, t, _ in rows], "doc_id long, text string")
    model = T.train(docs, spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int"), identity=table)
    assert {"alphas", "betas"} <= set(model.weights) and "jews" not in model.weights


def test_scores_equal_a_plain_reading_of_the_weights(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    model = T.train(docs, labels)
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    for r in T.scored(docs, model).collect():
        words = "".join(c if ord(c) > 127 or c.isalnum() else " " for c in texts[r.doc_id].lower()).split()
        have = {f for w in words for f in [w] + [w[:n] + "*" for n in (4, 5) if len(w) >= n]}
        z = model.base + sum(v for f, v in model.weights.items() if f in have)
        assert abs(r.score - 1 / (1 + np.exp(-z))) < 1e-9


def test_fit_without_both_labels_is_constant():
    base, w = T.fit([[0], [1]], np.zeros(2), 2)
    assert (w == 0).all() and base < 0


def test_edge_cases(spark, docs_of):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    rows = [(1, None), (2, ""), (3, "x " * 30_000), (4, "ümlaut IDIOT!!"), (4, "ümlaut IDIOT!!"), (None, "no id")]
    got = pd.DataFrame([r.asDict() for r in T.scored(docs_of(rows), T.train(docs_of(rows), none)).collect()])
    assert len(got) == 6 and got.score.nunique() == 1 and (got.predicted == 0).all()
    assert got[got.doc_id.isna()].held_out.all()
    assert T.scored(docs_of([]), T.Model(0.0, {})).count() == 0
    model = T.Model(-2.0, {"idiot": 5.0, "idio*": 0.5})
    by_id = {r.doc_id: r for r in T.scored(docs_of(rows), model).collect()}
    assert by_id[4].predicted == 1 and by_id[2].score == by_id[1].score < 0.5
