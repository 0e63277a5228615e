"""Bags of words: look-ups by frequency, tf-idf and common terms by hand, and
what is shuffled."""

import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from factorspark.plans.text import bow as bw
from factorspark.plans.text import classify as tc
from factorspark.plans.text import ngrams as ng

TEXTS = [(1, "Cats like cat food. The cat likes walking"), (2, "walk walked walking cats"), (3, None), (4, "!"),
         (5, "the food"), (5, "food walks"), (None, "cat zz9 walk"), (None, "cat cats")]


@pytest.fixture(scope="module")
def corpus(spark):
    docs = spark.createDataFrame(TEXTS, "doc_id long, text string").repartition(3)
    vocab = bw.vocabulary(docs)
    lemmas = bw.lemma_table(vocab)
    own = bw.bags(bw.normalised_counts(bw.term_counts(docs), lemmas))
    lemma = {r.word: r.lemma for r in lemmas.collect()}
    counts = Counter((i, lemma.get(w, w)) for i, t in TEXTS for w in re.findall(r"\w\w+", (t or "").lower())
                     if lemma.get(w, w) != "the")
    return docs, lemmas, own, counts


def test_bags_by_hand(corpus):
    _, _, own, counts = corpus
    got = Counter({(r.doc_id, x.term): x.tf for r in own.collect() for x in r.bag})
    assert got == counts and len({r.doc_id for r in own.collect()}) == own.count()
    assert counts[5, "food"] == 2 and counts[None, "cat"] == 3


def test_texts_are_shuffled_once(corpus):
    """Terms were shuffled by (document, term), before and after the lemmas."""
    _, _, own, _ = corpus
    own.count()
    plan = own._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(doc_id" in plan and not re.search(r"hashpartitioning\(doc_id#\d+L?, term", plan)


@pytest.mark.parametrize("most", [0, 1, 2, 100])
def test_look_up_by_frequency(spark, most):
    rows = [(i, w) for i, w in enumerate(["a"] * 9 + ["b"] * 4 + ["c", "d", "e", None])]
    table = [("a", "x", 9), ("a", "y", 9), ("b", "x", 4), ("c", "y", 1), ("e", "x", None), ("f", "x", 1)]
    got = bw.at_terms(spark.createDataFrame(rows, "id long, term string"),
                      spark.createDataFrame(table, "term string, list string, df long"), "df", most)
    assert Counter((r.id, r.term, r.list, r.df) for r in got.collect()) == Counter(
        (i, w, s, n) for i, w in rows for t, s, n in table if t == w)


@pytest.mark.parametrize("most", [1, 100])
def test_tfidf_by_hand(spark, corpus, monkeypatch, most):
    monkeypatch.setattr(bw, "HOT_TERMS", most)
    docs, _, own, counts = corpus
    lists = [("cat", "p"), ("food", "p"), ("cat", "q"), ("walk", "q"), ("absent", "q")]
    rows = bw.terms_of(own)
    w = bw.term_weights(spark.createDataFrame(lists, "word string, sentiment string"), bw.document_frequencies(rows),
                        docs.agg(F.count(F.lit(1)).alias("n"))).localCheckpoint()
    got = {(r.doc_id, r.sentiment, r.term): r.tfidf for r in bw.tfidf(own, w, bw.tfidf_sums(rows, w)).collect()}
    df = Counter(t for _, t in counts)
    weight = {(i, s, t): n * (math.log((1 + len(TEXTS)) / (1 + df[t])) + 1) for (i, t), n in counts.items() for u, s in lists if u == t}
    norm = Counter()
    for (i, s, _), x in weight.items():
        norm[i, s] += x * x
    assert got.keys() == weight.keys() and any(i is None for i, _, _ in got)
    assert all(abs(got[k] - x / math.sqrt(norm[k[0], k[1]])) < 1e-12 for k, x in weight.items())


def test_common_terms(spark, corpus):
    _, _, own, counts = corpus
    pr = spark.createDataFrame([(1, 2), (2, 5), (3, 1), (1, 2)], "doc_a long, doc_b long")
    got = Counter((r.doc_a, r.doc_b, r.term, r.product) for r in bw.common_terms(own, pr).collect())
    assert got == Counter((a, b, t, n * counts[b, t]) for a, b in [(1, 2), (2, 5), (3, 1), (1, 2)]
                          for (i, t), n in counts.items() if i == a and (b, t) in counts)


def test_vectors_of_bags(corpus):
    _, _, own, _ = corpus
    a = {r.doc_id: r.features for r in tc.hashed_tfidf(own, width=64).collect()}
    assert a == {r.doc_id: r.features for r in tc.hashed_tfidf(bw.terms_of(own), width=64).collect()}


def test_bigrams_are_not_shuffled_to_the_phrases(spark, monkeypatch):
    sent = spark.createDataFrame([(i, 0, ["new", "york", "is", "big", "new"]) for i in range(9)], "doc_id long, sent_id int, tokens array<string>")
    ph = spark.createDataFrame([("new", "york", 9, 0.9)], "a string, b string, count long, score double")
    limits = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    was = [spark.conf.get(c, None) for c in limits]
    try:
        for c in limits:
            spark.conf.set(c, "-1")
        out = ng.apply_phrases(sent, ph)
        assert {tuple(r.tokens) for r in out.collect()} == {("new_york", "is", "big", "new")}
        assert "BroadcastHashJoin [a#" in out._jdf.queryExecution().executedPlan().toString()
        monkeypatch.setattr(ng, "MOST_PAIRS", 0)                             # more than may be broadcast
        assert {tuple(r.tokens) for r in ng.apply_phrases(sent, ph).collect()} == {("new_york", "is", "big", "new")}
    finally:
        for c, v in zip(limits, was):
            spark.conf.set(c, v) if v is not None else spark.conf.unset(c)
