"""Rows that share ids in the n-gram stage, the classifier by plain loops, and
components of chunks."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from factorspark.llm import graph, ngram_join, toxicity


def words(r, n):
    return [f"w{r.randrange(10_000)}" for _ in range(n)]


def test_one_of_each_tells_rows_apart_by_id_and_text(spark):
    r = random.Random(6)
    a, b, c, d = (words(r, 60) for _ in range(4))
    near = lambda x: " ".join([*x[:-1], "edited"])
    rows = [(5, " ".join(a), 1), (5, " ".join(b), 1),          # one id, two texts that link with nothing of each other
            (7, near(a), 1), (4, near(b), 1),                   # copies of both; 4 is smaller
            (9, " ".join(c), 1), (9, " ".join(c), 2),           # the same row twice but for a column
            (None, " ".join(d), 1), (None, near(d), 1),         # two rows without id that link
            (None, near(c), 1),                                 # links with 9
            (None, "lone words of a row without id", 1),
            (20, None, 1), (20, "", 1), (21, " ", 3), (None, None, 1), (None, "", 2), (22, "a short text", 1), (23, "A short text", 1)]
    docs = spark.createDataFrame([(*x, {"k": "v"}, i % 1) for i, x in enumerate(rows)],
                                 "doc_id long, text string, own int, label map<string,string>, place int").repartition(4)
    out = ngram_join.one_of_each(docs)
    assert out.schema == docs.schema
    got = sorted(((x.doc_id, x.text) for x in out.collect()), key=str)
    kept_d = {t for i, t in got if i is None and t in (" ".join(d), near(d))}
    assert len(kept_d) == 1
    # Null and empty texts count as the same text.
    blanks = [(i, t) for i, t in got if not (t or "").strip()]
    assert sorted(str(i) for i, _ in blanks) == ["20", "21", "None"]
    rest = [x for x in got if (x[1] or "").strip() and x[1] not in kept_d]
    assert rest == sorted([(5, " ".join(a)), (4, near(b)), (9, " ".join(c)), (None, "lone words of a row without id"),
                           (22, "a short text")], key=str)
    again = sorted(((x.doc_id, x.text, x.own) for x in ngram_join.one_of_each(docs.repartition(7)).collect()), key=str)
    assert again == sorted(((x.doc_id, x.text, x.own) for x in out.collect()), key=str)


def test_one_of_each_keeps_distinct_texts_under_one_id(spark):
    r = random.Random(8)
    texts = [" ".join(words(r, 20)) for _ in range(30)]
    docs = spark.createDataFrame([(1, t) for t in texts], "doc_id long, text string")
    assert sorted(x.text for x in ngram_join.one_of_each(docs).collect()) == sorted(texts)


def plain_score(net, ids, first):
    """Score of each text by loops over places, filters and components."""
    out = []
    for a, z in zip(first, first[1:]):
        v = [[sum(float(net.embed[e][c]) for e in row) for c in range(toxicity.DIM)] for row in ids[a:z]]
        total, hidden = float(net.bias[0]), []
        for k, w in zip(toxicity.WIDTHS, net.filters):
            for f in range(toxicity.FILTERS):
                best = -math.inf
                for p in range(len(v) - k + 1):
                    best = max(best, sum(v[p + j][c] * float(w[j][c][f]) for j in range(k) for c in range(toxicity.DIM)))
                hidden.append(best)
        for h, (x, s, o) in enumerate(zip(hidden, net.shift, net.out)):
            total += max(x + float(s), 0.0) * float(o)
        out.append(1 / (1 + math.exp(-total)))
    return out


def test_network_is_the_plain_convolution(monkeypatch):
    r = random.Random(1)
    texts = [" ".join(f"{r.choice('abcdefg')}{r.randrange(50)}xyz"[: r.randrange(1, 8)] for _ in range(r.randrange(0, 25)))
             for _ in range(20)] + [None, "", "one", "Two words"]
    column = pa.array(texts, pa.string())
    ids, first = toxicity.features(column)
    y = np.array([i % 2 for i in range(len(texts))], np.float32)
    monkeypatch.setattr(toxicity, "STEPS", 20)
    net = toxicity.Network(seed=3).train(ids.copy(), first, y, epochs=1)
    net.embed[:] = np.random.default_rng(0).normal(0, 0.3, net.embed.shape).astype(np.float32)
    net.embed[0] = 0
    assert np.allclose(net.score(column), plain_score(net, ids, first), atol=1e-5)
    # The longest pass in slices and the way through bytes change nothing.
    monkeypatch.setattr(toxicity, "SLICE", 16)
    assert np.allclose(net.score(column), plain_score(net, ids, first), atol=1e-5)
    again = toxicity.Network.loads(net.dumps())
    assert np.array_equal(again.score(column), net.score(column))


def test_components_in_small_chunks(spark, monkeypatch):
    monkeypatch.setattr(graph, "CHUNK", 5)
    r = random.Random(3)
    edges = [(i, i + 1) for i in range(0, 60)] + [(r.randrange(100, 160), r.randrange(100, 160)) for _ in range(45)]
    up = {n: n for e in edges for n in e}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b in edges:
        up[max(root(a), root(b))] = min(root(a), root(b))
    df = spark.createDataFrame(edges, "a long, b long").repartition(6)
    got = {x.node: x.label for x in graph.components(df).collect()}
    assert got == {n: root(n) for n in up if any(n in e and e[0] != e[1] for e in edges)}
    assert graph.components(df.where(F.lit(False))).count() == 0
