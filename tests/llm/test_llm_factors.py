"""Operator 3's parse: factors grow along their source and are looked up again
at their boundaries only."""

import random

import numpy as np
import pytest

from factorspark.llm import substring_dedup as sd


def parse_plain(texts, window):
    """Factors of each text by plain loops: (start, words, source, source start)."""
    out = []
    seen = {}
    for i, w in enumerate(texts):
        found, p = [], 0
        while p + window <= len(w):
            src = seen.get(tuple(w[p:p + window]))
            if src is None:
                p += 1
                continue
            j, q = src
            n = window
            while p + n < len(w) and q + n < len(texts[j]) and w[p + n] == texts[j][q + n]:
                n += 1
            found.append((p, n, j, q))
            p += n - window + 1
        out.append(found)
        for p in range(len(w) - window + 1):
            seen.setdefault(tuple(w[p:p + window]), (i, p))
    return out


def cover(spans, n):
    hit = np.zeros(n, bool)
    for a, k, *_ in spans:
        hit[a:a + k] = True
    return hit


def collection(seed):
    r = random.Random(seed)
    word = lambda: f"w{r.randrange(10 ** 6)}"
    pool = [[word() for _ in range(r.randrange(60, 200))] for _ in range(6)]
    texts = []
    for _ in range(40):
        t = []
        for _ in range(r.randrange(1, 5)):
            own = r.choice(pool)
            a = r.randrange(len(own))
            t += own[a:a + r.randrange(1, 160)] if r.random() < 0.7 else [word() for _ in range(r.randrange(1, 90))]
        texts.append(t)
    return texts + [["a"] * 300, ["a"] * 200, [], ["b"] * 50]


@pytest.mark.parametrize("seed,flush", [(1, 10 ** 9), (2, 500), (3, 1)])
def test_factors_against_a_plain_parse(spark, seed, flush):
    texts = collection(seed)
    want = parse_plain(texts, 50)
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string").repartition(4)
    raw = {}
    for row in sd.factors(docs, flush=flush).collect():
        raw.setdefault(row.doc_id, []).extend(np.frombuffer(row.spans, sd.SPAN).tolist())
    for i, t in enumerate(texts):
        got = sd.whole(raw.get(i, []), 50)
        assert (cover(got, len(t)) == cover(want[i], len(t))).all()
        for start, n, source, at in got:
            assert source < i and n >= 50 and texts[source][at:at + n] == t[start:start + n]


def test_a_factor_ends_where_its_source_does(spark):
    r = random.Random(4)
    x, y = ([f"{c}{r.randrange(10 ** 6)}" for _ in range(70)] for c in "xy")
    docs = spark.createDataFrame([(1, " ".join(x)), (2, " ".join(y)), (3, " ".join(x + y))], "doc_id long, text string")
    got = {d.doc_id: [tuple(f) for f in d.factors] for d in sd.substring_dedup(docs).collect()}
    assert got == {1: [], 2: [], 3: [(0, 70, 1, 0), (70, 70, 2, 0)]}


@pytest.mark.parametrize("abreast,piece", [(1, 1), (3, 7), (64, 1 << 14)])
def test_parse_looks_up_at_boundaries_only(monkeypatch, abreast, piece):
    """The earliest place of a window inside a factor is not asked for."""
    monkeypatch.setattr(sd, "ABREAST", abreast)
    monkeypatch.setattr(sd, "PIECE", piece)
    first = np.array([0, 100, 250])
    doc = np.repeat([0, 1, 2], [100, 150, 100])
    start = np.concatenate([np.arange(100), np.arange(150), np.arange(100)])
    full = np.concatenate([np.arange(100), np.r_[np.arange(20, 100), np.arange(500, 570)],
                           np.r_[np.arange(540, 570), np.arange(0, 70)]]).astype(np.uint64)
    anchor = np.zeros(350, np.uint64)
    got = sd._parse(np.arange(3), doc, start, anchor, full, first)
    assert got.T.tolist() == [[100, 80, 20], [250, 30, 220], [280, 70, 0]] or sorted(got.T.tolist()) == [
        [100, 80, 20], [250, 30, 220], [280, 70, 0]]
    # A longer match at another place than the earliest is not sought: greedy along the first source.
    assert sd._parse(np.array([0, 0, 0]), doc, start, anchor, full, first).shape == (3, 0)
