"""The operators against brute force on small tables, and their defined cases."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from factorspark.llm import (decontaminate, exact_dedup, graph, line_dedup, lm_score, ngram_join, packing,
                             substring_dedup, token_counts, toxicity)
from factorspark.llm.tokens import vocabulary

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
CLASH = "doc_id long, text string, hash long, spans string, sections int, label int, _n string"


def spaced(text, lower=True):
    text = text or ""
    return re.findall(r"[^\x20\x09-\x0D]+", text.translate(LOWER) if lower else text)


def docs_of(spark, rows):
    """Documents with further columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, 1, "x", None, 2, "y") for i, t in rows], CLASH).repartition(3)


def prose(r, n, words=60):
    return " ".join(r.choice("abcdefghij") * r.randrange(1, 3) + str(r.randrange(words)) for _ in range(n))


EDGES = [(900, None), (901, ""), (902, " \n\t"), (903, "Un"), (904, "ﬀ　é\x0bß"), (905, "x" * 300_000), (906, "\n\n\n")]


@pytest.fixture(scope="module")
def mixed():
    """Copies, near copies, shared passages, ties, and the edge cases."""
    r = random.Random(11)
    rows, base = [], [prose(r, r.randrange(60, 300)) for _ in range(12)]
    passage = prose(r, 70)
    for i in range(60):
        text = r.choice(base)
        kind = r.randrange(5)
        if kind == 1:
            words = text.split()
            for _ in range(r.randrange(1, 6)):
                words[r.randrange(len(words))] = f"edit{r.randrange(9)}"
            text = " ".join(words)
        elif kind == 2:
            text = prose(r, 30) + "\n" + passage + " " + prose(r, 20)
        elif kind == 3:
            text = prose(r, r.randrange(1, 80))
        rows.append((i, text))
    r.shuffle(rows)
    return rows + EDGES


# --- 1


def items_of(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string, spans int")


def hits(text, items, n=10):
    find = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
    w, hit, found = find(text), set(), set()
    for i, t, *_ in items:
        v = find(t)
        for p in range(max(len(v) - n + 1, 1) if v else 0):
            g = v[p:p + n]
            for q in range(len(w) - len(g) + 1):
                if w[q:q + len(g)] == g:
                    hit |= set(range(q, q + len(g)))
                    if i is not None:
                        found.add(str(i))
    return len(w), hit, found


def test_decontamination(spark, mixed, monkeypatch):
    r = random.Random(3)
    items = [(i, " ".join(t.split()[k:k + r.randrange(4, 16)]), 0) for i, (_, t) in enumerate(mixed[:20])
             for k in [r.randrange(3)]] + [(7, "Un", 0), (8, None, 0), (9, " ", 0), (None, "edit1", 0)]
    for chars in (1 << 20, 300):                              # one automaton, and several passes
        monkeypatch.setattr(decontaminate, "ITEM_CHARS", chars)
        got = {x.doc_id: x for x in decontaminate.matches(docs_of(spark, mixed), items_of(spark, items)).collect()}
        for i, t in mixed:
            n, hit, found = hits(t, items)
            assert got[i].n_words == n and set(got[i]["items"]) == found
            assert {q for a, z in got[i].spans for q in range(a, z)} == hit


def test_decontamination_removes_spans_and_documents(spark):
    rows = [(1, "keep this. One two three FOUR! and that"), (2, "one two three four"), (3, None), (4, "clean")]
    d = docs_of(spark, rows)
    out = decontaminate.remove(d, items_of(spark, [(1, "one two three four", 0)]))
    assert out.schema == d.schema
    assert {x.doc_id: x.text for x in out.collect()} == {1: "keep this. ! and that", 3: None, 4: "clean"}
    kept = decontaminate.remove(d, items_of(spark, [(1, "one two three four", 0)]), max_words=4, max_coverage=1.0)
    assert {x.doc_id: x.text for x in kept.collect()} == dict(rows)


# --- 2


@pytest.mark.parametrize("capacity, windows", [(16, 3), (64, 1), (2048, 16)])
def test_packing_round_trip(spark, mixed, capacity, windows):
    from tokenizers import Tokenizer
    rows = mixed + [(None, "no id"), (5, "again")]
    out = packing.pack(docs_of(spark, rows), capacity=capacity, windows=windows).collect()
    tokenizer, by, sequences = Tokenizer.from_file(vocabulary()), defaultdict(list), defaultdict(list)
    for x in out:
        by[x.doc_id, x.doc_tokens].append(x)
        sequences[x.sequence_id].append(x)
    want = Counter()
    for i, t in rows:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [1]
        want[i, len(ids)] += 1
        if want[i, len(ids)] > 1:
            continue
        at = 0
        for x in sorted(by[i, len(ids)], key=lambda x: x.start):
            assert x.start == at and x.ids == np.array(ids[at:at + x.length], "<u4").tobytes()
            assert x.ids_crc32 == zlib.crc32(x.ids)
            at += x.length
        assert at == len(ids)
    assert set(by) == set(want)
    for own in sequences.values():
        at = 0
        for x in sorted(own, key=lambda x: x.offset):
            assert x.offset == at and x.length > 0
            at += x.length
        assert at == capacity or at < capacity and at & (at - 1) == 0          # nothing to pad


def test_packer_places_best_fit_and_emits_the_fullest():
    p = packing.Packer(10, 2)
    for i, n in enumerate((6, 7, 3, 8)):                      # 3 fits best beside 7; 8 fits nowhere
        p.add(i, np.full(n, i))
    assert [[len(x[3]) for x in s] for s in p.done] == [[7, 3]]
    p.add(4, np.full(5, 4))                                   # the fullest (8) goes out, filled up
    assert [(x[0], len(x[3])) for x in p.done[-1]] == [(3, 8), (4, 2)]


# --- 3


def repeats(rows, window):
    words = [(i, spaced(t, False)) for i, t in rows]
    first = {}
    for i, w in words:
        for p in range(len(w) - window + 1):
            g = tuple(w[p:p + window])
            first[g] = min(first.get(g, i), i)
    out = {}
    for i, w in words:
        gone = {q for p in range(len(w) - window + 1) if first[tuple(w[p:p + window])] < i
                for q in range(p, p + window)}
        out[i] = len(w), len(gone), " ".join(x for q, x in enumerate(w) if q not in gone)
    return out


@pytest.mark.parametrize("window, seed", [(50, 16), (8, 3), (2, 1)])
def test_substring_dedup(spark, mixed, window, seed):
    got = {x.doc_id: x for x in substring_dedup.substring_dedup(docs_of(spark, mixed), window=window, seed=seed)
           .collect()}
    texts = dict(mixed)
    for i, (n, removed, kept) in repeats(mixed, window).items():
        assert (got[i].n_words, got[i].n_removed, got[i].kept) == (n, removed, kept)
        w = spaced(texts[i], False)
        for f in got[i].factors:                              # a factor says where it was read from
            source = spaced(texts[f.source], False)
            assert f.source < i and f.words >= window
            assert w[f.start:f.start + f.words] == source[f.source_start:f.source_start + f.words]


def test_substring_dedup_in_many_chunks(spark, mixed):
    d = docs_of(spark, mixed)
    spans = lambda flush: sorted((x.doc_id, s) for x in substring_dedup.factors(
        d, window=8, seed=3, flush=flush).collect() for s in np.frombuffer(x.spans, substring_dedup.SPAN)["start"])
    covered = lambda xs: {i for i, _ in xs}
    assert covered(spans(200)) == covered(spans(10**6))


def test_substring_dedup_without_ids(spark):
    long = " ".join(f"w{i}" for i in range(60))
    out = substring_dedup.substring_dedup(docs_of(spark, [(None, long), (4, long), (4, long)])).collect()
    assert sorted((x.doc_id or -1, x.n_removed) for x in out) == [(-1, 60), (4, 0), (4, 0)]


# --- 5


def test_token_counts(spark):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(vocabulary())
    size = {v: len(k) for k, v in tokenizer.get_vocab().items()}

    def brute(text, sections, rule):
        owner = [i for i, c in enumerate(text) for _ in c.encode()]
        at, tokens = 0, []
        for i in tokenizer.encode(text, add_special_tokens=False).ids:
            tokens.append((owner[at], owner[at + size[i] - 1] + 1))
            at += size[i]
        ref = [{"first": a, "middle": (a + z - 1) // 2, "last": z - 1}[rule] for a, z in tokens]
        out = [(k, a, z, sum(a <= x < z for x in ref), sum(a < z and (t < a < u or t < z < u) for t, u in tokens))
               for k, a, z in sections]
        outside = sum(not any(a <= x < z for _, a, z in sections) for x in ref)
        return out + ([(-1, None, None, outside, 0)] if outside else [])

    def lines(t):
        at, out = 0, []
        for i, x in enumerate(t.split("\n")):
            out.append((i, at, at + len(x)))
            at += len(x) + 1
        return out

    rows = [(1, "a\n\nbé日本 x\n "), (2, ""), (3, None), (4, "it's <|endoftext|> 'd\nthé,x \U0001f600"), (4, "again")]
    for rule in token_counts.RULES:
        got = Counter(tuple(x) for x in token_counts.token_counts(docs_of(spark, rows), rule=rule).collect())
        assert got == Counter((i, *x) for i, t in rows for x in brute(t or "", lines(t or ""), rule))
    sections = [(1, 5, 0, 4), (1, 6, 2, 99), (1, 7, 3, 1), (4, 1, 1, 9), (8, 1, 0, 2)]
    table = spark.createDataFrame(sections, "doc_id long, section long, start long, end long")
    got = Counter(tuple(x) for x in token_counts.token_counts(docs_of(spark, rows), table).collect())
    assert got == Counter((i, *x) for i, t in rows for x in brute(
        t or "", [(k, min(a, len(t or "")), max(min(a, len(t or "")), min(z, len(t or ""))))
                  for j, k, a, z in sections if j == i], "middle"))
    with pytest.raises(ValueError):
        token_counts.token_counts(docs_of(spark, rows), rule="nearest")


# --- 6


def test_network_gradients():
    """Analytic steps against finite differences."""
    import pyarrow as pa
    ids, first = toxicity.features(pa.array(["aa bb cc dd", "bb ee", "", "ff aa gg"]))
    y = np.array([1, 0, 0, 1], np.float32)

    def loss(net):
        p = toxicity._sigmoid(net.logit(ids, first))
        return -np.mean(np.where(y == 1, np.log(p), np.log(1 - p)))

    net = toxicity.Network(seed=3)
    net.trained = True
    for name in ("embed", "shift", "out", "bias"):
        setattr(net, name, getattr(net, name).astype(np.float64))
    net.filters = [w.astype(np.float64) for w in net.filters]
    net.shift += 0.01                                         # away from the kink for an empty text
    moved = {}
    net._move = lambda p, g, seen: moved.__setitem__(id(p), np.array(g, np.float64))
    state = {q: 0 for q in range(3)} | {"out": 0, "shift": 0, "bias": 0, "embed": np.full((len(net.embed), 1), np.inf)}
    net._step(ids, first, y, state)
    for p in (*net.filters, net.out, net.shift, net.bias):
        g = moved[id(p)]
        for at in [tuple(np.random.default_rng(k).integers(0, p.shape)) for k in range(6)]:
            old = p[at]
            p[at] = old + 1e-5
            up = loss(net)
            p[at] = old - 1e-5
            down = loss(net)
            p[at] = old
            assert (up - down) / 2e-5 == pytest.approx(g[at], rel=1e-3, abs=1e-6)


def test_toxicity_learns_and_calibrates(spark):
    r = random.Random(5)
    bad = ["vilename", "scumword", "trashtalk"]
    rows, labels = [], []
    for i in range(500):
        words, y = prose(r, r.randrange(5, 60)).split(), int(r.random() < 0.4)
        for _ in range(2 * y):
            words.insert(r.randrange(len(words)), r.choice(bad) + r.choice(["", "s", "ing"]))
        rows.append((i, " ".join(words), "en" if i % 3 else "de"))
        labels.append((i, y))
    rows += [(900, None, None), (901, "", "xx"), (902, "q " * 50_000, "en"), (902, "q vilename a1", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame(labels + [(903, 1), (904, None), (None, 1)], "doc_id long, toxic int")
    learn = labels.where(~toxicity.held_out(labels["doc_id"]) | labels["doc_id"].isNull())
    model = toxicity.fit(docs, learn, min_positive=5)
    assert set(model.thresholds) == {"de", "en"}
    got = {(x.doc_id, x.score): x for x in toxicity.toxicity(docs, model).collect()}
    y = dict(labels.collect())
    held = [x for x in got.values() if x.doc_id < 500 and zlib.crc32(str(x.doc_id).encode()) % 5 == 0]
    assert np.mean([(x.score >= 0.5) == y[x.doc_id] for x in held]) > 0.95
    assert np.mean([x.toxic == bool(y[x.doc_id]) for x in held]) > 0.95
    assert len(got) == len(rows) and all(0 <= x.score <= 1 for x in got.values())
    clean = toxicity.reject(docs, model)
    assert clean.schema == docs.schema
    assert {x.doc_id for x in clean.collect()} == {x.doc_id for x in got.values() if not x.toxic}


def test_toxicity_without_two_classes(spark):
    docs = docs_of(spark, [(1, "a"), (2, None)])
    for labels, score in (([], 0.0), ([(1, 0), (2, 0)], 0.0), ([(1, 1)], 1.0)):
        model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
        assert [round(x.score, 3) for x in toxicity.toxicity(docs, model).collect()] == [score, score]


def test_best_threshold():
    s, y = np.array([0.9, 0.8, 0.8, 0.4, 0.1]), np.array([1, 1, 1, 0, 0])
    assert toxicity.best_threshold(s, y, 0.9) == pytest.approx(0.6)
    assert toxicity.best_threshold(s, 1 - y, 0.9) == 1.0


def test_toxicity_thresholds_hold_for_the_natural_share(spark):
    r = random.Random(9)
    kinds = ["vilename"] * 1000 + ["maybe"] * 4000 + ["fine"] * 27_000
    rows = [(i, f"{prose(r, 3)} {k}", "en") for i, k in enumerate(kinds)]
    # A quarter of the texts with "maybe" is toxic: both words together have a precision of 0.4.
    labels = [(i, int(k == "vilename" or k == "maybe" and i % 4 == 0)) for i, k in enumerate(kinds)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"), train_rows=300, precision=0.5)
    y = dict(labels)
    out = [y[x.doc_id] for x in toxicity.toxicity(docs, model).where("toxic").select("doc_id").collect()]
    assert len(out) >= 900 and np.mean(out) >= 0.5
    assert min(model.thresholds["en"], model.other) < 1


def test_best_threshold_of_weighted_bins():
    bins, y = np.array([9, 9, 5, 5, 1]), np.array([1, 0, 1, 0, 0])
    low, high = np.array([0.8, 0.7, 0.5, 0.4, 0.1]), np.array([0.9, 0.75, 0.6, 0.45, 0.2])
    best = lambda *w: toxicity.best_threshold(bins, y, 0.9, np.array(w), low, high)
    assert best(90, 1, 9, 1, 50) == pytest.approx(0.3)
    assert best(90, 1, 9, 100, 50) == pytest.approx(0.65)
    assert best(90, 20, 9, 1, 50) == 1.0


# --- 7


def test_exact_dedup(spark, mixed):
    rows = mixed + [(100, "x y"), (101, "xy "), (102, "x  y"), (100, "x y"), (None, "xy"), (103, " x\ny")]
    got = Counter(tuple(x) for x in exact_dedup.exact_dedup(docs_of(spark, rows)).collect())
    groups = defaultdict(list)
    for i, t in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", t or "")].append((i, t or ""))
    want = Counter()
    for norm, own in groups.items():
        keep = min(own, key=lambda x: (-len(x[1]), x[0] is None, x[0] or 0))[0]
        for i, _ in own:
            want[i, keep, len(own), i == keep, hashlib.sha256(norm.encode()).hexdigest()] += 1
    assert got == want


# --- 8


def test_lm_score(spark, mixed):
    rows = mixed + [(None, "no id"), (3, "again twice")]
    seen = []
    learn = lm_score.expectation_maximisation

    def spy(*a):
        seen.append(learn(*a))
        return seen[0]

    lm_score.expectation_maximisation = spy
    try:
        d = docs_of(spark, rows)
        out = lm_score.lm_score(d, d["doc_id"] % 4 != 1, flush=500).collect()
    finally:
        lm_score.expectation_maximisation = learn
    weights = seen[0]
    assert np.allclose(weights.sum(axis=1), 1) and (weights > 0).all()
    tokens = [(i, [*spaced(t), None]) for i, t in rows]
    one, two = Counter(), Counter()
    for i, w in tokens:
        if i is not None and i % 4 != 1:
            one.update(w)
            one["start"] += 1
            two.update(zip(["start", *w], w))
    texts = one.pop("start")
    n, v = sum(one.values()), len(one)
    want = Counter()
    for i, w in tokens:
        base = sum(np.log10((one[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w)
        score = 0
        for a, x in zip(["start", *w], w):
            c = texts if a == "start" else one[a]
            l0, l1, l2 = weights[int(np.log2(c)) + 1 if c else 0]
            score += np.log10(l0 / (v + 1) + l1 * one[x] / n + (l2 * two[a, x] / c if c else 0))
        want[i, len(w), sum(one[x] > 0 for x in w), n, round(base, 6), round(score, 6)] += 1
    assert Counter((*x[:4], round(x[4], 6), round(x[5], 6)) for x in out) == want


def test_expectation_maximisation_finds_the_mixture():
    side = lm_score.FINE * lm_score.OCTAVES
    # Half of the tokens are only explained by the bigram, half only by the unigram.
    cell = np.array([(3 * side + 9) * side, 3 * side * side + 9])
    w = lm_score.expectation_maximisation(cell, np.array([5000, 5000]), 10**9)
    assert w[3] == pytest.approx([0, 0.5, 0.5], abs=1e-2)
    assert w[4] == pytest.approx([1 / 3] * 3)


# --- 9


def linked(rows, size=5, percent=80):
    sets = []
    for _, t in rows:
        w = spaced(t)
        sets.append({tuple(w[p:p + size]) for p in range(max(len(w) - size + 1, 1))} if w else set())
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    degree = [set() for _ in rows]
    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                up[root(a)] = root(b)
                if sets[a] != sets[b]:
                    degree[a].add(frozenset(sets[b]))
                    degree[b].add(frozenset(sets[a]))
    low = defaultdict(list)
    for k, (i, _) in enumerate(rows):
        if i is not None:
            low[root(k)].append(i)
    return Counter((i, len(sets[k]), min(low[root(k)], default=None) if sets[k] else i, len(degree[k]))
                   for k, (i, _) in enumerate(rows))


@pytest.mark.parametrize("flush, hot, rows_a_tile", [(10**6, 64, 512), (300, 2, 2), (300, 3, 5)])
def test_ngram_join(spark, mixed, monkeypatch, flush, hot, rows_a_tile):
    monkeypatch.setattr(ngram_join, "HOT_CLASSES", hot)
    monkeypatch.setattr(ngram_join, "TILE_ROWS", rows_a_tile)
    rows = mixed + [(None, mixed[0][1]), (0, "one two"), (77, "One two"), (78, "two one")]
    got = Counter(tuple(x) for x in ngram_join.ngram_join(docs_of(spark, rows), flush=flush).collect())
    assert got == linked(rows)


def test_ngram_join_of_a_large_near_copy_group(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "TILE_ROWS", 16)
    r = random.Random(1)
    base, rows = prose(r, 120, 1000).split(), []
    for i in range(90):
        w = list(base)
        for _ in range(r.randrange(0, 5)):
            w[r.randrange(len(w))] = f"e{r.randrange(10**6)}"
        rows.append((i, " ".join(w)))
    assert Counter(tuple(x) for x in ngram_join.ngram_join(docs_of(spark, rows)).collect()) == linked(rows)


def test_overlaps_in_steps(monkeypatch):
    monkeypatch.setattr(ngram_join, "STEP", 7)
    r = np.random.default_rng(2)
    rows = [np.unique(r.integers(0, 40, r.integers(1, 40))).astype(np.uint64) for _ in range(30)]
    n = np.array([len(x) for x in rows])
    side = np.arange(30) % 2
    for cross in (False, True):
        x, y = ngram_join.overlaps(rows, n, side, cross, 50)
        want = {(a, b) for a in range(30) for b in range(a + 1, 30) if not cross or side[a] != side[b]
                if 2 * len(set(rows[a]) & set(rows[b])) >= len(set(rows[a]) | set(rows[b]))}
        assert set(zip(x.tolist(), y.tolist())) == want


def test_components(spark):
    r = random.Random(4)
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [
        (r.randrange(200, 260), r.randrange(200, 260)) for _ in range(40)] + [(7, 7)]
    up = {}

    def root(i):
        while up.setdefault(i, i) != i:
            i = up[i]
        return i

    for a, b in edges:
        if a != b:
            x, y = sorted((root(a), root(b)))
            up[y] = x
    got = {x.node: x.label for x in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: root(i) for i in up if any(i in e and e[0] != e[1] for e in edges)}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- 10


def later_lines(rows, window):
    lines = [(i, [x for x in re.split(r"[\r\n]", t or "") if x]) for i, t in rows]
    first = {}
    for i, x in lines:
        for p in range(len(x) - window + 1):
            g = tuple(x[p:p + window])
            first[g] = min(first.get(g, (i, p)), (i, p))
    out = {}
    for i, x in lines:
        gone = {q for p in range(len(x) - window + 1) if first[tuple(x[p:p + window])] < (i, p)
                for q in range(p, p + window)}
        out[i] = len(x), len(gone), [y for q, y in enumerate(x) if q not in gone]
    return out


@pytest.mark.parametrize("window", [1, 2, 4])
def test_line_dedup(spark, window):
    r = random.Random(window)
    rows = [(i, "\n".join(r.choice("abcdefgh") * r.randrange(1, 3) for _ in range(r.randrange(0, 14))))
            for i in range(60)] + EDGES + [(950, "a\r\nb\n\n\nc"), (951, "a\nb\nc\n"), (952, "z\nz\nz\nz\nz")]
    got = {x.doc_id: x for x in line_dedup.line_dedup(docs_of(spark, rows), window=window).collect()}
    want = later_lines(rows, window)
    for i, t in rows:
        n, removed, kept = want[i]
        assert (got[i].n_lines, got[i].n_removed) == (n, removed)
        assert [x for x in re.split(r"[\r\n]", got[i].kept) if x] == kept
        assert sum(x.end - x.start for x in got[i].runs) == removed
        assert removed or got[i].kept == (t or "")
    d = docs_of(spark, rows)
    out = line_dedup.remove(d, window=window)
    assert out.schema == d.schema
    left = {x.doc_id: x.text for x in out.collect()}
    assert left == {i: got[i].kept if got[i].n_removed else t for i, t in rows
                    if not want[i][0] or want[i][1] < want[i][0]}


def test_line_dedup_repeated_ids(spark):
    out = line_dedup.line_dedup(docs_of(spark, [(1, "a\nb"), (1, "a\nb"), (None, "a\nb"), (2, "x\na\nb")])).collect()
    assert sorted((x.doc_id or 99, x.n_removed) for x in out) == [(1, 0), (1, 0), (2, 2), (99, 2)]


def test_line_dedup_of_one_long_line(spark):
    r = random.Random(3)
    long, wide, short = prose(r, 50), "漢" * 100, prose(r, 49)
    rows = [(1, f"a\n{long}\nb"), (2, f"c\n{long}\nd\n{long}"), (3, long), (4, f"{wide}\ne"), (5, f"f\n{wide}"),
            (6, f"g\n{short}"), (7, f"h\n{short}\ni"), (8, f"j\n{long}\ne\nk"), (9, f"l\n{long}\ne")]
    d = docs_of(spark, rows)
    got = {x.doc_id: (x.n_removed, [tuple(y) for y in x.runs]) for x in line_dedup.line_dedup(d).collect()}
    assert got == {1: (0, []), 2: (2, [(1, 2), (3, 4)]), 3: (1, [(0, 1)]), 4: (0, []), 5: (1, [(1, 2)]), 6: (0, []),
                   7: (0, []), 8: (1, [(1, 2)]), 9: (2, [(1, 3)])}
    left = {x.doc_id: x.text.split() for x in line_dedup.remove(d).collect()}
    assert 3 not in left and (left[2], left[5], left[8], left[9]) == (["c", "d"], ["f"], ["j", "e", "k"], ["l"])
    assert not any(x.n_removed for x in line_dedup.line_dedup(d, long_words=None).collect() if x.doc_id != 9)


def test_rows_are_told_apart_by_their_texts(spark):
    """Rows without an id, or with the same one, lose what their own text repeats."""
    r = random.Random(8)
    a, b, c, own = (prose(r, 60) for _ in range(4))
    rows = [(1, a), (None, f"{a} {own}"), (None, f"{b} {c}"), (None, f"{c} {b}"), (2, f"{a} {a}"), (2, f"{own} {c}")]
    got = [(x.doc_id, x.n_words, x.n_removed, x.kept) for x in substring_dedup.substring_dedup(docs_of(spark, rows)).collect()]
    left = Counter(w for x in got for w in [x[3]] if w)
    assert (2, 120, 0, f"{own} {c}") in got and (2, 120, 120, "") in got and (None, 120, 120, "") in got
    assert sorted(x[2] for x in got if x[0] is None) == [60, 120, 120] and left[b] == 1

    rows = [(1, "a\nb"), (None, "a\nb\nu\nv"), (None, "m\nn\no\np"), (None, "m\nn\nq"), (3, "s\nt"), (2, "a\nb\nx"), (2, "y\nz\nw")]
    got = [(x.doc_id, x.n_lines, x.n_removed) for x in line_dedup.line_dedup(docs_of(spark, rows)).collect()]
    assert {(1, 2, 0), (None, 4, 2), (2, 3, 2), (2, 3, 0), (3, 2, 0)} <= set(got)
    assert sorted(n for i, m, n in got if i is None) == [0, 2, 2] and len(got) == 7
    assert line_dedup.remove(docs_of(spark, [(1, "a\nb"), (2, "a\nb"), (2, "y\nz")])).count() == 2


# --- all


@pytest.mark.parametrize("rows", [[], [(1, None)]])
def test_empty_tables(spark, rows):
    d = docs_of(spark, rows)
    n = len(rows)
    assert decontaminate.matches(d, items_of(spark, [])).count() == n
    assert decontaminate.remove(d, items_of(spark, [])).count() == n
    assert packing.pack(d).count() == n
    assert substring_dedup.substring_dedup(d).count() == n
    assert token_counts.token_counts(d).count() == n
    assert exact_dedup.exact_dedup(d).count() == n
    assert [x.n_tokens for x in lm_score.lm_score(d, d["doc_id"] > 0).collect()] == [1] * n
    assert [x.component_id for x in ngram_join.ngram_join(d).collect()] == [1] * n
    assert line_dedup.remove(d).count() == n
