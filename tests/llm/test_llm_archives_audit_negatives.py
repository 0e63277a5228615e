"""Operators 11 to 13 against brute force on small tables, and their defined cases."""

import gzip
import hashlib
import math
import random
import re
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from factorspark.llm import filter_audit as fa
from factorspark.llm import hard_negatives as hn
from factorspark.llm import warc

# --- 11

BIG = "<p>Ünïcode é</p>\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc" * 40
PAGES = [(1, "http://a/1", BIG), (2, "http://a/2", BIG), (9, "http://a/9", BIG), (3, "http://b c/ü\r\nX: 1", "small"),
         (4, None, None), (5, "u", ""), (6, "u", "small"), (None, "n", BIG), (None, "n2", "y" * 3000),
         (None, "n3", "y" * 3000), (7, "long", "z0\n" * 60_000), (8, "twin", "w" * 50_000), (8, "twin", "w" * 50_000),
         (10, "nul", "\x00\x01" * 600), (11, "lf", "\n" * 1200), (12, "crlf", "\r\n" * 1200)]
CLASHING = "page_id long, url string, html string, digest int, refers string, value int, key int, size int"


def pages_of(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2, 3, 4) for r in rows], CLASHING).repartition(3)


def archive(spark, tmp, rows, **how):
    path = f"{tmp}/w"
    warc.write_warc(pages_of(spark, rows), path, **how)
    return path


@pytest.mark.parametrize("segment", [100, 4096, 32 << 10])
def test_archives_round_trip(spark, tmp, segment):
    path = archive(spark, tmp, PAGES, segment_bytes=segment, chunk_bytes=77)
    r = warc.read_warc(spark, path).collect()
    assert all(x.verified for x in r) and len(r) == len(PAGES)
    stored = {x.record_id: bytes(x.payload) for x in r if x.type == "response"}
    back = Counter((x.page_id, stored[x.refers_to] if x.type == "revisit" else bytes(x.payload)) for x in r)
    assert back == Counter((i, (h or "").encode()) for i, _, h in PAGES)
    kinds = Counter((x.page_id, x.type) for x in r)
    assert kinds[9, "response"] == 1 and kinds[1, "revisit"] == kinds[2, "revisit"] == 1
    assert kinds[8, "response"] == 2 and kinds[3, "response"] == kinds[6, "response"] == 1
    # Without ids: the copy of page 9 revisits, and of two nameless equal pages one is stored.
    assert kinds[None, "revisit"] == 2 and kinds[None, "response"] == 1
    uri = {x.page_id: x.target_uri for x in r}
    assert uri[3] == "http://b%20c/%C3%BC%0D%0AX:%201" and uri[4] is None


def test_archive_files_are_valid(spark, tmp):
    """A plain reader of the format, byte by byte, sees every record."""
    import glob
    path = archive(spark, tmp, PAGES, segment_bytes=500)
    seen, lengths, totals = Counter(), defaultdict(dict), {}
    for name in glob.glob(f"{path}/*.gz"):
        raw = gzip.open(name).read()
        while raw:
            head, _, raw = raw.partition(b"\r\n\r\n")
            lines = head.split(b"\r\n")
            assert lines[0] == b"WARC/1.1"
            f = dict(line.split(b": ", 1) for line in lines[1:])
            n = int(f[b"Content-Length"])
            assert raw[n:n + 4] == b"\r\n\r\n"
            raw = raw[n + 4:]
            seen[f[b"WARC-Type"]] += 1
            origin = f.get(b"WARC-Segment-Origin-ID", f[b"WARC-Record-ID"])
            if b"WARC-Segment-Number" in f:
                lengths[origin][int(f[b"WARC-Segment-Number"])] = n
            if b"WARC-Segment-Total-Length" in f:
                totals[origin] = int(f[b"WARC-Segment-Total-Length"])
    assert seen[b"revisit"] == 4 and seen[b"response"] == 12 and seen[b"continuation"] > 100
    assert set(lengths) == set(totals) and all(sum(v.values()) == totals[k] for k, v in lengths.items())
    assert all(sorted(v) == list(range(1, len(v) + 1)) for v in lengths.values())


def _gz(path, name, data):
    import os
    os.makedirs(path, exist_ok=True)
    with gzip.open(f"{path}/{name}.gz", "wb") as f:
        f.write(data)


def test_broken_archives(spark, tmp):
    def rec(kind, rid, block, **more):
        f = [("WARC-Type", kind.encode()), ("WARC-Record-ID", rid)]
        return warc.record(f + [(k.replace("_", "-"), v) for k, v in more.items()], block) + b"\r\n\r\n"
    ok = warc.HTTP + warc.chunked(b"hello", 2)
    plain = b"HTTP/1.0 200 OK\r\n\r\nplain\r\n"
    gap = rec("response", b"<g>", b"HTTP/1.1 200 OK\r\n\r\nab", WARC_Segment_Number=b"1") + rec(
        "continuation", b"<g3>", b"ef", WARC_Segment_Origin_ID=b"<g>", WARC_Segment_Number=b"3",
        WARC_Segment_Total_Length=b"25")
    short = rec("response", b"<s>", b"HTTP/1.1 200 OK\r\n\r\nab", WARC_Segment_Number=b"1") + rec(
        "continuation", b"<s2>", b"cd", WARC_Segment_Origin_ID=b"<s>", WARC_Segment_Number=b"2",
        WARC_Segment_Total_Length=b"99")
    orphan = rec("continuation", b"<o2>", b"cd", WARC_Segment_Origin_ID=b"<o>", WARC_Segment_Number=b"2",
                 WARC_Segment_Total_Length=b"2")
    wrong = rec("response", b"<w>", ok, WARC_Payload_Digest=b"sha1:" + b"A" * 32)
    chunks = rec("response", b"<c>", warc.HTTP + b"5\r\nhel")
    path = f"{tmp}/b"
    # Two gzip members in one file, junk between records, a record cut off at the end, later segments first.
    _gz(path, "one", rec("response", b"<1>", ok) + b"junk\r\n\r\n" + rec("response", b"<2>", plain) + gap + short)
    with open(f"{path}/one.gz", "ab") as f:
        f.write(gzip.compress(orphan + wrong + chunks + rec("response", b"<3>", ok)[:-9]))
    _gz(path, "two", rec("continuation", b"<t2>", b"lo", WARC_Segment_Origin_ID=b"<t>", WARC_Segment_Number=b"2",
                         WARC_Segment_Total_Length=b"24") + rec("response", b"<t>", b"HTTP/1.1 200 OK\r\n\r\nhel",
                                                               WARC_Segment_Number=b"1"))
    r = {x.record_id: x for x in warc.read_warc(spark, path).where("type <> 'invalid' OR record_id IS NOT NULL").collect()}
    assert bytes(r["<1>"].payload) == b"hello" and bytes(r["<2>"].payload) == b"plain\r\n"
    assert bytes(r["<t>"].payload) == b"hello" and r["<t>"].verified
    for k in ("<g>", "<s>", "<o>", "<w>", "<c>"):
        assert not r[k].verified and r[k].payload is None, k
    assert "<3>" not in r and r["<o>"].type == "invalid"
    assert warc.read_warc(spark, path).where("type = 'invalid' AND record_id IS NULL").count() == 2


def test_chunk_framing():
    for n in (1, 2, 5, 100):
        for body in (b"", b"a", b"\r\n", b"0\r\n\r\n", bytes(range(256))):
            assert warc.unchunked(warc.chunked(body, n)) == body
    assert warc.unchunked(b"3;x=y\r\nabc\r\n0\r\nTrailer: 1\r\n\r\n") == b"abc"
    for bad in (b"", b"3\r\nab", b"x\r\n", b"3\r\nabcd\r\n0\r\n\r\n", b"1\r\na\r\n0\r\n", b"-1\r\n", b"1\r\na\r\n"):
        assert warc.unchunked(bad) is None, bad


def test_op11_contract(spark, tmp):
    pages = [p for p in PAGES if p[0] is not None and p[0] != 8]
    pages_of(spark, pages).write.parquet(f"{tmp}/pages.parquet")
    got = {r.page_id: r for r in warc.op11_warc(spark, tmp).collect()}
    assert len(got) == len(pages)
    for i, _, h in pages:
        raw = (h or "").encode()
        same = [j for j, _, x in pages if (x or "").encode() == raw]
        late = len(raw) >= 1000 and i < max(same)
        assert (got[i].payload_bytes, got[i].payload_digest, got[i].record_type, got[i].refers_to) == (
            len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if late else "response", max(same) if late else None)


def test_empty_archive(spark, tmp):
    pages_of(spark, []).write.parquet(f"{tmp}/pages.parquet")
    assert warc.op11_warc(spark, tmp).count() == 0


# --- 12


def fails_of(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    caps = len(re.findall("[A-Z]", text))
    return [len(w) < 200, 100 * len(set(w)) < 50 * len(w), 100 * caps > 2 * len(text),
            bool(re.search(r"[#$%&*|]", text))]


def audit_by_hand(docs, labels):
    known = defaultdict(lambda: [0, 0])
    for i, q, t in labels:
        if i is not None:
            known[i] = [max(known[i][0], int(q == 1)), max(known[i][1], int(t == 1))]
    first = {}
    for i, t, _ in docs:
        if i is not None:
            first[t or ""] = min(first.get(t or "", i), i)
    rows = [(p or "", [*fails_of(t or ""), i is not None and i > first[t or ""]],
             known[i] if i is not None else [0, 0]) for i, t, p in docs]
    out = {}
    for part in {p for p, _, _ in rows}:
        own = [(f, lab) for p, f, lab in rows if p == part]
        total = Counter()
        for order in permutations("ABCDE"):
            left = own
            for step, x in enumerate(order, 1):
                k = ord(x) - 65
                gone = [r for r in left if r[0][k]]
                left = [r for r in left if not r[0][k]]
                total[x] += len(gone)
                out[part, "".join(order), step] = [
                    len(left), len(gone), sum(f[k] for f, _ in own) - len(gone),
                    sum(f[k] and sum(f) == 1 for f, _ in own), sum(g[1][0] for g in gone), sum(g[1][1] for g in gone)]
        for (p, order, step), v in out.items():
            if p == part:
                v.append(total[order[step - 1]])
    return out


def test_audit_against_all_orders(spark):
    r = random.Random(5)
    word = lambda n: " ".join(f"w{r.randrange(n)}" for _ in range(r.choice([20, 199, 200, 300])))
    texts = [word(r.choice([50, 400])) + r.choice(["", " #", " A" * 40, "\x0b|"]) for _ in range(25)]
    texts += [None, "", " \t", "ÀÉ" * 300, "A" * 3, "é　x " * 200, "y " * 100_000]
    docs = [(i, r.choice(texts), r.choice(["s0", "s0", "s0", "s1", None, ""])) for i in range(150)]
    docs += [(3, docs[3][1], "s1"), (None, texts[0], "s0"), (None, None, None)]
    labels = [(i, r.choice([0, 1, None]), r.choice([0, 1, None])) for i in range(0, 200, 2)] + [(4, 1, 1), (None, 1, 1)]
    d = spark.createDataFrame([(*x, 1, "z", 2, 3) for x in docs],
                              "doc_id long, text string, source string, part int, fails string, good int, potential int").repartition(4)
    lab = spark.createDataFrame([(*x, "q") for x in labels], "doc_id long, quality int, toxic int, part string")
    got = {(x.part, x.filter_order, x.step): [x.kept, x.removed, x.redundant, x.unique_fails, x.good_lost,
                                              x.toxic_lost, x.shapley] for x in fa.filter_audit(d, lab).collect()}
    assert got == audit_by_hand(docs, labels)
    assert fa.filter_audit(d.limit(0), lab).count() == 0
    none = fa.filter_audit(d, lab.limit(0)).agg(F.max("good_lost"), F.max("toxic_lost")).first()
    assert tuple(none) == (0, 0)


@pytest.mark.parametrize("k", [1, 2, 3, 5])
def test_potential_is_the_shapley_potential(spark, k):
    """On any game: P(all) - P(all without i) is the mean gain of i, and the
    potential of the whole is shared out without rest."""
    r = np.random.default_rng(k)
    v = [0, *map(int, r.integers(-50, 50, (1 << k) - 1))]
    games = spark.createDataFrame([(v,)], "v array<long>")
    p = fa.with_potential(games, "v", k).first().potential
    unit, full = math.lcm(*range(1, k + 1)), (1 << k) - 1
    orders = list(permutations(range(k)))
    for i in range(k):
        gains = 0
        for o in orders:
            head = sum(1 << j for j in o[:o.index(i)])
            gains += v[head | 1 << i] - v[head]
        assert (p[full] - p[full ^ 1 << i]) * len(orders) == gains * unit
    assert sum(p[full] - p[full ^ 1 << i] for i in range(k)) == v[full] * unit


# --- 13


def negatives_by_hand(rows, positives=5, negatives=10):
    whole = [(i, y, [math.floor(256 * x) for x in v]) for i, v, y in rows
             if i is not None and y is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a in sorted({i for i, _, _ in whole if i % 100 == 0}):
        y, v = min((y, v) for i, y, v in whole if i == a)
        s = sorted((-sum(p * q for p, q in zip(v, w)), i, z) for i, z, w in whole if i != a and len(w) == len(v))
        for ns, i, _ in [x for x in s if x[2] == y][:positives]:
            found = [x for x in s if x[2] != y and 30 * -ns <= 100 * -x[0] <= 90 * -ns][:negatives]
            out += [(a, i, k, j, -ns, -t) for k, (t, j, _) in enumerate(found, 1)]
    return sorted(out)


def vectors_of(spark, rows, parts=5):
    return spark.createDataFrame([(*r, 1, "x", True) for r in rows],
                                 "vec_id long, embedding array<float>, label int, anchor int, id string, other boolean").repartition(parts)


def test_negatives_against_brute_force(spark):
    r = np.random.default_rng(3)
    centre = r.normal(size=(4, 8))
    rows = [(i, [float(np.float32(x)) for x in (centre[i % 4] + r.normal(size=8)) * (0 if i % 50 == 7 else 0.3)],
             int(r.choice(4, p=[.55, .25, .1, .1]))) for i in range(600)]
    one = rows[17][1]
    rows += [(700 + i, one, i % 3) for i in range(40)]                       # ties
    rows += [(800, one, 9), (None, one, 1), (801, None, 1), (802, [], 1), (803, [None] * 8, 1), (804, one, None),
             (805, [math.nan] * 8, 0), (806, [math.inf] + [0.0] * 7, 0), (900, [], 0), (901, [], 0), (902, [], 1),
             (1000, [1.0, 2.0], 0), (1001, [1.0, 1.0], 0), (1002, [0.5, 0.5], 1), (100, one, 0), (5, one, 2), (5, one, 1)]
    d = vectors_of(spark, rows)
    got = sorted(map(tuple, hn.hard_negatives(d, F.col("vec_id") % 100 == 0).collect()))
    assert got == negatives_by_hand(rows)
    few = sorted(map(tuple, hn.hard_negatives(d, F.col("vec_id") % 100 == 0, positives=2, negatives=3).collect()))
    assert few == negatives_by_hand(rows, 2, 3)


def test_negatives_in_blocks_and_small_buffers(spark, monkeypatch):
    r = np.random.default_rng(4)
    rows = [(i * 4, [float(x) for x in np.float32(r.normal(size=4))], int(r.integers(3))) for i in range(500)]
    monkeypatch.setattr(hn, "BLOCK_BYTES", 8 * 4 * 3)                        # three anchors a block
    monkeypatch.setattr(hn, "GATHER", 50)
    monkeypatch.setattr(hn, "TILE", 100)
    got = sorted(map(tuple, hn.hard_negatives(vectors_of(spark, rows), F.col("vec_id") % 100 == 0).collect()))
    assert got == negatives_by_hand(rows)


def test_negatives_of_nothing(spark):
    d = vectors_of(spark, [(1, [1.0], 0)])
    assert hn.hard_negatives(d, F.col("vec_id") % 100 == 0).count() == 0
    assert hn.hard_negatives(d.limit(0), F.col("vec_id") % 100 == 0).count() == 0
    assert hn.hard_negatives(d, F.lit(True)).columns == ["anchor_id", "positive_id", "rank", "negative_id",
                                                         "positive_score", "negative_score"]


def test_large_components_stay_whole():
    big = np.array([[1 << 40, -(1 << 31)]], np.int64)
    assert hn.inner(big, np.array([[1 << 20, 3]], np.int64)).tolist() == [[(1 << 60) - 3 * (1 << 31)]]
    assert hn.inner(np.array([[3, -5]]), np.array([[7, 2]])).tolist() == [[11]]


def test_windows_are_exact():
    for p in range(-40, 2000):
        lo, hi = hn.window(p, (30, 100), (90, 100))
        fits = [n for n in range(-60, 2000) if 30 * p <= 100 * n <= 90 * p]
        assert fits == list(range(lo, hi + 1)) or (not fits and lo > hi)
