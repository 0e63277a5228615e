"""Operator 3, substring dedup by relative Lempel-Ziv parsing.

A document is parsed against the earlier ones: a factor is a stretch of at
least ``window`` words that also stands, word for word, in a source with a
smaller id.  The reference index holds every ``window``-word window with its
earliest place.  It is dealt to blocks by the window's minimizer, the smallest
hash of a ``seed``-word gram in it: equal windows have the same minimizer, so a
document meets exactly those reference blocks that can hold one of its
windows, and no others.  (Parsing against each block in turn would be
quadratic in the blocks.)  In a block a stretch is looked up where it begins;
a factor grows greedily along its source, window by window, as long as the two
go on alike, and the next look-up is at its boundary, ``window`` - 1 words
before its end, so no repeat hides between two factors.  Pieces of a factor
that different blocks found are put together at the end.

Before the shuffle a task parses what it has gathered in the same way: only
windows that no factor holds go out.  A passage in a
third of all documents costs one entry a task.  Everything travels as packed
arrays: words are hashed to 64 bits, a window is known by its own 64 bits and
those of its minimizer.

Defined cases: a null or short text has no windows and keeps its words; rows
that repeat an id are one document (nothing in them repeats an earlier one
because of each other) and each returns its row, without what was found in its
own text; rows without id come after all others, in the order of their texts'
hashes, those with the same text as one document; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import FLUSH_WORDS, NO_ID, frugal, identified, parts, prepare, query, table
from .words import SPACED, U64, Words, kgrams, long_grams, planes, unplanes

WINDOW, SEED = 50, 16
#: Windows that factors grow side by side, and windows compared at once beyond.
ABREAST, PIECE = 64, 1 << 14

_SENT = "block int, bucket int, ids binary, anchors binary, runs binary, windows binary, spans binary"
_SPANS = "doc_id long, one long, two long, spans binary"
#: A factor: first word, number of words, source document and the source's first word.
SPAN = np.dtype([("start", "<i8"), ("words", "<i8"), ("source", "<i8"), ("source_start", "<i8")])


def _minimizer(seeds: np.ndarray, width: int) -> np.ndarray:
    """Position of the smallest of each ``width`` consecutive seed hashes, the
    first of equal ones."""
    n = len(seeds) - width + 1
    at = np.arange(len(seeds))
    k = 1
    low = seeds
    while 2 * k <= width:
        a, b = low[:-k], low[k:]
        left = a <= b
        low, at = np.where(left, a, b), np.where(left, at[:-k], at[k:])
        k *= 2
    a, b = low[:n], low[width - k:width - k + n]
    return np.where(a <= b, at[:n], at[width - k:width - k + n])


def _ranks(keys: np.ndarray) -> np.ndarray:
    """The order of rows by their keys (place, one, two): rows that repeat an
    id are one document, those without id are told apart by their texts."""
    k = np.where(keys[0] == NO_ID, keys, np.stack([keys[0], *np.zeros_like(keys[1:])]))
    o = np.lexsort(k[::-1])
    rank = np.empty(len(o), np.int64)
    rank[o] = np.cumsum(np.r_[False, (k[:, o[1:]] != k[:, o[:-1]]).any(0)])
    return rank


def _earliest(rank, doc, start, anchor, full) -> np.ndarray:
    """The index: of each window that occurs again its earliest place (by rank,
    then position), of the others -1."""
    place = np.full(len(full), -1)
    o = np.argsort(full, kind="stable")
    f = full[o]
    same = np.r_[False, f[1:] == f[:-1]][:len(f)]
    o = o[same | np.r_[same[1:], False]]
    if len(o):
        o = o[np.lexsort((start[o], rank[doc[o]], anchor[o], full[o]))]
        head = np.r_[True, (full[o][1:] != full[o][:-1]) | (anchor[o][1:] != anchor[o][:-1])]
        place[o] = o[head][np.cumsum(head) - 1]
    return place


def _grown(at, source, end, anchor, full) -> np.ndarray:
    """Windows that each factor takes: as far as the source's next windows are
    the document's next ones, inside both stretches.  Many factors grow side by
    side; what is long after ``ABREAST`` windows is compared piece by piece."""
    n = np.ones(len(at), np.int64)
    room = np.minimum(end[at] - at, end[source] - source)
    live = np.flatnonzero(room > 1)
    for _ in range(ABREAST):
        if not len(live):
            return n
        i, j = at[live] + n[live], source[live] + n[live]
        live = live[(full[i] == full[j]) & (anchor[i] == anchor[j])]
        n[live] += 1
        live = live[n[live] < room[live]]
    for x in live.tolist():
        while n[x] < room[x]:
            i, j, k = at[x] + n[x], source[x] + n[x], min(int(room[x] - n[x]), PIECE)
            apart = np.flatnonzero((full[i:i + k] != full[j:j + k]) | (anchor[i:i + k] != anchor[j:j + k]))
            n[x] += apart[0] if len(apart) else k
            if len(apart):
                break
    return n


def _parse(rank, doc, start, anchor, full, first):
    """Relative Lempel-Ziv parse of every stretch of windows (``first``: where
    they begin) against what is indexed: (window, number of windows, source
    window) of each factor.

    A stretch is looked up where it begins; a window that has an earlier place
    in a document of a smaller rank starts a factor, which grows along that
    source as far as it goes.  The next look-up is at the factor's boundary:
    with the first window that the factor doesn't hold, ``window`` - 1 words
    before its end.  Windows that occur once are passed over."""
    place = _earliest(rank, doc, start, anchor, full)
    n = len(full)
    end = np.repeat(np.r_[first[1:], n], np.diff(np.r_[first, n]))
    again = np.where(place >= 0, np.arange(n), n)
    again = np.minimum.accumulate(again[::-1])[::-1]               # the next window that occurs again
    at, limit = again[first], end[first]
    out = []
    while True:
        keep = at < limit
        at, limit = at[keep], limit[keep]
        if not len(at):
            break
        source = place[at]
        hit = rank[doc[source]] < rank[doc[at]]
        size = np.ones(len(at), np.int64)
        size[hit] = _grown(at[hit], source[hit], end, anchor, full)
        out.append(np.stack([at[hit], size[hit], source[hit]]))
        at = at + size
        at = np.where(at < limit, again[np.minimum(at, n - 1)], limit)
    return np.concatenate(out, axis=1) if out else np.zeros((3, 0), np.int64)


def _spans(factors, doc, start, keys, window) -> list[tuple[np.ndarray, bytes]]:
    """Factors by document (its key)."""
    at, size, source = factors[:, np.argsort(factors[0], kind="stable")]
    out = np.empty(len(at), SPAN)
    out["start"], out["words"] = start[at], size + window - 1
    out["source"], out["source_start"] = keys[0, doc[source]], start[source]
    owner = doc[at]
    o = np.argsort(owner, kind="stable")
    owner, out = owner[o], out[o]
    cut = np.r_[0, np.flatnonzero(np.diff(owner)) + 1, len(owner)] if len(owner) else np.zeros(1, int)
    return [(keys[:, owner[i]], out[i:j].tobytes()) for i, j in zip(cut, cut[1:])]


def _windows(words: Words, window: int, seed: int):
    """(document, start, minimizer hash, window hash) of a batch's windows."""
    n = len(words.hash) - window + 1
    if n <= 0:
        return None
    seeds = kgrams(words.hash, seed)
    at = _minimizer(seeds, window - seed + 1)
    full = long_grams(words.hash, window)
    doc = np.repeat(np.arange(len(words.first) - 1), np.diff(words.first))[:n]
    start = np.arange(n) - words.first[doc]
    inside = np.arange(n) + window <= words.first[doc + 1]
    return doc[inside], start[inside], seeds[at][inside], full[inside]


def _send(n_buckets: int, window: int, seed: int, flush: int):
    """Index and first reduction, chunk by chunk of about ``flush`` words."""
    def emit(held, keys):
        doc, start, anchor, full = (np.concatenate(x) for x in zip(*held))
        keys = np.concatenate(keys, axis=1)
        first = np.r_[0, np.flatnonzero(np.diff(doc)) + 1]
        found = _parse(_ranks(keys), doc, start, anchor, full, first)
        yield from _spans(found, doc, start, keys, window)
        edge = np.zeros(len(doc) + 1, np.int64)  # what no factor holds waits for the index's answer
        np.add.at(edge, found[0], 1)
        np.add.at(edge, found[0] + found[1], -1)
        keep = np.cumsum(edge[:-1]) == 0
        doc, start, anchor, full = doc[keep], start[keep], anchor[keep], full[keep]
        bucket = (anchor % U64(n_buckets)).astype(np.uint16 if n_buckets < 1 << 16 else np.uint32)
        o = np.argsort(bucket, kind="stable")
        doc, start, anchor, full, bucket = doc[o], start[o], anchor[o], full[o], bucket[o]
        cut = np.searchsorted(bucket, np.arange(n_buckets + 1))
        for b in range(n_buckets):
            i, j = cut[b], cut[b + 1]
            if i == j:
                continue
            d, s, a = doc[i:j], start[i:j], anchor[i:j]
            new = np.r_[0, np.flatnonzero((np.diff(d) != 0) | (np.diff(s) != 1) | (a[1:] != a[:-1])) + 1]
            present, index = np.unique(d[new], return_inverse=True)
            runs = np.stack([index, s[new], np.diff(np.r_[new, j - i])]).astype(np.uint32)
            yield b, keys[:, present], a[new], runs, full[i:j]

    def run(batches):
        held, keys, rows_held, words = [], [], 0, 0

        def out(found):
            rows = {"block": [], "bucket": [], "ids": [], "anchors": [], "runs": [], "windows": [], "spans": []}
            for i, x in enumerate(found):
                if len(x) == 2:              # to any block; copies are spread as others are
                    row = ((int(x[0].sum()) + i) % n_buckets, None, x[0].tobytes(), None, None, None, x[1])
                else:
                    row = (x[0], x[0], planes(x[1].reshape(-1)), planes(x[2]), planes(x[3].reshape(-1)), planes(x[4]), None)
                for name, v in zip(rows, row):
                    rows[name].append(v)
                if len(rows["block"]) >= 256:
                    yield rows
                    rows = {n: [] for n in rows}
            if rows["block"]:
                yield rows

        for batch in batches:
            w = Words(batch.column("text"), SPACED, False)
            got = _windows(w, window, seed)
            if got is not None and len(got[0]):
                held.append((got[0] + rows_held, *got[1:]))
                words += len(got[0])
            keys.append(np.stack([batch.column(k).to_numpy() for k in ("place", "one", "two")]))
            rows_held += batch.num_rows
            if words >= flush:
                for rows in out(emit(held, keys)):
                    yield pa.RecordBatch.from_pydict(rows, _sent_schema())
                held, keys, rows_held, words = [], [], 0, 0
        if held:
            for rows in out(emit(held, keys)):
                yield pa.RecordBatch.from_pydict(rows, _sent_schema())
    return run


def _sent_schema():
    return pa.schema([("block", pa.int32()), ("bucket", pa.int32()),
                      *((n, pa.binary()) for n in ("ids", "anchors", "runs", "windows", "spans"))])


def _answer(window: int):
    """A reference block: all stretches of windows around its minimizers, parsed
    against each other."""
    schema = pa.schema([("doc_id", pa.int64()), ("one", pa.int64()), ("two", pa.int64()), ("spans", pa.binary())])
    named = lambda keys, spans: dict(zip(schema.names, (*np.array(keys).T, spans)))

    def run(batches):
        keys, doc, start, anchor, full, first = [], [], [], [], [], []
        n = windows = 0
        for batch in batches:
            passed, spans = [], []
            for row in batch.to_pylist():
                if row["bucket"] is None:
                    passed.append(np.frombuffer(row["ids"], np.int64))
                    spans.append(row["spans"])
                    continue
                own = unplanes(row["ids"], np.int64).reshape(3, -1)
                index, begin, length = unplanes(row["runs"], np.uint32).reshape(3, -1).astype(np.int64)
                keys.append(own)
                doc.append(np.repeat(index + n, length))
                step = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
                start.append(np.repeat(begin, length) + step)
                first.append(windows + np.cumsum(length) - length)
                windows += int(length.sum())
                anchor.append(np.repeat(unplanes(row["anchors"], U64), length))
                full.append(unplanes(row["windows"], U64))
                n += own.shape[1]
            if passed:
                yield pa.RecordBatch.from_pydict(named(passed, spans), schema)
        if not keys:
            return
        keys = np.concatenate(keys, axis=1)
        doc, start, anchor, full, first = map(np.concatenate, (doc, start, anchor, full, first))
        rows = _spans(_parse(_ranks(keys), doc, start, anchor, full, first), doc, start, keys, window)
        for i in range(0, len(rows), 4096):
            a, b = zip(*rows[i:i + 4096])
            yield pa.RecordBatch.from_pydict(named(a, b), schema)
    return run


def factors(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
            seed: int = SEED, flush: int = FLUSH_WORDS // 2) -> DataFrame:
    """(doc_id, one, two, spans): packed ``SPAN`` records of the factors of
    documents that have any, under the row's own key; a document can have
    several rows."""
    spark = prepare(docs.sparkSession)
    n = parts(spark)
    sent = identified(docs, id_col, text_col).mapInArrow(frugal(_send(n, window, seed, flush)), _SENT)
    return sent.repartitionById(n, F.col("block")).mapInArrow(frugal(_answer(window)), _SPANS)


def whole(spans: list[tuple], window: int) -> list[tuple]:
    """Factors (start, words, source, source start) whose pieces came from
    several blocks, in one: pieces that go on at the same source."""
    out: list[list[int]] = []
    open_: dict[tuple, list[int]] = {}
    for start, words, source, at in sorted(spans):
        last = open_.get((source, at - start))
        if last is not None and start <= last[0] + last[1] - window + 1:
            last[1] = max(last[1], start + words - last[0])
        else:
            out.append([start, words, source, at])
            open_[source, at - start] = out[-1]
    return [tuple(x) for x in out]


def covered(raw: list[bytes], n_words: int) -> np.ndarray:
    """Which words lie in a factor."""
    edge = np.zeros(n_words + 1, np.int64)
    for x in raw:
        s = np.frombuffer(x, SPAN)
        np.add.at(edge, np.minimum(s["start"], n_words), 1)
        np.add.at(edge, np.minimum(s["start"] + s["words"], n_words), -1)
    return np.cumsum(edge[:-1]) > 0


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                    seed: int = SEED) -> DataFrame:
    """doc_id, n_words, n_removed, kept (the words left, joined by a space),
    factors (array of struct start, words, source, source_start)."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
                        ("kept", pa.string()), ("factors", pa.list_(pa.struct(
                            [(n, pa.int64()) for n in SPAN.names])))])

    def cut(batches):
        for batch in batches:
            out = {n: [] for n in schema.names}
            for doc_id, text, raw in zip(*(batch.column(n).to_pylist() for n in ("doc_id", "text", "spans"))):
                words = text.encode().split()
                gone = covered(raw or [], len(words))
                removed = int(gone.sum())
                if removed:
                    words = [w for w, g in zip(words, gone.tolist()) if not g]
                found = whole([x for r in raw or [] for x in np.frombuffer(r, SPAN).tolist()], window)
                for name, v in zip(schema.names, (doc_id, len(gone), removed, b" ".join(words).decode(),
                                                  [dict(zip(SPAN.names, x)) for x in found])):
                    out[name].append(v)
            yield pa.RecordBatch.from_pydict(out, schema)

    d = identified(docs, id_col, text_col)
    spans = (factors(docs, id_col, text_col, window, seed).withColumnRenamed("doc_id", "place")
             .groupBy("place", "one", "two").agg(F.collect_set("spans").alias("spans")))
    joined = d.join(spans, ["place", "one", "two"], "left")
    return joined.select("doc_id", "text", "spans").mapInArrow(
        frugal(cut), "doc_id long, n_words long, n_removed long, kept string, "
             "factors array<struct<start:long,words:long,source:long,source_start:long>>")


ORACLE = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
p AS (SELECT doc_id, p, array_to_string(w[p:p + {WINDOW - 1}], ' ') AS g
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - {WINDOW - 2})) AS p FROM d WHERE len(w) >= {WINDOW})),
f AS (SELECT doc_id, p, min(doc_id) OVER (PARTITION BY md5(g)) < doc_id AS late FROM p),
gone AS (SELECT DISTINCT doc_id, unnest(range(p, p + {WINDOW})) AS p FROM f WHERE late),
k AS (SELECT u.doc_id, string_agg(u.word, ' ' ORDER BY u.p) FILTER (gone.p IS NULL) AS kept, count(gone.p) AS n_removed
      FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d) u
      LEFT JOIN gone ON gone.doc_id = u.doc_id AND gone.p = u.p GROUP BY u.doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
"""


@query("op3_substring_dedup", ORACLE)
def op3_substring_dedup(spark, sf_dir):
    """Stretches of 50 words that stand in an earlier document, removed."""
    r = substring_dedup(table(spark, sf_dir, "documents"))
    return r.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))
