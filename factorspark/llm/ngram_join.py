"""Operator 9, n-gram Jaccard join: documents linked by shared shingles.

The documents' distinct shingles make a sparse incidence matrix A; two
documents overlap in what A A^T says.  The product is never formed whole:

1. Tasks reduce documents to classes of equal shingle sets (known by size and
   128 bits of fingerprint) and deal the entries (column, class) to blocks of
   columns as packed arrays, each class once a chunk.
2. A block counts how many classes each column has.  Columns of one class add
   to no overlap and end here; the others go back to their classes.
3. Size bounds discard rows: a partner at similarity t shares at least t of a
   class's columns, so classes with fewer shared columns have no links.  What
   is left is ordered from rare to frequent columns; of ``n`` columns a partner
   has one of the first ``n - ceil(t n) + 1``.  Classes joined by such columns
   form the diagonal blocks (connected components) beyond which no link exists.
4. Each diagonal block is multiplied, large ones in tiles of bounded size that
   go to different tasks.  A tile adds up overlaps column block by column
   block, discards pairs whose overlap can no longer reach its bound, and sends
   only a spanning forest of its links and each class's number of links.

So all pairs are evaluated inside diagonal blocks, but no list of pairs is
ever made.  A column that many classes of one chunk have (a passage many
documents share) is marked as hot there: its classes keep it on the spot and
one entry goes out in place of theirs.

Defined cases: documents with fewer words than ``size`` have their whole word
sequence as the one shingle; null and wordless texts have none and link with
nothing; rows that repeat an id are taken one by one; rows without id take
part, but ``component_id`` is the smallest id there is; further columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import FLUSH_WORDS, cut_lineage, frugal, parts, prepare, query, table, texts
from .graph import components
from .words import SPACED, U64, Words, kgrams, mix, planes, unplanes

SIZE, PERCENT = 5, 80
#: Classes of a chunk from which on a column is hot, and its count in the order.
HOT_CLASSES, HOT = 64, np.int32(1 << 30)
#: Rows and entries of a tile's side, and columns of a step of the product.
TILE_ROWS, TILE_ENTRIES, STEP = 512, 1 << 19, 4096

NO_ID = np.iinfo(np.int64).max
MEMBERS, ENTRIES, SHARED = 0, 1, 2
_PARTS = ("one", "two", "n", "index", "hash", "more")
_SENT = "dest int, kind int, " + ", ".join(f"{n} binary" for n in _PARTS)
_SENT_SCHEMA = pa.schema([("dest", pa.int32()), ("kind", pa.int32()), *((n, pa.binary()) for n in _PARTS)])
_ROWS = "doc_id long, own long, node long, two long, n long, prefix array<long>, cols binary"
_ROWS_SCHEMA = pa.schema([("doc_id", pa.int64()), ("own", pa.int64()), ("node", pa.int64()), ("two", pa.int64()),
                          ("n", pa.int64()), ("prefix", pa.list_(pa.int64())), ("cols", pa.binary())])


def _shingles(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, hash), in document order, of all shingles of a batch."""
    count = np.diff(words.first)
    h = kgrams(words.hash, size)
    doc = np.repeat(np.arange(len(count)), count)[:len(h)]
    inside = np.arange(len(h)) + size <= words.first[doc + 1]
    doc, h = doc[inside], h[inside]
    short = np.flatnonzero((count > 0) & (count < size))
    if len(short):
        whole = np.array([kgrams(words.hash[words.first[i]:words.first[i + 1]], int(count[i]), int(count[i]))[0]
                          for i in short], U64)
        o = np.argsort(np.r_[doc, short], kind="stable")
        doc, h = np.r_[doc, short][o], np.r_[h, whole][o]
    return doc, h


def _dealt(dest: np.ndarray, n: int):
    """(partition, positions) of the rows of each partition that has any."""
    o = np.argsort(dest.astype(np.uint16 if n < 1 << 16 else np.int64), kind="stable")
    cut = np.searchsorted(dest[o], np.arange(n + 1))
    return ((k, o[cut[k]:cut[k + 1]]) for k in np.flatnonzero(np.diff(cut)))


def _shared(n: int, cls, hashes, df, one, two, size):
    """Entries of columns that several classes have, dealt by class."""
    for k, at in _dealt((one[cls] % U64(n)).astype(np.int64), n):
        at = at[np.argsort(cls[at], kind="stable")]
        own, count = np.unique(cls[at], return_counts=True)
        yield (k, SHARED, planes(one[own]), planes(two[own]), planes(size[own]), planes(count.astype(np.int32)),
               planes(hashes[at]), planes(df[at]))


def _record(rows, schema):
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _send(n: int, size: int, flush: int):
    def emit(held, ids, owns, docs):
        doc, h = (np.concatenate(x) for x in zip(*held)) if held else (np.zeros(0, np.int64), np.zeros(0, U64))
        o = np.argsort(h, kind="stable")
        again = np.zeros(len(h), bool)           # a document's shingle that came before in it
        again[o[1:]] = (h[o][1:] == h[o][:-1]) & (doc[o][1:] == doc[o][:-1])
        count = np.bincount(doc[~again], minlength=docs).astype(np.int32)
        first = np.searchsorted(doc, np.arange(docs))
        has = count > 0
        prints = []
        for salt in (U64(0x5851F42D4C957F2D), U64(0x14057B7EF767814F)):
            v = mix(h ^ salt)
            v[again] = 0
            p = np.zeros(docs, U64)
            if len(v):
                p[has] = np.add.reduceat(v, first[has])
            prints.append(mix(p + count.astype(U64)))
        one, two = prints
        ids, owns = np.array(ids, np.int64), np.concatenate(owns)
        for k, at in _dealt((mix(one ^ ids.astype(U64)) % U64(n)).astype(np.int64), n):
            yield k, MEMBERS, planes(one[at]), planes(two[at]), planes(count[at]), planes(ids[at]), planes(owns[at]), None
        # One document a class stands for it.
        o2 = np.lexsort((two, one))
        lead = np.zeros(docs, bool)
        lead[o2] = np.r_[True, (one[o2][1:] != one[o2][:-1]) | (two[o2][1:] != two[o2][:-1])] if docs else False
        keep = o[lead[doc[o]] & ~again[o]]       # in the order of hashes
        cls, h = doc[keep], h[keep]
        new = np.flatnonzero(np.r_[True, h[1:] != h[:-1]]) if len(h) else np.zeros(0, np.int64)
        df = np.repeat(np.diff(np.r_[new, len(h)]), np.diff(np.r_[new, len(h)]))
        hot = df >= HOT_CLASSES
        if hot.any():
            yield from _shared(n, cls[hot], h[hot], np.full(int(hot.sum()), HOT), one, two, count)
            lone = hot & np.r_[True, h[1:] != h[:-1]]
            cls = np.where(lone, -1, cls)[~hot | lone]
            h = h[~hot | lone]
        for k, at in _dealt((h % U64(n)).astype(np.int64), n):
            own, index = np.unique(cls[at], return_inverse=True)
            marks = own < 0                      # -1, if there, sorts first
            step = np.r_[h[at][:1], np.diff(h[at])]
            yield (k, ENTRIES, planes(one[own[~marks]]), planes(two[own[~marks]]), planes(count[own[~marks]]),
                   planes((index - int(marks.sum())).astype(np.int32)), planes(step), None)

    def run(batches):
        held, ids, owns, docs, total = [], [], [], 0, 0
        for batch in batches:
            w = Words(batch.column("text"), SPACED, True)
            doc, h = _shingles(w, size)
            held.append((doc + docs, h))
            ids.extend(NO_ID if x is None else x for x in batch.column("doc_id").to_pylist())
            owns.append(batch.column("own").to_numpy())
            docs, total = len(ids), total + len(h)
            if total >= flush:
                yield from _flush(emit(held, ids, owns, docs))
                held, ids, owns, docs, total = [], [], [], 0, 0
        if docs:
            yield from _flush(emit(held, ids, owns, docs))
    return run


def _flush(found, size: int = 64):
    rows = []
    for r in found:
        rows.append(r)
        if len(rows) == size:
            yield _record(rows, _SENT_SCHEMA)
            rows = []
    if rows:
        yield _record(rows, _SENT_SCHEMA)


def _columns(n: int):
    """A block of columns: how many classes has each; the shared ones go back."""
    def run(batches):
        one, two, size, cls, h, total = [], [], [], [], [], 0
        for batch in batches:
            entry = pa.compute.equal(batch.column("kind"), ENTRIES)
            passed = batch.filter(pa.compute.invert(entry))
            if passed.num_rows:
                yield passed
            for r in batch.filter(entry).to_pylist():
                index = unplanes(r["index"], np.int32).astype(np.int64)
                cls.append(np.where(index < 0, -1, index + total))
                h.append(np.cumsum(unplanes(r["hash"], U64), dtype=U64))
                one.append(unplanes(r["one"], U64))
                two.append(unplanes(r["two"], U64))
                size.append(unplanes(r["n"], np.int32))
                total += len(one[-1])
        if not h:
            return
        one, two, size, cls, h = map(np.concatenate, (one, two, size, cls, h))
        # The same class of several chunks becomes one.
        o = np.lexsort((two, one))
        new = np.r_[True, (one[o][1:] != one[o][:-1]) | (two[o][1:] != two[o][:-1])][:len(o)]
        same = np.empty(len(o) + 1, np.int64)
        same[o] = o[new][np.cumsum(new) - 1]
        same[-1] = -1                            # a mark stays one
        cls = same[cls]
        o = np.argsort(h, kind="stable")
        twice = h[o][1:] == h[o][:-1]
        mark = cls[o] < 0
        o = o[np.r_[False, twice] | np.r_[twice, False] | mark]
        o = o[np.lexsort((cls[o], h[o]))]
        if len(o):
            o = o[np.r_[True, (h[o][1:] != h[o][:-1]) | (cls[o][1:] != cls[o][:-1])]]
        cls, h = cls[o], h[o]
        new = np.flatnonzero(np.r_[True, h[1:] != h[:-1]]) if len(h) else np.zeros(0, np.int64)
        count = np.diff(np.r_[new, len(h)])
        df = np.repeat(np.where(cls[new] < 0, HOT, count), count).astype(np.int32) if len(h) else np.zeros(0, np.int32)
        keep = (df > 1) & (cls >= 0)
        yield from _flush(_shared(n, cls[keep], h[keep], df[keep], one, two, size))
    return run


def _need(n, percent):
    """Columns of ``n`` that a partner has at least."""
    return -(-n * percent // 100)


def _classes(percent: int):
    """Member rows as they are; classes that can have links, with their shared
    columns from rare to frequent."""
    def run(batches):
        one, two, size, cls, h, df, total = [], [], [], [], [], [], 0
        for batch in batches:
            members = []
            for r in batch.to_pylist():
                if r["kind"] == MEMBERS:
                    ids = unplanes(r["index"], np.int64)
                    members.append(pa.RecordBatch.from_arrays(
                        [pa.array(ids, mask=ids == NO_ID), pa.array(unplanes(r["hash"], np.int64)),
                         pa.array(unplanes(r["one"], np.int64)), pa.array(unplanes(r["two"], np.int64)),
                         pa.array(unplanes(r["n"], np.int32).astype(np.int64)),
                         pa.nulls(len(ids), pa.list_(pa.int64())), pa.nulls(len(ids), pa.binary())],
                        schema=_ROWS_SCHEMA))
                    continue
                count = unplanes(r["index"], np.int32)
                one.append(unplanes(r["one"], U64))
                two.append(unplanes(r["two"], U64))
                size.append(unplanes(r["n"], np.int32))
                cls.append(np.repeat(np.arange(len(count)) + total, count))
                h.append(unplanes(r["hash"], U64))
                df.append(unplanes(r["more"], np.int32))
                total += len(count)
            yield from members
        if not h:
            return
        one, two, size, cls, h, df = map(np.concatenate, (one, two, size, cls, h, df))
        o = np.lexsort((two, one))
        new = np.r_[True, (one[o][1:] != one[o][:-1]) | (two[o][1:] != two[o][:-1])]
        same = np.empty(len(o), np.int64)
        same[o] = o[new][np.cumsum(new) - 1]
        cls = same[cls]
        # Hot columns may come from a chunk and from the block: once is enough.
        o = np.lexsort((h, df, cls))
        o = o[np.r_[True, (h[o][1:] != h[o][:-1]) | (cls[o][1:] != cls[o][:-1])]]
        cls, h = cls[o], h[o]
        first = np.r_[0, np.flatnonzero(np.diff(cls)) + 1, len(cls)]
        out = []
        for a, z in zip(first, first[1:]):
            c = int(cls[a])
            n, shared = int(size[c]), int(z - a)
            if shared >= _need(n, percent):
                ahead = n - _need(n, percent) + 1 - (n - shared)
                out.append((None, None, int(one[c].view(np.int64)), int(two[c].view(np.int64)), n,
                            h[a:a + ahead].view(np.int64).tolist(), h[a:z].tobytes()))
            if len(out) == 256:
                yield _record(out, _ROWS_SCHEMA)
                out = []
        if out:
            yield _record(out, _ROWS_SCHEMA)
    return run


def overlaps(rows: list[np.ndarray], n: np.ndarray, side: np.ndarray, cross: bool, percent: int):
    """Pairs of a tile that are similar enough: the product of the tile's
    incidence rows, added up over steps of columns.  With ``cross`` only pairs
    between the two sides count."""
    count = len(rows)
    flat = np.concatenate(rows)
    owner = np.repeat(np.arange(count), [len(r) for r in rows])
    _, col, often = np.unique(flat, return_inverse=True, return_counts=True)
    keep = often[col] > 1
    number = np.cumsum(often > 1) - 1
    col, owner = number[col[keep]], owner[keep]
    o = np.argsort(col, kind="stable")
    col, owner = col[o], owner[o]
    need = n[:, None] + n[None, :]
    acc = np.zeros((count, count), np.float32)
    alive = np.triu(np.ones((count, count), bool), 1)
    if cross:
        alive &= side[:, None] != side[None, :]
    rest = np.bincount(owner, minlength=count)
    width = int(col[-1]) + 1 if len(col) else 0
    cut = np.searchsorted(col, np.arange(0, width + STEP, STEP))
    for lo, a, z in zip(range(0, width, STEP), cut, cut[1:]):
        bound = acc + np.minimum(rest[:, None], rest[None, :])
        alive &= bound * (100 + percent) >= percent * need
        live = alive.any(0) | alive.any(1)
        if not live.any():
            break
        at = np.cumsum(live) - 1
        on = live[owner[a:z]]
        d = np.zeros((int(live.sum()), min(STEP, width - lo)), np.float32)
        d[at[owner[a:z][on]], col[a:z][on] - lo] = 1
        acc[np.ix_(live, live)] += d @ d.T
        rest = rest - np.bincount(owner[a:z], minlength=count)
    return np.nonzero(alive & (acc.astype(np.int64) * (100 + percent) >= percent * need))


def _forest(x, y, count):
    """The edges of ``x``-``y`` that join what the ones before left apart."""
    up = list(range(count))

    def root(i):
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    out = []
    for i, j in zip(x.tolist(), y.tolist()):
        a, b = root(i), root(j)
        if a != b:
            up[max(a, b)] = min(a, b)
            out.append((i, j))
    return out


_LINKS_SCHEMA = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("links", pa.int64())])


def _tiles(percent: int):
    def solve(held):
        node = np.array([r["node"] for r in held], np.int64)
        side = np.array([r["side"] for r in held], np.int64)
        x, y = overlaps([np.frombuffer(r["cols"], U64) for r in held], np.array([r["n"] for r in held], np.int64),
                        side, held[0]["i"] != held[0]["j"], percent)
        links = np.bincount(np.r_[x, y], minlength=len(held))
        for i, j in _forest(x, y, len(held)):
            yield int(node[i]), int(node[j]), None
        for i in np.flatnonzero(links).tolist():
            yield int(node[i]), None, int(links[i])

    def run(batches):
        key, held, out = None, [], []
        for batch in batches:
            for r in batch.to_pylist():
                if (r["label"], r["i"], r["j"]) != key:
                    if len(held) > 1:
                        out.extend(solve(held))
                    key, held = (r["label"], r["i"], r["j"]), []
                held.append(r)
            if out:
                yield _record(out, _LINKS_SCHEMA)
                out = []
        if len(held) > 1:
            out.extend(solve(held))
        if out:
            yield _record(out, _LINKS_SCHEMA)
    return run


def _grouped(docs: DataFrame, id_col: str, text_col: str, size: int, percent: int, flush: int) -> DataFrame:
    """doc_id, own (the text's hash), n, label (of the component; null without
    shingles), component (its smallest id), links, one row per input row."""
    spark = prepare(docs.sparkSession)
    n = parts(spark)
    sent = texts(docs, id_col, text_col).withColumn("own", F.xxhash64("text")).mapInArrow(frugal(_send(n, size, flush)), _SENT).repartitionById(n, F.col("dest"))
    shared = sent.mapInArrow(frugal(_columns(n)), _SENT).repartitionById(n, F.col("dest"))
    rows = cut_lineage(shared.mapInArrow(frugal(_classes(percent)), _ROWS))
    members = rows.where("cols IS NULL").select("doc_id", "own", "node", "two", "n")
    classes = rows.where("cols IS NOT NULL").select("node", "n", "prefix", "cols")

    spread = classes.select("node", F.explode("prefix").alias("col"))
    # Written before it is joined, so that Spark can split the rows of a hot column.
    heads = cut_lineage(spread.groupBy("col").agg(F.min("node").alias("b"), F.count(F.lit(1)).alias("c"))
                        .where("c > 1").select("col", "b"))
    blocks = components(spread.join(heads, "col").select(F.col("node").alias("a"), "b"))

    placed = classes.select("node", "n", "cols").join(blocks, "node")
    sizes = cut_lineage(placed.groupBy("label").agg(F.greatest(
        F.ceil(F.count(F.lit(1)) / TILE_ROWS), F.ceil(F.sum(F.length("cols")) / (8 * TILE_ENTRIES))).cast("int")
        .alias("k")))
    side = F.pmod(F.xxhash64("node"), F.col("k")).cast("int")
    tiles = (placed.join(sizes, "label").withColumn("side", side)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
             .select("label", F.least("side", "other").alias("i"), F.greatest("side", "other").alias("j"),
                     "side", "node", "n", "cols"))
    links = cut_lineage(tiles.repartition(n, "label", "i", "j").sortWithinPartitions("label", "i", "j", "node")
                        .mapInArrow(frugal(_tiles(percent)), "a long, b long, links long"))
    joined = components(links.where("b IS NOT NULL").select("a", "b"))
    linked = links.where("b IS NULL").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))

    lowest = (members.where("n > 0").groupBy("node", "two").agg(F.min("doc_id").alias("low"))
              .join(joined, "node", "left").join(linked, "node", "left")
              .withColumn("label", F.coalesce("label", "node")))
    least = cut_lineage(lowest.groupBy("label").agg(F.min("low").alias("component")))
    known = lowest.join(least, "label").select("node", "two", "label", "component", "links")
    return members.join(known, ["node", "two"], "left").select("doc_id", "own", "n", "label", "component", "links")


def ngram_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE,
               percent: int = PERCENT, flush: int = FLUSH_WORDS // 2) -> DataFrame:
    """doc_id, n_shingles, component_id, n_links (to documents with other
    shingle sets, each set counted once), one row per input row."""
    return _grouped(docs, id_col, text_col, size, percent, flush).select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id")).alias("component_id"),
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE,
                percent: int = PERCENT, flush: int = FLUSH_WORDS // 2) -> DataFrame:
    """``docs``, all columns, with one row of each component: that with the
    smallest id (rows without id last), then the smallest hash of the text.

    Rows are told apart by id and text: rows that share an id stay each for its
    own component, whatever the other's text.  Rows that repeat id and text are
    one document, which the row with the smallest hash of all its columns
    stands for; so are wordless ones.
    """
    groups = _grouped(docs, id_col, text_col, size, percent, flush)
    key = F.struct(F.coalesce("doc_id", F.lit(NO_ID)).alias("place"), "own")
    best = groups.where("n > 0").groupBy("label").agg(F.min(key).alias("k")).select("k.*")
    stay = best.unionAll(groups.where("n = 0").select(key.alias("k")).select("k.*").distinct())
    place = F.coalesce(docs[id_col].cast("long"), F.lit(NO_ID))
    own = F.xxhash64(F.coalesce(docs[text_col].cast("string"), F.lit("")))
    # A map has no hash; its text has.
    cells = [F.to_json(F.struct(docs[c])) if "map<" in t or "variant" in t else docs[c] for c, t in docs.dtypes]
    rows = docs.select(place.alias("_llm_place"), own.alias("_llm_own"), F.xxhash64(*cells).alias("_llm_rank"),
                       F.struct(*docs.columns).alias("_llm_row"))
    kept = rows.join(stay, (rows["_llm_place"] == stay["place"]) & (rows["_llm_own"] == stay["own"]), "left_semi")
    return (kept.groupBy("_llm_place", "_llm_own").agg(F.min_by("_llm_row", "_llm_rank").alias("_llm_row"))
            .select("_llm_row.*"))


ORACLE = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                              'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(w[p:p + least(len(w), 5) - 1], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS p FROM d WHERE len(w) > 0)
), c AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS o FROM s x JOIN s y USING (g) WHERE x.doc_id <> y.doc_id
      GROUP BY ALL),
l AS (SELECT a, b FROM o JOIN c x ON x.doc_id = a JOIN c y ON y.doc_id = b WHERE 100 * o >= 80 * (x.n + y.n - o)),
r AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT r.a, l.b FROM r JOIN l ON l.a = r.b)
SELECT d.doc_id, coalesce(c.n, 0) AS n_shingles, m.component_id
FROM d LEFT JOIN c USING (doc_id) JOIN (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a) m USING (doc_id)
"""


@query("op9_ngram_join", ORACLE)
def op9_ngram_join(spark, sf_dir):
    """Documents linked at 80 % of their five-word shingles, by components."""
    return ngram_join(table(spark, sf_dir, "documents")).drop("n_links")
