"""Operator 13, hard negatives: a secondary-sort shuffle of pair scores.

For each anchor the other rows come in the order of their score.  The first
``positives`` rows of the anchor's own label open one window of scores each
([low, high] times the positive's score); the first ``negatives`` rows of other
labels inside a window are that positive's hard negatives.

Anchors are a stated query set, taken in blocks of at most ``BLOCK_BYTES`` of
vectors; only such a block, and the scores of its positives, is ever broadcast.
For each block

1. tasks score their rows against the block's anchors, a batch of rows at a
   time, and keep for each anchor its first rows of the same label;
2. the keys (anchor, descending score, id) are dealt by anchor and sorted within
   partitions (the DataFrame form of ``repartitionAndSortWithinPartitions``),
   and a streaming pass takes the first of each anchor: its positives;
3. tasks score their rows again, now knowing the windows, and keep for each
   window its first rows of other labels;
4. those keys and the positives' are dealt and sorted in the same way; a
   positive comes before the negatives of its window, so a streaming iterator
   opens windows and emits negatives and holds nothing of an anchor but its
   open windows.

What a task keeps is exact: the first rows of a window over the whole table are
among the first rows of that window in some task.  So a task sends at most
``positives * negatives`` keys for an anchor, whatever its rows, and no anchor's
row list is gathered.

A component x becomes floor(scale * x) and scores are integer inner products,
exact while they fit in 64 bits (beyond that they wrap).

Defined cases: rows without id, label or vector, or with a component that is
null or not finite, take no part; vectors of different lengths have no score
with each other (an empty vector scores 0 with empty ones); rows with the
anchor's id are not among its partners; other rows that repeat an id count one
by one, and of anchor rows that repeat an id the one with the smallest label,
then vector, is the anchor; equal scores go by the smaller id; a positive with
a negative score has an empty window (its bounds cross), one with score 0 the
score 0; an anchor without positives or negatives has no rows; further columns
are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import frugal, parts, prepare, query, table

#: Bytes of anchor vectors that one block holds at most.
BLOCK_BYTES = 8 << 20
#: Scores that a task forms at a time, and candidates it gathers before it sorts.
TILE, GATHER = 1 << 21, 1 << 19

KEY = "anchor long, down long, other boolean, id long"
_KEY = pa.schema([("anchor", pa.int64()), ("down", pa.int64()), ("other", pa.bool_()), ("id", pa.int64())])


def vectors(batch, scale: int):
    """By length of the vectors: (ids, labels, integer matrix) of the rows that
    take part, in their order."""
    ids, labels, lists = batch.column("id"), batch.column("label"), batch.column("vector")
    sizes = np.asarray(lists.value_lengths().fill_null(-1))
    values = lists.flatten()
    x = values.cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False)
    bad = np.zeros(len(x) + 1, np.int64)
    np.cumsum(~np.isfinite(x), out=bad[1:])
    ends = np.cumsum(np.maximum(sizes, 0))
    starts = ends - np.maximum(sizes, 0)
    fine = (sizes >= 0) & (bad[ends] == bad[starts]) & np.asarray(ids.is_valid()) & np.asarray(labels.is_valid())
    ids, labels = ids.fill_null(0).to_numpy(), labels.fill_null(0).to_numpy()
    for size in np.unique(sizes[fine]).tolist():
        at = np.flatnonzero(fine & (sizes == size))
        m = np.floor(scale * x[(starts[at, None] + np.arange(size)).reshape(-1)])
        edge = float(1 << 63)
        whole = np.where(m >= edge, (1 << 63) - 1, np.clip(m, -edge, np.nextafter(edge, 0)).astype(np.int64))
        yield size, ids[at], labels[at], whole.reshape(len(at), size)


def inner(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products of the rows of ``a`` and ``b``."""
    top = lambda m: int(max(m.max(initial=0), -int(m.min(initial=0))))
    if top(a) * top(b) * max(a.shape[1], 1) < 1 << 53:       # sums that doubles hold exactly
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return a @ b.T


class First:
    """The first ``k`` entries, by score downwards and then id, of each of
    ``slots``; ``worst`` is the score that an entry must reach to matter."""

    def __init__(self, slots: int, k: int):
        self.k, self.n = k, 0
        self.worst = np.full(slots, np.iinfo(np.int64).min)
        self.held = [np.zeros((0, 3), np.int64)]

    def add(self, slot, score, ids):
        self.held.append(np.stack([slot, score, ids], 1))
        self.n += len(slot)
        if self.n > GATHER:
            self.settle()

    def settle(self) -> np.ndarray:
        """(slot, score, id) of what is kept, in order."""
        h = np.concatenate(self.held)
        h = h[np.lexsort((h[:, 2], ~h[:, 1], h[:, 0]))]      # ~x falls as x grows
        heads = np.flatnonzero(np.r_[True, h[1:, 0] != h[:-1, 0]]) if len(h) else np.zeros(0, int)
        place = np.arange(len(h)) - np.repeat(heads, np.diff(np.r_[heads, len(h)]))
        h, last = h[place < self.k], h[place == self.k - 1]
        self.worst[last[:, 0]] = last[:, 1]
        self.held, self.n = [h], 0
        return h


class Anchors:
    """A block of anchors: of each length of vectors (ids, labels, matrix,
    windows), where windows are (low, high) arrays or None for the positives."""

    def __init__(self, rows: list, k: int, windows=None):
        self.rows, self.k = rows, k
        #: windows by anchor: bounds in the order of the positives
        self.windows = windows
        self.width = 1 if windows is None else max([1, *(len(w) for w in windows.values())])

    def bounds(self, ids):
        low = np.full((len(ids), self.width), 1, np.int64)
        high = np.zeros((len(ids), self.width), np.int64)    # empty
        for i, x in enumerate(ids.tolist()):
            for j, (a, z) in enumerate(self.windows.get(x, ())):
                low[i, j], high[i, j] = a, z
        return low, high

    def best(self, batches, scale: int):
        """(anchor, score, id) of what the rows of ``batches`` give: a
        superset of the block's first ``k`` for each anchor or window."""
        held = {size: (First(len(ids) * self.width, self.k),
                       self.bounds(ids) if self.windows is not None else None)
                for size, (ids, _, _) in self.rows.items()}
        for batch in batches:
            for size, rid, label, m in vectors(batch, scale):
                if size in self.rows:
                    self._meet(*self.rows[size], *held[size], rid, label, m)
        for size, (first, _) in held.items():
            kept = first.settle()
            kept[:, 0] = self.rows[size][0][kept[:, 0] // self.width]
            yield np.unique(kept, axis=0) if self.width > 1 else kept

    def _meet(self, ids, labels, matrix, first, bounds, rid, label, m):
        step = max(1, TILE // max(len(rid), 1))
        for i in range(0, len(ids), step):
            s = inner(matrix[i:i + step], m)
            apart = labels[i:i + step, None] != label
            fine = (ids[i:i + step, None] != rid) & (apart if bounds is not None else ~apart)
            for j in range(self.width):
                slot = np.arange(i, i + len(s)) * self.width + j
                ok = fine & (s >= first.worst[slot, None])
                if bounds is not None:
                    ok &= (s >= bounds[0][i:i + step, j, None]) & (s <= bounds[1][i:i + step, j, None])
                r, c = np.nonzero(ok)
                first.add(slot[r], s[r, c], rid[c])


def _keys(rows: DataFrame, block: Anchors, scale: int, other: bool) -> DataFrame:
    def run(batches):
        for kept in block.best(batches, scale):
            yield pa.RecordBatch.from_arrays(
                [pa.array(kept[:, 0]), pa.array(~kept[:, 1]), pa.array(np.full(len(kept), other)),
                 pa.array(kept[:, 2])], schema=_KEY)

    return rows.mapInArrow(frugal(run), KEY)


def _sorted(keys: DataFrame) -> DataFrame:
    """Secondary sort: an anchor's keys in one partition, by descending score
    (``down`` is its complement), own label first, then id."""
    return keys.repartition(parts(keys.sparkSession), "anchor").sortWithinPartitions("anchor", "down", "other", "id")


def _runs(batches):
    """(anchor, score, other, id) arrays: the pieces of one anchor in a batch."""
    for batch in batches:
        anchor, down, other, ids = (batch.column(c).to_numpy(zero_copy_only=False) for c in range(4))
        if len(anchor):
            heads = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
            for a, z in zip(heads.tolist(), [*heads[1:].tolist(), len(anchor)]):
                yield int(anchor[a]), ~down[a:z], other[a:z], ids[a:z]


def _leading(k: int):
    """The first ``k`` keys of each anchor."""
    def run(batches):
        at, left = None, 0
        for anchor, score, _, ids in _runs(batches):
            at, left = anchor, left if anchor == at else k
            n = min(left, len(ids))
            left -= n
            if n:
                yield pa.RecordBatch.from_arrays([pa.array(np.full(n, anchor)), pa.array(score[:n]),
                                                  pa.array(ids[:n])], ["anchor", "score", "id"])
    return run


def window(positive: int, low: tuple[int, int], high: tuple[int, int]) -> tuple[int, int]:
    """Smallest and largest integer score between the two shares (numerator,
    denominator) of the positive's."""
    return -(-low[0] * positive // low[1]), high[0] * positive // high[1]


OUT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
_OUT = pa.schema([("anchor_id", pa.int64()), ("positive_id", pa.int64()), ("rank", pa.int32()),
                  ("negative_id", pa.int64()), ("positive_score", pa.int64()), ("negative_score", pa.int64())])


def _emit(negatives: int, low, high):
    """Opens a window at each positive of the sorted stream and emits the first
    negatives that fall into it."""
    def run(batches):
        at, windows = None, []
        for anchor, score, other, ids in _runs(batches):
            if anchor != at:
                at, windows = anchor, []
            own = np.flatnonzero(~other)
            windows += [[int(ids[i]), int(score[i]), *window(int(score[i]), low, high), 0] for i in own]
            for w in windows:
                pid, positive, lo, hi, n = w
                if n == negatives:
                    continue
                found = np.flatnonzero(other & (score >= lo) & (score <= hi))[:negatives - n]
                if len(found):
                    w[4] += len(found)
                    full = lambda x: pa.array(np.full(len(found), x, np.int64))
                    yield pa.RecordBatch.from_arrays(
                        [full(anchor), full(pid), pa.array(np.arange(n + 1, w[4] + 1, dtype=np.int32)),
                         pa.array(ids[found]), full(positive), pa.array(score[found])], schema=_OUT)
    return run


def _blocks(anchors: DataFrame, dim: int, scale: int):
    """The anchors, distinct ids in order, in blocks of bounded size."""
    rows = max(1, BLOCK_BYTES // (8 * max(dim, 1)))
    after = None
    while True:
        part = (anchors if after is None else anchors.where(F.col("id") > after)).orderBy("id").limit(rows).toArrow()
        if not part.num_rows:
            return
        yield {size: x for b in [part.combine_chunks().to_batches()[0]] for size, *x in vectors(b, scale)}
        if part.num_rows < rows:
            return
        after = part.column("id")[-1].as_py()


def hard_negatives(rows: DataFrame, anchors: Column, id_col: str = "vec_id", vector_col: str = "embedding",
                   label_col: str = "label", positives: int = 5, negatives: int = 10, low: tuple[int, int] = (30, 100),
                   high: tuple[int, int] = (90, 100), scale: int = 256) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score; ``anchors`` says of a row of ``rows`` whether it is one."""
    spark = prepare(rows.sparkSession)
    cols = [rows[id_col].cast("long").alias("id"), rows[label_col].cast("long").alias("label"),
            rows[vector_col].cast("array<double>").alias("vector")]
    all_rows = rows.select(*cols)
    whole = rows.where(anchors).select(*cols).where(
        "id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL AND forall(vector, x -> "
        "x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity'))")
    chosen = whole.groupBy("id").agg(F.min(F.struct("label", "vector")).alias("a")).select("id", "a.label", "a.vector")
    dim = chosen.agg(F.max(F.size("vector"))).first()[0] or 0
    out = None
    for block in _blocks(chosen, dim, scale):
        found = (_sorted(_keys(all_rows, Anchors(block, positives), scale, False))
                 .mapInArrow(_leading(positives), "anchor long, score long, id long").toArrow())
        names = found.column("anchor").to_pylist()
        scores = found.column("score").to_pylist()
        bounds: dict[int, list] = {}
        for a, s in zip(names, scores):
            bounds.setdefault(a, []).append(window(s, low, high))
        opened = spark.createDataFrame(
            pa.table([found.column("anchor"), pa.array([~s for s in scores], pa.int64()),
                      pa.array([False] * len(names), pa.bool_()), found.column("id")], schema=_KEY))
        keys = _keys(all_rows, Anchors(block, negatives, bounds), scale, True).unionAll(opened)
        part = _sorted(keys).mapInArrow(frugal(_emit(negatives, low, high)), OUT)
        out = part if out is None else out.unionAll(part)
    return spark.createDataFrame([], OUT) if out is None else out


#: Fixed values of the query: every hundredth row is an anchor; every seventh
#: row's label is one further (of ten).
ANCHOR_EVERY, MOVED_EVERY, LABELS = 100, 7, 10

ORACLE = f"""
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % {MOVED_EVERY} = 0 THEN (label + 1) % {LABELS} ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
         CAST(list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * b.v[i])) AS BIGINT) AS score
  FROM e a JOIN e b ON a.vec_id <> b.vec_id WHERE a.vec_id % {ANCHOR_EVERY} = 0
), p AS (
  SELECT anchor_id, id, score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
), n AS (
  SELECT p.anchor_id, p.id AS positive_id, s.id AS negative_id, p.score AS positive_score, s.score AS negative_score,
         CAST(row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY s.score DESC, s.id) AS INTEGER) AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id
  WHERE NOT s.same AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10
"""


@query("op13_hard_negatives", ORACLE)
def op13_hard_negatives(spark, sf_dir):
    """Hard negatives of every hundredth vector against all vectors."""
    e = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % MOVED_EVERY == 0, (F.col("label") + 1) % LABELS).otherwise(F.col("label"))
    return hard_negatives(e.withColumn("label", moved), F.col("vec_id") % ANCHOR_EVERY == 0)
