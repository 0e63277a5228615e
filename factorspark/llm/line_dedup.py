"""Operator 10, line dedup by winnowing over line hashes.

Of every ``window`` consecutive lines the line with the smallest hash (the
first of equal ones) is a fingerprint, so equal runs of at least ``window``
lines have a fingerprint at the same place, whatever stands around them.
Positions with the same fingerprint are joined; they extend to a match on both
sides if the window around them is the same.  Joining each position only to
the earliest one with its fingerprint and window keeps a line that stands in a
third of all documents linear: the earliest places are pre-aggregated minima
and the join has no window above it, so Spark can split its hot keys.  Joined
windows of a document that overlap or touch grow into maximal runs.  The run
is deleted where it is the later one, in the order of (doc_id, text hash, line).

What counts as a repeat: ``window`` consecutive lines whatever their length, or
one line of at least ``long_words`` words or ``LONG_BYTES`` bytes a word of
those (for scripts without spaces), which is a window of its own.  Without
``long_words`` only the first rule holds; so it is in the query
``op10_line_dedup``, which its SQL defines by two lines.

Lines are what stands between line breaks (LF or CR); empty ones neither match
nor go.  Hashes have 64 bits, and a match has both fingerprint and window
equal.

Defined cases: a null or empty text has no lines; texts with fewer lines than
``window``, none of them long, stay; a line that repeats itself within a document goes where a
window of it starts again; rows with the same id and text count as the same
place, so none of them repeats the other; rows that share an id alone, or have
none, are documents of their own, in the order of their texts' hashes (whatever
was found in a row is cut out of that text only); rows without id come last; further columns are
kept by ``remove`` and ignored by ``line_dedup``; an empty table stays empty.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import frugal, identified, prepare, query, row_key, table, texts
from .substring_dedup import _minimizer
from .words import LINES, SPACED, U64, Words, long_grams, mix

WINDOW = 2
#: Words of a line that is compared on its own, and bytes that stand for a word.
LONG_WORDS, LONG_BYTES = 50, 6

#: A row's own key (``row_key``).
KEY = ("place", "one", "two")
#: Added by ``_marked``; the name is not one that data would use.
STARTS = "_llm_starts"


def _long(w: Words, long_words: int) -> np.ndarray:
    """The lines that are compared on their own."""
    size = w.end - w.start
    long = size >= LONG_BYTES * long_words
    some = np.flatnonzero(~long & (size >= 2 * long_words - 1))
    if len(some):
        word = ~SPACED[w.buf]
        heads = np.zeros(len(w.buf) + 1, bool)
        heads[1:-1] = word[1:] & ~word[:-1]
        heads[w.start[some]] = word[w.start[some]]
        edges = np.stack([w.start[some], w.end[some]], 1).reshape(-1)
        long[some] = np.add.reduceat(heads, edges, dtype=np.int64)[::2] >= long_words
    return np.flatnonzero(long)


def _fingerprints(window: int, long_words: int | None):
    """A row per window: its fingerprint, its own hash, and where it starts:
    twice the line, and 1 more for a long line."""
    schema = pa.schema([("print", pa.int64()), ("win", pa.int64()), *((k, pa.int64()) for k in KEY),
                        ("start", pa.int64())])

    def run(batches):
        for batch in batches:
            w = Words(batch.column("text"), LINES, False)
            owner = np.repeat(np.arange(batch.num_rows), np.diff(w.first))
            key = [batch.column(k).to_numpy() for k in KEY]

            def found(line, prints, full, kind):
                doc = owner[line]
                return pa.RecordBatch.from_arrays(
                    [pa.array(prints.view(np.int64)), pa.array(full.view(np.int64)),
                     *(pa.array(k[doc]) for k in key), pa.array(2 * (line - w.first[doc]) + kind)], schema=schema)

            n = len(w.hash) - window + 1
            if n > 0:
                at = _minimizer(w.hash, window)
                inside = np.flatnonzero(np.arange(n) + window <= w.first[owner[:n] + 1])
                yield found(inside, w.hash[at[inside]], long_grams(w.hash, window)[inside], 0)
            line = _long(w, long_words) if long_words is not None and len(w.hash) else ()
            if len(line):
                h = w.hash[line]
                yield found(line, h, mix(h ^ U64(1)), 1)
    return run


def _marked(docs: DataFrame, id_col: str, text_col: str, window: int, long_words: int | None) -> DataFrame:
    """``docs`` and, in ``STARTS``, where its repeated windows start."""
    prepare(docs.sparkSession)
    prints = identified(docs, id_col, text_col).mapInArrow(
        frugal(_fingerprints(window, long_words)), "print long, win long, place long, one long, two long, start long")
    first = (prints.groupBy("print", "win")
             .agg(F.min(F.struct(*KEY, "start")).alias("first"), F.count(F.lit(1)).alias("places"))
             .where("places > 1").select("print", "win", "first"))
    late = prints.join(first, ["print", "win"]).where(F.struct(*KEY, "start") > F.col("first"))
    starts = late.groupBy(*KEY).agg(F.sort_array(F.collect_set("start")).alias(STARTS))
    own = row_key(docs[id_col].cast("long"), F.coalesce(docs[text_col].cast("string"), F.lit("")))
    same = [a == starts[k] for a, k in zip(own, KEY)]
    return docs.join(starts, same, "left").select(*(docs[c] for c in docs.columns), STARTS)


def _runs(starts, window: int) -> list[tuple[int, int]]:
    """Maximal runs [first, end) of the windows that start there."""
    out: list[list[int]] = []
    for x in starts or ():
        s, z = x // 2, x // 2 + (1 if x % 2 else window)
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], z)
        else:
            out.append([s, z])
    return [(a, z) for a, z in out]


def _cut(words: Words, i: int, runs) -> str:
    """Text ``i`` without the runs' lines and the line breaks that follow them."""
    base, lo, out = int(words.first[i]), int(words.offs[i]), []
    for a, z in runs:
        out.append(words.buf[lo:words.start[base + a]].tobytes())
        lo = int(words.start[base + z]) if base + z < words.first[i + 1] else int(words.offs[i + 1])
    out.append(words.buf[lo:words.offs[i + 1]].tobytes())
    return b"".join(out).decode()


def remove(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
           long_words: int | None = LONG_WORDS) -> DataFrame:
    """``docs``, all columns, without later repeated runs of lines; documents
    whose lines all were in such runs go."""
    schema = docs.schema

    def run(batches):
        for batch in batches:
            words = Words(batch.column(text_col), LINES, False)
            new, kept = batch.column(text_col).to_pylist(), [True] * batch.num_rows
            lines = np.diff(words.first).tolist()
            for i, starts in enumerate(batch.column(STARTS).to_pylist()):
                runs = _runs(starts, window)
                if runs:
                    new[i] = _cut(words, i, runs)
                    kept[i] = sum(z - a for a, z in runs) < lines[i]
            cols = [pa.array(new, batch.column(n).type) if n == text_col else batch.column(n)
                    for n in batch.schema.names if n != STARTS]
            yield pa.RecordBatch.from_arrays(cols, schema.names).filter(pa.array(kept, pa.bool_()))

    return _marked(docs, id_col, text_col, window, long_words).mapInArrow(frugal(run), schema)


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
               long_words: int | None = LONG_WORDS) -> DataFrame:
    """doc_id, n_lines, n_removed, runs (array of struct start, end: lines),
    kept (the text without them); one row per input row."""
    schema = T.StructType([
        T.StructField("doc_id", T.LongType()), T.StructField("n_lines", T.LongType()),
        T.StructField("n_removed", T.LongType()),
        T.StructField("runs", T.ArrayType(T.StructType([T.StructField("start", T.LongType()),
                                                        T.StructField("end", T.LongType())]))),
        T.StructField("kept", T.StringType())])
    arrow = pa.schema([("doc_id", pa.int64()), ("n_lines", pa.int64()), ("n_removed", pa.int64()),
                       ("runs", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                       ("kept", pa.string())])

    def run(batches):
        for batch in batches:
            words = Words(batch.column("text"), LINES, False)
            kept, lines = batch.column("text").to_pylist(), np.diff(words.first)
            found = []
            for i, starts in enumerate(batch.column(STARTS).to_pylist()):
                runs = _runs(starts, window)
                if runs:
                    kept[i] = _cut(words, i, runs)
                found.append([{"start": a, "end": z} for a, z in runs])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(lines), pa.array([sum(r["end"] - r["start"] for r in x)
                                                                    for x in found], pa.int64()),
                 pa.array(found, arrow.field("runs").type), pa.array(kept, pa.string())], schema=arrow)

    d = texts(docs, id_col, text_col)
    return _marked(d, "doc_id", "text", window, long_words).mapInArrow(frugal(run), schema)


ORACLE = rf"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\r\n]'), lambda x: x <> '') AS l
           FROM documents),
w AS (SELECT doc_id, p, array_to_string(l[p:p + {WINDOW - 1}], chr(10)) AS g
      FROM (SELECT doc_id, l, unnest(range(1, len(l) - {WINDOW - 2})) AS p FROM d WHERE len(l) >= {WINDOW})),
f AS (SELECT doc_id, p, row_number() OVER (PARTITION BY g ORDER BY doc_id, p) > 1 AS late FROM w),
gone AS (SELECT DISTINCT doc_id, unnest(range(p, p + {WINDOW})) AS p FROM f WHERE late),
k AS (SELECT d.doc_id, string_agg(u.line, chr(10) ORDER BY u.p) FILTER (gone.p IS NULL) AS kept,
             count(u.p) AS n_lines, count(gone.p) AS n_removed
      FROM d LEFT JOIN (SELECT doc_id, unnest(l) AS line, unnest(range(1, len(l) + 1)) AS p FROM d) u USING (doc_id)
      LEFT JOIN gone ON gone.doc_id = u.doc_id AND gone.p = u.p GROUP BY d.doc_id)
SELECT doc_id, n_lines, n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM k
"""

#: The operator's own rule: a long line is a window as well.
FULL_ORACLE = rf"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\r\n]'), lambda x: x <> '') AS l
           FROM documents),
w AS (SELECT doc_id, p, 'pair ' || array_to_string(l[p:p + {WINDOW - 1}], chr(10)) AS g, {WINDOW} AS n
      FROM (SELECT doc_id, l, unnest(range(1, len(l) - {WINDOW - 2})) AS p FROM d WHERE len(l) >= {WINDOW})
      UNION ALL
      SELECT doc_id, p, 'line ' || l[p], 1 FROM (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS p FROM d)
      WHERE strlen(l[p]) >= {LONG_BYTES * LONG_WORDS} OR len(regexp_extract_all(l[p], '[^\x20\x09-\x0D]+')) >= {LONG_WORDS}),
f AS (SELECT doc_id, p, n, row_number() OVER (PARTITION BY g ORDER BY doc_id, p) > 1 AS late FROM w),
gone AS (SELECT DISTINCT doc_id, unnest(range(p, p + n)) AS p FROM f WHERE late),
k AS (SELECT d.doc_id, string_agg(u.line, chr(10) ORDER BY u.p) FILTER (gone.p IS NULL) AS kept,
             count(u.p) AS n_lines, count(gone.p) AS n_removed
      FROM d LEFT JOIN (SELECT doc_id, unnest(l) AS line, unnest(range(1, len(l) + 1)) AS p FROM d) u USING (doc_id)
      LEFT JOIN gone ON gone.doc_id = u.doc_id AND gone.p = u.p GROUP BY d.doc_id)
SELECT doc_id, n_lines, n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM k
"""


def _digest(r: DataFrame) -> DataFrame:
    kept = F.array_join(F.filter(F.split("kept", r"[\r\n]"), lambda x: x != ""), "\n")
    return r.select("doc_id", "n_lines", "n_removed", F.sha2(kept.cast("binary"), 256).alias("kept_sha256"))


@query("op10_line_dedup", ORACLE)
def op10_line_dedup(spark, sf_dir):
    """Runs of lines that stand earlier in the corpus, removed; the SQL's
    runs are of two lines at least."""
    return _digest(line_dedup(table(spark, sf_dir, "documents"), long_words=None))


@query("line_dedup_long_lines", FULL_ORACLE)
def line_dedup_long_lines(spark, sf_dir):
    """The same with the operator's own rule, as the pipeline applies it: one
    line of 50 words or 300 bytes is a run as well."""
    return _digest(line_dedup(table(spark, sf_dir, "documents")))
