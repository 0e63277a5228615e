"""Operator 1, benchmark decontamination with a suffix automaton of the items.

The normalised items make one generalised suffix automaton; tasks stream the
words of the documents through it, tracking the longest match.  A hit is
``window`` consecutive words of an item, or all words of a shorter item.

The automaton goes to every task, so its size is checked: items are dealt by hash to
blocks of about ``ITEM_CHARS`` characters, each block gets an automaton and a
pass of its own, and the passes add up their spans behind a checkpoint.
Documents are not shuffled.

Defined cases: a null or wordless text has no hits; a null or wordless item
has no window; an item without id hits but is not listed; rows that repeat an
id are matched one by one; items that share an id count once; without
documents or items nothing is hit; further columns are kept by ``remove`` and
ignored by ``matches``.
"""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .automaton import Matcher
from .common import cut_lineage, frugal, prepare, query, table
from .words import ALNUM, Words

#: Characters of items that one automaton takes (about 300 MB as Python objects).
ITEM_CHARS = 4_000_000

#: Added by a pass; the name is not one that data would use.
HITS = "_llm_hits"
_HITS = T.StructType([T.StructField("n_words", T.LongType()),
                      T.StructField("spans", T.ArrayType(T.ArrayType(T.LongType()))),
                      T.StructField("items", T.ArrayType(T.StringType()))])
_ARROW_HITS = pa.struct([("n_words", pa.int64()), ("spans", pa.list_(pa.list_(pa.int64()))),
                         ("items", pa.list_(pa.string()))])


def _merged(spans) -> list[list[int]]:
    out: list[list[int]] = []
    for a, z in sorted(map(tuple, spans)):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], z)
        else:
            out.append([a, z])
    return out


def _pass(matcher, text_col: str, first: bool):
    """One pass: adds this block's hits to those of the blocks before."""
    def run(batches):
        for batch in batches:
            words = Words(batch.column(text_col), ALNUM, True)
            before = None if first else batch.column(HITS).to_pylist()
            hits, found = [], matcher.match(words)
            for i, (a, z) in enumerate(zip(words.first[:-1].tolist(), words.first[1:].tolist())):
                spans, items = found.get(i, ((), ()))
                items = {x for x in items if x is not None}
                if before:
                    spans = [*spans, *before[i]["spans"]]
                    items |= set(before[i]["items"])
                hits.append({"n_words": z - a, "spans": _merged(spans), "items": sorted(items)})
            names = [n for n in batch.schema.names if n != HITS]
            yield pa.RecordBatch.from_arrays([batch.column(n) for n in names] + [pa.array(hits, _ARROW_HITS)],
                                             [*names, HITS])
    return run


def _hits(docs: DataFrame, text_col: str, items: DataFrame, item_id: str, item_text: str, window: int,
          then=None) -> DataFrame:
    """``docs`` and ``HITS``; or what ``then`` makes of both in the last pass,
    with the columns of ``docs``."""
    prepare(docs.sparkSession)
    it = items.select(items[item_id].cast("string").alias("id"), items[item_text].cast("string").alias("text"))
    chars = it.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(chars / ITEM_CHARS))
    kept = docs.schema
    schema = T.StructType([*kept.fields, T.StructField(HITS, _HITS)])
    for b in range(blocks):
        own = it.where(F.pmod(F.xxhash64("text"), F.lit(blocks)) == b) if blocks > 1 else it
        matcher = Matcher([(r.id, r.text) for r in own.collect()], window)
        run = _pass(matcher, text_col, b == 0)
        if b < blocks - 1:
            docs = cut_lineage(docs.mapInArrow(frugal(run), schema))
        elif then is None:
            docs = docs.mapInArrow(frugal(run), schema)
        else:
            docs = docs.mapInArrow(frugal(lambda batches, run=run: then(run(batches))), kept)
    return docs


def matches(docs: DataFrame, items: DataFrame, window: int = 10, id_col: str = "doc_id", text_col: str = "text",
            item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """doc_id, n_words, spans (word positions [start, end), disjoint and in
    order) and items (ids as strings, sorted), one row per document."""
    d = docs.select(docs[id_col].alias("doc_id"), docs[text_col].cast("string").alias("text"))
    return _hits(d, "text", items, item_id, item_text, window).select("doc_id", f"{HITS}.*")


def remove(docs: DataFrame, items: DataFrame, window: int = 10, max_words: int = 0, max_coverage: float = 0.5,
           text_col: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """``docs``, all columns, without what matches the items.

    Spans of more than ``max_words`` words are cut out of the text, from the
    first byte of their first word to the last of their last; documents of
    whose words more than ``max_coverage`` lie in spans go altogether.
    """
    def cut(batches):
        for batch in batches:
            words = Words(batch.column(text_col), ALNUM, True)
            kept, new = [], batch.column(text_col).to_pylist()
            for i, hit in enumerate(batch.column(HITS).to_pylist()):
                over = [s for s in hit["spans"] if s[1] - s[0] > max_words]
                kept.append(sum(z - a for a, z in hit["spans"]) <= max_coverage * hit["n_words"])
                if over and kept[-1]:
                    base, lo, out = int(words.first[i]), int(words.offs[i]), []
                    for a, z in over:
                        out.append(words.buf[lo:words.start[base + a]].tobytes())
                        lo = int(words.end[base + z - 1])
                    out.append(words.buf[lo:words.offs[i + 1]].tobytes())
                    new[i] = b"".join(out).decode()
            names = [n for n in batch.schema.names if n != HITS]
            cols = [pa.array(new, batch.column(n).type) if n == text_col else batch.column(n) for n in names]
            yield pa.RecordBatch.from_arrays(cols, names).filter(pa.array(kept, pa.bool_()))

    return _hits(docs, text_col, items, item_id, item_text, window, cut)


_AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_WORDS = rf"regexp_extract_all(translate(coalesce(text, ''), {_AZ}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLE = rf"""
WITH i AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[p:p + least(len(w), 10) - 1], ' ') AS gram
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS p FROM i WHERE len(w) > 0)
), d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
p AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS p FROM d),
g AS (
  SELECT doc_id, p, n, array_to_string(w[p:p + n - 1], ' ') AS gram
  FROM p, (SELECT DISTINCT n FROM win) WHERE p + n - 1 <= len(w)
), h AS (SELECT doc_id, p, g.n, item_id FROM g JOIN win USING (n, gram)),
c AS (SELECT doc_id, count(DISTINCT q) AS n_hit
      FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM h) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
      FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM h) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN t USING (doc_id)
"""


@query("op1_decontamination", ORACLE)
def op1_decontamination(spark, sf_dir):
    """Benchmark windows of ten words in all documents, by suffix automaton."""
    m = matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda s, x: s + x[1] - x[0])
    return m.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                    F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
                    (n_hit > 0).alias("contaminated"))
