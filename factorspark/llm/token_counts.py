"""Operator 5, token counts by section through the tokens' offsets.

A document is encoded once, as a whole.  Its tokens lie end to end, so running
sums of their byte lengths are their offsets; read as characters they are
joined to the sections' intervals by binary search, for a whole Arrow batch at
a time.  A token that crosses a boundary counts where its reference character
lies: its first, middle or last one (``rule``).  So the sections' counts and
those outside all sections (section -1) add up to the document's tokens.

Sections are the lines of a text, or those of a table (doc_id, section, start,
end: characters, end excluded), which may leave gaps.  If they overlap each
counts for itself.

Defined cases: a null text is empty; the lines of an empty text are one empty
section; a section with null or reversed bounds is empty, bounds beyond the
text are cut to it, and a document without sections has only the row of
section -1, if it has tokens; rows of documents that repeat an id are counted
one by one; further columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import frugal, prepare, query, table, texts
from .tokens import Encoder
from .words import text_buffer

RULES = ("first", "middle", "last")
OUTSIDE = -1
_SCHEMA = pa.schema([(n, pa.int64()) for n in ("doc_id", "section", "start", "end", "n_tokens", "n_crossing")])
_COLUMNS = ", ".join(f"{f.name} long" for f in _SCHEMA)


def _lines(buf, offs, chars):
    """(document, section, start, end) of all lines of a batch."""
    at = np.flatnonzero(buf == 10)
    doc = np.searchsorted(offs, at, "right") - 1
    n = len(offs) - 1
    start = np.r_[offs[:-1], at + 1]
    end = np.r_[at, offs[1:]]
    a = np.lexsort((start, np.r_[np.arange(n), doc]))
    z = np.lexsort((end, np.r_[doc, np.arange(n)]))
    owner = np.r_[np.arange(n), doc][a]
    return owner, np.arange(len(a)) - np.searchsorted(owner, owner), chars[start[a]], chars[end[z]]


def _given(column, base, size):
    """The same of a list column of sections."""
    doc, section, start, end = [], [], [], []
    for i, own in enumerate(column.to_pylist()):
        for s in own or ():
            a, z = (min(max(x if x is not None else 0, 0), int(size[i])) for x in (s["start"], s["end"]))
            doc.append(i)
            section.append(s["section"])
            start.append(base[i] + a)
            end.append(base[i] + max(a, z))
    return np.array(doc, np.int64), section, np.array(start, np.int64), np.array(end, np.int64)


def _count(path, rule: str, lines: bool):
    def run(batches):
        encoder = Encoder(path)
        for batch in batches:
            buf, offs = text_buffer(batch.column("text"))
            ids, first = encoder.batch(batch.column("text"))
            chars = np.r_[0, np.cumsum((buf & 0xC0) != 0x80)]    # characters before each byte
            edge = np.r_[0, np.cumsum(encoder.bytes[ids])]
            lo = chars[np.minimum(edge[:-1] + 1, len(buf))] - 1  # the character that holds a byte
            hi = chars[edge[1:]]
            ref = {"first": lo, "middle": (lo + hi - 1) // 2, "last": hi - 1}[rule]
            base = chars[offs]
            doc, section, a, z = (_lines(buf, offs, chars) if lines
                                  else _given(batch.column("sections"), base, np.diff(base)))
            n = np.searchsorted(ref, z) - np.searchsorted(ref, a)
            crossing = np.zeros(len(a), np.int64)
            if len(lo) and len(a):
                i, j = (np.searchsorted(lo, x) - 1 for x in (a, z))   # the last token that starts before
                over_a, over_z = (i >= 0) & (hi[i] > a), (j >= 0) & (hi[j] > z)
                crossing = over_a.astype(np.int64) + (over_z & ~(over_a & (i == j)))
                crossing[a == z] = 0
            doc_ids = batch.column("doc_id")
            yield pa.RecordBatch.from_arrays(
                [doc_ids.take(pa.array(doc)), pa.array(section, pa.int64()), pa.array(a - base[doc]),
                 pa.array(z - base[doc]), pa.array(n), pa.array(crossing)], schema=_SCHEMA)
            inside = np.zeros(int(chars[-1]) + 1, np.int64)
            np.add.at(inside, a, 1)
            np.add.at(inside, z, -1)
            free = np.r_[0, np.cumsum(np.cumsum(inside)[ref] == 0)]
            out = free[first[1:]] - free[first[:-1]]
            k = np.flatnonzero(out)
            none = pa.nulls(len(k), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [doc_ids.take(pa.array(k)), pa.array(np.full(len(k), OUTSIDE)), none, none, pa.array(out[k]),
                 pa.array(np.zeros(len(k), np.int64))], schema=_SCHEMA)
    return run


def token_counts(docs: DataFrame, sections: DataFrame | None = None, rule: str = "middle", id_col: str = "doc_id",
                 text_col: str = "text", tokenizer: str | None = None) -> DataFrame:
    """doc_id, section, start, end (characters), n_tokens, n_crossing: one row
    for each section, and one of section -1 where tokens lie in none."""
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    prepare(docs.sparkSession)
    d = texts(docs, id_col, text_col)
    if sections is not None:
        own = sections.groupBy(F.col("doc_id").cast("long").alias("of")).agg(F.sort_array(F.collect_list(F.struct(
            *(F.col(n).cast("long").alias(n) for n in ("start", "end", "section"))))).alias("sections"))
        d = d.join(own, d["doc_id"] == own["of"], "left").select("doc_id", "text", "sections")
    return d.mapInArrow(frugal(_count(tokenizer, rule, sections is None)), _COLUMNS)


@query("op5_token_counts")
def op5_token_counts(spark, sf_dir):
    """Tokens of every line of all documents, from one encoding of each."""
    return token_counts(table(spark, sf_dir, "documents"))
