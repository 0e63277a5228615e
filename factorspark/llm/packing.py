"""Operator 2, bounded-space online packing of token sequences.

Each partition keeps ``windows`` open windows.  A document's full windows go
out at once; its rest goes to the open window where it leaves the least room.
If it fits nowhere and no further window may open, the fullest window goes out,
filled up with the rest's head, and the remainder opens a new one.  At the end
the open windows of a partition are run together; what is then left, less than
one window a partition, is merged over groups of ``GROUP`` partitions, and the
very last tokens of a group become sequences whose lengths are powers of two.
So no sequence needs padding.

Tasks hold the open windows and one batch; only pieces of documents are
shuffled, with token ids only where a piece may be cut again.  Which group a
leftover meets depends on partition numbers alone, and a merging task sorts
what it gets, so a task that runs again makes the same sequences.

Defined cases: a null or empty text is its end token alone; rows that repeat
an id are packed one by one; a row without id keeps its null; further columns
are ignored; an empty table gives no sequences.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import frugal, parts, prepare, query, table, texts
from .tokens import Encoder

CAPACITY, WINDOWS, END_ID = 2048, 16, 1
#: Partitions whose leftovers meet in one task: at most 32 windows of tokens.
GROUP = 32

_COLUMNS = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
            "offset long, ids binary")
_SCHEMA = pa.schema([*((n, pa.int64()) for n in ("doc_id", "start", "length", "ids_crc32", "doc_tokens",
                                                  "sequence_id", "offset")), ("ids", pa.binary())])
_TASK = ", key int, partition int, nth int"
_TASK_SCHEMA = pa.schema([*_SCHEMA, ("key", pa.int32()), ("partition", pa.int32()), ("nth", pa.int32())])


class Packer:
    """Open windows; a piece is [doc_id, start, doc_tokens, ids]."""

    def __init__(self, capacity: int, windows: int):
        self.capacity, self.windows = capacity, windows
        self.open: list[list] = []               # [tokens, pieces]
        self.done: list[list] = []               # full windows: lists of pieces

    def _put(self, window, doc_id, start, total, ids):
        window[0] += len(ids)
        window[1].append((doc_id, start, total, ids))
        if window[0] == self.capacity:
            self.done.append(window[1])
            self.open.remove(window)

    def add(self, doc_id, ids, start: int = 0, total: int | None = None):
        size, total = len(ids), len(ids) if total is None else total
        at = 0
        while size - at >= self.capacity:
            self.done.append([(doc_id, start + at, total, ids[at:at + self.capacity])])
            at += self.capacity
        rest = ids[at:]
        if not len(rest):
            return
        fits = [w for w in self.open if w[0] + len(rest) <= self.capacity]
        if fits:
            self._put(max(fits, key=lambda w: w[0]), doc_id, start + at, total, rest)
            return
        if len(self.open) == self.windows:       # the fullest goes out, filled up
            full = max(self.open, key=lambda w: w[0])
            gap = self.capacity - full[0]
            self._put(full, doc_id, start + at, total, rest[:gap])
            at, rest = at + gap, rest[gap:]
        window = [0, []]
        self.open.append(window)
        self._put(window, doc_id, start + at, total, rest)

    def run_together(self) -> list[tuple]:
        """Fill the open windows from each other; the pieces of the last one."""
        left = [p for w in sorted(self.open, key=lambda w: -w[0]) for p in w[1]]
        self.open = []
        one = Packer(self.capacity, 1)
        for doc_id, start, total, ids in left:
            one.add(doc_id, ids, start, total)
        self.done += one.done
        return one.open[0][1] if one.open else []


def _halved(pieces, capacity):
    """Cut what is left into sequences whose lengths are powers of two."""
    left = sum(len(p[3]) for p in pieces)
    k, room, out = capacity, 0, []
    for doc_id, start, total, ids in pieces:
        at = 0
        while at < len(ids):
            if not room:
                while k > left:
                    k //= 2
                room = k
                out.append([])
            n = min(room, len(ids) - at)
            out[-1].append((doc_id, start + at, total, ids[at:at + n]))
            at, room, left = at + n, room - n, left - n
    return out


def _rows(sequences, first_id: int, with_ids: bool):
    for k, pieces in enumerate(sequences):
        offset = 0
        for doc_id, start, total, ids in pieces:
            raw = np.ascontiguousarray(ids, "<u4").tobytes()
            yield doc_id, start, len(ids), zlib.crc32(raw), total, first_id + k, offset, raw if with_ids else None
            offset += len(ids)


def _batches(rows, schema, size: int = 4096):
    held = []
    for r in rows:
        held.append(r)
        if len(held) == size:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def _pack(path: str | None, capacity: int, windows: int, end_id: int, n: int, with_ids: bool):
    def run(batches):
        me = TaskContext.get().partitionId()
        encoder, packer, made = Encoder(path), Packer(capacity, windows), 0

        def out():
            nonlocal made
            base, k = made, len(packer.done)
            done, packer.done, made = packer.done, [], made + k
            for r in _rows(done, me << 32 | base, with_ids):
                yield (*r, (r[5] * 0x9E3779B1 >> 16) % n, me, 0)

        for batch in batches:
            ids, first = encoder.batch(batch.column("text"))
            ids = np.insert(ids, first[1:], end_id)
            first = (first + np.arange(len(first))).tolist()
            for doc_id, a, z in zip(batch.column("doc_id").to_pylist(), first, first[1:]):
                packer.add(doc_id, ids[a:z].copy())
            yield from _batches(out(), _TASK_SCHEMA)
        left = packer.run_together()
        yield from _batches(out(), _TASK_SCHEMA)
        yield from _batches(((d, s, len(i), None, t, None, None, np.ascontiguousarray(i, "<u4").tobytes(),
                              me // GROUP % n, me, k) for k, (d, s, t, i) in enumerate(left)), _TASK_SCHEMA)
    return run


def _merge(capacity: int, with_ids: bool):
    def run(batches):
        left: dict[int, list] = {}
        for batch in batches:
            open_ = pa.compute.is_null(batch.column("sequence_id"))
            yield pa.RecordBatch.from_arrays([c for c in batch.filter(pa.compute.invert(open_)).columns[:8]],
                                             schema=_SCHEMA)
            for r in batch.filter(open_).to_pylist():
                left.setdefault(r["partition"] // GROUP, []).append(r)
        for group, rows in sorted(left.items()):
            rows.sort(key=lambda r: (r["partition"], r["nth"]))
            packer = Packer(capacity, 1)
            for r in rows:
                packer.add(r["doc_id"], np.frombuffer(r["ids"], "<u4"), r["start"], r["doc_tokens"])
            rest = packer.run_together()
            sequences = packer.done + _halved(rest, capacity)
            yield from _batches(_rows(sequences, 1 << 62 | group << 32, with_ids), _SCHEMA)
    return run


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
         windows: int = WINDOWS, end_id: int = END_ID, tokenizer: str | None = None,
         with_ids: bool = True) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset, ids (little-endian unsigned 32-bit; null unless
    ``with_ids``)."""
    spark = prepare(docs.sparkSession)
    n = parts(spark)
    made = texts(docs, id_col, text_col).mapInArrow(
        frugal(_pack(tokenizer, capacity, windows, end_id, n, with_ids)), _COLUMNS + _TASK)
    return made.repartitionById(n, F.col("key")).mapInArrow(frugal(_merge(capacity, with_ids)), _COLUMNS)


@query("op2_packing")
def op2_packing(spark, sf_dir):
    """All documents packed into sequences of at most 2048 tokens."""
    return pack(table(spark, sf_dir, "documents"), with_ids=False).drop("ids")
