"""Connected components of an edge table, by alternating stars."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .common import cut_lineage, frugal


#: Edges that a task joins at a time.
CHUNK = 1 << 20


def _forest(batches):
    """The same components with fewer, shorter paths: every node of a chunk of
    edges is linked to the smallest one that the chunk links it with."""
    schema = pa.schema([("hi", pa.int64()), ("lo", pa.int64())])

    def stars(a, b):
        nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
        x, y = at[:len(a)], at[len(a):]
        low = np.arange(len(nodes))              # ranks, so the smallest rank is the smallest node
        while True:
            m = np.minimum(low[x], low[y])
            new = low.copy()
            np.minimum.at(new, low[x], m)
            np.minimum.at(new, low[y], m)
            new = new[new]
            if (new == low).all():
                break
            low = new
        other = low != np.arange(len(nodes))
        return pa.RecordBatch.from_arrays([pa.array(nodes[other]), pa.array(nodes[low[other]])], schema=schema)

    held, n = [], 0
    for batch in batches:
        held.append([batch.column(i).to_numpy() for i in (0, 1)])
        n += batch.num_rows
        if n >= CHUNK:
            yield stars(*map(np.concatenate, zip(*held)))
            held, n = [], 0
    if n:
        yield stars(*map(np.concatenate, zip(*held)))


def _cut(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """``edges`` written, and their number and checksum, seen on the way."""
    seen = Observation()
    out = cut_lineage(edges.observe(seen, F.count(F.lit(1)).alias("n"),
                                    F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)")).alias("sum")))
    return out, (seen.get["n"], seen.get["sum"])


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of ``edges`` (a, b: long); the label is the
    smallest node that can be reached.

    Tasks first join what their own edges link, a bounded chunk at a time, so
    that what is left are links between tasks.  Rounds then alternate two steps
    that keep the components: every node links its larger neighbours, then its
    smaller ones, to the smallest node around it.  This halves paths, so few
    rounds end in stars around the smallest nodes (Kiveris et al., "Connected
    Components in MapReduce and Beyond", 2014).  The tables are cut off by
    reliable checkpoints; a count and a checksum, which tell the end, are
    observed while a table is written.  Minima are pre-aggregated and written
    before they are joined, so that Spark can split the keys of hubs.
    """
    e = edges.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).where("hi <> lo")
    e, state = _cut(e.mapInArrow(frugal(_forest), "hi long, lo long").distinct())
    while True:
        both = e.select(F.col("hi").alias("node"), F.col("lo").alias("other")).union(e.select("lo", "hi"))
        least = cut_lineage(both.groupBy("node").agg(F.min("other").alias("least"))
                            .select("node", F.least("node", "least").alias("least")))
        e = cut_lineage(both.where("other > node").join(least, "node")
                        .select(F.col("other").alias("hi"), F.col("least").alias("lo")).distinct())
        least = cut_lineage(e.groupBy("hi").agg(F.min("lo").alias("least")))
        before = state
        e, state = _cut(e.join(least, "hi").where("lo <> least").select(F.col("lo").alias("hi"), "least")
                        .union(least).withColumnRenamed("least", "lo").distinct())
        if state == before:
            return e.select(F.col("hi").alias("node"), F.col("lo").alias("label")).union(
                e.select("lo", "lo").distinct())
