"""Operator 12, filter interaction audit by the Hart-Mas-Colell potential.

A document's failures are the players that would remove it.  In the removal
game of a part of the table a coalition S of filters is worth v(S), the
documents that fail at least one of S.  The potential is found recursively over
the coalitions, P(S) = (v(S) + the sum of P(S without i)) / |S|, and a filter's
Shapley value is P(all) - P(all without it): what it removes on average over
all orders.  With k filters, lcm(1..k) P is whole, so the recursion runs in
integers.  Whatever an order's steps report are coalition differences as well:
a step removes v(before + filter) - v(before).

Documents are measured in one pass without a shuffle of texts.  Per part only
the counts of the failure patterns (at most 2^k, with what is labelled good or
toxic among them) are aggregated, partial counts first, so a source with a third
of all rows is one row per task.  Equality with an earlier document is decided
by a 128-bit hash: the smallest id of each text that occurs again is joined back
to (id, hash) pairs, a join whose hot keys Spark can split.  Coalitions and
orders are columns of the parts' rows: constants of the number of filters.

Defined cases: a null text is empty; a null part is the empty string; a
document without id is no copy and has no label; rows that repeat an id count
one by one, are no copies of each other, and share its labels; of labels that
repeat an id the largest counts, null ones count as 0; labels of no document are
left out; further columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from functools import reduce
from itertools import permutations
from math import factorial, lcm

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage, frugal, prepare, query, table
from .words import SPACED, Words

#: Fixed values of the filters: fewest words, least percentage of distinct
#: words, largest percentage of capital letters, characters that a text may not
#: have.
MIN_WORDS, MIN_DISTINCT, MAX_CAPITALS, BARRED = 200, 50, 2, b"#$%&*|"
FILTERS = "ABCDE"


def failures(column) -> np.ndarray:
    """Bits 0 to 3 of each text: whether it fails A, B, C, D."""
    w = Words(column, SPACED, False)
    n = np.diff(w.first)
    owner = np.repeat(np.arange(len(n)), n)
    o = np.lexsort((w.hash, owner))
    new = np.ones(len(o), bool)
    new[1:] = (w.hash[o][1:] != w.hash[o][:-1]) | (owner[o][1:] != owner[o][:-1])
    distinct = np.bincount(owner[o][new], minlength=len(n))

    def count(these: np.ndarray) -> np.ndarray:
        sums = np.zeros(len(w.buf) + 1, np.int64)
        np.cumsum(these, out=sums[1:])
        return np.diff(sums[w.offs])

    points = count((w.buf & 0xC0) != 0x80)
    capitals = count((w.buf >= 0x41) & (w.buf <= 0x5A))
    barred = count(np.isin(w.buf, np.frombuffer(BARRED, np.uint8)))
    return ((n < MIN_WORDS) | (100 * distinct < MIN_DISTINCT * n) << 1
            | (100 * capitals > MAX_CAPITALS * points) << 2 | (barred > 0) << 3).astype(np.int32)


def measured(docs: DataFrame, id_col: str, text_col: str, part_col: str) -> DataFrame:
    """doc_id, part, fails (bits in the order of ``FILTERS``), one row per
    document."""
    prepare(docs.sparkSession)
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    d = docs.select(docs[id_col].cast("long").alias("doc_id"),
                    F.coalesce(docs[part_col].cast("string"), F.lit("")).alias("part"),
                    F.unhex(F.md5(text.cast("binary"))).alias("hash"), text.alias("text"))

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(failures(batch.column(3)), pa.int32())], ["doc_id", "part", "hash", "bits"])

    d = d.mapInArrow(frugal(run), "doc_id long, part string, hash binary, bits int")
    # Written before it is joined, so that Spark can split the rows of a hot text.
    first = cut_lineage(docs.select(docs[id_col].cast("long").alias("doc_id"), F.unhex(F.md5(text.cast("binary"))).alias("hash"))
                        .groupBy("hash").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n"))
                        .where("n > 1").drop("n"))
    copy = F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False)).cast("int") * (1 << 4)
    return d.join(first, "hash", "left").select("doc_id", "part", F.col("bits").bitwiseOR(copy).alias("fails"))


def coalition_values(patterns: DataFrame, part: str, fails: str, weights: dict[str, Column], k: int) -> DataFrame:
    """Per part and weight an array: at index S (a bit set of filters) the
    weight of the rows that fail at least one filter of S; and, as ``all_`` and
    the weight's name, that of all rows."""
    value = {name: [F.sum(F.when(F.col(fails).bitwiseAND(F.lit(s)) != 0, w).otherwise(0)) for s in range(1 << k)]
             for name, w in weights.items()}
    return patterns.groupBy(part).agg(*(F.array(*v).alias(name) for name, v in value.items()),
                                      *(F.sum(w).alias(f"all_{name}") for name, w in weights.items()))


def with_potential(games: DataFrame, value: str, k: int) -> DataFrame:
    """``games`` and ``potential``: lcm(1..k) times the Hart-Mas-Colell
    potential of the game ``value`` at each coalition, by the recursion.  The
    coalitions of a size make one step, as they need the next smaller alone."""
    unit = lcm(*range(1, k + 1))
    out = games.withColumn("potential", F.array(*[F.lit(0).cast("long")] * (1 << k)))
    for size in range(1, k + 1):
        cells = []
        for s in range(1 << k):
            here = F.col("potential")[s]
            if s.bit_count() == size:
                smaller = reduce(lambda a, b: a + b, [F.col("potential")[s ^ 1 << i] for i in range(k) if s >> i & 1])
                here = ((F.col(value)[s] * unit + smaller) / size).cast("long")
            cells.append(here)
        out = out.withColumn("potential", F.array(*cells))
    return out


def audit(patterns: DataFrame, names: str = FILTERS, part: str = "part", fails: str = "fails",
          weights: dict[str, Column] | None = None) -> DataFrame:
    """part, filter_order, step, kept, removed, redundant, unique_fails,
    shapley (times the number of orders), and for each weight but ``all``
    ``<name>_lost``.

    ``patterns`` has a row per document or per group of them; ``weights`` says
    what a row counts for (``all``: documents).
    """
    weights = weights or {"all": F.lit(1).cast("long")}
    k = len(names)
    full = (1 << k) - 1
    games = with_potential(coalition_values(patterns, part, fails, weights, k), "all", k)
    orders = F.explode(F.array(*[F.lit("".join(p)) for p in permutations(names)])).alias("filter_order")
    steps = games.select("*", orders).select("*", F.explode(F.sequence(F.lit(1), F.lit(k))).alias("step"))

    bit = F.lit(0)
    for i, name in enumerate(names):
        bit = F.when(F.col("letter") == name, 1 << i).otherwise(bit)
    # The filters before the step, as a bit set: each letter that the order's head holds.
    before = reduce(lambda a, b: a + b, [F.when(F.instr("head", name) > 0, 1 << i).otherwise(0)
                                         for i, name in enumerate(names)])
    d = (steps.withColumn("letter", F.substring("filter_order", F.col("step"), F.lit(1)))
         .withColumn("head", F.substring("filter_order", F.lit(1), F.col("step") - 1))
         .withColumn("bit", bit).withColumn("before", before))
    value = lambda name, s: F.get(F.col(name), s)
    gain = lambda name: value(name, F.col("before") + F.col("bit")) - value(name, F.col("before"))
    shapley = ((F.get("potential", F.lit(full)) - F.get("potential", F.lit(full) - F.col("bit")))
               * (factorial(k) // lcm(*range(1, k + 1))))
    return d.select(
        part, "filter_order", "step", (F.col("all_all") - value("all", F.col("before") + F.col("bit"))).alias("kept"),
        gain("all").alias("removed"), (value("all", F.col("bit")) - gain("all")).alias("redundant"),
        (value("all", F.lit(full)) - value("all", F.lit(full) - F.col("bit"))).alias("unique_fails"),
        *(gain(name).alias(f"{name}_lost") for name in weights if name != "all"), shapley.alias("shapley"))


def filter_audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 part_col: str = "source") -> DataFrame:
    """The audit of the five filters over ``docs``, with the good and toxic
    documents that each step loses."""
    known = (labels.select(labels[id_col].cast("long").alias("doc_id"), (labels["quality"] == 1).alias("good"),
                           (labels["toxic"] == 1).alias("toxic")).where("doc_id IS NOT NULL")
             .groupBy("doc_id").agg(F.max("good").alias("good"), F.max("toxic").alias("toxic")))
    flag = lambda c: F.coalesce(F.col(c), F.lit(False)).cast("long")
    patterns = (measured(docs, id_col, text_col, part_col).join(known, "doc_id", "left")
                .groupBy("part", "fails").agg(F.count(F.lit(1)).alias("n"), F.sum(flag("good")).alias("good"),
                                              F.sum(flag("toxic")).alias("toxic")))
    return audit(patterns, weights={"all": F.col("n"), "good": F.col("good"), "toxic": F.col("toxic")})


ORACLE = rf"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
         min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS first
  FROM documents
), f AS (
  SELECT part, doc_id,
    [len(w) < 200, 100 * len(list_distinct(w)) < 50 * len(w),
     100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t), regexp_matches(t, '[#$%&*|]'),
     coalesce(doc_id > first, false)] AS fails
  FROM d
), l AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels GROUP BY doc_id
), g AS (
  SELECT part, fails, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
  FROM f LEFT JOIN l USING (doc_id) GROUP BY part, fails
), letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x), o AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
), s AS (
  SELECT g.*, filter_order, step, ascii(filter_order[step]) - 64 AS own,
    list_bool_or(list_transform(range(1, step), lambda j: fails[ascii(filter_order[j]) - 64])) AS gone
  FROM g, o, (SELECT unnest(range(1, 6)) AS step)
), r AS (
  SELECT part, filter_order, step, own,
    sum(CASE WHEN NOT coalesce(gone, false) AND NOT fails[own] THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN NOT coalesce(gone, false) AND fails[own] THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN coalesce(gone, false) AND fails[own] THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN fails[own] AND len(list_filter(fails, lambda x: x)) = 1 THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN NOT coalesce(gone, false) AND fails[own] THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN NOT coalesce(gone, false) AND fails[own] THEN toxic ELSE 0 END) AS toxic_lost
  FROM s GROUP BY part, filter_order, step, own
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept,
  CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
  CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
  CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM r
"""


@query("op12_filter_audit", ORACLE)
def op12_filter_audit(spark, sf_dir):
    """Five filters over all documents, in all orders, by source."""
    return filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
