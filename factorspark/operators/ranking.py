"""Exact ranks and quantiles that survive a hot group.

``PARTITION BY g ORDER BY x`` sends a whole group to one task; a global rank
(Spearman over a whole sample, ROC-AUC) or a quantile of one huge group
would run in a single task.  Here the work is split by value instead:

1. distinct values with their multiplicity, ``groupBy(g, x).count()``
   (partial aggregation: a value repeated a billion times is one row);
2. per group, approximate value edges (``percentile_approx``: bounded
   memory, mergeable) cut the distinct values into B buckets of similar size;
3. bucket totals (groups x B rows) give each bucket its offset in the group;
4. a window per (group, bucket) - about ndistinct/B rows - gives the running
   count inside the bucket.

offset + running count is the exact position, so average-tie ranks and
linear-interpolation quantiles are exact; only the work split is approximate.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

RANK_DIGITS = 10


def _buckets(df: DataFrame) -> int:
    """Value buckets a group: enough for the cluster to share a hot group, few
    enough that finding a value's bucket stays cheap."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    return min(512, max(64, n))


def edges_below(edges: Column, value: Column, most: int) -> Column:
    """How many of at most ``most`` ascending edges lie below the value, by
    binary search: one look for each bit of the count."""
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(most.bit_length()))])
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(
        F.get(edges, at + step - 1) < value, at + step).otherwise(at))


def value_positions(df: DataFrame, by: Sequence[str], value: str,
                    buckets: int | None = None) -> DataFrame:
    """(by..., _k, _c, _before): each distinct rounded value ``_k`` of a group,
    its multiplicity and the number of smaller values in the group."""
    by = list(by)
    g = by or ["_all"]
    base = df if by else df.withColumn("_all", F.lit(0))
    d = (base.filter(F.col(value).isNotNull())
         .groupBy(*g, F.round(F.col(value), RANK_DIGITS).alias("_k"))
         .agg(F.count(F.lit(1)).alias("_c")))
    # the distinct-value table feeds edges, totals and running counts: write
    # it once to the shared checkpoint folder instead of recomputing its input
    d = cut_lineage(d)
    b = buckets or _buckets(df)
    probs = F.array(*[F.lit(i / b) for i in range(1, b)])
    edges = d.groupBy(*g).agg(F.percentile_approx("_k", probs, 100 * b).alias("_e"))
    d = d.join(edges, g).withColumn("_b", edges_below(F.col("_e"), F.col("_k"), b))
    tot = d.groupBy(*g, "_b").agg(F.sum("_c").alias("_bc"))
    tot = tot.withColumn("_off", F.coalesce(F.sum("_bc").over(
        Window.partitionBy(*g).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    w = Window.partitionBy(*g, "_b").orderBy("_k").rowsBetween(Window.unboundedPreceding, -1)
    d = d.withColumn("_run", F.coalesce(F.sum("_c").over(w), F.lit(0)))
    d = d.join(tot.select(*g, "_b", "_off"), [*g, "_b"])
    return d.select(*g, "_b", "_k", "_c", (F.col("_off") + F.col("_run")).alias("_before"))


def average_rank(df: DataFrame, by: Sequence[str], value: str, out: str = "rank",
                 buckets: int | None = None) -> DataFrame:
    """Average-tie rank (scipy ``rankdata``) of ``value`` within groups;
    NULL values keep a NULL rank.  Ties are values equal to 1e-10."""
    by = list(by)
    g = by or ["_all"]
    vp = value_positions(df, by, value, buckets)
    ranks = vp.select(*g, "_k", (F.col("_before") + (F.col("_c") + 1) / 2.0).alias(out))
    base = (df if by else df.withColumn("_all", F.lit(0))).withColumn(
        "_k", F.round(F.col(value), RANK_DIGITS))
    out_df = base.join(ranks, [*g, "_k"], "left").drop("_k")
    return out_df if by else out_df.drop("_all")


def rank_zscore(df: DataFrame, by: Sequence[str], value: str, out: str, buckets: int | None = None) -> DataFrame:
    """Sample z-score of the average-tie rank within groups, from the table of
    distinct values alone: a rank's mean is (n + 1) / 2, and its squares are
    summed with the values' counts."""
    by = list(by)
    vp = value_positions(df, by, value, buckets).withColumn("_r", F.col("_before") + (F.col("_c") + 1) / 2.0)
    n, s2 = F.col("_n").cast("double"), F.col("_s2")
    var = (s2 - n * ((n + 1) / 2) * ((n + 1) / 2)) / F.nullif(n - 1, F.lit(0.0))
    st = vp.groupBy(*by).agg(F.sum("_c").alias("_n"), F.sum(F.col("_c") * F.col("_r") * F.col("_r")).alias("_s2")).select(
        *by, ((n + 1) / 2).alias("_mu"), F.sqrt(F.greatest(var, F.lit(0.0))).alias("_sd"))
    z = vp.join(st, by).select(*by, "_k", F.try_divide(F.col("_r") - F.col("_mu"), F.col("_sd")).alias(out))
    base = df.withColumn("_k", F.round(F.col(value), RANK_DIGITS))
    return base.join(z, [*by, "_k"], "left").drop("_k")


def exact_quantiles(df: DataFrame, by: Sequence[str], value: str,
                    probs: Sequence[float], buckets: int | None = None) -> DataFrame:
    """Linear-interpolation quantiles (``np.quantile``, DuckDB
    ``quantile_cont``) per group: (by..., p, q).  Values are taken at 1e-10
    resolution."""
    by = list(by)
    g = by or ["_all"]
    vp = value_positions(df, by, value, buckets)
    n = vp.groupBy(*g).agg(F.sum("_c").alias("_n"))
    need = (n.withColumn("p", F.explode(F.array(*[F.lit(float(p)) for p in probs])))
            .withColumn("_h", (F.col("_n") - 1) * F.col("p"))
            .withColumns({"_lo": F.floor("_h").cast("long") + 1, "_hi": F.ceil("_h").cast("long") + 1}))
    want = need.select(*g, F.explode(F.array_distinct(F.array("_lo", "_hi"))).alias("_pos")).distinct()
    # route each wanted position to its bucket (groups x B ranges), then to
    # the value whose run (before, before + c] covers it
    span = vp.groupBy(*g, "_b").agg(F.min("_before").alias("_s0"),
                                   F.max(F.col("_before") + F.col("_c")).alias("_s1"))
    want = want.join(span, g).filter((F.col("_pos") > F.col("_s0")) &
                                     (F.col("_pos") <= F.col("_s1"))).select(*g, "_b", "_pos")
    hit = vp.join(want, [*g, "_b"]).filter((F.col("_pos") > F.col("_before")) &
                                           (F.col("_pos") <= F.col("_before") + F.col("_c")))
    lo = hit.select(*g, F.col("_pos").alias("_lo"), F.col("_k").alias("_vlo"))
    hi = hit.select(*g, F.col("_pos").alias("_hi"), F.col("_k").alias("_vhi"))
    q = (need.join(lo, [*g, "_lo"]).join(hi, [*g, "_hi"])
         .withColumn("q", F.col("_vlo") + (F.col("_h") - F.floor("_h")) * (F.col("_vhi") - F.col("_vlo"))))
    out = q.select(*g, "p", "q")
    return out if by else out.drop("_all")


def neighbours(df: DataFrame, by: Sequence[str], order: str, out: str = "prev") -> DataFrame:
    """The previous ``order`` value inside each group (lag by one),
    without a per-group window: position = number of smaller values, then an
    equi-join on (group, position - 1).  ``order`` must be unique per group."""
    by = list(by)
    g = by or ["_all"]
    vp = value_positions(df.select(*by, order), by, order)
    pos = vp.select(*g, F.col("_k").alias("_o"), "_before")
    prev = pos.select(*g, F.col("_o").alias(out), (F.col("_before") + 1).alias("_before"))
    pairs = pos.join(prev, [*g, "_before"]).select(*g, F.col("_o").alias("_o"), out)
    base = (df if by else df.withColumn("_all", F.lit(0))).withColumn(
        "_o", F.round(F.col(order), RANK_DIGITS))
    res = base.join(pairs, [*g, "_o"], "left").drop("_o")
    return res if by else res.drop("_all")
