"""Cross-section steps that do not need a date in one task.

The windows of ``xs`` hold one date (and group) in a task, which is right
while a date's assets fit one.  ``wide_dates`` measures that; beyond it the
functions here take the same steps with a date spread over many tasks:

* moments and extremes by partial aggregation, joined back per date (a table
  that the calendar bounds);
* ordinal ranks and top-n by (date, value bucket), with the rows of smaller
  buckets as offset.  Buckets come from the value alone (sixteen to a power of
  two on either side of zero, in the order of the values), so no edges have to
  be collected, and zeros, the value that really repeats, are split by asset;
* quantile edges from the rows at the edges' places;
* average ranks from distinct values with their counts (``ranking``).

Each function adds one column and gives what the window gives (values are
ranked at 1e-10 in both).  With ``split=False`` it is the window.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from . import ranking, xs

#: Rows of one date that a task is to hold at most.
DATE_ROWS = 2_000_000
#: Buckets of a power of two; the least double apart from zero.
STEPS, LEAST = 16, 5e-324
#: Parts that rows without a value are dealt to (they have no rank).
SPREAD = 64


def wide_dates(df: DataFrame, by: str | Sequence[str] = "date", bound: int | None = None) -> bool:
    """Whether a date of the panel has more rows than one task is to hold."""
    keys = [by] if isinstance(by, str) else list(by)
    top = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0]
    return (top or 0) > (DATE_ROWS if bound is None else bound)


def order_bucket(x: Column) -> Column:
    """A number that never falls as ``x`` grows: zero for zero, else the place
    of its size on a logarithmic scale, with its sign."""
    size = F.floor(F.greatest(F.log(F.abs(x)) - math.log(LEAST), F.lit(0.0)) * (STEPS / math.log(2))) + 1
    return F.when(x == 0, F.lit(0)).otherwise(F.signum(x) * size).cast("long")


def _keys(by: str | Sequence[str]) -> list[str]:
    return [by] if isinstance(by, str) else list(by)


def _with_stats(df: DataFrame, by: Sequence[str], **aggs: Column) -> DataFrame:
    """``df`` and its groups' aggregates; a missing group key is a group."""
    s = df.groupBy(*by).agg(*(a.alias(n) for n, a in aggs.items())).select(
        *(F.col(c).alias(f"_s_{c}") for c in by), *aggs)
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_s_{c}")) for c in by])
    return df.join(F.broadcast(s), same, "left").drop(*(f"_s_{c}" for c in by))       # dates x groups


def demean(df: DataFrame, out: str, x, by="date", split: bool = False) -> DataFrame:
    """W1."""
    if not split:
        return df.withColumn(out, xs.demean(x, by))
    d = cut_lineage(df.withColumn("_x", xs._c(x)))
    return _with_stats(d, _keys(by), _m=F.avg("_x")).withColumn(out, F.col("_x") - F.col("_m")).drop("_x", "_m")


def zscore(df: DataFrame, out: str, x, by="date", ddof: int = 0, split: bool = False) -> DataFrame:
    """W4."""
    if not split:
        return df.withColumn(out, xs.zscore(x, by, ddof))
    d = cut_lineage(df.withColumn("_x", xs._c(x)))
    sd = F.stddev_pop("_x") if ddof == 0 else F.stddev_samp("_x")
    return (_with_stats(d, _keys(by), _m=F.avg("_x"), _sd=sd)
            .withColumn(out, F.try_divide(F.col("_x") - F.col("_m"), F.col("_sd"))).drop("_x", "_m", "_sd"))


def share_of_abs(df: DataFrame, out: str, x, by="date", split: bool = False) -> DataFrame:
    """De-meaned value over the date's sum of sizes."""
    if not split:
        return df.withColumn(out, xs.share_of_abs(x, by))
    d = cut_lineage(demean(df, "_d", x, by, True))
    return _with_stats(d, _keys(by), _t=F.sum(F.abs("_d"))).withColumn(
        out, F.try_divide(F.col("_d"), F.col("_t"))).drop("_d", "_t")


def cut(df: DataFrame, out: str, x, bins: int, by="date", split: bool = False) -> DataFrame:
    """W14."""
    if not split:
        return df.withColumn(out, xs.cut(x, bins, by))
    d = _with_stats(cut_lineage(df.withColumn("_x", xs._c(x))), _keys(by), _lo=F.min("_x"), _hi=F.max("_x"))
    return d.withColumn(out, xs.bin_between("_x", F.col("_lo"), F.col("_hi"), bins)).drop("_x", "_lo", "_hi")


def rank_ordinal(df: DataFrame, out: str, x, by="date", tiebreak: str = "asset", ascending: bool = True,
                 split: bool = False) -> DataFrame:
    """W2."""
    if not split:
        return df.withColumn(out, xs.rank_ordinal(x, by, tiebreak, ascending))
    key = F.round(xs._c(x), xs.RANK_DIGITS)
    d = _positions(df.withColumn("_k", key if ascending else -key), _keys(by), tiebreak)
    return d.withColumn(out, F.col("_pos").cast("double")).drop("_k", "_pos")


def _positions(df: DataFrame, by: list[str], tiebreak: str) -> DataFrame:
    """``df`` and, as ``_pos``, the place of each row's ``_k`` on its date
    (ties by ``tiebreak``; null without a value)."""
    null = F.col("_k").isNull()
    d = cut_lineage(df.withColumns({
        "_b": F.when(null, F.lit(None).cast("long")).otherwise(order_bucket(F.col("_k"))),
        "_a": F.when(null, F.pmod(F.xxhash64(tiebreak), F.lit(SPREAD)))
               .when(F.col("_k") == 0, order_bucket(F.col(tiebreak).cast("double"))).otherwise(F.lit(0).cast("long"))}))
    at = [*by, "_b", "_a"]
    n = d.where("_k IS NOT NULL").groupBy(*at).agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(*by).orderBy("_b", "_a").rowsBetween(Window.unboundedPreceding, -1))
    n = n.select(*at, F.coalesce(before, F.lit(0)).alias("_off"))                     # buckets of a date
    own = F.row_number().over(Window.partitionBy(*at).orderBy("_k", tiebreak))
    return (d.withColumn("_own", own).join(n, at, "left")
            .withColumn("_pos", F.when(F.col("_k").isNotNull(), F.col("_own") + F.col("_off")))
            .drop("_b", "_a", "_own", "_off"))


def top_n_flag(df: DataFrame, out: str, x, n: int, by="date", tiebreak: str = "asset", split: bool = False) -> DataFrame:
    """W16."""
    if not split:
        return df.withColumn(out, xs.top_n_flag(x, n, by, tiebreak))
    return rank_ordinal(df, "_r", x, by, tiebreak, False, True).withColumn(
        out, F.coalesce(F.col("_r") <= n, F.lit(False))).drop("_r")


def rank_average(df: DataFrame, out: str, x, by="date", split: bool = False) -> DataFrame:
    """W3."""
    if not split:
        return df.withColumn(out, xs.rank_average(x, by))
    return ranking.average_rank(cut_lineage(df.withColumn("_x", xs._c(x))), _keys(by), "_x", out).drop("_x")


def qcut(df: DataFrame, out: str, x, q: int, by="date", tiebreak: str = "asset", split: bool = False) -> DataFrame:
    """The rows at the edges' places give the edges, interpolated as
    ``percentile`` does."""
    if not split:
        return df.withColumn(out, xs.qcut(x, q, by))
    by = _keys(by)
    d = cut_lineage(_positions(df.withColumn("_k", xs._c(x)), by, tiebreak))
    place = [(F.col("_n") - 1) * F.lit(i / q) for i in range(1, q)]                     # from 0
    n = d.where("_k IS NOT NULL").groupBy(*by).agg(F.count(F.lit(1)).alias("_n")).select(
        *by, F.array(*place).alias("_h"))
    need = F.exists("_h", lambda h: (F.floor(h) == F.col("_pos") - 1) | (F.ceil(h) == F.col("_pos") - 1))
    at = (d.where("_k IS NOT NULL").join(F.broadcast(n), by).where(need)               # at most two rows an edge
          .groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct(F.col("_pos") - 1, "_k"))).alias("_at")))

    def edge(h):
        lo, hi = F.floor(h), F.ceil(h)
        low, high = (F.try_element_at(F.col("_at"), p.cast("long")) for p in (lo, hi))
        return F.when(lo == hi, low).otherwise((hi - h) * low + (h - lo) * high)

    e = n.join(at, by).select(*by, F.transform("_h", edge).alias("_e"))
    above = F.aggregate("_e", F.lit(0), lambda acc, v: acc + F.when(F.col("_k") > v, 1).otherwise(0))
    return d.join(F.broadcast(e), by, "left").withColumn(
        out, F.when(F.col("_k").isNotNull(), (above + 1).cast("int"))).drop("_k", "_pos", "_e")
