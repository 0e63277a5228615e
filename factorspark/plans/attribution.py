"""PnL attribution Q12, Q14, Q15: per-date cross-sectional regression of the
delayed asset returns on the exposures (alphas and risk betas).

One aggregation per date sums the K (K + 1) / 2 products of the exposures, kept
as columns of one row per (date, asset), and their K products with the return;
a row of sums is solved on its own (``mapInPandas``, K x K numbers a row).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SOLVE_SCHEMA = "date date, factor string, f double"


def wide_exposures(expo: DataFrame, factors: list[str]) -> DataFrame:
    """(date, asset, x0, x1, ...): a missing exposure is 0."""
    return expo.groupBy("date", "asset").agg(*[
        F.coalesce(F.sum(F.when(F.col("factor") == f, F.col("x"))), F.lit(0.0)).alias(f"x{i}")
        for i, f in enumerate(factors)])


def factor_regression(expo: DataFrame, rets: DataFrame, factors: list[str]) -> DataFrame:
    """Q12: factor returns f_t = pinv(X'X) X'r per date, X = exposures
    (date, asset, factor, x) and r = the delayed return (date, asset, r);
    assets without a return count 0."""
    k = len(factors)
    x = wide_exposures(expo, factors).join(rets, ["date", "asset"], "left")
    sums = x.groupBy("date").agg(
        *[F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"g{i}_{j}") for i in range(k) for j in range(i, k)],
        *[F.coalesce(F.sum(F.col(f"x{i}") * F.col("r")), F.lit(0.0)).alias(f"b{i}") for i in range(k)])

    def solve(batches):
        for pdf in batches:
            out = []
            for _, r in pdf.iterrows():
                g = np.array([[r[f"g{min(i, j)}_{max(i, j)}"] for j in range(k)] for i in range(k)])
                f = np.linalg.pinv(g) @ np.array([r[f"b{i}"] for i in range(k)])   # rank-deficient dates like pinv OLS
                out += [(r["date"], n, float(v)) for n, v in zip(factors, f)]
            yield pd.DataFrame(out, columns=["date", "factor", "f"])

    return sums.mapInPandas(solve, SOLVE_SCHEMA)


def factor_pnl(w: DataFrame, expo: DataFrame, f: DataFrame) -> DataFrame:
    """Q14: PnL of each exposure (E * f) per portfolio and date, with its
    running total."""
    ex = (w.join(expo, ["date", "asset"]).groupBy("port_name", "date", "factor")
          .agg(F.sum(F.col("w") * F.col("x")).alias("exposure")))
    fp = ex.join(f, ["date", "factor"]).withColumn("pnl", F.col("exposure") * F.col("f"))
    run = Window.partitionBy("port_name", "factor").orderBy("date") \
        .rowsBetween(Window.unboundedPreceding, 0)       # one row per date
    return fp.withColumn("cum_pnl", F.sum("pnl").over(run))


def attribution(w: DataFrame, rets: DataFrame, fp: DataFrame, component: dict[str, str]) -> DataFrame:
    """Q15: the factors' PnL grouped into components (e.g. alpha / beta), the
    idiosyncratic rest (total - factor PnL) and running totals."""
    comp = F.create_map(*[x for k, v in component.items() for x in (F.lit(k), F.lit(v))])
    by_c = fp.groupBy("port_name", "date", comp[F.col("factor")].alias("component")).agg(
        F.sum("pnl").alias("pnl"))
    tot = (w.join(rets, ["date", "asset"], "left").groupBy("port_name", "date")
           .agg(F.coalesce(F.sum(F.col("w") * F.col("r")), F.lit(0.0)).alias("total")))
    fac = by_c.groupBy("port_name", "date").agg(F.sum("pnl").alias("fac"))
    idio = tot.join(fac, ["port_name", "date"], "left").select(
        "port_name", "date", F.lit("idiosyncratic").alias("component"),
        (F.col("total") - F.coalesce("fac", F.lit(0.0))).alias("pnl"))
    out = by_c.unionByName(idio)
    run = Window.partitionBy("port_name", "component").orderBy("date") \
        .rowsBetween(Window.unboundedPreceding, 0)       # one row per date
    return out.withColumn("cum_pnl", F.sum("pnl").over(run))
