"""Prediction metrics L1-L7, L18: set-based aggregations over scored tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import ranking, reshape


def _safe(n: Column, d: Column) -> Column:
    return F.coalesce(F.try_divide(n.cast("double"), d.cast("double")), F.lit(0.0))


def direction_accuracy(df: DataFrame, y_true: str, y_pred: str, by: Sequence[str] = (),
                       w_fp: float = 2.0, w_fn: float = 2.0, more: Mapping[str, Column] | None = None) -> DataFrame:
    """L1: global, upwards, downwards and weighted direction accuracy.

    Up means > 0; a missing value is 'not up' (M6); undefined ratios are 0.
    ``more`` names further aggregates of the same pass."""
    up_t = F.coalesce(F.col(y_true) > 0, F.lit(False))
    up_p = F.coalesce(F.col(y_pred) > 0, F.lit(False))
    c = df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"),
                            F.count_if(up_t & up_p).alias("tp"),
                            F.count_if(~up_t & ~up_p).alias("tn"),
                            F.count_if(~up_t & up_p).alias("fp"),
                            F.count_if(up_t & ~up_p).alias("fn"),
                            *(a.alias(name) for name, a in (more or {}).items()))
    tp, tn, fp, fn, n = (F.col(x) for x in ("tp", "tn", "fp", "fn", "n"))
    return c.withColumns({
        "acc_global": _safe(tp + tn, n),
        "acc_up": _safe(tp, tp + fn),
        "acc_down": _safe(tn, tn + fp),
        "acc_weighted": _safe(tp + tn, tp + tn + fp * w_fp + fn * w_fn)})


def accuracy_by_feature(df: DataFrame, y_true: str, features: Sequence[str],
                        key: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """L2 / L3: L1 for every feature column (optionally per year/date)."""
    long = reshape.to_long(df, [*key, y_true, *by], features, dropna=False)
    return direction_accuracy(long, y_true, "value", ["feature", *by])


def roc_auc(df: DataFrame, score: str, label: str, by: Sequence[str] = ()) -> DataFrame:
    """ROC-AUC by the rank-sum (Mann-Whitney) formula with global,
    tie-averaged ranks."""
    r = ranking.average_rank(df.filter(F.col(score).isNotNull() & F.col(label).isNotNull()),
                             by, score, "rk")
    pos = F.col(label) == 1
    s = r.groupBy(*by).agg(F.sum(F.when(pos, F.col("rk"))).alias("rpos"),
                           F.count_if(pos).alias("npos"), F.count_if(~pos).alias("nneg"))
    return s.withColumn("auc", F.try_divide(
        F.col("rpos") - F.col("npos") * (F.col("npos") + 1) / 2.0,
        (F.col("npos") * F.col("nneg")).cast("double")))


def predict_and_score(scored: DataFrame, y: str, pred: str, split: str = "split", kind: str = "reg") -> DataFrame:
    """L4: mean prediction, score and hit rate by target side per split.

    ``reg``: the score is the MSE (``mse``) and a hit is the right sign;
    ``clf``: the score is the accuracy, a hit is the right class, and the sides
    are class 1 and the others."""
    if kind == "reg":
        side = F.col(y) > 0
        hit, score = ((F.col(pred) > 0) == side), F.avg((F.col(pred) - F.col(y)) ** 2).alias("mse")
    elif kind == "clf":
        side, hit = F.col(y) == 1, F.col(pred) == F.col(y)
        score = F.avg(hit.cast("double")).alias("accuracy")
    else:
        raise ValueError(f"unknown kind {kind!r}")
    hit = hit.cast("double")
    return scored.groupBy(split).agg(
        F.avg(pred).alias("pmean"), score, F.avg(F.when(side, hit)).alias("acc_target_pos"),
        F.avg(F.when(~side, hit)).alias("acc_target_neg"), F.avg(hit).alias("acc"))
