"""Metric jobs L1-L7, L18, A4-A9 over the scored weekly factor table."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import stats

from ..operators import ranking, reshape
from ..plans import factors as fx
from ..plans import features as ft
from ..plans import metrics as mt
from ..registry import register
from . import sqlkit as q
from .common import WEEKLY, nn, pw, r8
from .q_factors import sql_factor_panel

FEATS = ["momentum", "mean_reversion", "overnight_sentiment"]


def _scored(spark, sf):
    return fx.factor_panel(pw(spark, sf), FEATS, WEEKLY, fwd_periods=(1,))


S_SQL = sql_factor_panel(FEATS, fwd_periods=(1,))
LONG_SQL = S_SQL + """,
lf AS (SELECT date, asset, fwd_1, 'momentum' AS feature, momentum AS value FROM fp
       UNION ALL SELECT date, asset, fwd_1, 'mean_reversion', mean_reversion FROM fp
       UNION ALL SELECT date, asset, fwd_1, 'overnight_sentiment', overnight_sentiment FROM fp)"""


def _acc_sql(src, by):
    g = f"{by}, " if by else ""
    gb = f"GROUP BY {by}" if by else ""
    return f"""
, c AS (SELECT {g}count(*) AS n,
  CAST(count_if(coalesce(fwd_1 > 0, false) AND coalesce(value > 0, false)) AS BIGINT) AS tp,
  CAST(count_if(NOT coalesce(fwd_1 > 0, false) AND NOT coalesce(value > 0, false)) AS BIGINT) AS tn,
  CAST(count_if(NOT coalesce(fwd_1 > 0, false) AND coalesce(value > 0, false)) AS BIGINT) AS fp,
  CAST(count_if(coalesce(fwd_1 > 0, false) AND NOT coalesce(value > 0, false)) AS BIGINT) AS fn FROM {src} {gb})
SELECT {g}n, tp, tn, fp, fn, round(coalesce((tp + tn) / NULLIF(n, 0), 0), 8) AS acc_global,
  round(coalesce(tp / NULLIF(tp + fn, 0), 0), 8) AS acc_up, round(coalesce(tn / NULLIF(tn + fp, 0), 0), 8) AS acc_down,
  round(coalesce((tp + tn) / NULLIF(tp + tn + fp * 2.0 + fn * 2.0, 0), 0), 8) AS acc_weighted FROM c"""


def _acc():
    return ["n", "tp", "tn", "fp", "fn", r8("acc_global"), r8("acc_up"), r8("acc_down"),
            r8("acc_weighted")]


@register("direction_accuracy", S_SQL + ",\nm AS (SELECT fwd_1, momentum AS value FROM fp)" + _acc_sql("m", ""))
def direction_accuracy(spark, sf):
    """L1: direction accuracy of momentum for the next-session return."""
    return mt.direction_accuracy(_scored(spark, sf), "fwd_1", "momentum").select(*_acc())


@register("accuracy_by_feature", LONG_SQL + _acc_sql("lf", "feature"))
def accuracy_by_feature(spark, sf):
    """L2: L1 for every feature column."""
    a = mt.accuracy_by_feature(_scored(spark, sf), "fwd_1", FEATS, ["date", "asset"])
    return a.select("feature", *_acc())


@register("accuracy_by_year", LONG_SQL.replace("lf AS (SELECT date,", "lf0 AS (SELECT date,") +
          ",\nlf AS (SELECT *, CAST(year(date) AS INTEGER) AS year FROM lf0)" + _acc_sql("lf", "feature, year"))
def accuracy_by_year(spark, sf):
    """L3: L1 per feature and calendar year."""
    d = _scored(spark, sf).withColumn("year", F.year("date"))
    a = mt.accuracy_by_feature(d, "fwd_1", FEATS, ["date", "asset"], by=["year"])
    return a.select("feature", "year", *_acc())


@register("spearman_rank", LONG_SQL + f""",
v AS (SELECT * FROM lf WHERE fwd_1 IS NOT NULL AND value IS NOT NULL),
r AS (SELECT *, {q.rank_avg('value', 'feature')} AS rx, {q.rank_avg('fwd_1', 'feature')} AS ry FROM v)
SELECT feature, round({q.nan_null('corr(rx, ry)')}, 8) AS spearman FROM r GROUP BY feature""")
def spearman_rank(spark, sf):
    """Spearman correlation of each feature with the forward return
    over the whole sample (global, hot-value-safe ranks)."""
    s = reshape.spearman_to_target(_scored(spark, sf), "fwd_1", FEATS, ["date", "asset"])
    return s.select("feature", r8(nn(F.col("spearman")), "spearman"))


@register("mutual_information", LONG_SQL + """,
v AS (SELECT *, CAST(fwd_1 > 0 AS INTEGER) AS label FROM lf WHERE fwd_1 IS NOT NULL AND value IS NOT NULL),
rg AS (SELECT feature, min(value) AS lo, max(value) AS hi FROM v GROUP BY feature),
b AS (SELECT v.feature, label, CASE WHEN hi = lo THEN 0 ELSE least(9, floor(round(10 * (value - lo) / (hi - lo), 9))) END AS xb
      FROM v JOIN rg USING (feature)),
mi_a AS (SELECT feature, xb, label, count(*) AS nxy FROM b GROUP BY ALL),
mi_b AS (SELECT *, sum(nxy) OVER (PARTITION BY feature) AS n, sum(nxy) OVER (PARTITION BY feature, xb) AS nx,
       sum(nxy) OVER (PARTITION BY feature, label) AS ny FROM mi_a)
SELECT feature, round(sum((nxy / n) * ln(nxy * n / (nx * ny))), 8) AS mutual_info FROM mi_b GROUP BY feature""")
def mutual_information(spark, sf):
    """Discrete mutual information of each feature (10 equal-width bins)
    with the up/down label of the next-session return."""
    d = _scored(spark, sf).filter(F.col("fwd_1").isNotNull()) \
        .withColumn("label", (F.col("fwd_1") > 0).cast("int"))
    m = reshape.mutual_information(d, "label", FEATS, ["date", "asset"])
    return m.select("feature", r8("mutual_info"))


@register("describe_by_group", S_SQL + """
SELECT sector_code, count(fwd_1) AS count, round(avg(fwd_1), 8) AS mean, round(stddev_samp(fwd_1), 8) AS std,
  round(min(fwd_1), 8) AS min, round(quantile_cont(round(fwd_1, 10), 0.25), 8) AS p25,
  round(quantile_cont(round(fwd_1, 10), 0.5), 8) AS p50, round(quantile_cont(round(fwd_1, 10), 0.75), 8) AS p75,
  round(max(fwd_1), 8) AS max FROM fp GROUP BY sector_code""")
def describe_by_group(spark, sf):
    """A4: describe() of the forward return per sector (exact quartiles)."""
    d = reshape.describe(_scored(spark, sf), "fwd_1", ["sector_code"])
    return d.select("sector_code", "count", *[r8(c) for c in ("mean", "std", "min", "p25", "p50", "p75", "max")])


@register("median_by_group", S_SQL + """
SELECT sector_code, round(quantile_cont(round(momentum, 10), 0.5), 8) AS median FROM fp
WHERE momentum IS NOT NULL GROUP BY sector_code""")
def median_by_group(spark, sf):
    """Exact median of the factor per sector."""
    m = ranking.exact_quantiles(_scored(spark, sf), ["sector_code"], "momentum", [0.5])
    return m.select("sector_code", r8("q", "median"))


@register("corr_matrix", S_SQL + """
SELECT a, b, round(CASE WHEN isnan(c) THEN NULL ELSE c END, 8) AS corr FROM (
  SELECT 'momentum' AS a, 'mean_reversion' AS b, corr(momentum, mean_reversion) AS c FROM fp
  UNION ALL SELECT 'momentum', 'overnight_sentiment', corr(momentum, overnight_sentiment) FROM fp
  UNION ALL SELECT 'mean_reversion', 'overnight_sentiment', corr(mean_reversion, overnight_sentiment) FROM fp)""")
def corr_matrix(spark, sf):
    """Pearson correlation of every factor pair in one aggregation."""
    return reshape.pearson_pairs(_scored(spark, sf), FEATS).select("a", "b", r8("corr"))


@register("corr_by_split", S_SQL + """,
lab AS (SELECT date, CASE WHEN session_idx < floor(count(*) OVER () * 0.6) THEN 'train'
  WHEN session_idx < floor(count(*) OVER () * 0.8) THEN 'valid' ELSE 'test' END AS split
  FROM (SELECT DISTINCT date, dense_rank() OVER (ORDER BY date) - 1 AS session_idx FROM fp))
SELECT split, round(CASE WHEN isnan(corr(momentum, fwd_1)) THEN NULL ELSE corr(momentum, fwd_1) END, 8) AS corr FROM fp JOIN lab USING (date) GROUP BY split""")
def corr_by_split(spark, sf):
    """Correlation of factor and forward return per date split."""
    s = ft.split_by_fraction(_scored(spark, sf))
    return s.groupBy("split").agg(r8(stats.corr("momentum", "fwd_1"), "corr"))


@register("roc_auc", S_SQL + f""",
v AS (SELECT sector_code, momentum AS s, CAST(fwd_1 > 0 AS INTEGER) AS y FROM fp
      WHERE momentum IS NOT NULL AND fwd_1 IS NOT NULL),
r AS (SELECT *, rank() OVER (PARTITION BY sector_code ORDER BY round(s, 10))
        + (count(*) OVER (PARTITION BY sector_code, round(s, 10)) - 1) / 2.0 AS rk FROM v)
SELECT sector_code, round((sum(CASE WHEN y = 1 THEN rk END) - count_if(y = 1) * (count_if(y = 1) + 1) / 2.0)
  / (count_if(y = 1) * count_if(y = 0)), 8) AS auc FROM r GROUP BY sector_code""")
def roc_auc(spark, sf):
    """ROC-AUC of momentum as a score for an up move, per sector."""
    d = _scored(spark, sf).withColumn("y", (F.col("fwd_1") > 0).cast("int")) \
        .filter(F.col("fwd_1").isNotNull())
    a = mt.roc_auc(d, "momentum", "y", ["sector_code"])
    return a.select("sector_code", r8("auc"))


@register("predict_and_score", S_SQL + """,
lab AS (SELECT date, CASE WHEN session_idx < floor(count(*) OVER () * 0.6) THEN 'train'
  WHEN session_idx < floor(count(*) OVER () * 0.8) THEN 'valid' ELSE 'test' END AS split
  FROM (SELECT DISTINCT date, dense_rank() OVER (ORDER BY date) - 1 AS session_idx FROM fp)),
s AS (SELECT split, momentum / 100.0 AS pred, fwd_1 AS y, CAST((momentum > 0) = (fwd_1 > 0) AS DOUBLE) AS hit
      FROM fp JOIN lab USING (date) WHERE momentum IS NOT NULL AND fwd_1 IS NOT NULL)
SELECT split, round(avg(pred), 8) AS pmean, round(avg((pred - y) ^ 2), 8) AS mse,
  round(avg(CASE WHEN y > 0 THEN hit END), 8) AS acc_target_pos, round(avg(CASE WHEN NOT y > 0 THEN hit END), 8)
  AS acc_target_neg, round(avg(hit), 8) AS acc FROM s GROUP BY split""")
def predict_and_score(spark, sf):
    """L4: prediction mean, MSE and hit rates by target sign per split
    (prediction = momentum / 100)."""
    s = ft.split_by_fraction(_scored(spark, sf)).filter(
        F.col("momentum").isNotNull() & F.col("fwd_1").isNotNull()) \
        .withColumn("pred", F.col("momentum") / 100.0)
    r = mt.predict_and_score(s, "fwd_1", "pred")
    return r.select("split", *[r8(c) for c in ("pmean", "mse", "acc_target_pos", "acc_target_neg", "acc")])


@register("predict_and_score_classes", S_SQL + """,
lab AS (SELECT date, CASE WHEN session_idx < floor(count(*) OVER () * 0.6) THEN 'train'
  WHEN session_idx < floor(count(*) OVER () * 0.8) THEN 'valid' ELSE 'test' END AS split
  FROM (SELECT DISTINCT date, dense_rank() OVER (ORDER BY date) - 1 AS session_idx FROM fp)),
s AS (SELECT split, CAST(momentum > 0 AS INTEGER) AS pred, CAST(fwd_1 > 0 AS INTEGER) AS y
      FROM fp JOIN lab USING (date) WHERE momentum IS NOT NULL AND fwd_1 IS NOT NULL)
SELECT split, round(avg(pred), 8) AS pmean, round(avg(CAST(pred = y AS DOUBLE)), 8) AS accuracy,
  round(avg(CAST(pred = y AS DOUBLE)) FILTER (y = 1), 8) AS acc_target_pos,
  round(avg(CAST(pred = y AS DOUBLE)) FILTER (y = 0), 8) AS acc_target_neg, round(avg(CAST(pred = y AS DOUBLE)), 8) AS acc
FROM s GROUP BY split""")
def predict_and_score_classes(spark, sf):
    """L4 (classes): mean predicted class, accuracy and hit rates by class per
    split (class = the factor's sign)."""
    s = ft.split_by_fraction(_scored(spark, sf)).filter(
        F.col("momentum").isNotNull() & F.col("fwd_1").isNotNull()).withColumns({
            "pred": (F.col("momentum") > 0).cast("int"), "y": (F.col("fwd_1") > 0).cast("int")})
    r = mt.predict_and_score(s, "y", "pred", kind="clf")
    return r.select("split", *[r8(c) for c in ("pmean", "accuracy", "acc_target_pos", "acc_target_neg", "acc")])
