"""Risk-model jobs R1-R12, Q2, Q3 with two given betas (volume z-score and
close/open ratio per asset) so DuckDB can check them, plus PCA jobs."""

from __future__ import annotations


from pyspark.sql import functions as F

from ..operators import xs
from ..plans import portfolio as pf
from ..plans import risk as rk
from ..registry import register
from ..session import cut_lineage
from .common import r8
from .q_portfolio import BETA_SQL, BOOK_SQL, Book

ANN = 52.0


def given_betas(p):
    """Two fixed betas per asset: mean volume z-score (k=0) and mean
    close/open - 1 (k=1)."""
    vz = p.repartition("date").select("asset", xs.zscore("volume").alias("z"),
                                      F.try_divide("close", "open").alias("co"))
    g = vz.groupBy("asset").agg(F.avg("z").alias("b0"), (F.avg("co") - 1).alias("b1"))
    return g.select("asset", F.explode(F.array(
        F.struct(F.lit(0).alias("k"), F.col("b0").alias("beta")),
        F.struct(F.lit(1).alias("k"), F.col("b1").alias("beta")))).alias("s")).select("asset", "s.k", "s.beta")


class RiskModel:
    def __init__(self, spark, sf):
        self.b = Book(spark, sf)
        # the model is read by several small aggregations: materialise its
        # inputs (returns, N x K betas) and the T x K factor returns once
        self.betas = cut_lineage(given_betas(self.b.p))
        cal = self.b.cal
        self.rets = cut_lineage(self.b.rets.join(cal, "session_idx").filter(F.col("r").isNotNull())
                                .select("date", "asset", "r"))
        self.f = cut_lineage(rk.static_factor_returns(self.rets, self.betas))

    def fvar(self):
        return rk.factor_var(self.f, ANN)

    def ivar(self):
        return rk.idio_var(self.rets, self.betas, self.f, ANN)


RISK_SQL = BOOK_SQL + BETA_SQL + """,
bw AS (SELECT asset, max(CASE WHEN k = 0 THEN beta END) AS b0, max(CASE WHEN k = 1 THEN beta END) AS b1
       FROM betas GROUP BY asset),
g AS (SELECT sum(b0 * b0) AS g00, sum(b0 * b1) AS g01, sum(b1 * b1) AS g11 FROM bw),
pm AS (SELECT asset, (g11 * b0 - g01 * b1) / (g00 * g11 - g01 * g01) AS p0,
              (g00 * b1 - g01 * b0) / (g00 * g11 - g01 * g01) AS p1 FROM bw, g),
rr AS (SELECT c.date, r.asset, r.r FROM rets r JOIN cal c USING (session_idx) WHERE r.r IS NOT NULL),
fw AS (SELECT date, sum(p0 * r) AS f0, sum(p1 * r) AS f1 FROM rr JOIN pm USING (asset) GROUP BY date),
fl AS (SELECT date, 0 AS k, f0 AS f FROM fw UNION ALL SELECT date, 1, f1 FROM fw),
grid AS (SELECT fw.date, bw.asset, coalesce(rr.r, 0) AS y, coalesce(rr.r, 0) - (f0 * b0 + f1 * b1) AS e
         FROM fw, bw LEFT JOIN rr ON rr.date = fw.date AND rr.asset = bw.asset),
fv AS (SELECT k, var_samp(f) * 52.0 AS var FROM fl GROUP BY k),
iv AS (SELECT asset, var_samp(e) * 52.0 AS var FROM grid GROUP BY asset),
ex AS (SELECT port_name, date, k, sum(beta * w) AS e FROM wts JOIN betas USING (asset) GROUP BY ALL),
risk AS (SELECT port_name, date, sqrt(coalesce(fr, 0) + coalesce(ir, 0)) AS risk FROM
         (SELECT port_name, date, sum(var * e * e) AS fr FROM ex JOIN fv USING (k) GROUP BY ALL) a FULL OUTER JOIN
         (SELECT port_name, date, sum(var * w * w) AS ir FROM wts JOIN iv USING (asset) GROUP BY ALL) b
         USING (port_name, date))"""


@register("static_factor_returns", RISK_SQL + "\nSELECT date, k, round(f, 6) AS f FROM fl")
def static_factor_returns(spark, sf):
    """Per-date regression (no intercept) of returns on the fixed betas."""
    return RiskModel(spark, sf).f.select("date", "k", r8("f", d=6))


@register("explained_variance", RISK_SQL + """
SELECT date, round(1 - var_pop(e) / NULLIF(var_pop(y), 0), 6) AS exp_var FROM grid GROUP BY date""")
def explained_variance(spark, sf):
    """Explained variance of each date's regression (all assets, missing
    returns as 0), computed from sums without the dates x assets grid."""
    m = RiskModel(spark, sf)
    return rk.explained_variance(m.rets, m.betas, m.f).select("date", r8("exp_var", d=6))


@register("factor_var", RISK_SQL + "\nSELECT k, round(var, 4) AS var FROM fv")
def factor_var(spark, sf):
    """Annualised variance of each factor return (diagonal covariance)."""
    return RiskModel(spark, sf).fvar().select("k", r8("var", d=4))


@register("idio_var", RISK_SQL + "\nSELECT asset, round(var, 4) AS var FROM iv")
def idio_var(spark, sf):
    """Annualised specific variance per asset (checked against the dense
    residual grid in SQL)."""
    return RiskModel(spark, sf).ivar().select("asset", r8("var", d=4))


@register("portfolio_risk", RISK_SQL + "\nSELECT port_name, date, round(risk, 6) AS risk FROM risk")
def portfolio_risk(spark, sf):
    """Predicted risk sqrt(w'(B F B' + S) w) of every portfolio and date."""
    m = RiskModel(spark, sf)
    r = rk.portfolio_risk(m.b.w, m.betas, m.fvar(), m.ivar())
    return r.select("port_name", "date", r8("risk", d=6))


@register("equal_weight_risk", RISK_SQL + """,
eq AS (SELECT asset, 1.0 / count(*) OVER () AS w FROM bw),
eex AS (SELECT k, sum(beta * w) AS e FROM eq JOIN betas USING (asset) GROUP BY k)
SELECT round(sqrt((SELECT sum(var * e * e) FROM eex JOIN fv USING (k)) +
                  (SELECT sum(var * w * w) FROM eq JOIN iv USING (asset))), 6) AS risk""")
def equal_weight_risk(spark, sf):
    """R11 + R10: predicted risk of the equal-weight portfolio."""
    m = RiskModel(spark, sf)
    w = rk.equal_weights(m.betas).withColumn("port_name", F.lit("eq"))
    r = rk.portfolio_risk(w, m.betas, m.fvar(), m.ivar(), keys=("port_name",))
    return r.select(r8("risk", d=6))


@register("constraint_audit", RISK_SQL + """,
per AS (SELECT port_name, date, max(w) AS w_max, min(w) AS w_min, sum(abs(w)) AS gross, sum(w) AS net FROM wts GROUP BY ALL),
au AS (SELECT port_name, date, 'weight_max' AS check_name, w_max AS value, 0.55 AS bound, w_max <= 0.55 + 1e-9 AS ok FROM per
  UNION ALL SELECT port_name, date, 'weight_min', w_min, -0.55, w_min >= -0.55 - 1e-9 FROM per
  UNION ALL SELECT port_name, date, 'gross_le_1', gross, 1.0, gross <= 1.0 + 1e-9 FROM per
  UNION ALL SELECT port_name, date, 'net_zero', net, 0.0, abs(net) <= 1e-6 FROM per
  UNION ALL SELECT port_name, date, 'factor_exposure', max(abs(e)), 10.0, max(abs(e)) <= 10.0 FROM ex GROUP BY ALL
  UNION ALL SELECT port_name, date, 'risk', risk * risk, 0.05 * 0.05, risk * risk <= 0.05 * 0.05 FROM risk)
SELECT port_name, date, check_name, round(value, 6) AS value, round(bound, 6) AS bound, ok FROM au""")
def constraint_audit(spark, sf):
    """Q2: the optimiser's constraints audited on the weight tables."""
    m = RiskModel(spark, sf)
    ex = pf.factor_exposure(m.b.w, m.betas)
    risk = rk.portfolio_risk(m.b.w, m.betas, m.fvar(), m.ivar())
    a = pf.constraint_audit(m.b.w, ex, risk)
    return a.select("port_name", "date", "check_name", r8("value", d=6), r8("bound", d=6), "ok")


@register("risk_tables", RISK_SQL + """
SELECT 'factor_var' AS table_name, CAST(k AS BIGINT) AS key, round(var, 6) AS value FROM fv
UNION ALL SELECT 'idio_var', CAST(asset AS BIGINT), round(var, 6) FROM iv
UNION ALL SELECT 'beta_' || CAST(k AS VARCHAR), CAST(asset AS BIGINT), round(beta, 6) FROM betas""")
def risk_tables(spark, sf):
    """The risk model's tables written to the shared folder, partitioned
    by table, and read back."""
    import uuid
    from ..session import checkpoint_dir
    from ..sources.sinks import write_table
    m = RiskModel(spark, sf)
    t = m.fvar().select(F.lit("factor_var").alias("table_name"), F.col("k").cast("long").alias("key"), F.col("var").alias("value"))
    t = t.unionByName(m.ivar().select(F.lit("idio_var").alias("table_name"), F.col("asset").cast("long").alias("key"),
                                      F.col("var").alias("value")))
    t = t.unionByName(m.betas.select(F.concat(F.lit("beta_"), F.col("k").cast("string")).alias("table_name"),
                                     F.col("asset").cast("long").alias("key"), F.col("beta").alias("value")))
    path = f"{checkpoint_dir(spark).rstrip('/')}/risk-{uuid.uuid4().hex}"
    write_table(t, path, ["table_name"])
    back = spark.read.schema("key long, value double, table_name string").parquet(path)
    return back.select("table_name", "key", r8("value", d=6))


# ------------------------------------------------------------------ PCA

COMPONENTS, GRID = 20, (3, 5, 10, 20, 50)


def _pca(spark, sf):
    m = RiskModel(spark, sf)
    return m, rk.DualPca(m.rets, COMPONENTS)


@register("pca_betas")
def pca_betas(spark, sf):
    """PCA loadings (20 components) of the weekly returns,
    sign-fixed, as (asset, k, beta)."""
    return _pca(spark, sf)[1].betas()


@register("pca_factor_returns")
def pca_factor_returns(spark, sf):
    """Factor returns = centred returns projected on the loadings."""
    m, pca = _pca(spark, sf)
    return rk.pca_factor_returns(m.rets, pca.betas())


@register("pca_variance_total", RISK_SQL + """,
v AS (SELECT date, asset, y - avg(y) OVER (PARTITION BY asset) AS c FROM grid),
n AS (SELECT count(DISTINCT date) AS t FROM grid)
SELECT round(sum(c * c) / (SELECT t - 1 FROM n), 6) AS total_variance, round(1.0, 6) AS norm FROM v""")
def pca_variance_total(spark, sf):
    """R2 checked in SQL: the components' variances add up to the returns'
    total variance, and the mean squared norm of the loadings is 1."""
    m, pca = _pca(spark, sf)
    norm = pca.betas().groupBy("k").agg(F.sum(F.col("beta") ** 2).alias("n"))
    return norm.agg(F.avg("n").alias("norm")).select(
        r8(F.lit(pca.total), "total_variance", 6), r8("norm", d=6))


@register("pca_top_loadings")
def pca_top_loadings(spark, sf):
    """Explained-variance ratio of each component and the 10 assets with
    its lowest loadings (top-k report)."""
    from pyspark.sql import Window
    m, pca = _pca(spark, sf)
    ev = spark.createDataFrame([(i, float(v / pca.total)) for i, v in enumerate(pca.variance)],
                               "k int, explained_variance_ratio double")
    low = pca.betas().withColumn("rank", F.row_number().over(Window.partitionBy("k").orderBy("beta", "asset")))
    return low.filter("rank <= 10").join(F.broadcast(ev), "k")


@register("pca_expvar_grid")
def pca_expvar_grid(spark, sf):
    """Variance explained by the first k components, k in (3, 5, 10, 20, 50),
    and its share of the total, on three expanding date folds."""
    from ..plans.features import time_folds
    m = RiskModel(spark, sf)
    folds = time_folds(m.rets, 3).filter("role = 'train'")
    rows = []
    for fold in range(3):
        own = m.rets.join(folds.filter(F.col("fold") == fold).select("date"), "date", "left_semi")
        pca = rk.DualPca(cut_lineage(own), max(GRID))
        for k in GRID:
            v = float(pca.variance[:k].sum())
            rows.append((fold, k, v, v / pca.total))
    return spark.createDataFrame(rows, "fold int, k int, cum_explained_variance double, share double")
