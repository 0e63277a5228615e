"""Model jobs L8-L17, E9, X23, Q12-Q15.  Closed forms carry DuckDB oracles;
iterative Spark ML fits are rows-only."""

from __future__ import annotations


from pyspark.sql import functions as F

from ..plans import attribution as at
from ..plans import evaluate as ev
from ..plans import factors as fx
from ..plans import features as ft
from ..plans import models as md
from ..plans.text import bow as bw
from ..registry import register
from ..sources.tables import read
from .common import WEEKLY, nn, pw, r8
from .q_factors import sql_factor_panel
from .q_text import DOCS, LEX_CTE, SCORE_CTE, Corpus

FEATS = ["momentum", "mean_reversion"]


def _panel(spark, sf):
    return fx.factor_panel(pw(spark, sf), FEATS + ["overnight_sentiment"], WEEKLY, fwd_periods=(1,))


@register("ridge_gram", sql_factor_panel(FEATS, fwd_periods=(1,)) + """,
v AS (SELECT momentum AS x1, mean_reversion AS x2, fwd_1 AS y FROM fp
      WHERE momentum IS NOT NULL AND mean_reversion IS NOT NULL AND fwd_1 IS NOT NULL),
s AS (SELECT sum(x1 * x1) + 1.0 AS a, sum(x1 * x2) AS b, sum(x2 * x2) + 1.0 AS d, sum(x1 * y) AS c1,
             sum(x2 * y) AS c2 FROM v)
SELECT 'momentum' AS feature, round((d * c1 - b * c2) / (a * d - b * b), 8) AS coef FROM s
UNION ALL SELECT 'mean_reversion', round((a * c2 - b * c1) / (a * d - b * b), 8) FROM s""")
def ridge_gram(spark, sf):
    """Ridge (alpha 1, no intercept) of the next return on two
    factors from Gram sums; coefficient table."""
    c = md.ridge_gram(_panel(spark, sf), FEATS, "fwd_1", 1.0)
    return c.select("feature", r8("coef"))


@register("interaction_features", sql_factor_panel(FEATS + ["overnight_sentiment"]) + """
SELECT date, asset, round(momentum * mean_reversion, 8) AS momentum_x_mean_reversion,
  round(momentum * overnight_sentiment, 8) AS momentum_x_overnight_sentiment,
  round(mean_reversion * overnight_sentiment, 8) AS mean_reversion_x_overnight_sentiment FROM fp""")
def interaction_features(spark, sf):
    """Pairwise interaction features of the three alphas."""
    p = _panel(spark, sf)
    fs = FEATS + ["overnight_sentiment"]
    cols = [r8(F.col(a) * F.col(b), f"{a}_x_{b}") for i, a in enumerate(fs) for b in fs[i + 1:]]
    return p.select("date", "asset", *cols)


NB_SQL = "WITH " + DOCS + LEX_CTE + """,
lab AS (SELECT doc_id, quality AS label FROM labels),
lc AS (SELECT term, label, tf FROM ncnt JOIN lab USING (doc_id)),
grid AS (SELECT t.term, k.label FROM (SELECT DISTINCT term FROM lc) t, (VALUES (0), (1)) k(label)),
seen AS (SELECT term, label, sum(tf) AS n_tc FROM lc GROUP BY ALL),
tot AS (SELECT k.label, coalesce(sum(tf), 0) AS n_c FROM (VALUES (0), (1)) k(label) LEFT JOIN lc USING (label) GROUP BY k.label),
nb AS (SELECT g.label, g.term, ln((coalesce(n_tc, 0) + 1.0) / (n_c + (SELECT count(DISTINCT term) FROM lc))) AS lp
       FROM grid g LEFT JOIN seen USING (term, label) JOIN tot USING (label)),
prior AS (SELECT label, ln(count(*) / (SELECT count(*) FROM lab)) AS p FROM lab GROUP BY label),
odds AS (SELECT d.doc_id, coalesce(sum(c.tf * (b.lp - a.lp)), 0)
           + (SELECT p FROM prior WHERE label = 1) - (SELECT p FROM prior WHERE label = 0) AS o
         FROM docs d LEFT JOIN ncnt c ON c.doc_id = d.doc_id LEFT JOIN nb a ON a.term = c.term AND a.label = 0
         LEFT JOIN nb b ON b.term = c.term AND b.label = 1 GROUP BY d.doc_id),
prob AS (SELECT doc_id, 1 / (1 + exp(-greatest(least(o, 700), -700))) AS prob FROM odds)"""

#: X23 / D18 of one value per document: sector de-mean, rank, z-score a year.
ML_ALPHA_SQL = """,
my AS (SELECT d.doc_id, d.ticker, d.lang, d.date, CAST(date_trunc('year', d.date) AS DATE) AS year, prob FROM docs d JOIN prob USING (doc_id)),
mdm AS (SELECT *, prob - avg(prob) OVER (PARTITION BY year, lang) AS d FROM my),
mrk AS (SELECT *, rank() OVER (PARTITION BY year ORDER BY round(d, 10))
          + (count(*) OVER (PARTITION BY year, round(d, 10)) - 1) / 2.0 AS r FROM mdm),
mz AS (SELECT *, -(r - avg(r) OVER (PARTITION BY year)) / NULLIF(stddev_samp(r) OVER (PARTITION BY year), 0) AS alpha FROM mrk)"""


def _labels(spark, sf):
    return read(spark, sf, "labels", "doc_id", "quality").withColumnRenamed("quality", "label")


def ml_alpha(spark, sf, c):
    """Naive-Bayes quality probability of every filing as a yearly alpha."""
    labels = _labels(spark, sf)
    d = md.naive_bayes_probability(c.docs, c.bags, md.naive_bayes(c.bags, labels), md.class_priors(labels))
    d = d.withColumn("year", F.trunc("date", "year")).withColumn("sentiment", F.lit("ml"))
    return bw.sentiment_alpha(d, value="prob")


@register("naive_bayes_counts", NB_SQL + """
SELECT label, term, round(lp, 8) AS log_prob FROM nb""")
def naive_bayes_counts(spark, sf):
    """Multinomial naive Bayes (alpha 1) term log-probabilities of both
    quality labels, closed form, all terms of the labelled filings."""
    nb = md.naive_bayes(Corpus(spark, sf).bags, _labels(spark, sf))
    both = F.explode(F.array(*[F.struct(F.lit(k).alias("label"), F.col(f"log_{k}").alias("lp")) for k in (0, 1)]))
    return nb.select("term", both.alias("x")).select("x.label", "term", r8("x.lp", "log_prob"))


@register("naive_bayes_prior", """
SELECT quality AS label, round(ln(count(*) / sum(count(*)) OVER ()), 8) AS log_prior FROM labels GROUP BY quality""")
def naive_bayes_prior(spark, sf):
    """Class log-priors."""
    return md.class_priors(_labels(spark, sf)).select("label", r8("log_prior"))


@register("naive_bayes_probability", NB_SQL + """
SELECT doc_id, round(prob, 6) AS prob, round(2 * prob - 1, 6) AS score FROM prob""")
def naive_bayes_probability(spark, sf):
    """Quality probability of every filing and the same as a score
    from -1 to 1."""
    c = Corpus(spark, sf)
    labels = _labels(spark, sf)
    d = md.naive_bayes_probability(c.docs, c.bags, md.naive_bayes(c.bags, labels), md.class_priors(labels))
    return d.select("doc_id", r8("prob", d=6), r8(md.probability_score("prob"), "score", 6))


@register("forest_reg")
def forest_reg(spark, sf):
    """Random-forest regressor grid (200 trees, depth 3/5), validation RMSE
    and direction accuracy per parameter set."""
    from pyspark.ml.regression import RandomForestRegressor
    from ..plans import ensemble as en
    from .q_selection import FEATS as TWO, labelled, of, small_panel
    p = ft.split_by_fraction(small_panel(spark, sf))

    def build(maxDepth):
        return RandomForestRegressor(labelCol="fwd_1", numTrees=200, maxDepth=maxDepth, seed=0, featureSubsetStrategy="all")

    _, t = en.train_valid_grid(build, {"maxDepth": [3, 5]}, labelled(of(p, "train"), TWO), labelled(of(p, "valid"), TWO),
                               "fwd_1", "reg")
    return t.where("split = 'valid'").select(F.lit("forest").alias("model"), "params", F.sqrt("score").alias("rmse"), "acc")


@register("forest_cv")
def forest_cv(spark, sf):
    """The forest's grid of sample shares (0.25, 0.5, 0.75) and depths
    (3, 5) over expanding date folds: a row per fold and scorer."""
    from .q_selection import FEATS as TWO, forest_cv as fit, small_panel
    return fit(small_panel(spark, sf), TWO).frame(spark, "forest")


@register("ridge_cv")
def ridge_cv(spark, sf):
    """Ridge on two factors over three expanding date folds; mean
    metrics per penalty and the champion by RMSE."""
    from ..plans import ridge as rg
    from .q_selection import FEATS as TWO, small_panel
    g = rg.ridge_grid(small_panel(spark, sf), {"two": TWO}, "fwd_1", [0.0, 0.1, 1.0, 10.0])
    s = g.summary().withColumnsRenamed({"mean_rmse": "cv_rmse", "mean_acc_global": "cv_acc"}).drop("rank")
    return s.withColumn("champion", F.col("alpha") == g.best("rmse")[1])


@register("voting_ensemble")
def voting_ensemble(spark, sf):
    """Non-overlapping voter: one forest per offset of every 5th
    session, class probabilities averaged; validation accuracy per setting."""
    from pyspark.ml.classification import RandomForestClassifier
    from ..plans import ensemble as en
    from .q_selection import FEATS as TWO, labelled, of, small_panel
    p = ft.split_by_fraction(small_panel(spark, sf))

    def build(maxDepth):
        return en.NoOverlapVoter(estimator=RandomForestClassifier(numTrees=50, maxDepth=maxDepth, seed=0))

    t = en.train_valid_grid(build, {"maxDepth": [3, 5]}, labelled(of(p, "train"), TWO), labelled(of(p, "valid"), TWO))[1]
    depth = F.get_json_object("params", "$.maxDepth").cast("int")
    return t.where("split = 'valid'").select(depth.alias("max_depth"), F.col("score").alias("valid_acc"))


@register("logreg_grid")
def logreg_grid(spark, sf):
    """L1 and L2 logistic regression (no intercept) of the
    quality label on hashed tf-idf vectors over three expanding date folds;
    mean AUC and accuracy, and the share of terms that the model of all dates
    holds at 0."""
    from ..plans import crossval as cv
    from ..plans.text import classify as tc
    from ..session import cut_lineage
    from .q_textmodels import ITERATIONS, TEXT_WIDTH
    c = Corpus(spark, sf)
    lab = read(spark, sf, "labels", "doc_id", "quality").dropna().groupBy("doc_id").agg(F.max("quality").alias("quality"))
    bags = cut_lineage(c.bags.join(lab.select("doc_id"), "doc_id", "left_semi"))
    terms = cut_lineage(tc.term_table(bw.terms_of(bags), TEXT_WIDTH))
    data = tc.hashed_tfidf(bags, width=TEXT_WIDTH).join(lab, "doc_id").join(c.docs.select("doc_id", "date"), "doc_id").select(
        "doc_id", "date", "features", F.col("quality").cast("double").alias("label"))
    own = tc.PenalisedLogistic(maxIter=ITERATIONS)
    grid = [(penalty, weight) for penalty in ("l1", "l2") for weight in (0.01, 0.1, 1.0, 10.0, 100.0)]
    each = cv.DateFoldCrossValidator(estimator=own, estimatorParamMaps=[{own.penalty: p, own.C: w} for p, w in grid],
                                     evaluator=tc.ClassEvaluator(), numFolds=3).fit_each(data)
    out = []
    for (penalty, weight), m in zip(grid, each):
        zero = tc.share_zero(tc.coefficient_table(m.bestModel, terms)).first().share_zero
        out.append((penalty, weight, *(m.mean()[x] for x in ("auc", "accuracy")), float(zero)))
    return spark.createDataFrame(out, "penalty string, C double, cv_auc double, cv_accuracy double, share_zero double")


@register("ml_sentiment_alpha", NB_SQL + ML_ALPHA_SQL + """
SELECT doc_id, year, round(alpha, 8) AS alpha FROM mz""")
def ml_sentiment_alpha(spark, sf):
    """Naive-Bayes quality probability of every filing turned into a
    sector-neutral, ranked, z-scored alpha (D18) per year."""
    return ml_alpha(spark, sf, Corpus(spark, sf)).select("doc_id", "year", r8("alpha"))


_ML_SQL = sql_factor_panel(FEATS + ["overnight_sentiment"], fwd_periods=(1,)) + """,
v AS (SELECT momentum AS x1, mean_reversion AS x2, fwd_1 AS y FROM fp
      WHERE momentum IS NOT NULL AND mean_reversion IS NOT NULL AND fwd_1 IS NOT NULL),
s AS (SELECT sum(x1 * x1) + 1.0 AS a, sum(x1 * x2) AS b, sum(x2 * x2) + 1.0 AS d, sum(x1 * y) AS c1,
             sum(x2 * y) AS c2 FROM v),
beta AS (SELECT (d * c1 - b * c2) / (a * d - b * b) AS b1, (a * c2 - b * c1) / (a * d - b * b) AS b2 FROM s),
fd AS (SELECT date, asset, coalesce(momentum, 0) * b1 + coalesce(mean_reversion, 0) * b2 AS value, fwd_1 FROM fp, beta
       WHERE fwd_1 IS NOT NULL),
dm AS (SELECT *, value - avg(value) OVER (PARTITION BY date) AS dv FROM fd),
wt AS (SELECT *, dv / NULLIF(sum(abs(dv)) OVER (PARTITION BY date), 0) AS w FROM dm),
fr AS (SELECT date, sum(w * fwd_1) AS r FROM wt GROUP BY date),
rk AS (SELECT date, rank() OVER (PARTITION BY date ORDER BY round(value, 10))
         + (count(*) OVER (PARTITION BY date, round(value, 10)) - 1) / 2.0 AS rv,
       rank() OVER (PARTITION BY date ORDER BY round(fwd_1, 10))
         + (count(*) OVER (PARTITION BY date, round(fwd_1, 10)) - 1) / 2.0 AS rf FROM fd),
ic AS (SELECT date, CASE WHEN isnan(corr(rv, rf)) THEN NULL ELSE corr(rv, rf) END AS ic FROM rk GROUP BY date)"""


@register("ml_factor_eval", _ML_SQL + """
SELECT 'ml_factor' AS factor, round((SELECT avg(r) / NULLIF(stddev_samp(r), 0) * sqrt(52.0) FROM fr), 8) AS sharpe,
  round((SELECT avg(ic) FROM ic), 8) AS mean_ic""")
def ml_factor_eval(spark, sf):
    """Ridge predictions as an ML factor, evaluated like any factor:
    factor returns, annualised Sharpe and mean rank IC."""
    fd = _ml_factor(spark, sf)
    fr = ev.factor_returns(fd, 1)
    sh = ev.sharpe(fr, "factor_return", "factor", "weekly")
    ic = ev.rank_ic(fd, 1).groupBy("factor").agg(F.avg("ic").alias("mean_ic"))
    return sh.join(ic, "factor").select("factor", r8("sharpe"), r8("mean_ic"))


def _ml_factor(spark, sf):
    """The ridge's predictions as long factor data."""
    p = _panel(spark, sf)
    sc = md.score_linear(p, md.ridge_gram(p, FEATS, "fwd_1", 1.0), FEATS, "ml_factor")
    return ev.factor_data(ev.to_long(sc, ["ml_factor"], ["fwd_1"]), (1,), quantiles=5)


@register("ml_factor_series", _ML_SQL.replace("fd AS (SELECT date, asset,", "fd AS (SELECT date, asset, session_idx,") + """,
rt AS (SELECT date, session_idx, asset, rv FROM (SELECT fd.*, rank() OVER (PARTITION BY date ORDER BY round(value, 10))
         + (count(*) OVER (PARTITION BY date, round(value, 10)) - 1) / 2.0 AS rv FROM fd)),
ac AS (SELECT a.date, CASE WHEN isnan(corr(a.rv, b.rv)) THEN NULL ELSE corr(a.rv, b.rv) END AS autocorr
       FROM rt a JOIN rt b ON b.asset = a.asset AND b.session_idx = a.session_idx - 1 GROUP BY a.date)
SELECT date, round(r, 8) AS factor_return, round(ln(abs(product(1 + r) OVER (ORDER BY date))), 8) AS log_cum_return,
  product(1 + r) OVER (ORDER BY date) > 0 AS cum_positive, round(autocorr, 8) AS autocorr FROM fr LEFT JOIN ac USING (date)""")
def ml_factor_series(spark, sf):
    """E9 with E5 and E7: return, cumulative return (the logarithm of its size,
    and its sign) and rank autocorrelation of the ML factor by date."""
    fd = _ml_factor(spark, sf)
    fr = ev.cumulative(ev.factor_returns(fd, 1), "factor_return")
    return fr.join(ev.rank_autocorr(fd), ["factor", "date"], "left").select(
        "date", r8("factor_return"), r8(F.log(F.abs("cum_return")), "log_cum_return"),
        (F.col("cum_return") > 0).alias("cum_positive"), r8(nn(F.col("autocorr")), "autocorr"))


@register("ml_model_eval")
def ml_model_eval(spark, sf):
    """A forest trained on the training dates as a factor of the others:
    Sharpe, mean rank IC, mean rank autocorrelation and final cumulative
    return."""
    from pyspark.ml.regression import RandomForestRegressor
    from ..session import cut_lineage
    cols = [*FEATS, "overnight_sentiment"]
    p = cut_lineage(_panel(spark, sf).select("date", "asset", "session_idx", *cols, "fwd_1"))
    p = cut_lineage(ft.split_by_fraction(p.dropna(subset=[*cols, "fwd_1"])))
    d = md.assemble(p, cols)
    m = RandomForestRegressor(labelCol="fwd_1", numTrees=50, maxDepth=4, seed=1).fit(d.where("split = 'train'"))
    said = m.transform(d.where("split <> 'train'")).select("date", "asset", "session_idx", "fwd_1",
                                                          F.col("prediction").alias("forest"))
    fd = cut_lineage(ev.factor_data(ev.to_long(said, ["forest"], ["fwd_1"]), (1,), quantiles=5))
    fr = ev.cumulative(ev.factor_returns(fd, 1), "factor_return")
    total = fr.groupBy("factor").agg(F.max_by("cum_return", "date").alias("cum_return"))
    ic = ev.rank_ic(fd, 1).groupBy("factor").agg(F.avg("ic").alias("mean_ic"))
    ac = ev.rank_autocorr(fd).groupBy("factor").agg(F.avg("autocorr").alias("mean_autocorr"))
    return ev.sharpe(fr, "factor_return", "factor", "weekly").join(ic, "factor").join(ac, "factor").join(total, "factor")


@register("scored_table", _ML_SQL[:_ML_SQL.index(",\ndm AS")] + """,
pr AS (SELECT fp.*, coalesce(momentum, 0) * b1 + coalesce(mean_reversion, 0) * b2 AS ml FROM fp, beta),
cb AS (SELECT *, (coalesce(momentum, 0) + coalesce(mean_reversion, 0) + coalesce(overnight_sentiment, 0)) / NULLIF(
         CAST(momentum IS NOT NULL AS INTEGER) + CAST(mean_reversion IS NOT NULL AS INTEGER)
         + CAST(overnight_sentiment IS NOT NULL AS INTEGER), 0) AS combo FROM pr)
SELECT date, asset, round(momentum, 8) AS momentum, round(mean_reversion, 8) AS mean_reversion,
  round(overnight_sentiment, 8) AS overnight_sentiment, round(combo, 8) AS avg_combo, round(ml, 8) AS ml_factor,
  round(ml - avg(ml) OVER (PARTITION BY date, sector_code), 8) AS ml_factor_sector_neutral FROM cb""")
def scored_table(spark, sf):
    """The alphas, their mean, the ridge's prediction and its
    sector-neutral form in one table by date and asset."""
    p = _panel(spark, sf)
    p = fx.avg_combo(p, [*FEATS, "overnight_sentiment"])
    p = md.score_linear(p, md.ridge_gram(p, FEATS, "fwd_1", 1.0), FEATS, "ml_factor")
    p = fx.sector_neutral(p, "ml_factor")
    return p.select("date", "asset", *(r8(c) for c in (*FEATS, "overnight_sentiment", "avg_combo", "ml_factor",
                                                       "ml_factor_sector_neutral")))


FACTORS = ["alpha_momentum", "alpha_mean_reversion", "beta_0", "beta_1"]


class Attribution:
    """Exposures, delayed returns and factor returns of the two portfolios,
    over the sessions that have a following one."""

    def __init__(self, spark, sf, factors=tuple(FACTORS)):
        from .q_portfolio import Book
        from .q_risk import given_betas
        b = Book(spark, sf)
        ahead = b.cal.select((F.col("session_idx") - 1).alias("session_idx"))
        self.w = b.w.join(ahead, "session_idx", "left_semi")
        ex_b = self.w.select("date", "asset").distinct().join(given_betas(b.p), "asset").select(
            "date", "asset", F.concat(F.lit("beta_"), F.col("k").cast("string")).alias("factor"),
            F.col("beta").alias("x"))
        ex_a = b.alpha.join(ahead, "session_idx", "left_semi").select(
            "date", "asset", F.concat(F.lit("alpha_"), F.col("port_name")).alias("factor"),
            F.col("alpha").alias("x")).distinct()
        self.expo = ex_a.unionByName(ex_b).where(F.col("factor").isin(*factors))
        self.rets = (b.rets.withColumn("session_idx", F.col("session_idx") - 1).join(b.cal, "session_idx")
                     .select("date", "asset", "r").filter(F.col("r").isNotNull()))
        self.f = at.factor_regression(self.expo, self.rets, list(factors))
        self.pnl = at.factor_pnl(self.w, self.expo, self.f)


@register("pnl_attribution")
def pnl_attribution(spark, sf):
    """Q15: alpha / beta / idiosyncratic PnL and running totals per portfolio,
    from a regression of delayed returns on alpha and beta exposures."""
    a = Attribution(spark, sf)
    return at.attribution(a.w, a.rets, a.pnl, {f: f.split("_")[0] for f in FACTORS})


@register("pnl_by_factor")
def pnl_by_factor(spark, sf):
    """Q14: PnL of each factor exposure and its running total."""
    return Attribution(spark, sf).pnl.select("port_name", "date", "factor", "exposure", "pnl", "cum_pnl")


def _one_sql():
    from .q_portfolio import BOOK_SQL
    return BOOK_SQL + """,
x AS (SELECT session_idx, date, asset, alpha AS x FROM al WHERE port_name = 'momentum'
      AND session_idx + 1 IN (SELECT session_idx FROM cal)),
dr AS (SELECT session_idx - 1 AS session_idx, asset, r FROM rets WHERE r IS NOT NULL),
f1 AS (SELECT x.date, coalesce(coalesce(sum(x * r), 0) / NULLIF(sum(x * x), 0), 0) AS f FROM x LEFT JOIN dr USING (session_idx, asset)
       GROUP BY x.date),
wa AS (SELECT * FROM wts WHERE session_idx + 1 IN (SELECT session_idx FROM cal)),
ex1 AS (SELECT port_name, wa.date, sum(w * x) AS exposure FROM wa JOIN x ON x.session_idx = wa.session_idx AND x.asset = wa.asset GROUP BY ALL),
fp1 AS (SELECT port_name, date, exposure, f, exposure * f AS pnl FROM ex1 JOIN f1 USING (date)),
to1 AS (SELECT port_name, date, coalesce(sum(w * r), 0) AS total FROM wa LEFT JOIN dr USING (session_idx, asset) GROUP BY ALL)"""


@register("pnl_attribution_one", _one_sql() + """
SELECT port_name, date, round(exposure, 8) AS exposure, round(f, 8) AS f, round(pnl, 8) AS alpha_pnl,
  round(sum(pnl) OVER (PARTITION BY port_name ORDER BY date), 6) AS cum_alpha_pnl, round(total - pnl, 8) AS idio_pnl
FROM fp1 JOIN to1 USING (port_name, date)""")
def pnl_attribution_one(spark, sf):
    """Q12, Q14, Q15 with one exposure, where the regression is a ratio of two
    sums: factor return, PnL of the exposure and the rest."""
    a = Attribution(spark, sf, ("alpha_momentum",))
    rest = at.attribution(a.w, a.rets, a.pnl, {"alpha_momentum": "alpha"}).where("component = 'idiosyncratic'").select(
        "port_name", "date", F.col("pnl").alias("idio_pnl"))
    return a.pnl.join(rest, ["port_name", "date"]).select(
        "port_name", "date", r8("exposure"), r8("f"), r8("pnl", "alpha_pnl"), r8("cum_pnl", "cum_alpha_pnl", 6), r8("idio_pnl"))


@register("alpha_merge", NB_SQL + ML_ALPHA_SQL + SCORE_CTE + """,
sy AS (SELECT *, CAST(date_trunc('year', date) AS DATE) AS yr FROM scores WHERE sentiment = 'negative' AND score_scaled IS NOT NULL),
sd AS (SELECT *, score_scaled - avg(score_scaled) OVER (PARTITION BY yr, lang) AS dv FROM sy),
sr AS (SELECT *, rank() OVER (PARTITION BY yr ORDER BY round(dv, 10))
         + (count(*) OVER (PARTITION BY yr, round(dv, 10)) - 1) / 2.0 AS rr FROM sd),
sz AS (SELECT *, -(rr - avg(rr) OVER (PARTITION BY yr)) / NULLIF(stddev_samp(rr) OVER (PARTITION BY yr), 0) AS ra FROM sr),
j AS (SELECT sz.yr AS year, sz.ticker, sz.date, sz.doc_id, ra, mz.alpha AS ma,
        row_number() OVER (PARTITION BY sz.yr, sz.ticker ORDER BY sz.date DESC, sz.doc_id DESC) AS k
      FROM sz LEFT JOIN mz USING (doc_id))
SELECT year, ticker, doc_id, round(ra, 8) AS rule_alpha, round(ma, 8) AS ml_alpha FROM j WHERE k = 1""")
def alpha_merge(spark, sf):
    """Rule-based (negative list) and ML sentiment alphas of each filing
    joined, then one row per (year, ticker) - the latest filing - kept with
    ``max_by`` (no per-group sort)."""
    c = Corpus(spark, sf)
    s = c.scores().withColumn("year", F.trunc("date", "year"))
    rule = bw.sentiment_alpha(s.filter((F.col("sentiment") == "negative") & F.col("score_scaled").isNotNull())) \
        .select("doc_id", "ticker", "year", "date", F.col("alpha").alias("rule_alpha"))
    ml = ml_alpha(spark, sf, c).select("doc_id", F.col("alpha").alias("ml_alpha"))
    j = rule.join(ml, "doc_id", "left")
    return j.groupBy("year", "ticker").agg(
        F.max_by(F.struct("doc_id", "rule_alpha", "ml_alpha"), F.struct("date", "doc_id")).alias("x")) \
        .select("year", "ticker", "x.doc_id", r8("x.rule_alpha", "rule_alpha"), r8("x.ml_alpha", "ml_alpha"))
