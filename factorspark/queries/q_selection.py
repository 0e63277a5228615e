"""Model selection jobs L8-L15: ridge grids over date folds, select-k on
interactions, bagged trees, voters, and the champion panel."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dates
from ..plans import crossval as cv
from ..plans import ensemble as en
from ..plans import factors as fx
from ..plans import features as ft
from ..plans import models as md
from ..plans import ridge as rg
from ..plans import selectk as sk
from ..registry import register
from ..session import cut_lineage
from .common import WEEKLY, pw, r8
from .q_factors import sql_factor_panel

FEATS = ["momentum", "mean_reversion"]
ALPHA = ["mean_reversion_smoothed", "momentum_smoothed", "overnight_smoothed"]
SECTORS = [f"sector_code_{i}" for i in range(5)]
DATES, WEEKDAYS = ["is_December", "qtr_end", "qtr_start"], [f"weekday_{i}" for i in range(5)]
QUARTERS = [f"qtr_{i}" for i in range(1, 5)]

#: The six feature sets of the reference's model comparison and
#: the powers of ten that each set's penalty takes.
SETS = {"alpha": ALPHA, "alpha_adv": [*ALPHA, "adv_rank"], "alpha_sector": [*ALPHA, *SECTORS],
        "alpha_dates": [*ALPHA, *DATES], "alpha_weekday": [*ALPHA, *WEEKDAYS], "alpha_quarter": [*ALPHA, *QUARTERS]}
POWERS = {"alpha": range(-4, 3), "alpha_adv": range(-1, 3), "alpha_sector": range(-1, 8), "alpha_dates": range(-1, 6),
          "alpha_weekday": range(-1, 8), "alpha_quarter": range(-1, 6)}
PENALTIES = {k: [10.0 ** x for x in p] for k, p in POWERS.items()}
FOLDS = 3


def written_panel(spark, sf, names, *more) -> DataFrame:
    """Complete rows of the named factors and the next return.  The panel is
    written first: a filter on its columns would make Catalyst carry the
    constraints of every window expression below it."""
    p = fx.factor_panel(pw(spark, sf), names, WEEKLY, fwd_periods=(1,))
    return cut_lineage(p.select("date", "asset", *more, *names, "fwd_1")).dropna()


def small_panel(spark, sf) -> DataFrame:
    """Complete rows of two factors and the next return."""
    return written_panel(spark, sf, FEATS)


def full_panel(spark, sf) -> DataFrame:
    """Three smoothed alphas, ADV rank, sector and calendar flags and the next
    return, with the split by date (T7); complete rows, written once."""
    p = written_panel(spark, sf, [*ALPHA, "adv_rank"], "sector_code")
    p = ft.split_by_fraction(p).withColumns(dates.one_hot("sector_code", range(5), "sector_code"))
    flags = dates.date_features("date")
    cols = list(dict.fromkeys(f for s in SETS.values() for f in s))
    return cut_lineage(p.withColumns({c: flags[c] for c in cols if c in flags}).select(
        "date", "asset", *cols, "fwd_1", "split"))


def of(panel: DataFrame, *splits: str) -> DataFrame:
    return panel.where(F.col("split").isin(*splits)).drop("split")


_SMALL = sql_factor_panel(FEATS, fwd_periods=(1,)) + """,
v AS (SELECT date, asset, momentum AS x1, mean_reversion AS x2, fwd_1 AS y FROM fp
      WHERE momentum IS NOT NULL AND mean_reversion IS NOT NULL AND fwd_1 IS NOT NULL),
dt AS (SELECT date, row_number() OVER (ORDER BY date) - 1 AS i, count(*) OVER () AS n FROM (SELECT DISTINCT date FROM v)),
sg AS (SELECT date, CASE WHEN i < n - 3 * (n // 4) THEN 0 ELSE (i - (n - 3 * (n // 4))) // (n // 4) + 1 END AS seg FROM dt),
w AS (SELECT v.*, seg FROM v JOIN sg USING (date)),
fo AS (SELECT unnest([0, 1, 2]) AS fold)"""

_ACC = """
  round((tp + tn) / (tp + tn + fp + fn), 8) AS acc_global, round(coalesce(tp / NULLIF(tp + fn, 0), 0), 8) AS acc_up,
  round(coalesce(tn / NULLIF(tn + fp, 0), 0), 8) AS acc_down,
  round((tp + tn) / (tp + tn + 2.0 * fp + 1.0 * fn), 8) AS acc_weighted"""


@register("ridge_grid_small", _SMALL + """,
al AS (SELECT unnest([0.1, 1.0, 10.0]) AS alpha),
s AS (SELECT fold, sum(x1 * x1) AS a, sum(x1 * x2) AS b, sum(x2 * x2) AS d, sum(x1 * y) AS c1, sum(x2 * y) AS c2
      FROM w JOIN fo ON seg <= fold GROUP BY fold),
m AS (SELECT 'one' AS feature_set, fold, alpha, c1 / (a + alpha) AS b1, CAST(0 AS DOUBLE) AS b2 FROM s, al
      UNION ALL SELECT 'two', fold, alpha, ((d + alpha) * c1 - b * c2) / ((a + alpha) * (d + alpha) - b * b),
        ((a + alpha) * c2 - b * c1) / ((a + alpha) * (d + alpha) - b * b) FROM s, al),
tr AS (SELECT feature_set, alpha, fold, sqrt(avg((b1 * x1 + b2 * x2 - y) ** 2)) AS train_rmse
       FROM m JOIN w ON seg <= fold GROUP BY ALL),
te AS (SELECT feature_set, alpha, fold, sqrt(avg((p - y) ** 2)) AS rmse,
         count_if(y > 0 AND p > 0) AS tp, count_if(NOT y > 0 AND NOT p > 0) AS tn,
         count_if(NOT y > 0 AND p > 0) AS fp, count_if(y > 0 AND NOT p > 0) AS fn
       FROM (SELECT feature_set, alpha, fold, y, b1 * x1 + b2 * x2 AS p FROM m JOIN w ON seg = fold + 1) GROUP BY ALL)
SELECT feature_set, CAST(alpha AS DOUBLE) AS alpha, CAST(fold AS INTEGER) AS fold, round(train_rmse, 8) AS train_rmse, round(rmse, 8) AS rmse,""" + _ACC + """
FROM te JOIN tr USING (feature_set, alpha, fold)""")
def ridge_grid_small(spark, sf):
    """Ridge on one and on two factors, three penalties, three date
    folds, from fold-additive Gram sums."""
    g = rg.ridge_grid(small_panel(spark, sf), {"one": FEATS[:1], "two": FEATS}, "fwd_1", [0.1, 1.0, 10.0], FOLDS)
    return g.frame().select("feature_set", "alpha", "fold", *(r8(c) for c in ("train_rmse", *rg.METRICS)))


@register("ridge_grid")
def ridge_grid(spark, sf):
    """The six feature sets, each with its own penalties."""
    return rg.ridge_grid(of(full_panel(spark, sf), "train"), SETS, "fwd_1", PENALTIES, FOLDS).frame()


@register("ridge_grid_summary")
def ridge_grid_summary(spark, sf):
    """Mean and deviation over the folds and rank by weighted accuracy of
    every penalty within its feature set."""
    return rg.ridge_grid(of(full_panel(spark, sf), "train"), SETS, "fwd_1", PENALTIES, FOLDS).summary()


_MI = _SMALL + """,
x AS (SELECT date, asset, seg, CAST(y > 0 AS INTEGER) AS up, unnest([
        {'feature': 'momentum', 'value': x1}, {'feature': 'mean_reversion', 'value': x2},
        {'feature': 'momentum_x_mean_reversion', 'value': x1 * x2}], recursive := true) FROM w),
rg AS (SELECT feature, min(value) AS lo, max(value) AS hi FROM x GROUP BY feature),
bn AS (SELECT x.*, greatest(0, least(9, CAST(floor(round(10 * (value - lo) / NULLIF(hi - lo, 0), 9)) AS INTEGER))) AS b
       FROM x JOIN rg USING (feature)),
up_to AS (SELECT unnest([0, 1, 2, 3]) AS fold),
ct AS (SELECT fold, feature, coalesce(b, 0) AS b, up, count(*) AS c FROM bn JOIN up_to ON seg <= fold GROUP BY ALL),
nn AS (SELECT *, sum(c) OVER (PARTITION BY fold, feature) AS n, sum(c) OVER (PARTITION BY fold, feature, b) AS nb,
         sum(c) OVER (PARTITION BY fold, feature, up) AS nu FROM ct),
mi AS (SELECT fold, feature, sum(c / n * ln(c * n / (nb * nu))) AS s FROM nn GROUP BY fold, feature)"""


@register("interaction_scores", _MI + """
SELECT CAST(fold AS INTEGER) AS fold, feature, round(s, 8) AS mutual_info,
  CAST(row_number() OVER (PARTITION BY fold ORDER BY round(s, 10) DESC, feature) AS INTEGER) AS place FROM mi""")
def interaction_scores(spark, sf):
    """Single features and products ranked by mutual information with the
    return's sign, on the training dates of each fold (3: all dates)."""
    import numpy as np
    p = sk.with_interactions(small_panel(spark, sf), FEATS).withColumn("up", (F.col("fwd_1") > 0).cast("int"))
    names = sk.interactions(FEATS)
    counts = sk.class_counts(rg.with_segments(p, FOLDS), names, "up", 10, rg.SEG, FOLDS + 1)
    rows = []
    for fold in range(FOLDS + 1):
        scores = sk.mutual_info(counts[..., :fold + 1].sum(-1))
        place = {f: i + 1 for i, f in enumerate(sk.order(names, scores))}
        rows += [(fold, f, float(s), place[f]) for f, s in zip(names, np.asarray(scores))]
    d = spark.createDataFrame(rows, "fold int, feature string, mutual_info double, place int")
    return d.select("fold", "feature", r8("mutual_info"), "place")


@register("select_k_ridge")
def select_k_ridge(spark, sf):
    """The best 3, 4 and 5 of all interactions of the three alphas and the
    ADV rank, chosen in each fold, and ridge on them."""
    grid, _ = sk.select_k_ridge(of(full_panel(spark, sf), "train"), [*ALPHA, "adv_rank"], "fwd_1", [3, 4, 5],
                                [0.1, 1.0, 10.0, 100.0], FOLDS)
    return grid.frame()


def labelled(panel: DataFrame, features: list[str]) -> DataFrame:
    """Feature vectors and the class of the next return."""
    return md.assemble(panel, features).withColumn("label", (F.col("fwd_1") > 0).cast("double")).select(
        "date", "asset", "features", "label", "fwd_1")


@register("bagging_grid")
def bagging_grid(spark, sf):
    """Bagged decision trees by share of the rows, share of the features
    and leaf size; figures of train and validation dates (L4, classes)."""
    p = full_panel(spark, sf)
    cols = SETS["alpha_adv"]
    build = lambda **x: en.BaggingClassifier(numBags=20, maxDepth=5, impurity="entropy", seed=42, **x)
    _, table = en.train_valid_grid(build, {"maxSamples": [0.25, 0.75], "maxFeatures": [0.5, 1.0], "minInstances": [10]},
                                   labelled(of(p, "train"), cols), labelled(of(p, "valid"), cols))
    return table


@register("forest_grid")
def forest_grid(spark, sf):
    """Random-forest classifier grid with figures of both splits."""
    from pyspark.ml.classification import RandomForestClassifier
    p = full_panel(spark, sf)
    cols = SETS["alpha_adv"]
    build = lambda **x: RandomForestClassifier(numTrees=50, impurity="entropy", seed=42, **x)
    _, table = en.train_valid_grid(build, {"maxDepth": [3, 5], "subsamplingRate": [0.5, 1.0], "minInstancesPerNode": [10]},
                                   labelled(of(p, "train"), cols), labelled(of(p, "valid"), cols))
    return table


@register("voting_grid")
def voting_grid(spark, sf):
    """Voters over non-overlapping samples: forests with soft and
    hard votes by depth, and the mean of ridge regressors by penalty."""
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.regression import LinearRegression
    p = full_panel(spark, sf)
    cols = SETS["alpha_adv"]
    train, valid = labelled(of(p, "train"), cols), labelled(of(p, "valid"), cols)

    def voter(voting, maxDepth):
        return en.NoOverlapVoter(estimator=RandomForestClassifier(numTrees=20, seed=42, maxDepth=maxDepth), voting=voting)

    def mean(regParam):
        own = LinearRegression(labelCol="fwd_1", fitIntercept=False, standardization=False, regParam=regParam)
        return en.NoOverlapVoter(estimator=own, voting="mean")

    _, classes = en.train_valid_grid(voter, {"voting": ["soft", "hard"], "maxDepth": [3, 5]}, train, valid)
    _, returns = en.train_valid_grid(mean, {"regParam": [0.0, 0.01]}, train, valid, "fwd_1", "reg")
    return classes.withColumn("kind", F.lit("clf")).unionByName(returns.withColumn("kind", F.lit("reg")))


def forest_cv(panel: DataFrame, features: list[str], trees: int = 200, seed: int = 42) -> cv.DateFoldModel:
    """The forest's grid of sample shares and depths over date folds."""
    from pyspark.ml.regression import RandomForestRegressor
    from pyspark.ml.tuning import ParamGridBuilder
    f = RandomForestRegressor(labelCol="fwd_1", featuresCol="features", numTrees=trees, seed=seed,
                              featureSubsetStrategy="all")
    grid = ParamGridBuilder().addGrid(f.subsamplingRate, [0.25, 0.5, 0.75]).addGrid(f.maxDepth, [3, 5]).build()
    return cv.DateFoldCrossValidator(estimator=f, estimatorParamMaps=grid, numFolds=FOLDS,
                                     evaluator=cv.DirectionEvaluator(labelCol="fwd_1")).fit(labelled(panel, features))


@register("date_fold_cv")
def date_fold_cv(spark, sf):
    """Linear models by penalty over expanding date folds: a row per
    parameter set, fold and scorer; the best is refitted on all dates."""
    from pyspark.ml.regression import LinearRegression
    from pyspark.ml.tuning import ParamGridBuilder
    own = LinearRegression(labelCol="fwd_1", fitIntercept=False, standardization=False)
    grid = ParamGridBuilder().addGrid(own.regParam, [0.0, 0.1, 1.0]).build()
    m = cv.DateFoldCrossValidator(estimator=own, estimatorParamMaps=grid, numFolds=FOLDS,
                                  evaluator=cv.DirectionEvaluator(labelCol="fwd_1")).fit(
        labelled(of(full_panel(spark, sf), "train"), ALPHA))
    return m.frame(spark, "linear")


class Champion:
    """Cross-validated ridge (best penalty of each feature set), the
    voter of ridges and a forest against the validation dates, and the champion
    among the ridges refitted on train and validation dates."""

    def __init__(self, spark, sf, others: bool = True):
        from pyspark.ml.regression import LinearRegression
        self.spark, self.panel = spark, full_panel(spark, sf)
        train, valid = of(self.panel, "train"), of(self.panel, "valid")
        self.grid = rg.ridge_grid(train, SETS, "fwd_1", PENALTIES, FOLDS)
        self.chosen = {s: self.grid.best("acc_weighted", s)[1] for s in SETS}
        self.score = cv.DirectionEvaluator(labelCol="fwd_1")
        self.cv = {f"ridge_{s}": self.grid.mean(s, a) for s, a in self.chosen.items()}
        self.valid = {f"ridge_{s}": self.linear(valid, self.grid.coefficients(s, a)) for s, a in self.chosen.items()}
        if not others:
            return
        cols, base = SETS["alpha"], LinearRegression(labelCol="fwd_1", fitIntercept=False, standardization=False)
        voter = en.NoOverlapVoter(estimator=base, voting="mean")
        voters = cv.DateFoldCrossValidator(estimator=voter, evaluator=self.score, numFolds=FOLDS).fit(labelled(train, cols))
        forest = forest_cv(train, cols)
        for name, m in (("voter", voters), ("forest", forest)):
            self.cv[name] = m.mean()
            self.valid[name] = self.score.scores(m.transform(labelled(valid, cols)))

    def linear(self, rows: DataFrame, coefs: dict[str, float]) -> dict[str, float]:
        """Scores of a linear model's predictions."""
        said = sum(F.col(f) * b for f, b in coefs.items())
        return self.score.scores(rows.select("fwd_1", said.alias("prediction")))

    def refit(self) -> tuple[str, dict, dict]:
        """The champion ridge, its coefficients on the training dates and on
        train and validation dates together."""
        only = {m: v for m, v in self.cv.items() if m.startswith("ridge_")}
        name = cv.champion(only, self.valid).removeprefix("ridge_")
        both = rg.ridge_grid(of(self.panel, "train", "valid"), {name: SETS[name]}, "fwd_1", [self.chosen[name]], 1)
        return name, self.grid.coefficients(name, self.chosen[name]), both.coefficients(name, self.chosen[name])


@register("champion_panel")
def champion_panel(spark, sf):
    """Means over the folds and validation figures of all models; the
    champion is best in the weaker of the two."""
    c = Champion(spark, sf)
    return cv.champion_panel(spark, c.cv, c.valid)


@register("champion_refit")
def champion_refit(spark, sf):
    """The champion ridge's coefficients and their shares on the
    training dates and refitted with the validation dates, and its accuracy on
    the test dates."""
    c = Champion(spark, sf, others=False)
    name, train, both = c.refit()
    t = c.linear(of(c.panel, "test"), both)
    d = cv.coefficient_shares(spark, {"train": train, "train_valid": both})
    return d.select(F.lit(name).alias("feature_set"), "*", *(F.lit(t[m]).alias(f"test_{m}") for m in rg.METRICS))
