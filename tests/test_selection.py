"""Ridge grids, select-k, ensembles and cross-validation against plain numpy."""

import datetime as dt
import json
import time

import numpy as np
import pytest
from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassifier
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from factorspark.plans import crossval as cv
from factorspark.plans import ensemble as en
from factorspark.plans import metrics, ridge, selectk
from factorspark.plans.models import assemble

F3 = ["a", "b", "c"]


@pytest.fixture(scope="module")
def table(spark):
    """22 dates of 30 assets with three features; a few rows are incomplete."""
    r = np.random.default_rng(1)
    rows = []
    for d in range(22):
        for a in range(30):
            x = r.normal(size=3)
            y = 0.5 * x[0] - 0.2 * x[1] + 0.1 * x[0] * x[2] + r.normal(scale=0.5)
            rows.append((dt.date(2020, 1, 1) + dt.timedelta(days=7 * d), a, *map(float, x), float(y)))
    rows[5] = (*rows[5][:2], None, *rows[5][3:])
    rows[50] = (*rows[50][:5], None)
    return spark.createDataFrame(rows, "date date, asset long, a double, b double, c double, y double").repartition(5), rows


def pieces(rows, k):
    """Rows of each piece, as the folds of expanding windows cut the dates."""
    whole = [r for r in rows if None not in r]
    days = sorted({r[0] for r in whole})
    n, size = len(days), len(days) // (k + 1)
    first = n - k * size
    at = {d: 0 if i < first else (i - first) // size + 1 for i, d in enumerate(days)}
    return [np.array([r[2:] for r in whole if at[r[0]] == s]) for s in range(k + 1)]


def plain_ridge(x, y, alpha):
    return np.linalg.solve(x.T @ x + alpha * np.eye(x.shape[1]), x.T @ y)


@pytest.mark.parametrize("k", [1, 3, 4])
def test_ridge_grid_against_refits(table, k):
    df, rows = table
    sets = {"one": ["b"], "two": ["c", "a"], "three": F3}
    grid = ridge.ridge_grid(df, sets, "y", {"one": [1.0], "two": [0.1, 5.0], "three": [0.5, 100.0]}, k)
    cut = pieces(rows, k)
    assert len(grid.rows) == 5 * k
    for r in grid.rows:
        at = ["abc".index(f) for f in sets[r["feature_set"]]]
        train, test = np.concatenate(cut[:r["fold"] + 1]), cut[r["fold"] + 1]
        beta = plain_ridge(train[:, at], train[:, 3], r["alpha"])
        p, y = test[:, at] @ beta, test[:, 3]
        assert np.isclose(r["rmse"], np.sqrt(np.mean((p - y) ** 2)))
        assert np.isclose(r["train_rmse"], np.sqrt(np.mean((train[:, at] @ beta - train[:, 3]) ** 2)))
        up, said = y > 0, p > 0
        tp, tn, fp, fn = (up & said).sum(), (~up & ~said).sum(), (~up & said).sum(), (up & ~said).sum()
        assert np.isclose(r["acc_global"], (tp + tn) / len(y)) and np.isclose(r["acc_up"], tp / (tp + fn))
        assert np.isclose(r["acc_down"], tn / (tn + fp)) and np.isclose(r["acc_weighted"], (tp + tn) / (tp + tn + 2 * fp + fn))
    whole = np.concatenate(cut)
    assert np.allclose(list(grid.coefficients("two", 5.0).values()), plain_ridge(whole[:, [2, 0]], whole[:, 3], 5.0))
    name, alpha = grid.best("rmse")
    assert name == "three" and alpha == 0.5 and grid.mean(name, alpha)["rmse"] <= grid.mean("one", 1.0)["rmse"]
    s = {(r.feature_set, r.alpha): r for r in grid.summary().collect()}
    assert sorted(r["rank"] for (f, _), r in s.items() if f == "two") in ([1, 2], [1, 1])


def test_ridge_without_penalty_and_with_equal_columns(spark, table):
    df, rows = table
    d = df.withColumn("a2", F.col("a"))
    grid = ridge.ridge_grid(d, {"x": ["a", "a2"]}, "y", [0.0], 2)
    b = grid.coefficients("x", 0.0)
    whole = np.concatenate(pieces(rows, 2))
    assert np.isclose(b["a"], b["a2"]) and np.isclose(b["a"] + b["a2"], plain_ridge(whole[:, [0]], whole[:, 3], 0.0)[0])


def test_ridge_grid_of_nothing(table):
    df, _ = table
    assert ridge.ridge_grid(df.limit(0), {"x": ["a"]}, "y", [1.0]).rows == []
    two = df.where("date < '2020-01-10'")                                   # two dates, three folds: no test dates
    assert ridge.ridge_grid(two, {"x": ["a"]}, "y", [1.0]).frame().count() == 0


def test_folds_are_those_of_time_folds(table):
    from factorspark.plans.features import time_folds
    df, _ = table
    seg = {r.date: r[ridge.SEG] for r in ridge.with_segments(df.select("date").distinct(), 3).collect()}
    for r in time_folds(df, 3).collect():
        assert seg[r.date] <= r.fold if r.role == "train" else seg[r.date] == r.fold + 1


def test_mutual_information_by_hand():
    counts = np.array([[[5, 0], [0, 5]], [[3, 3], [2, 2]]], float)
    assert np.allclose(selectk.mutual_info(counts), [np.log(2), 0])
    assert np.allclose(selectk.mutual_info(np.zeros((1, 3, 2))), 0)


def test_selector(spark, table, tmp):
    df, rows = table
    d = df.dropna().withColumn("label", (F.col("a") * F.col("c") > 0).cast("int"))
    fitted = selectk.InteractionSelector(inputCols=F3, k=2, bins=8).fit(d)
    assert fitted.selected()[0] == "a_x_c" and len(fitted.scores) == 6
    x = np.array([r[2:5] for r in rows if None not in r])
    for name in ("a", "b_x_c"):
        v = x[:, 0] if name == "a" else x[:, 1] * x[:, 2]
        y = x[:, 0] * x[:, 2] > 0
        b = np.minimum(7, np.floor(np.round(8 * (v - v.min()) / (v.max() - v.min()), 9))).astype(int)
        n = np.zeros((1, 8, 2))
        np.add.at(n, (0, b, y.astype(int)), 1)
        assert np.isclose(fitted.scores[name], selectk.mutual_info(n)[0])
    fitted.write().overwrite().save(f"{tmp}/sel")
    again = selectk.InteractionModel.load(f"{tmp}/sel")
    assert again.selected() == fitted.selected()
    assert again.transform(d).columns == fitted.transform(d).columns == [*d.columns, *(
        c for c in fitted.selected() if selectk.CROSS in c)]


def test_select_k_chooses_in_each_fold(table):
    df, rows = table
    grid, chosen = selectk.select_k_ridge(df, F3, "y", [1, 2], [1.0], 3)
    cut = pieces(rows, 3)
    cols = {"a": lambda z: z[:, 0], "b": lambda z: z[:, 1], "c": lambda z: z[:, 2], "a_x_b": lambda z: z[:, 0] * z[:, 1],
            "a_x_c": lambda z: z[:, 0] * z[:, 2], "b_x_c": lambda z: z[:, 1] * z[:, 2]}
    for r in grid.rows:
        own = chosen[int(r["feature_set"][2:]), r["fold"]]
        train, test = np.concatenate(cut[:r["fold"] + 1]), cut[r["fold"] + 1]
        x, z = (np.stack([cols[c](t) for c in own], 1) for t in (train, test))
        assert np.isclose(r["rmse"], np.sqrt(np.mean((z @ plain_ridge(x, train[:, 3], 1.0) - test[:, 3]) ** 2)))
    assert chosen[1, None] == ["a"]


# --- ensembles


@pytest.fixture(scope="module")
def classes(table):
    df, _ = table
    d = df.dropna().withColumn("label", (F.col("a") - F.col("b") > 0).cast("double"))
    return assemble(d, F3).select("date", "asset", "features", "label", "y")


def test_bags_are_weights_drawn_from_keys(classes):
    b = en.BaggingClassifier(maxSamples=0.6, seed=3)
    n = classes.count()
    bags = [{(r.date, r.asset): r._weight for r in b.bag(d, k).select("date", "asset", "_weight").collect()}
            for k, d in ((0, classes), (0, classes.repartition(7)), (1, classes))]
    assert bags[0] == bags[1] != bags[2]                                     # a retry elsewhere draws the same bag
    for bag in (bags[0], bags[2]):
        assert abs(sum(bag.values()) / n - 0.6) < 0.12 and set(bag.values()) <= set(map(float, range(1, 9)))
        assert abs(len(bag) / n - (1 - np.exp(-0.6))) < 0.09


def test_poisson_weights_have_their_distribution(spark):
    n = 200_000
    got = spark.range(n).select(en.poisson_weight(["id"], 2, 1.5, 9).alias("w")).groupBy("w").count().collect()
    from math import exp, factorial
    for r in got:
        p = exp(-1.5) * 1.5 ** r.w / factorial(int(r.w))
        assert abs(r["count"] / n - p) < 5 * np.sqrt(p / n) + 1e-4
    assert spark.range(1000).where(en.poisson_weight(["id"], 0, 0.0, 1) > 0).count() == 0


def test_bagging_learns_and_persists(classes, tmp):
    m = en.BaggingClassifier(numBags=7, maxSamples=0.7, maxFeatures=0.6, maxDepth=5, seed=5).fit(classes)
    out = m.transform(classes)
    acc = out.agg(F.avg((F.col("prediction") == F.col("label")).cast("double"))).first()[0]
    assert acc > 0.8 and out.columns == [*classes.columns, "probability", "prediction"]
    used = [{f for f in range(3) if t.featureImportances[f] > 0} for t in m.trees]
    assert all(u <= set(en.feature_subset(3, 0.6, k, 5)) for k, u in enumerate(used))
    assert len({tuple(en.feature_subset(3, 0.6, k, 5)) for k in range(7)}) > 1
    again = en.BaggingClassifier(numBags=7, maxSamples=0.7, maxFeatures=0.6, maxDepth=5, seed=5).fit(classes.repartition(3))
    key = lambda d: sorted((r.date, r.asset, r.prediction) for r in d.select("date", "asset", "prediction").collect())
    assert key(again.transform(classes)) == key(out)
    m.write().overwrite().save(f"{tmp}/bag")
    loaded = en.BaggingModel.load(f"{tmp}/bag")
    assert key(loaded.transform(classes)) == key(out) and loaded.uid == m.uid


def test_mean_probability_by_hand(classes):
    m = en.BaggingClassifier(numBags=3, maxDepth=2, seed=1).fit(classes)
    rows = m.transform(classes).limit(40).collect()
    for r in rows:
        p = np.mean([t.predictProbability(r.features).toArray() for t in m.trees], axis=0)
        assert np.allclose(r.probability.toArray(), p) and r.prediction == float(np.argmax(p))


def voters(classes, voting, tmp):
    base = LinearRegression(labelCol="y") if voting == "mean" else DecisionTreeClassifier(maxDepth=3, seed=1)
    m = en.NoOverlapVoter(estimator=base, voting=voting, nSkipSamples=2).fit(classes)
    m.write().overwrite().save(f"{tmp}/v")
    return m, en.NoOverlapVoterModel.load(f"{tmp}/v")


@pytest.mark.parametrize("voting", ["soft", "hard", "mean"])
def test_voters_by_hand(classes, voting, tmp):
    m, loaded = voters(classes, voting, tmp)
    assert len(m.models) == 3
    key = lambda d: sorted((r.date, r.asset, round(r.prediction, 12)) for r in d.collect())
    out = m.transform(classes)
    assert key(loaded.transform(classes)) == key(out)
    assert out.columns == [*classes.columns, *(["probability"] if voting == "soft" else []), "prediction"]
    for r in out.limit(60).collect():
        each = [x.predict(r.features) for x in m.models]
        if voting == "mean":
            want = np.mean(each)
        elif voting == "hard":
            want = max(sorted(set(each)), key=each.count)
        else:
            want = float(np.argmax(np.mean([x.predictProbability(r.features).toArray() for x in m.models], axis=0)))
        assert np.isclose(r.prediction, want)


def test_hard_ties_go_to_the_smallest_class(spark):
    class Fixed:
        def __init__(self, v):
            self.v = v

        def hasParam(self, n):
            return n == "predictionCol"

        def getParam(self, n):
            return n

        def copy(self, own):
            self.out = own["predictionCol"]
            return self

        def transform(self, d):
            return d.withColumn(self.out, F.lit(float(self.v)))

    for votes, want in (([2, 1, 2, 1], 1.0), ([0, 1, 1], 1.0), ([3, 0], 0.0), ([5], 5.0)):
        m = en.NoOverlapVoterModel([Fixed(v) for v in votes])
        m.set(m.voting, "hard")
        assert m.transform(spark.range(1)).first().prediction == want


def test_samples_do_not_overlap(classes):
    s = en.NoOverlapVoter(estimator=None, nSkipSamples=4).samples(classes)
    days = sorted({r.date for r in classes.select("date").distinct().collect()})
    got = [sorted({r.date for r in x.select("date").distinct().collect()}) for x in s]
    assert got == [days[k::5] for k in range(5)]
    few = en.NoOverlapVoter(estimator=None, nSkipSamples=40).samples(classes)
    assert len(few) == len(days)


def test_grid_figures(classes):
    train, valid = classes.where("asset % 3 > 0"), classes.where("asset % 3 = 0")
    models, t = en.train_valid_grid(lambda **x: RandomForestClassifier(numTrees=5, seed=2, **x), {"maxDepth": [1, 4]}, train, valid)
    rows = {(json.loads(r.params)["maxDepth"], r.split): r for r in t.collect()}
    assert len(rows) == 4
    for depth, m in zip((1, 4), models):
        p = m.transform(valid).select("label", "prediction").toPandas()
        r = rows[depth, "valid"]
        assert np.isclose(r.score, (p.label == p.prediction).mean()) and np.isclose(r.pmean, p.prediction.mean())
        assert np.isclose(r.acc_target_pos, (p.prediction[p.label == 1] == 1).mean())
        assert np.isclose(r.acc_target_neg, (p.prediction[p.label == 0] == 0).mean())
    assert rows[4, "train"].score > rows[1, "train"].score


class _Watched(en.BaggingClassifier):
    """Counts the fits that run at once."""

    now, most = [], [0]

    def _fit(self, df):
        self.now.append(1)
        self.most[0] = max(self.most[0], len(self.now))
        time.sleep(0.3)
        self.now.pop()
        return RandomForestClassifier(numTrees=1, maxDepth=1, seed=2).fit(df)


def test_fits_of_a_grid_do_not_overlap(classes):
    """Fits beside each other on one table failed at times (not serializable)."""
    _Watched.most[0] = 0
    en.train_valid_grid(lambda **x: _Watched(**x), {"maxDepth": [1, 2, 3]}, classes, classes)
    assert _Watched.most[0] == 1


def test_fits_of_folds_do_not_overlap(classes):
    _Watched.most[0] = 0
    cv.DateFoldCrossValidator(estimator=_Watched(), numFolds=2, evaluator=cv.DirectionEvaluator()).fit(classes)
    assert _Watched.most[0] == 1


def test_unknown_kind(classes):
    with pytest.raises(ValueError):
        metrics.predict_and_score(classes, "y", "y", "label", kind="rank")
    with pytest.raises(ValueError):
        en.NoOverlapVoter(estimator=None, voting="loud")


# --- cross-validation


def test_evaluator(spark):
    d = spark.createDataFrame([(1.0, 2.0), (1.0, -1.0), (-1.0, -1.0), (-1.0, 1.0), (0.0, -2.0), (None, 1.0)], "label double, prediction double")
    e = cv.DirectionEvaluator(metricName="acc_weighted", wFp=3.0, wFn=1.0)
    s = e.scores(d)
    assert s["acc_global"] == 3 / 5 and s["acc_up"] == 1 / 2 and s["acc_down"] == 2 / 3
    assert s["acc_weighted"] == e.evaluate(d) == 3 / (3 + 3 + 1) and np.isclose(s["rmse"], np.sqrt((1 + 4 + 0 + 4 + 4) / 5))
    assert e.isLargerBetter() and not cv.DirectionEvaluator(metricName="rmse").isLargerBetter()
    with pytest.raises(ValueError):
        cv.DirectionEvaluator(metricName="auc")


def test_date_fold_cross_validator(table, classes):
    from pyspark.ml.tuning import ParamGridBuilder
    _, rows = table
    own = LinearRegression(labelCol="y", fitIntercept=False, standardization=False, solver="normal")
    grid = ParamGridBuilder().addGrid(own.regParam, [0.0, 50.0]).build()
    m = cv.DateFoldCrossValidator(estimator=own, estimatorParamMaps=grid, numFolds=3,
                                  evaluator=cv.DirectionEvaluator(labelCol="y", metricName="rmse")).fit(classes)
    cut = pieces(rows, 3)
    for r in (r for r in m.rows if r["params"] == 0):
        train, test = np.concatenate(cut[:r["fold"] + 1]), cut[r["fold"] + 1]
        p = test[:, :3] @ plain_ridge(train[:, :3], train[:, 3], 0.0)
        assert np.isclose(r["rmse"], np.sqrt(np.mean((p - test[:, 3]) ** 2)), atol=1e-6)
        assert np.isclose(r["acc_global"], np.mean((p > 0) == (test[:, 3] > 0)))
    assert m.best == 0 and len(m.rows) == 6
    whole = np.concatenate(cut)
    assert np.allclose(m.bestModel.coefficients.toArray(), plain_ridge(whole[:, :3], whole[:, 3], 0.0), atol=1e-6)   # refitted
    f = m.frame(classes.sparkSession, "lin")
    assert f.count() == 6 * 5 and f.where("best").select("params").distinct().first()[0] == "regParam=0.0"


def test_champion_is_best_in_its_weaker_figure(spark):
    x = lambda v: {"acc_weighted": v, "acc_global": v, "acc_up": v, "acc_down": v}
    c, v = {"m": x(.9), "n": x(.6), "o": x(.5)}, {"m": x(.3), "n": x(.55), "o": x(.99)}
    assert cv.champion(c, v) == "n"
    p = cv.champion_panel(spark, c, v).collect()
    assert len(p) == 6 and {r.model for r in p if r.champion} == {"n"}
    s = {(r.feature, r.fit): r.share for r in cv.coefficient_shares(spark, {"t": {"a": 1.0, "b": 3.0}, "u": {"a": 0.0}}).collect()}
    assert s == {("a", "t"): .25, ("b", "t"): .75, ("a", "u"): None}
