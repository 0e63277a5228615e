"""Interaction features and the choice of the k that tell most of the
target's direction.

All F single features and F (F - 1) / 2 products are ranked in one pass: a row
becomes a bin number per feature, and only the counts of (feature, bin, class,
piece of the history) are aggregated, partial counts first.  Counts add over
the pieces, so the choice of every date fold comes from the same counts.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasLabelCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import ridge

CROSS = "_x_"


def interactions(features: Sequence[str]) -> list[str]:
    """Names of the single features and of all products, in order."""
    f = list(features)
    return [*f, *(f"{a}{CROSS}{b}" for i, a in enumerate(f) for b in f[i + 1:])]


def with_interactions(df: DataFrame, features: Sequence[str], names: Sequence[str] | None = None) -> DataFrame:
    """``df`` and the products among ``names`` (all of them by default)."""
    want = set(interactions(features) if names is None else names)
    f = list(features)
    return df.withColumns({f"{a}{CROSS}{b}": F.col(a) * F.col(b) for i, a in enumerate(f) for b in f[i + 1:]
                           if f"{a}{CROSS}{b}" in want})


def bin_of(value: Column, low: float, high: float, bins: int) -> Column:
    """Number of the equal-width bin between ``low`` and ``high``; values are
    taken to nine digits of a bin, so that noise moves none across an edge."""
    if not high > low:
        return F.lit(0)
    at = F.floor(F.round(F.lit(bins) * (value - F.lit(low)) / F.lit(high - low), 9))
    return F.greatest(F.lit(0), F.least(F.lit(bins - 1), at)).cast("int")


def class_counts(df: DataFrame, features: Sequence[str], label: str, bins: int = 10, segment: str | None = None,
                 segments: int = 1) -> np.ndarray:
    """Counts by (feature, bin, class 0 or 1, piece); rows with a missing
    feature or label take no part."""
    f = list(features)
    d = df.dropna(subset=[*f, label])
    r = d.agg(*(g(c).alias(f"{n}_{i}") for i, c in enumerate(f) for n, g in (("lo", F.min), ("hi", F.max)))).first()
    cells = F.explode(F.array(*[F.struct(F.lit(i).alias("feature"), (
        bin_of(F.col(c).cast("double"), r[f"lo_{i}"], r[f"hi_{i}"], bins) if r[f"lo_{i}"] is not None else F.lit(0)
    ).cast("int").alias("bin")) for i, c in enumerate(f)]))
    seg = F.col(segment) if segment else F.lit(0)
    got = (d.select(F.col(label).cast("int").alias("y"), seg.alias("s"), cells.alias("c"))
           .groupBy("c.feature", "c.bin", "y", "s").agg(F.count(F.lit(1)).alias("n")).toArrow())
    out = np.zeros((len(f), bins, 2, segments))
    at = [got.column(c).to_numpy() for c in ("feature", "bin", "y", "s")]
    out[tuple(at)] = got.column("n").to_numpy()
    return out


def mutual_info(counts: np.ndarray) -> np.ndarray:
    """Sum p ln(p / (px py)) of each feature's (bin, class) counts."""
    n = counts.sum((1, 2), keepdims=True)
    p = counts / np.maximum(n, 1)
    free = p.sum(2, keepdims=True) * p.sum(1, keepdims=True)
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(p > 0, p * np.log(p / free), 0.0).sum((1, 2))


def order(names: Sequence[str], scores: np.ndarray) -> list[str]:
    """Names by descending score at 10 digits, equal ones by name."""
    return [n for _, n in sorted((-round(float(s), 10), n) for n, s in zip(names, scores))]


class InteractionSelector(Estimator, HasInputCols, HasLabelCol, DefaultParamsReadable, DefaultParamsWritable):
    """Choose, among ``inputCols`` and their products, the ``k`` with the
    largest mutual information with the 0/1 label."""

    k = Param(Params._dummy(), "k", "features to keep", TypeConverters.toInt)
    bins = Param(Params._dummy(), "bins", "equal-width bins of a feature", TypeConverters.toInt)

    @keyword_only
    def __init__(self, **params):
        super().__init__()
        self._setDefault(labelCol="label", k=3, bins=10)
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> InteractionModel:
        names = interactions(self.getInputCols())
        counts = class_counts(with_interactions(df, self.getInputCols()), names, self.getLabelCol(),
                              self.getOrDefault(self.bins))
        scores = mutual_info(counts[..., 0])
        chosen = order(names, scores)[:self.getOrDefault(self.k)]
        model = InteractionModel(inputCols=self.getInputCols(), selectedCols=chosen)
        model.scores = dict(zip(names, map(float, scores)))
        return model


class InteractionModel(Model, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Adds the selected products; ``selectedCols`` names the chosen features."""

    selectedCols = Param(Params._dummy(), "selectedCols", "the chosen features", TypeConverters.toListString)
    scores: dict[str, float] = {}

    @keyword_only
    def __init__(self, **params):
        super().__init__()
        self._set(**self._input_kwargs)

    def selected(self) -> list[str]:
        return self.getOrDefault(self.selectedCols)

    def _transform(self, df: DataFrame) -> DataFrame:
        return with_interactions(df, self.getInputCols(), self.selected())


def select_k_ridge(df: DataFrame, features: Sequence[str], target: str, ks: Sequence[int], alphas: Sequence[float],
                   folds: int = 3, bins: int = 10, date: str = "date") -> tuple[ridge.RidgeGrid, dict]:
    """Interactions, the best k of them and ridge, over date folds: a fold
    chooses its features on its own training dates.  Returns the grid (sets are
    named ``k=3`` ...) and the chosen features by (k, fold; None: all dates)."""
    names = interactions(features)
    d = with_interactions(df.dropna(subset=[*features, target]), features)
    cut = ridge.with_segments(d, folds, date).withColumn("_up", (F.col(target) > 0).cast("int"))
    counts = class_counts(cut, names, "_up", bins, ridge.SEG, folds + 1)
    ranked = {f: order(names, mutual_info(counts[..., :(folds + 1 if f is None else f + 1)].sum(-1)))
              for f in (None, *range(folds))}
    sets = {f"k={k}": (lambda fold, k=k: ranked[fold][:k]) for k in ks}
    grid = ridge.ridge_grid(d, sets, target, alphas, folds, date)
    return grid, {(k, f): r[:k] for k in ks for f, r in ranked.items()}
