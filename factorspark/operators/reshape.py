"""Multi-step reshaping and summary helpers (unpivot, describe, crosstab,
correlation tables).  Quantiles and ranks go through ``ranking`` so one huge
group never lands in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import stats

from ..session import cut_lineage
from . import ranking

QUARTILES = (0.25, 0.5, 0.75)


def to_long(df: DataFrame, ids: Sequence[str], cols: Sequence[str], var: str = "feature",
            val: str = "value", dropna: bool = True) -> DataFrame:
    """Wide -> long; missing values dropped."""
    out = df.unpivot(list(ids), list(cols), var, val)
    return out.filter(F.col(val).isNotNull()) if dropna else out


def describe(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """A4: count, mean, sample std, min, quartiles, max per group."""
    by = list(by)
    agg = df.groupBy(*by).agg(F.count(value).alias("count"), F.avg(value).alias("mean"),
                              F.stddev_samp(value).alias("std"), F.min(value).alias("min"),
                              F.max(value).alias("max"))
    q = ranking.exact_quantiles(df, by, value, QUARTILES)
    q = q.withColumn("name", F.concat(F.lit("p"), (F.col("p") * 100).cast("int").cast("string")))
    wide = q.groupBy(*by).pivot("name", ["p25", "p50", "p75"]).agg(F.first("q"))
    if by:
        return agg.join(wide, by, "left")
    one = F.lit(0).alias("_one")
    return agg.select("*", one).join(wide.select("*", one), "_one").drop("_one")


def crosstab(df: DataFrame, a: str, b: str) -> DataFrame:
    """A5: contingency counts in long form (a, b, n)."""
    return df.groupBy(a, b).agg(F.count(F.lit(1)).alias("n"))


def pearson_pairs(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Pearson correlation of every column pair in one aggregation,
    returned long (by..., a, b, corr)."""
    cols = list(cols)
    pairs = [(x, y) for i, x in enumerate(cols) for y in cols[i + 1:]]
    agg = df.groupBy(*by).agg(*[stats.corr(x, y).alias(f"{x}__{y}") for x, y in pairs])
    st = F.explode(F.array(*[F.struct(F.lit(x).alias("a"), F.lit(y).alias("b"),
                                      F.col(f"{x}__{y}").alias("corr")) for x, y in pairs]))
    return agg.select(*by, st.alias("s")).select(*by, "s.a", "s.b", "s.corr")


def spearman_to_target(df: DataFrame, target: str, features: Sequence[str],
                       key: Sequence[str]) -> DataFrame:
    """Spearman correlation of each feature with the target over
    rows where both are present; ranks are global and hot-value safe."""
    long = to_long(df.filter(F.col(target).isNotNull()), [*key, target], features)
    long = cut_lineage(long)   # ranked twice; do not recompute the inputs
    rx = ranking.average_rank(long, ["feature"], "value", "rx")
    rxy = ranking.average_rank(rx, ["feature"], target, "ry")
    return rxy.groupBy("feature").agg(stats.corr("rx", "ry").alias("spearman"))


def mutual_information(df: DataFrame, label: str, features: Sequence[str],
                       key: Sequence[str], bins: int = 10) -> DataFrame:
    """Discrete mutual information between each feature (equal-width
    bins over its global range) and a class label: sum p ln(p / (px py))."""
    long = to_long(df.filter(F.col(label).isNotNull()), [*key, label], features)
    rng = long.groupBy("feature").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    b = long.join(F.broadcast(rng), "feature").withColumn(   # one row per feature
        "xb", F.when(F.col("hi") == F.col("lo"), 0).otherwise(
            F.least(F.lit(bins - 1), F.floor(F.round(F.lit(bins) * (F.col("value") - F.col("lo"))
                                                     / (F.col("hi") - F.col("lo")), 9)))))
    c = b.groupBy("feature", "xb", label).agg(F.count(F.lit(1)).alias("nxy"))
    from pyspark.sql import Window
    wf = Window.partitionBy("feature")
    c = c.withColumns({"n": F.sum("nxy").over(wf),
                       "nx": F.sum("nxy").over(Window.partitionBy("feature", "xb")),
                       "ny": F.sum("nxy").over(Window.partitionBy("feature", label))})
    term = (F.col("nxy") / F.col("n")) * F.log(F.col("nxy") * F.col("n") / (F.col("nx") * F.col("ny")))
    return c.groupBy("feature").agg(F.sum(term).alias("mutual_info"))
