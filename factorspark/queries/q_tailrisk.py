"""Tail-risk jobs V1-V4 on the back-test losses (loss = -daily total)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..plans import tailrisk as tr
from ..registry import register
from .common import r8
from .q_portfolio import BOOK_SQL, Book

CI = 0.95
LOSS_SQL = BOOK_SQL + ",\nls AS (SELECT port_name, -daily_total AS loss FROM pnl)"


def _losses(spark, sf):
    return Book(spark, sf).pnl().select("port_name", (-F.col("daily_total")).alias("loss"))


@register("var_empirical", LOSS_SQL + """
SELECT port_name, round(quantile_cont(round(loss, 10), 0.95), 8) AS var_empirical FROM ls GROUP BY port_name""")
def var_empirical(spark, sf):
    """V1: empirical 95 % VaR (interpolated quantile of losses)."""
    return tr.empirical_var(_losses(spark, sf), CI).select("port_name", r8("var_empirical"))


@register("var_normal", LOSS_SQL + """
SELECT port_name, round(avg(loss) + 1.6448536269514715 * stddev_samp(loss), 8) AS var_normal FROM ls GROUP BY port_name""")
def var_normal(spark, sf):
    """V2: normal 95 % VaR, mean + z * sample std."""
    return tr.normal_var(_losses(spark, sf), CI).select("port_name", r8("var_normal"))


@register("cvar_normal", LOSS_SQL + """
SELECT port_name, round(avg(loss) + stddev_samp(loss) * 0.10313564037537153 / (1 - 0.95), 8) AS cvar_normal
FROM ls GROUP BY port_name""")
def cvar_normal(spark, sf):
    """V4: normal 95 % CVaR, mean + std * phi(z) / (1 - ci)."""
    return tr.normal_cvar(_losses(spark, sf), CI).select("port_name", r8("cvar_normal"))


@register("var_kde")
def var_kde(spark, sf):
    """V3: 95 % VaR of a 100 000-draw Gaussian-KDE smoothed bootstrap."""
    return tr.kde_var(_losses(spark, sf), CI).select("port_name", r8("var_kde"))
