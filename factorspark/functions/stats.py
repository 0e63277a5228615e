"""Aggregate expressions that stay defined under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def corr(x, y) -> Column:
    """Pearson correlation; NULL (not an error) when either side is constant
    or fewer than two complete pairs exist.  Pairs with a NULL are skipped."""
    x = F.col(x) if isinstance(x, str) else x
    y = F.col(y) if isinstance(y, str) else y
    both = x.isNotNull() & y.isNotNull()
    xx, yy = F.when(both, x), F.when(both, y)
    return F.try_divide(F.covar_samp(xx, yy), F.stddev_samp(xx) * F.stddev_samp(yy))
