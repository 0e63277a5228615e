"""Shared inputs and parameters of the registered jobs."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.factors import FactorConfig
from ..session import checkpoint_dir, configure
from ..sources import panels
from ..sources.bars import store_bars, stored_bars

# Weekly supplier panel: ~357 sessions; windows scaled from days to weeks.
WEEKLY = FactorConfig(adv_window=4, top=500, mom_window=5, mom_smooth=3, mr_window=3,
                      cto_window=2, trail_window=3, vol_window=8, adv_rank_window=8,
                      disp_window=8, mvol_window=8)


#: (application, folder, name) -> where a shared table is stored.
_STORED: dict[tuple[str, str, str], str] = {}


def _shared(spark: SparkSession, sf: str, name: str, write, read) -> DataFrame:
    """A table that the session's jobs share: ``write(path)`` by the first that
    asks, in the shared folder (input tables don't change within a session),
    ``read(path)`` by all."""
    configure(spark)
    key = (spark.sparkContext.applicationId, sf, name)
    if key in _STORED:
        try:
            return read(_STORED[key])
        except AnalysisException:                             # somebody cleared the folder
            pass
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    write(path)
    _STORED[key] = path
    return read(path)


def shared_table(spark: SparkSession, sf: str, name: str, build) -> DataFrame:
    """``build()``, written once a session and read as a table."""
    return _shared(spark, sf, name, lambda path: build().write.parquet(path), spark.read.parquet)


def pw(spark: SparkSession, sf: str, **slice_) -> DataFrame:
    """Weekly supplier bars, stored by year; ``slice_`` as in ``stored_bars``."""
    return _shared(spark, sf, "weekly", lambda path: store_bars(panels.weekly_supplier_bars(spark, sf), path),
                   lambda path: stored_bars(spark, path, **slice_))


def pe(spark: SparkSession, sf: str, **slice_) -> DataFrame:
    """Daily event bars, stored by year."""
    return _shared(spark, sf, "events", lambda path: store_bars(panels.daily_event_bars(spark, sf), path),
                   lambda path: stored_bars(spark, path, **slice_))


def rd(col: Column, d: int = 8) -> Column:
    """Round for the oracle compare.  A nudge of 1e-(d+3) moves values that
    sit on a half-way point (common for ratios of decimal prices) off it, so
    summation-order noise cannot round one engine up and the other down."""
    return F.round(col.cast("double") + F.lit(10.0 ** -(d + 3)), d) + F.lit(0.0)


def r8(c: str | Column, name: str | None = None, d: int = 8) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return rd(col, d).alias(name or (c if isinstance(c, str) else "value"))


def nn(c: Column) -> Column:
    """NaN -> NULL on an output statistic (corr of a constant series)."""
    return F.nanvl(c, F.lit(None).cast("double"))
