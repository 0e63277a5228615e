"""Small column tools: selection by name pattern, value replacement, row-wise
statistics, epochs, time zones and symbols (P6, P9, P15, P16, P19)."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def matching(df: DataFrame, pattern: str) -> list[str]:
    """The columns whose name the pattern finds."""
    return [c for c in df.columns if re.search(pattern, c)]


def replace_values(col: str, values: dict) -> Column:
    """Values replaced by a mapping; others stay as they are (as strings
    if the mapping is to strings)."""
    kind = "string" if any(isinstance(v, str) for v in values.values()) else None
    out = F.col(col).cast(kind) if kind else F.col(col)
    for k, v in values.items():
        out = F.when(F.col(col).eqNullSafe(F.lit(k)), F.lit(v)).otherwise(out)
    return out


def row_stats(cols: list[str]) -> dict[str, Column]:
    """Mean and sum of the present values of a row, whether any is
    missing, and how many (T6)."""
    n = sum(F.col(c).isNotNull().cast("int") for c in cols)
    s = sum(F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in cols)
    return {"row_mean": F.try_divide(s, n.cast("double")), "row_sum": s, "any_missing": n < len(cols),
            "n_missing": F.lit(len(cols)) - n}


def to_epoch(ts) -> Column:
    """Seconds since 1970 of a timestamp."""
    return F.unix_seconds(F.col(ts).cast("timestamp") if isinstance(ts, str) else ts)


def from_epoch(seconds) -> Column:
    """The timestamp of seconds since 1970."""
    return F.timestamp_seconds(F.col(seconds) if isinstance(seconds, str) else seconds)


def local_date(ts, zone: str) -> Column:
    """The date that a UTC timestamp has in a time zone."""
    return F.to_date(F.from_utc_timestamp(F.col(ts) if isinstance(ts, str) else ts, zone))


def symbol(asset, width: int = 6) -> Column:
    """A printable symbol of an asset number."""
    return F.concat(F.lit("A"), F.lpad((F.col(asset) if isinstance(asset, str) else asset).cast("string"), width, "0"))
