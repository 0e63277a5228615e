"""Calendar features F1-F7 as built-in expressions (Mon-Fri business days, no
holiday calendar)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(d: Column | str) -> Column:
    return F.col(d) if isinstance(d, str) else d


def is_month(d, m: int) -> Column:
    """1 when the date falls in month ``m``."""
    return (F.month(_c(d)) == m).cast("int")


def last_business_day(d) -> Column:
    ld = F.last_day(_c(d))
    return F.date_sub(ld, F.greatest(F.weekday(ld) - 4, F.lit(0)))


def first_business_day(d) -> Column:
    d1 = F.trunc(_c(d), "month")
    return F.date_add(d1, F.when(F.weekday(d1) == 5, 2).when(F.weekday(d1) == 6, 1).otherwise(0))


def month_end(d) -> Column:
    """last weekday of the month (pandas 'BM')."""
    return (_c(d) == last_business_day(d)).cast("int")


def month_start(d) -> Column:
    """first weekday of the month ('BMS')."""
    return (_c(d) == first_business_day(d)).cast("int")


def qtr_end(d) -> Column:
    return (month_end(d).cast("boolean") & (F.month(_c(d)) % 3 == 0)).cast("int")


def qtr_start(d) -> Column:
    return (month_start(d).cast("boolean") & (F.month(_c(d)) % 3 == 1)).cast("int")


def in_set(d, dates: list[str]) -> Column:
    """1 when the date is one of the given dates."""
    return _c(d).isin([F.lit(x).cast("date") for x in dates]).cast("int")


def one_hot(x, levels, prefix: str) -> dict[str, Column]:
    """one integer column per known level."""
    x = _c(x)
    return {f"{prefix}_{v}": (x == F.lit(v)).cast("int") for v in levels}


def date_features(d="date") -> dict[str, Column]:
    """T4: the feature bundle of ``compute_date_features``."""
    d = _c(d)
    out = {"is_January": is_month(d, 1), "is_December": is_month(d, 12),
           "month_end": month_end(d), "month_start": month_start(d),
           "qtr_end": qtr_end(d), "qtr_start": qtr_start(d),
           "month": F.month(d), "weekday": F.weekday(d), "quarter": F.quarter(d),
           "year": F.year(d)}
    out.update(one_hot(F.weekday(d), range(7), "weekday"))
    out.update(one_hot(F.quarter(d), range(1, 5), "qtr"))
    return out


def shifted(d, years: int = 0, months: int = 0, days: int = 0) -> Column:
    """calendar arithmetic: whole years and months first (a day that the
    month lacks becomes its last), then days."""
    return F.date_add(F.add_months(_c(d), 12 * years + months), days)


def add_business_days(d, n: int) -> Column:
    """``n`` weekdays on (or back, if negative); from a weekend counting
    starts at the Friday before (forward) or the Monday after (back)."""
    d = _c(d)
    w = F.weekday(d)
    if n >= 0:
        at = F.least(w, F.lit(4))
        start = F.date_sub(d, w - at)
        whole = at + n
    else:
        at = F.when(w > 4, 0).otherwise(w)
        start = F.when(w > 4, F.date_add(d, 7 - w)).otherwise(d)
        whole = at + n
    weeks = F.floor(whole / 5).cast("int")
    return F.date_add(start, weeks * 7 + (whole - weeks * 5) - at)


def safe_positive(x) -> Column:
    """F8: 1 when x >= 0, 0 when negative, NULL when missing."""
    x = _c(x)
    return F.when(x.isNotNull(), (x >= 0).cast("int"))
