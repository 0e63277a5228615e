"""Name -> (Spark job, DuckDB oracle SQL) registry used by ``__spark_entry__``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Job = Callable[[SparkSession, str], DataFrame]

JOBS: dict[str, Job] = {}
ORACLE: dict[str, str] = {}


def nudge_rounds(sql: str) -> str:
    """``round(e, d)`` with d in 4/6/8 -> ``round((e) + 1e-(d+3), d)``, the
    same half-way nudge the Spark side applies (``queries.common.rd``)."""
    out, i, low = [], 0, sql.lower()
    while True:
        j = low.find("round(", i)
        if j < 0 or (j > 0 and (low[j - 1].isalnum() or low[j - 1] == "_")):
            if j < 0:
                out.append(sql[i:])
                return "".join(out)
            out.append(sql[i:j + 6])
            i = j + 6
            continue
        k, depth, comma = j + 6, 1, -1
        while depth:
            ch = sql[k]
            if ch == "(":
                depth += 1
            elif ch == ")":
                depth -= 1
            elif ch == "," and depth == 1:
                comma = k
            k += 1
        inner_end = k - 1
        digits = sql[comma + 1:inner_end].strip() if comma > 0 else ""
        expr = sql[j + 6:comma] if comma > 0 else ""
        if digits in ("4", "6", "8"):
            expr = nudge_rounds(expr)
            # "+ 0.0" turns a rounded -0.0 into 0.0, as Spark's decimal rounding does
            out.append(sql[i:j] + f"(round(CAST(({expr}) AS DOUBLE) + 1e-{int(digits) + 3}, {digits})"
                       " + CAST(0 AS DOUBLE))")
        else:
            out.append(sql[i:j + 6] + nudge_rounds(sql[j + 6:inner_end]) + ")")
        i = k


def register(name: str, sql: str | None = None):
    """Register a job; ``sql`` is its DuckDB oracle (omit for rows-only checks)."""
    def deco(fn: Job) -> Job:
        if name in JOBS:
            raise ValueError(f"duplicate job {name}")
        JOBS[name] = fn
        if sql is not None:
            ORACLE[name] = nudge_rounds(sql)
        return fn
    return deco


def load_all() -> None:
    from .queries import (  # noqa: F401
        q_panel, q_xs, q_ts, q_factors, q_evaluate, q_features, q_metrics,
        q_risk, q_portfolio, q_tailrisk, q_text, q_models, q_incremental, q_columns, q_selection, q_textmodels)
