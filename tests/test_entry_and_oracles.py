"""Driver contract and a representative set of DuckDB oracle checks."""

import datetime as dt
import math

import duckdb
import pytest

import __spark_entry__ as E
from factorspark.sources.tables import TABLES
from conftest import SF0


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else f"{v:.9g}"      # keeps the sign of zero
    if isinstance(v, dt.date):
        return v.isoformat()[:10]
    return v


def _rows(rows):
    return sorted((tuple(_norm(x) for x in r) for r in rows), key=lambda r: tuple(str(x) for x in r))


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["factor", "date", "ic"]
    assert df.count() > 0


def test_every_query_has_a_docstring():
    for name, fn in E.queries().items():
        assert fn.__doc__, name
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF0}/{t}.parquet')")
    return c


CHECKED = ["rank_ic", "momentum_smoothed", "overnight_smoothed", "market_volatility", "xs_qcut", "xs_cut",
           "ts_interpolate", "factor_returns", "quantile_returns", "rank_autocorr", "target_quantiles",
           "date_features", "time_folds", "spearman_rank", "describe_by_group", "roc_auc", "backtest_pnl",
           "idio_var", "portfolio_risk", "var_empirical", "section_positions", "html_clean", "tfidf",
           "jaccard_neighbours", "sentiment_alpha", "phrases_applied", "ridge_gram", "naive_bayes_counts",
           "filing_returns", "constraint_audit"]


@pytest.mark.parametrize("name", CHECKED)
def test_oracle(spark, con, name):
    df = E.queries()[name](spark, SF0)
    got = _rows(df.collect())
    cur = con.execute(E.oracle_sql()[name])
    cols = [d[0] for d in cur.description]
    assert sorted(cols) == sorted(df.columns)
    perm = [cols.index(c) for c in df.columns]
    exp = _rows([tuple(r[i] for i in perm) for r in cur.fetchall()])
    assert got == exp
