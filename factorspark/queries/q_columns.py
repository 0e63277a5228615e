"""Jobs of the column tools, of keyed cross-sections and of small summaries
(P6, P9, P13, P16, P19, A7, A16, F3, J12, O1, O2, T5, T6, X8, X20)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import columns as co
from ..functions import dates as dt
from ..functions import stats
from ..functions import text as tx
from ..plans import factors as fx
from ..plans import features as ft
from ..plans.text import bow as bw
from ..plans.text import sections as sc
from ..registry import register
from ..session import configure
from ..sources.tables import read
from . import sqlkit as q
from .common import WEEKLY, nn, pe, pw, r8
from .q_factors import sql_factor_panel
from .q_text import RAW, SCORE, Corpus, _main

NAMES = ["momentum", "mean_reversion", "overnight_sentiment"]


@register("columns_by_pattern", """
SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice FROM lineitem""")
def columns_by_pattern(spark, sf):
    """The key and the columns whose name ends in quantity or price."""
    configure(spark)
    d = read(spark, sf, "lineitem")
    return d.select("l_orderkey", "l_linenumber", *co.matching(d, r"(quantity|price)$"))


@register("replaced_values", """
SELECT doc_id, CASE quality WHEN 0 THEN -1 ELSE quality END AS target,
  CASE toxic WHEN 0 THEN 'clean' WHEN 1 THEN 'toxic' ELSE CAST(toxic AS VARCHAR) END AS class FROM labels""")
def replaced_values(spark, sf):
    """0/1 labels as -1/1 and as names."""
    configure(spark)
    d = read(spark, sf, "labels", "doc_id", "quality", "toxic")
    return d.select("doc_id", co.replace_values("quality", {0: -1}).alias("target"),
                    co.replace_values("toxic", {0: "clean", 1: "toxic"}).alias("class"))


@register("event_epochs", """
SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS seconds, CAST(make_timestamp(CAST(floor(epoch(ts)) AS BIGINT) * 1000000) AS DATE) AS day,
  'A' || lpad(CAST(user_id AS VARCHAR), 6, '0') AS symbol FROM events""")
def event_epochs(spark, sf):
    """Event times as epochs, back as dates, and asset symbols."""
    configure(spark)
    d = read(spark, sf, "events", "event_id", "ts", "user_id").withColumn("seconds", co.to_epoch("ts"))
    return d.select("event_id", "seconds", co.from_epoch("seconds").cast("date").alias("day"),
                    co.symbol("user_id").alias("symbol"))


@register("row_statistics", sql_factor_panel(NAMES) + """
SELECT date, asset, round((coalesce(momentum, 0) + coalesce(mean_reversion, 0) + coalesce(overnight_sentiment, 0))
    / NULLIF((momentum IS NOT NULL)::INT + (mean_reversion IS NOT NULL)::INT + (overnight_sentiment IS NOT NULL)::INT, 0), 8) AS row_mean,
  round(coalesce(momentum, 0) + coalesce(mean_reversion, 0) + coalesce(overnight_sentiment, 0), 8) AS row_sum,
  momentum IS NULL OR mean_reversion IS NULL OR overnight_sentiment IS NULL AS any_missing,
  (momentum IS NULL)::INT + (mean_reversion IS NULL)::INT + (overnight_sentiment IS NULL)::INT AS n_missing FROM fp""")
def row_statistics(spark, sf):
    """Mean, sum and missing values over the factors of a row."""
    p = fx.factor_panel(pw(spark, sf), NAMES, WEEKLY)
    s = co.row_stats(NAMES)
    return p.select("date", "asset", r8(s["row_mean"], "row_mean"), r8(s["row_sum"], "row_sum"),
                    s["any_missing"].alias("any_missing"), s["n_missing"].alias("n_missing"))


@register("factor_covariance", sql_factor_panel(NAMES) + "\n" + " UNION ALL ".join(
    f"SELECT '{a}' AS factor_a, '{b}' AS factor_b, round(covar_samp({a}, {b}), 8) AS cov FROM fp"
    for a in NAMES for b in NAMES))
def factor_covariance(spark, sf):
    """Sample covariance matrix of the factors, one aggregation."""
    p = fx.factor_panel(pw(spark, sf), NAMES, WEEKLY)
    pairs = [(a, b) for a in NAMES for b in NAMES]
    s = p.agg(*[F.covar_samp(a, b).alias(f"{a}|{b}") for a, b in pairs])
    rows = F.array(*[F.struct(F.lit(a).alias("factor_a"), F.lit(b).alias("factor_b"),
                              F.col(f"{a}|{b}").alias("c")) for a, b in pairs])
    return s.select(F.explode(rows).alias("x")).select("x.factor_a", "x.factor_b", r8("x.c", "cov"))


#: Days that a calendar marks (the first Mondays of three quarters).
MARKED = ["1995-04-03", "1996-07-01", "1997-10-06"]


@register("marked_sessions", q.with_(q.PW) + f"""
SELECT date, asset, CAST(date IN ({", ".join(f"DATE '{d}'" for d in MARKED)}) AS INTEGER) AS marked FROM bars""")
def marked_sessions(spark, sf):
    """Whether a session is one of the calendar's marked days."""
    return pw(spark, sf).select("date", "asset", dt.in_set("date", MARKED).alias("marked"))


@register("without_last_sessions", q.with_(q.PE, q.CAL) + """
SELECT date, asset FROM p WHERE session_idx < (SELECT count(*) FROM cal) - 5""")
def without_last_sessions(spark, sf):
    """T5: the panel without its last 5 dates, whose targets look ahead of it."""
    return ft.drop_last_sessions(pe(spark, sf), 5).select("date", "asset")


@register("cross_section", q.with_(q.PW) + """
SELECT asset, round(close, 4) AS close FROM bars WHERE date = DATE '1996-07-01'""")
def cross_section(spark, sf):
    """The cross-section of one date, sorted by price, then asset."""
    p = pw(spark, sf, start="1996-07-01", end="1996-07-01")
    return p.select("asset", r8("close", d=4)).orderBy("close", "asset")


@register("score_corr_summary", SCORE + """,
t AS (SELECT sentiment, ticker, CASE WHEN isnan(corr(score, doc_len)) THEN NULL ELSE corr(score, doc_len) END AS c
      FROM scores GROUP BY sentiment, ticker)
SELECT sentiment, count(c) AS n_tickers, round(avg(c), 8) AS mean_corr, round(median(c), 8) AS median_corr,
  round(min(c), 8) AS min_corr, round(max(c), 8) AS max_corr FROM t GROUP BY sentiment""")
def score_corr_summary(spark, sf):
    """The tickers' score-length correlations, summed up per list."""
    c = Corpus(spark, sf)
    s = c.scores()
    t = s.groupBy("sentiment", "ticker").agg(nn(stats.corr("score", "doc_len")).alias("c"))
    return t.groupBy("sentiment").agg(
        F.count("c").alias("n_tickers"), r8(F.avg("c"), "mean_corr"), r8(F.median("c"), "median_corr"),
        r8(F.min("c"), "min_corr"), r8(F.max("c"), "max_corr"))


@register("sentences_per_section", "WITH " + RAW + f"""
SELECT doc_id, item, len(list_filter(string_split_regex(section, '{tx.SENTENCE_SPLIT}'), lambda s: length(trim(s)) > 0)) AS n_sentences
FROM secs""")
def sentences_per_section(spark, sf):
    """Sentences of every section of the filings."""
    s = sc.section_text(_main(spark, sf))
    n = F.size(F.filter(tx.sentences("section"), lambda x: F.length(F.trim(x)) > 0))
    return s.select("doc_id", "item", n.cast("bigint").alias("n_sentences"))


@register("recent_filings", "WITH " + RAW + """
SELECT doc_id, length(body) AS body_len FROM main WHERE date >= DATE '1997-01-01'""")
def recent_filings(spark, sf):
    """Main documents of the filings from 1997 on."""
    from ..sources import text as st
    configure(spark)
    m = sc.main_documents(st.raw_filings(spark, sf), since="1997-01-01")
    return m.select("doc_id", F.length("body").cast("bigint").alias("body_len"))
