"""Invariants of the rows-only jobs and end-to-end behaviour."""

import numpy as np
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF0, SF1


def test_pnl_attribution_reconciles(spark):
    a = E.queries()["pnl_attribution"](spark, SF0)
    tot = E.queries()["weights_pnl_join"](spark, SF0)
    s = a.groupBy("port_name", "date").agg(F.sum("pnl").alias("s"))
    t = tot.groupBy("port_name", "date").agg(F.sum("asset_pnl").alias("t"))
    j = s.join(t, ["port_name", "date"], "full_outer").collect()
    assert j and all(r.s is not None and r.t is not None and abs(r.s - r.t) < 1e-6 for r in j)
    f = E.queries()["pnl_by_factor"](spark, SF0).groupBy("port_name", "date").agg(F.sum("pnl").alias("f"))
    k = f.join(a.filter("component <> 'idiosyncratic'").groupBy("port_name", "date").agg(F.sum("pnl").alias("c")),
               ["port_name", "date"], "full_outer").collect()
    assert k and all(abs(r.f - r.c) < 1e-6 for r in k)


def test_pca_loadings_orthonormal(spark):
    b = E.queries()["pca_betas"](spark, SF0).toPandas()
    m = b.pivot(index="asset", columns="k", values="beta").fillna(0).values
    assert np.allclose(m.T @ m, np.eye(m.shape[1]), atol=1e-8)
    low = E.queries()["pca_top_loadings"](spark, SF0).toPandas()
    share = low.groupby("k").explained_variance_ratio.first()
    assert (share > 0).all() and share.sum() <= 1 + 1e-9 and (share.diff().dropna() <= 1e-12).all()
    grid = E.queries()["pca_expvar_grid"](spark, SF0).toPandas()
    assert (grid.groupby("fold").cum_explained_variance.diff().dropna() >= 0).all() and (grid.share <= 1 + 1e-9).all()


def test_dual_pca_equals_the_covariance_matrix(spark):
    import datetime
    from factorspark.plans import risk
    r = np.random.default_rng(0).normal(size=(12, 40))
    day = lambda i: datetime.date(2020, 1, 1) + datetime.timedelta(i)
    rets = spark.createDataFrame([(day(t), a, float(r[t, a])) for t in range(12) for a in range(40)
                                  if (t + a) % 7], "date date, asset long, r double")
    full = np.where(np.add.outer(np.arange(12), np.arange(40)) % 7, r, 0.0)
    values = np.linalg.eigvalsh(np.cov(full.T))[::-1]
    pca = risk.DualPca(rets, 20)
    assert pca.k == 11 and np.allclose(pca.variance, values[:11]) and np.isclose(pca.total, values.sum())
    b = pca.betas().toPandas().pivot(index="asset", columns="k", values="beta").fillna(0).values
    assert np.allclose(b.T @ np.cov(full.T) @ b, np.diag(values[:11]), atol=1e-10)


def test_small_column_tools(spark):
    from factorspark.functions import columns as co
    from factorspark.functions.text import decode_entities
    d = spark.createDataFrame([("2024-03-10 03:30:00", 1)], "ts string, k int").withColumn("ts", F.col("ts").cast("timestamp"))
    x = d.select(co.local_date("ts", "America/New_York").cast("string").alias("day"),
                 co.replace_values("k", {2: 5}).alias("k")).first()
    assert (x.day, x.k) == ("2024-03-09", 1)
    e = spark.createDataFrame([("a&lt;b&#233;&#xE9;&eacute;&nope;&#160;c&amp;lt; &#1114112;",)], "t string")
    assert e.select(decode_entities("t")).first()[0] == "a<b\u00e9\u00e9\u00e9&nope; c&lt; \ufffd"


def test_entity_decoding_is_linear(spark):
    import time

    from factorspark.functions.text import decode_entities
    n = 10_000
    d = spark.createDataFrame([("x&lt;" * n,)], "t string").repartition(1).select(decode_entities("t").alias("t"))
    assert d.first()[0] == "x<" * n
    began = time.time()
    d.first()
    assert time.time() - began < 3


def test_document_pattern_is_not_repeated_in_the_plan(spark):
    for job in ("section_positions", "section_text"):
        plan = E.queries()[job](spark, SF0)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("<DOCUMENT>(.*?)") == 1, job


def test_naive_bayes_by_hand(spark):
    from factorspark.plans import models as md
    counts = spark.createDataFrame([(1, "a", 2), (1, "b", 1), (2, "b", 1), (3, "c", 4), (4, "zz", 1)],
                                   "doc_id long, term string, tf long")
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 0)], "doc_id long, label int")
    nb = {r.term: (r.log_0, r.log_1) for r in md.naive_bayes(counts, labels).collect()}
    assert set(nb) == {"a", "b", "c"}                          # class 0 has 5 tokens, class 1 has 3, V = 3
    assert np.allclose(nb["a"], np.log([1 / 8, 3 / 6])) and np.allclose(nb["c"], np.log([5 / 8, 1 / 6]))
    p = {r.doc_id: r.prob for r in md.naive_bayes_probability(
        counts.select("doc_id").distinct(), counts, md.naive_bayes(counts, labels), md.class_priors(labels)).collect()}
    odds = 0.5 * (4 ** 2) * ((2 / 6) / (2 / 8))
    assert np.isclose(p[4], 1 / 3) and np.isclose(p[1], odds / (1 + odds))


def test_incremental_rerun_adds_nothing(spark):
    r = E.queries()["incremental_sections"](spark, SF0)
    rows = r.collect()
    assert rows and rows[0].batches_per_run.split(",")[2] == "0"
    assert r.select("doc_id").distinct().count() == len(rows)


def test_tfidf_rows_unit_norm(spark):
    t = E.queries()["tfidf"](spark, SF0)
    n = t.groupBy("doc_id", "sentiment").agg(F.sqrt(F.sum(F.col("tfidf") ** 2)).alias("n")).collect()
    assert all(abs(r.n - 1) < 1e-6 for r in n)


def test_phrase_merge_is_greedy(spark):
    from factorspark.plans.text.ngrams import apply_phrases
    s = spark.createDataFrame([(1, 0, ["a", "b", "c", "d"])], "doc_id long, sent_id int, tokens array<string>")
    ph = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "d")], "a string, b string")
    assert apply_phrases(s, ph).first().tokens == ["a_b", "c_d"]


def test_rows_only_jobs_run(spark):
    for n in ["var_kde", "forest_reg", "phrase_catalogue"]:
        assert E.queries()[n](spark, SF0).count() > 0, n


def test_file_sources_and_sinks(spark, tmp):
    from factorspark.sources import files, sinks
    import os
    os.makedirs(f"{tmp}/f")
    for name, body in [("aapl_10-K_20140103.txt", "x"), ("msft_10-K_20150105.txt", "yy\nzz")]:
        with open(f"{tmp}/f/{name}", "w") as fh:
            fh.write(body)
    d = files.read_filings_text(spark, f"{tmp}/f").orderBy("ticker").collect()
    assert [(r.ticker, r.doc_type, str(r.date), r.text) for r in d] == [
        ("aapl", "10-K", "2014-01-03", "x"), ("msft", "10-K", "2015-01-05", "yy\nzz")]
    with open(f"{tmp}/lex.csv", "w") as fh:
        fh.write("Word,Negative,Positive,Uncertainty,Litigious,Constraining,Interesting,Other\n"
                 "LOSS,2009,0,0,0,0,0,1\nGAIN,0,2009,0,0,0,0,1\nNONE,0,0,0,0,0,0,0\n")
    lex = {(r.word, r.sentiment) for r in files.read_lexicon(spark, f"{tmp}/lex.csv").collect()}
    assert lex == {("loss", "negative"), ("gain", "positive")}
    p = spark.read.parquet(f"{SF0}/region.parquet")
    sinks.write_table(p, f"{tmp}/out", ["r_regionkey"], fmt="csv")
    back = files.read_csv_table(spark, f"{tmp}/out", "r_name string, r_regionkey int", ["r_name"])
    assert back.count() == p.count()


def test_more_file_sources_and_sinks(spark, tmp):
    from factorspark.sources import files, sinks
    from factorspark.streaming.incremental import new_only
    import os
    os.makedirs(f"{tmp}/n")
    for name, body in [("12.txt", "one\ntwo"), ("7.txt", ""), ("x7.txt", "no"), ("8.csv", "no")]:
        with open(f"{tmp}/n/{name}", "w") as fh:
            fh.write(body)
    assert {r.number: r.text for r in files.read_filings_by_number(spark, f"{tmp}/n").collect()}[12] == "one\ntwo"
    assert {r.number for r in files.read_filings_by_number(spark, f"{tmp}/n").collect()} <= {12, 7}
    with open(f"{tmp}/cik.csv", "w") as fh:
        fh.write("ticker,cik\nAAPL,320193\n")
    assert files.read_cik_map(spark, f"{tmp}/cik.csv").first().cik == "0000320193"
    with open(f"{tmp}/s.txt", "w") as fh:
        fh.write("a b  c\n d\n")
    assert sorted(r.tokens for r in files.read_sentences(spark, f"{tmp}/s.txt").collect()) == [["a", "b", "c"], ["d"]]
    d = spark.createDataFrame([(1, "x"), (2, "y")], "k int, t string")
    sinks.write_table(d, f"{tmp}/p", partition_by=["k"])
    assert {(r.k, r.t) for r in spark.read.parquet(f"{tmp}/p").collect()} == {(1, "x"), (2, "y")}
    sinks.write_text(d, "t", f"{tmp}/t")
    assert sorted(r.value for r in spark.read.text(f"{tmp}/t").collect()) == ["x", "y"]
    assert all(f.endswith((".gz", ".crc")) or f.startswith(("_", ".")) for f in os.listdir(f"{tmp}/t"))
    assert [r.k for r in new_only(d, d.filter("k = 1"), key=("k",)).collect()] == [2]


def test_model_persistence(spark, tmp):
    from pyspark.ml.feature import StringIndexer, StringIndexerModel
    from factorspark.sources import sinks
    d = spark.createDataFrame([("a",), ("b",), ("a",)], "t string")
    m = StringIndexer(inputCol="t", outputCol="i").fit(d)
    sinks.save_model(m, f"{tmp}/m", {"kind": "index"}, spark)
    assert StringIndexerModel.load(f"{tmp}/m/model").labels == m.labels
    assert '"kind"' in spark.read.json(f"{tmp}/m/meta").first().meta


def test_model_grids(spark):
    """The jobs that no SQL can give: shares and scores in range, errors near
    the closed form, sparser with less C."""
    q = E.queries()
    cv = q["ridge_cv"](spark, SF0).toPandas()
    assert cv.champion.sum() == 1 and cv[cv.champion].cv_rmse.iloc[0] == cv.cv_rmse.min()
    assert cv.cv_acc.between(0, 1).all()
    forest = q["forest_reg"](spark, SF0).toPandas()
    assert len(forest) == 2 and (forest.rmse > 0).all() and forest.acc.between(0, 1).all()
    vote = q["voting_ensemble"](spark, SF0).toPandas()
    assert vote.valid_acc.between(0, 1).all()


def test_kde_near_the_empirical_quantile(spark):
    k = E.queries()["var_kde"](spark, SF1).toPandas()
    e = E.queries()["var_empirical"](spark, SF1).toPandas()
    assert len(k) and len(e)
