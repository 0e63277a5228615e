"""Stored bars, compressed and split files, and the figures of the KDE VaR and
the PCA against plain numpy."""

import datetime as dt
import gzip
import os
from statistics import NormalDist

import numpy as np

from factorspark.plans import risk, tailrisk
from factorspark.sources import bars, files


def scanned(df):
    """(files, rows) that the plan's scans have read."""
    plan = df._jdf.queryExecution().executedPlan()
    df._jdf.collectToPython()
    leaves = plan.collectLeaves()
    n = rows = 0
    for i in range(leaves.size()):
        m = leaves.apply(i).metrics()
        if m.contains("numFiles"):
            n += m.apply("numFiles").value()
            rows += m.apply("numOutputRows").value()
    return n, rows


def test_bars_from_csv_to_a_stored_table(spark, tmp):
    os.makedirs(f"{tmp}/daily")
    days = [dt.date(y, m, 3) for y in (2019, 2020, 2021) for m in range(1, 13)]
    for k, name in enumerate(("aapl", "msft", "brk.b", "other")):
        text = "date,open,high,low,close,volume,dividend,split\n" + "".join(
            f"{d},{k + 1}.5,{k + 2},{k},{'NaN' if i == 4 else k + 1 + i / 100},{100 * i},0.0,1.0\n" for i, d in enumerate(days))
        if name == "msft":
            with gzip.open(f"{tmp}/daily/{name}.csv.gz", "wt") as f:
                f.write(text)
        else:
            with open(f"{tmp}/daily/{name}.csv", "w") as f:
                f.write(text + ",1,1,1,1,1,0,1\n")                        # a row without date
    symbols = spark.createDataFrame([("aapl", 1, 0), ("msft", 2, 1), ("brk.b", 3, None)], "symbol string, asset long, sector_code int")
    b = bars.read_bars_csv(spark, f"{tmp}/daily", symbols, glob="*.{csv,csv.gz}")
    assert b.count() == 3 * 36 and b.where("close IS NULL").count() == 3
    bars.store_bars(b, f"{tmp}/stored")
    whole = bars.stored_bars(spark, f"{tmp}/stored")
    assert whole.columns == ["date", "asset", "open", "close", "volume", "sector_code"]
    key = lambda d: sorted(map(tuple, d.collect()), key=str)
    assert key(whole) == key(b.select(*whole.columns))
    assert sorted(x for x in os.listdir(f"{tmp}/stored") if x.startswith("year=")) == ["year=2019", "year=2020", "year=2021"]
    part = bars.stored_bars(spark, f"{tmp}/stored", "2020-03-01", "2020-06-03", [1, 3])
    assert key(part) == key(b.select(*whole.columns).where("date BETWEEN '2020-03-01' AND '2020-06-03' AND asset <> 2"))
    all_files, _ = scanned(bars.stored_bars(spark, f"{tmp}/stored"))
    year_files, _ = scanned(bars.stored_bars(spark, f"{tmp}/stored", "2020-03-01", "2020-06-03"))
    assert 0 < year_files <= all_files / 2                              # the other years' files are not opened
    plan = part.select("asset", "close")._jdf.queryExecution().executedPlan().toString()
    assert "volume" not in plan.split("ReadSchema")[1].split("\n")[0] and "PartitionFilters: [isnotnull(year" in plan


def test_jobs_share_their_bars(spark, monkeypatch):
    from conftest import SF0
    from factorspark.queries import common
    built = []
    real = common.panels.weekly_supplier_bars
    monkeypatch.setattr(common, "_STORED", {})
    monkeypatch.setattr(common.panels, "weekly_supplier_bars", lambda *a: built.append(1) or real(*a))
    a, b = common.pw(spark, SF0), common.pw(spark, SF0, start="1996-07-01", end="1996-07-01")
    assert len(built) == 1 and a.where("date = '1996-07-01'").count() == b.count() > 0


def test_compressed_filings(spark, tmp):
    os.makedirs(f"{tmp}/f")
    with gzip.open(f"{tmp}/f/aapl_10-K_20140103.txt.gz", "wt") as f:
        f.write("first\nsecond é")
    with open(f"{tmp}/f/msft_10-Q_20150105.txt", "w") as f:
        f.write("plain")
    with open(f"{tmp}/f/notes.csv", "w") as f:
        f.write("no")
    d = files.read_filings_text(spark, f"{tmp}/f").orderBy("ticker").collect()
    assert [(r.ticker, r.doc_type, str(r.date), r.text) for r in d] == [
        ("aapl", "10-K", "2014-01-03", "first\nsecond é"), ("msft", "10-Q", "2015-01-05", "plain")]


def test_lines_are_numbered_through_splits(spark, tmp):
    os.makedirs(f"{tmp}/s")
    want = {}
    for name, n in (("a", 900), ("b", 40), ("c", 0)):
        lines = [f"{name} w{i} " + "x" * (i % 37) for i in range(n)]
        want |= {(f"{name}.txt", i): x.split() for i, x in enumerate(lines)}
        with open(f"{tmp}/s/{name}.txt", "w") as f:
            f.write("\n".join(lines))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("1000", "3000", old):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            got = {(os.path.basename(r.file), r.line): r.tokens for r in files.read_sentences(spark, f"{tmp}/s").collect()}
            assert got == want
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_kde_is_the_quantile_of_the_smoothed_losses(spark):
    r = np.random.default_rng(5)
    losses = {"p": r.normal(1, 2, 60), "q": r.exponential(3, 200)}
    d = spark.createDataFrame([(k, float(x)) for k, v in losses.items() for x in v], "port_name string, loss double")
    for ci in (0.9, 0.99):
        got = {x.port_name: x.var_kde for x in tailrisk.kde_var(d, ci, draws=60_000).collect()}
        for k, v in losses.items():
            h = len(v) ** -0.2 * v.std(ddof=1)
            cdf = lambda x: np.mean([NormalDist(m, h).cdf(x) for m in v])
            lo, hi = v.min() - 10 * h, v.max() + 10 * h
            for _ in range(60):
                mid = (lo + hi) / 2
                lo, hi = (mid, hi) if cdf(mid) < ci else (lo, mid)
            density = (cdf(lo + 1e-4) - cdf(lo - 1e-4)) / 2e-4
            assert abs(got[k] - lo) < 5 * np.sqrt(ci * (1 - ci) / 60_000) / density, (k, ci)
            assert abs(got[k] - np.quantile(v, ci)) > 1e-6                # smoothed, not the empirical one


def test_gram_rows_are_summed_on_the_cluster(spark):
    r = np.random.default_rng(2)
    x = r.normal(size=(40, 12))                                         # assets x dates
    days = [dt.date(2020, 1, 1) + dt.timedelta(days=i) for i in range(12)]
    d = spark.createDataFrame([(days[j], i, float(x[i, j])) for i in range(40) for j in range(12) if (i + j) % 9],
                              "date date, asset long, r double").repartition(5)
    y = np.where((np.add.outer(np.arange(40), np.arange(12)) % 9) > 0, x, 0.0)
    y = y - y.mean(1, keepdims=True)
    assert np.allclose(risk.dates_gram(d, days), y.T @ y)
    assert risk.DualPca(d, 50).k == 11                                  # bounded by the rank


def test_business_days(spark):
    from pyspark.sql import functions as F

    from factorspark.functions import dates
    days = [dt.date(2024, 2, 26) + dt.timedelta(days=i) for i in range(14)]
    d = spark.createDataFrame([(x,) for x in days], "d date")
    for n in (-11, -5, -1, 0, 1, 4, 5, 13):
        got = {r.d: r.x for r in d.select("d", dates.add_business_days(F.col("d"), n).alias("x")).collect()}
        want = np.busday_offset(np.array(days, "M8[D]"), n, roll="backward" if n >= 0 else "forward")
        assert [got[x] for x in days] == [w.astype(object) for w in want], n
