"""The pipeline's stages against brute force, each on its own input."""

import random

import pytest

import corpus_pipeline as P
from factorspark.llm import toxicity
from test_llm_operators import hits, later_lines, linked, prose
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, spans array<int>, label struct<a:int>"


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """Toxic texts, copies, near copies, repeated lines, benchmark passages,
    and the edge cases, with further columns."""
    r = random.Random(2)
    items = [(i, prose(r, 14)) for i in range(4)]
    rows, labels = [], []
    lines = [prose(r, 12) for _ in range(3)]
    for i in range(260):
        parts = [prose(r, r.randrange(8, 40)) for _ in range(r.randrange(1, 6))]
        if i % 9 == 0:
            parts[0] += " " + r.choice(items)[1]
        if i % 7 == 0:
            parts += lines[:2]
        text = "\n".join(parts)
        if i % 11 == 3:
            text = rows[r.randrange(len(rows))][1]
        if i % 13 == 5:
            text = rows[r.randrange(len(rows))][1].replace("a", "b", 1)
        toxic = i % 3 == 1
        if toxic:
            text += " vilename scumword trashtalk"
        rows.append((i, text, "en" if i % 2 else "de", "s", len(text), [1], (i,)))
        labels.append((i, int("vilename" in text)))
    rows += [(900, None, None, None, None, None, None), (901, "", "en", "s", 0, [], None), (902, "\n\n", "en", "s", 2, [], None),
             (903, items[0][1], "en", "s", 1, None, None), (None, "no id here", "en", "s", 3, None, None),
             (904, "x " * 50_000, "en", "s", 100_000, None, None), (905, "same row", "en", "s", 8, None, None),
             (905, "same row", "en", "s", 8, None, None)]
    base = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{base}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{base}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{base}/benchmark.parquet")
    docs, kept = spark.read.parquet(f"{base}/documents.parquet"), []
    for k, (name, stage) in enumerate(P.STAGES):
        stage(spark, docs, base).write.parquet(f"{base}/out{k}")
        kept.append((name, docs, spark.read.parquet(f"{base}/out{k}")))
        docs = kept[-1][2]
    return base, items, dict(labels), {name: (before, after) for name, before, after in kept}


def rows_of(df):
    return [(x.doc_id, x.text) for x in df.select("doc_id", "text").collect()]


def test_stages(corpus):
    assert [n for n, _ in P.STAGES] == ["toxicity", "line_dedup", "ngram_join", "decontamination", "packing"]
    for name, _ in P.STAGES[:-1]:
        before, after = corpus[3][name]
        assert after.schema == before.schema


def test_toxicity_rejects_toxic_and_keeps_clean_documents(spark, corpus):
    base, _, labels, stages = corpus
    before, after = stages["toxicity"]
    model = toxicity.fit_on(spark, base, before)
    out = toxicity.toxicity(before, model).where("toxic").select("doc_id").collect()
    assert {i for i, _ in rows_of(before)} - {i for i, _ in rows_of(after)} == {x.doc_id for x in out}
    wrong = [i for i, y in labels.items() if bool(y) == (i in {i for i, _ in rows_of(after)})]
    assert len(wrong) <= 0.03 * len(labels)


def test_line_dedup_stage(corpus):
    before, after = corpus[3]["line_dedup"]
    rows, got = rows_of(before), dict(rows_of(after))
    want = later_lines(rows[:], 2) if all(i is not None for i, _ in rows) else later_lines(
        [(10**9 if i is None else i, t) for i, t in rows], 2)
    for i, t in rows:
        n, removed, kept = want[10**9 if i is None else i]
        assert (i in got) == (n == 0 or removed < n)
        if i in got:
            assert [x for x in (got[i] or "").split("\n") if x] == kept
    assert all(x.n_chars is None or x.n_chars == len(x.text) for x in after.where("n_chars IS NOT NULL").collect())


def test_ngram_join_stage(corpus):
    before, after = corpus[3]["ngram_join"]
    rows = rows_of(before)
    stay = {i for (i, _, c, _) in linked(rows) if i is not None and i == c}
    assert sorted(i for i, _ in rows_of(after) if i is not None) == sorted(stay)
    assert sum(i is None for i, _ in rows_of(after)) == sum(i is None for i, _ in rows)


def test_decontamination_stage(corpus):
    before, after = corpus[3]["decontamination"]
    got = dict(rows_of(after))
    for i, t in rows_of(before):
        n, hit, _ = hits(t, corpus[1])
        assert (i in got) == (len(hit) <= 0.5 * n)
        if i in got:
            assert hits(got[i], [])[0] == n - len(hit)
    assert 903 not in got


def test_packing_stage(corpus):
    before, after = corpus[3]["packing"]
    length = {x.doc_id: x.n for x in after.groupBy("doc_id").agg(F.sum("length").alias("n")).collect()}
    total = {x.doc_id: x.doc_tokens for x in after.select("doc_id", "doc_tokens").distinct().collect()}
    assert length == total and set(length) == {i for i, _ in rows_of(before)}
    assert after.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 2048").count() == 0


def test_run_is_the_stages(spark, corpus):
    key = ["doc_id", "start", "length", "doc_tokens", "ids_crc32"]
    pieces = lambda df: df.groupBy("doc_id").agg(F.sum("length")).collect()
    out = P.run(spark, corpus[0])
    assert set(key) <= set(out.columns)
    assert sorted(map(str, pieces(out))) == sorted(map(str, pieces(corpus[3]["packing"][1])))


def test_empty_tables(spark, tmp_path):
    base = str(tmp_path)
    docs = spark.createDataFrame([], SCHEMA)
    docs.write.parquet(f"{base}/documents.parquet")
    spark.createDataFrame([], "doc_id long, toxic int").write.parquet(f"{base}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{base}/benchmark.parquet")
    assert P.run(spark, base).count() == 0
