"""Bag of words, tf-idf, neighbour similarity and sentiment.

Long sparse form: (doc, term, value), stored as bags, one row a document.  A
text is shuffled once, by document; bags are joined whole with what concerns a
document and taken apart where terms are looked up, frequent ones in a
broadcast table (``at_terms``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ...functions import text as tx
from ...operators import ranking
from ...session import small_dim
from ...sources.text import SENTIMENTS

# noun/verb suffix rules of a dictionary lemmatiser, applied in
# this order; a rule counts only if its result is itself a corpus word.
LEMMA_RULES = [("ies", "y"), ("ses", "s"), ("xes", "x"), ("zes", "z"), ("ches", "ch"),
               ("shes", "sh"), ("s", ""), ("ing", ""), ("ed", "")]


#: Characters of text that one task counts: its terms fit a hash table.
TASK_CHARS = 1 << 24
#: Terms whose entries are broadcast; rows of the others meet theirs in a shuffle.
HOT_TERMS = 500_000


def vocabulary(docs: DataFrame, text: str = "text") -> DataFrame:
    """(term): distinct lower-cased tokens of 2+ word characters."""
    return docs.select(F.explode(tx.tokens(F.lower(text), min2=True)).alias("term")).distinct()


def term_counts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, term, tf): lower-cased tokens of 2+ word characters.

    Only the texts are shuffled, by document: Spark then groups by (doc, term),
    here and in ``normalised_counts`` and ``bags``, without another shuffle."""
    d = docs.select(key, text)
    chars = d.agg(F.sum(F.length(text))).first()[0] or 0
    n = max(int(d.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-chars // TASK_CHARS))
    t = d.repartition(n, key).select(key, F.explode(tx.tokens(F.lower(text), min2=True)).alias("term"))
    return t.groupBy(key, "term").agg(F.count(F.lit(1)).alias("tf"))


def bags(counts: DataFrame, key: str = "doc_id") -> DataFrame:
    """(doc, bag): a document's terms and counts in one row."""
    return counts.groupBy(key).agg(F.collect_list(F.struct("term", "tf")).alias("bag"))


def terms_of(rows: DataFrame) -> DataFrame:
    """A row for each term of ``bag``, with the other columns."""
    rest = [c for c in rows.columns if c != "bag"]
    return rows.select(*rest, F.explode("bag").alias("_x")).select(*rest, "_x.term", "_x.tf")


def join_terms(counts: DataFrame, other: DataFrame, key: str = "doc_id") -> DataFrame:
    """Term rows with the columns of ``other``; bags are joined before they
    are taken apart, so that a document and not each of its terms is shuffled."""
    j = counts.join(other, key)
    return terms_of(j) if "bag" in counts.columns else j


def document_frequencies(counts: DataFrame) -> DataFrame:
    """(term, df)."""
    return counts.groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def at_terms(rows: DataFrame, table: DataFrame, frequency: str, most: int | None = None) -> DataFrame:
    """``rows`` joined with ``table`` on the term.  Entries of at most ``most``
    frequent terms (by the table's ``frequency``) are broadcast; only rows of
    the rarer terms, few of a large text, are shuffled.  ``table`` is read
    several times and should be stored."""
    most = HOT_TERMS if most is None else most
    own = table.agg(*[F.count_if(F.col(frequency) >= (1 << i)).alias(f"n_{i}") for i in range(48)],
                    F.count(F.lit(1)).alias("n")).first()
    if own["n"] <= most:
        return rows.join(F.broadcast(table), "term")
    least = next((1 << i for i in range(48) if own[f"n_{i}"] <= most), 1 << 48)
    hot = F.col(frequency) >= least
    often = rows.join(F.broadcast(table.where(hot)), "term")
    rest = rows.join(F.broadcast(table.where(hot).select("term").distinct()), "term", "left_anti")
    return often.unionByName(rest.join(table.where(~hot | F.col(frequency).isNull()), "term"))


def lemma_table(counts: DataFrame) -> DataFrame:
    """X10 re-aimed: (word, lemma) from suffix rules validated against the
    corpus vocabulary (first matching rule wins)."""
    vocab = counts.select(F.col("term").alias("word")).distinct()
    cands = vocab.select("word", F.explode(F.array(*[
        F.struct(F.lit(i).alias("rule"),
                 F.when(F.col("word").endswith(suf) & (F.length("word") > len(suf) + 1),
                        F.concat(F.expr(f"substring(word, 1, length(word) - {len(suf)})"), F.lit(rep)))
                 .alias("lemma")) for i, (suf, rep) in enumerate(LEMMA_RULES)])).alias("c")) \
        .select("word", "c.rule", "c.lemma").filter(F.col("lemma").isNotNull())
    ok = cands.join(vocab.select(F.col("word").alias("lemma")), "lemma", "left_semi")
    best = ok.groupBy("word").agg(F.min_by("lemma", "rule").alias("lemma"))
    return best


def normalised_counts(counts: DataFrame, lemmas: DataFrame, key: str = "doc_id",
                      stop: list[str] = tx.STOP_WORDS) -> DataFrame:
    """Lemmatise terms, drop stop words, re-aggregate counts."""
    j = counts.join(small_dim(lemmas.withColumnRenamed("word", "term"), HOT_TERMS), "term", "left")
    j = j.select(key, F.coalesce("lemma", "term").alias("term"), "tf")
    j = j.filter(~F.col("term").isin(stop))
    return j.groupBy(key, "term").agg(F.sum("tf").alias("tf"))


def normalised_lexicon(lex: DataFrame, lemmas: DataFrame) -> DataFrame:
    """Lexicon words through the same lemma map, de-duplicated."""
    j = lex.join(lemmas, "word", "left").select(F.coalesce("lemma", "word").alias("word"), "sentiment")
    return j.distinct()


def bag_of_words(counts: DataFrame, weights: DataFrame, key: str = "doc_id") -> DataFrame:
    """Counts over each sentiment's vocabulary, long (doc, sentiment, term, tf)."""
    return at_terms(counts, weights, "df").select(key, "sentiment", "term", "tf")


def term_weights(lex: DataFrame, frequencies: DataFrame, n_docs: DataFrame) -> DataFrame:
    """(term, sentiment, df, idf): the lists' words that occur, with their
    corpus-wide IDF ln((1 + n) / (1 + df)) + 1 (B6 fixed).  ``n_docs``: one row ``n``."""
    j = lex.withColumnRenamed("word", "term").join(frequencies, "term").join(F.broadcast(n_docs))   # n: one row
    return j.select("term", "sentiment", "df", (F.log((1 + F.col("n")) / (1 + F.col("df"))) + 1).alias("idf"))


def tfidf_sums(counts: DataFrame, weights: DataFrame, key: str = "doc_id") -> DataFrame:
    """(doc, sentiment, n_terms, total, norm): number of a document's list
    words, sum and length of their weights tf * idf.  A document's rows are
    summed where they are; only the sums are shuffled."""
    w = F.col("tf") * F.col("idf")
    return at_terms(counts, weights, "df").groupBy(key, "sentiment").agg(
        F.count(F.lit(1)).alias("n_terms"), F.sum(w).alias("total"), F.sqrt(F.sum(w * w)).alias("norm"))


def tfidf(bag: DataFrame, weights: DataFrame, sums: DataFrame, key: str = "doc_id") -> DataFrame:
    """Tf * idf, L2-normalised per (document, sentiment) - the
    vectoriser defaults - for every sentiment in one job.  The few lengths of a
    document are joined to its bag before that is taken apart; further columns
    of ``bag`` stay."""
    rest = [c for c in bag.columns if c not in (key, "bag")]
    norms = sums.groupBy(F.col(key).alias("_key")).agg(
        F.map_from_entries(F.collect_list(F.struct("sentiment", "norm"))).alias("_norms"))
    j = terms_of(bag.join(norms, F.col(key).eqNullSafe(F.col("_key"))).drop("_key"))
    value = F.col("tf") * F.col("idf") / F.element_at("_norms", F.col("sentiment"))
    return at_terms(j, weights, "df").select(key, "sentiment", "term", "tf", value.alias("tfidf"), *rest)


def df_filtered_vocab(frequencies: DataFrame, n_docs: DataFrame, min_df: float, max_df: float) -> DataFrame:
    """Corpus words whose document share lies in [min_df, max_df]."""
    d = frequencies.join(F.broadcast(n_docs))                                                 # one row
    share = F.col("df") / F.col("n")
    return d.filter((share >= min_df) & (share <= max_df)).select(
        F.col("term").alias("word"), F.lit("all").alias("sentiment"))


def combined(tf: DataFrame, lex: DataFrame, priority: list[str] = SENTIMENTS) -> tuple[DataFrame, DataFrame]:
    """A word listed under several sentiments stays only in the
    first (by ``priority``); returns (merged tf-idf, removed words per sentiment)."""
    pr = F.array_position(F.array(*[F.lit(s) for s in priority]), F.col("sentiment"))
    first = lex.groupBy("word").agg(F.min_by("sentiment", pr).alias("first"))
    keep = tf.join(first.withColumnRenamed("word", "term"), "term").filter(
        F.col("sentiment") == F.col("first")).drop("first")
    return keep, overlap(lex, priority)


def overlap(lex: DataFrame, priority: list[str] = SENTIMENTS) -> DataFrame:
    """Words that the first-list-wins merge removes from each list."""
    pr = F.array_position(F.array(*[F.lit(s) for s in priority]), F.col("sentiment"))
    first = lex.groupBy("word").agg(F.min_by("sentiment", pr).alias("first"))
    return (lex.join(first, "word").filter(F.col("sentiment") != F.col("first"))
            .groupBy("sentiment").agg(F.count(F.lit(1)).alias("removed")))


def lexicon_stats(lex: DataFrame) -> DataFrame:
    """Vocabulary size per sentiment and the count of its words that are
    also in another list."""
    multi = lex.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("word")
    return lex.groupBy("sentiment").agg(F.count(F.lit(1)).alias("n_words")).join(
        lex.join(multi, "word", "left_semi").groupBy("sentiment").agg(F.count(F.lit(1)).alias("n_shared")),
        "sentiment", "left").na.fill(0, ["n_shared"])


def pairs(docs: DataFrame, group: str = "ticker", key: str = "doc_id",
          order: str = "ord") -> DataFrame:
    """(doc, next_doc) for consecutive documents of a ticker, hot-ticker
    safe (``ranking.neighbours``)."""
    n = ranking.neighbours(docs.select(group, key, order), [group], order, "prev_ord")
    prev = docs.select(group, F.col(order).alias("prev_ord"), F.col(key).alias("prev_doc"))
    return n.join(prev, [group, "prev_ord"]).select(group, F.col("prev_doc").alias("doc_a"),
                                                    F.col(key).alias("doc_b"))


def common_terms(bag: DataFrame, pr: DataFrame, key: str = "doc_id") -> DataFrame:
    """(doc_a, doc_b, term, product): terms that both documents of a pair hold,
    and the product of their counts; bags meet whole, sorted together."""
    a = bag.select(F.col(key).alias("doc_a"), F.col("bag").alias("_a"))
    b = bag.select(F.col(key).alias("doc_b"), F.col("bag").alias("_b"))
    j = pr.select("doc_a", "doc_b").join(a, "doc_a").join(b, "doc_b")

    def equal_neighbours(x):
        n = F.greatest(F.size(x) - 1, F.lit(0))
        return F.filter(F.zip_with(F.slice(x, 1, n), F.slice(x, 2, n), lambda p, q: F.when(
            p["term"] == q["term"], F.struct(p["term"].alias("term"), (p["tf"] * q["tf"]).alias("product")))),
            lambda p: p.isNotNull())

    both = tx.bound(F.sort_array(F.concat("_a", "_b")), equal_neighbours)
    return j.select("doc_a", "doc_b", F.explode(both).alias("_x")).select("doc_a", "doc_b", "_x.term", "_x.product")


def _per_list(pr: DataFrame, sums: DataFrame, value: str, key: str) -> DataFrame:
    """Every pair and list, with ``value`` of both documents (``na``, ``nb``)."""
    s = sums.select(key, "sentiment", value)
    sents = F.explode(F.array(*[F.lit(x) for x in SENTIMENTS])).alias("sentiment")
    return (pr.select("*", sents)
            .join(s.withColumnsRenamed({key: "doc_a", value: "na"}), ["doc_a", "sentiment"], "left")
            .join(s.withColumnsRenamed({key: "doc_b", value: "nb"}), ["doc_b", "sentiment"], "left"))


def jaccard(bag: DataFrame, weights: DataFrame, sums: DataFrame, pr: DataFrame, key: str = "doc_id") -> DataFrame:
    """|A n B| / |A u B| of the binary term sets of neighbouring
    documents, per sentiment."""
    inter = at_terms(common_terms(bag, pr, key), weights, "df").groupBy("doc_a", "doc_b", "sentiment").agg(
        F.count(F.lit(1)).alias("inter"))
    j = _per_list(pr, sums, "n_terms", key).join(inter, ["doc_a", "doc_b", "sentiment"], "left")
    i = F.coalesce("inter", F.lit(0))
    u = F.coalesce("na", F.lit(0)) + F.coalesce("nb", F.lit(0)) - i
    return j.select("ticker", "doc_a", "doc_b", "sentiment", F.try_divide(i.cast("double"), u.cast("double")).alias("jaccard"))


def cosine(bag: DataFrame, weights: DataFrame, sums: DataFrame, pr: DataFrame, key: str = "doc_id") -> DataFrame:
    """Cosine similarity of the tf-idf rows of neighbouring documents."""
    dot = at_terms(common_terms(bag, pr, key), weights, "df").groupBy("doc_a", "doc_b", "sentiment").agg(
        F.sum(F.col("product") * F.col("idf") * F.col("idf")).alias("dot"))
    j = _per_list(pr, sums, "norm", key).join(dot, ["doc_a", "doc_b", "sentiment"], "left")
    return j.select("ticker", "doc_a", "doc_b", "sentiment",
                    F.try_divide(F.coalesce("dot", F.lit(0.0)), F.col("na") * F.col("nb")).alias("cosine"))


def sentiment_scores(docs: DataFrame, sums: DataFrame, key: str = "doc_id") -> DataFrame:
    """Sum of tf-idf per document and sentiment (documents with no
    sentiment word score 0), document length and length-scaled score."""
    # the length first: beside the explode it would be counted for every list
    base = docs.select(key, "ticker", "date", "lang", tx.doc_len("text").cast("bigint").alias("doc_len")).select(
        "*", F.explode(F.array(*[F.lit(s) for s in SENTIMENTS])).alias("sentiment"))
    s = sums.select(key, "sentiment", (F.col("total") / F.col("norm")).alias("score"))
    j = base.join(s, [key, "sentiment"], "left").withColumn("score", F.coalesce("score", F.lit(0.0)))
    return j.withColumn("score_scaled", F.try_divide(F.col("score"), F.col("doc_len").cast("double")))


def sentiment_alpha(scores: DataFrame, value: str = "score_scaled", date: str = "year",
                    sector: str = "lang") -> DataFrame:
    """Per sentiment and date: sector de-mean, average-tie rank,
    sample z-score, times +1 (positive, interesting) or -1 (other lists).
    Aggregations and ranks are skew-safe (a year may hold most filings)."""
    g = ["sentiment", date]
    m = scores.groupBy(*g, sector).agg(F.avg(value).alias("_m"))
    d = scores.join(m, [*g, sector]).withColumn("_dm", F.col(value) - F.col("_m"))
    z = ranking.rank_zscore(d, g, "_dm", "_z")
    sign = F.when(F.col("sentiment").isin("positive", "interesting"), 1.0).otherwise(-1.0)
    return z.withColumn("alpha", F.col("_z") * sign).drop("_m", "_dm", "_z")
