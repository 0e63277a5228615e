"""Text jobs (X1-X28, F11-F21, S18, A19, A20) over ``documents`` and ``pages``."""

from __future__ import annotations

from decimal import Decimal
from html.entities import name2codepoint

from pyspark.sql import functions as F

from ..functions import stats

from ..functions import text as tx
from ..plans.text import bow as bw
from ..plans.text import ngrams as ng
from ..plans.text import sections as sc
from ..registry import register
from ..session import configure, cut_lineage
from ..sources import text as st
from ..sources.tables import read
from .common import nn, r8, shared_table

KEY = ("ticker", "date", "doc_id")
W1 = r"([\p{L}\p{N}_]+)"
W2 = r"([\p{L}\p{N}_]{2,})"
SENTS = "[" + ", ".join(f"'{s}'" for s in st.SENTIMENTS) + "]"
STOPS = "[" + ", ".join(f"'{s}'" for s in tx.STOP_WORDS) + "]"
HDR = ["<p><b>Item&#160;1A.</b> Risk Factors</p>", "<p>ITEM 7 Management discussion</p>",
       "<p><b>Item&nbsp;7A.</b> Market risk</p>", "<div>>Item 1A. continued</div>"]
HDRS = "[" + ", ".join(f"'{h}'" for h in HDR) + "]"
TOC = "<table><tr><td>>Item 1A</td><td>>Item 7</td><td>>Item 7A</td></tr></table>"
PAT = tx.SECTION_HEADER

DOCS = """docs AS (SELECT doc_id, source AS ticker, lang,
  CAST(DATE '1995-01-02' + CAST(doc_id % 2400 AS INTEGER) AS DATE) AS date, text FROM documents)"""

RAW = DOCS + f""",
raw AS (SELECT doc_id, ticker, date,
  '<DOCUMENT>' || chr(10) || '<TYPE>10-K' || chr(10) || '<TEXT>' || chr(10) || '{TOC}' || chr(10) ||
  array_to_string(list_transform(string_split(text, chr(10)), lambda ln, i:
     CASE WHEN (i - 1) % 3 = 0 THEN {HDRS}[CAST(floor((i - 1) / 3) AS INTEGER) % 4 + 1] ELSE '' END || '<p>' || ln || '</p>'), chr(10))
  || chr(10) || '</TEXT>' || chr(10) || '</DOCUMENT>' || chr(10) ||
  '<DOCUMENT>' || chr(10) || '<TYPE>EX-21' || chr(10) || '<TEXT>' || chr(10) || string_split(text, chr(10))[1] ||
  chr(10) || '</TEXT>' || chr(10) || '</DOCUMENT>' || chr(10) AS raw FROM docs),
dl AS (SELECT doc_id, ticker, date, regexp_extract_all(raw, '(?s)<DOCUMENT>(.*?)</DOCUMENT>', 1) AS l FROM raw),
dsplit AS (SELECT doc_id, ticker, date, unnest(l) AS body, unnest(range(0, len(l))) AS doc_pos FROM dl),
dtyped AS (SELECT *, regexp_extract(body, '<TYPE>([^\\n]+)', 1) AS doc_type FROM dsplit),
main AS (SELECT * FROM dtyped WHERE doc_type = '10-K' QUALIFY row_number() OVER (PARTITION BY ticker, date, doc_id ORDER BY doc_pos) = 1),
hm AS (SELECT ticker, date, doc_id, length(body) AS text_len, string_split_regex(body, '{PAT}') AS pieces,
         regexp_extract_all(body, '{PAT}', 0) AS m FROM main),
he AS (SELECT ticker, date, doc_id, text_len, pieces, unnest(m) AS header, unnest(range(0, len(m))) AS i FROM hm),
hp AS (SELECT ticker, date, doc_id, text_len, header,
         CAST(sum(length(pieces[i + 1]) + length(header)) OVER (PARTITION BY ticker, date, doc_id ORDER BY i
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - length(header) AS BIGINT) AS start_pos FROM he),
hi AS (SELECT *, start_pos + length(header) AS end_pos,
         regexp_replace(lower(header), '&#160;|&nbsp;|\\s|\\.|>', '', 'g') AS item FROM hp),
hl AS (SELECT ticker, date, doc_id, item, arg_max(start_pos, start_pos) AS start_pos, arg_max(end_pos, start_pos) AS end_pos,
         arg_max(text_len, start_pos) AS text_len FROM hi GROUP BY ALL),
pos AS (SELECT ticker, date, doc_id, item, start_pos, end_pos,
          coalesce(lead(start_pos) OVER (PARTITION BY ticker, date, doc_id ORDER BY start_pos), text_len) AS next_start FROM hl
        UNION ALL
        SELECT ticker, date, doc_id, 'all', CAST(0 AS BIGINT), CAST(0 AS BIGINT), CAST(length(body) AS BIGINT) FROM main m
        WHERE NOT EXISTS (SELECT 1 FROM hi WHERE hi.doc_id = m.doc_id AND hi.ticker = m.ticker AND hi.date = m.date)),
secs AS (SELECT p.ticker, p.date, p.doc_id, p.item, substring(m.body, p.end_pos + 1, p.next_start - p.end_pos) AS section
         FROM pos p JOIN main m USING (ticker, date, doc_id))"""


def _strip(x):
    s = (f"regexp_replace(regexp_replace(regexp_replace(regexp_replace({x}, '(?is)<script[^>]*>.*?</script\\s*>', ' ', 'g'), "
         f"'(?is)<style[^>]*>.*?</style\\s*>', ' ', 'g'), '(?s)<!--.*?-->', ' ', 'g'), '<[^>]*>', ' ', 'g')")
    names = ", ".join(f"'{k}': chr({c})" for k, c in name2codepoint.items())
    code = "CASE WHEN e[2:2] = 'x' THEN CAST('0x' || e[3:] AS BIGINT) ELSE CAST(e[2:] AS BIGINT) END"
    e = (f"CASE WHEN e[1:1] = '#' THEN chr(CAST({code} AS INTEGER)) "
         f"ELSE coalesce(map_extract(MAP {{{names}}}, e)[1], '&' || e || ';') END")
    s = (f"array_to_string(list_transform(list_zip(string_split_regex({s}, '{tx.ENTITY}'), list_transform("
         f"regexp_extract_all({s}, '{tx.ENTITY}', 1), lambda e: {e})), lambda z: z[1] || coalesce(z[2], '')), '')")
    s = f"replace({s}, chr(160), ' ')"
    return f"lower(trim(regexp_replace({s}, '\\s+', ' ', 'g')))"


def _filings(spark, sf):
    configure(spark)
    return st.raw_filings(spark, sf)


def _main(spark, sf):
    return sc.main_documents(_filings(spark, sf))


@register("document_split", "WITH " + RAW + "\nSELECT doc_id, doc_pos, doc_type, length(body) AS body_len FROM dtyped")
def document_split(spark, sf):
    """Documents of each submission with position and type."""
    d = sc.split_documents(_filings(spark, sf))
    return d.select("doc_id", F.col("doc_pos").cast("bigint").alias("doc_pos"), "doc_type",
                    F.length("body").cast("bigint").alias("body_len"))


@register("section_positions", "WITH " + RAW + "\nSELECT doc_id, item, start_pos, end_pos, next_start FROM pos")
def section_positions(spark, sf):
    """10-K document, header matches normalised, last match
    per item, section end at the next header (audit table)."""
    p = sc.section_positions(_main(spark, sf))
    return p.select("doc_id", "item", "start_pos", "end_pos", "next_start")


@register("section_text", "WITH " + RAW + f"""
SELECT doc_id, item, length(section) AS n_chars, md5(section) AS section_md5,
  {_strip('section')} AS clean FROM secs""")
def section_text(spark, sf):
    """Section slices and their cleaned (HTML-stripped) text."""
    s = sc.section_text(_main(spark, sf))
    return s.select("doc_id", "item", F.length("section").cast("bigint").alias("n_chars"),
                    F.md5("section").alias("section_md5"), tx.strip_html("section").alias("clean"))


@register("clean_filing", "WITH " + RAW + f""",
cl AS (SELECT ticker, date, doc_id, item, {_strip('section')} AS clean FROM secs)
SELECT doc_id, string_agg(clean, ' ' ORDER BY item, clean) AS text FROM cl GROUP BY ticker, date, doc_id""")
def clean_filing(spark, sf):
    """Cleaned risk sections of each filing concatenated in item order."""
    return sc.clean_filing(_main(spark, sf)).select("doc_id", "text")


@register("html_clean", f"SELECT page_id, {_strip('html')} AS text FROM pages")
def html_clean(spark, sf):
    """raw web pages to lower-case text without scripts, styles, comments
    or tags, entities decoded."""
    configure(spark)
    p = read(spark, sf, "pages", "page_id", "html")
    return p.select("page_id", tx.strip_html("html").alias("text"))


@register("url_rewrite", """
SELECT page_id, replace(replace(url, '.example.', '.archive.'), '?page=', '-index.htm?page=') AS index_url,
  replace(replace(replace(url, '.example.', '.archive.'), '?page=', '-index.htm?page='), '-index.htm', '.txt') AS txt_url
FROM pages""")
def url_rewrite(spark, sf):
    """filing index URL ('-index.htm') rewritten to the text URL ('.txt')."""
    configure(spark)
    p = read(spark, sf, "pages", "page_id", "url")
    idx = F.replace(F.replace("url", F.lit(".example."), F.lit(".archive.")), F.lit("?page="),
                    F.lit("-index.htm?page="))
    return p.select("page_id", idx.alias("index_url"),
                    F.replace(idx, F.lit("-index.htm"), F.lit(".txt")).alias("txt_url"))


@register("file_key", "WITH " + DOCS + """,
fn AS (SELECT doc_id, '/data/filings/' || ticker || '_10-K_' || strftime(date, '%Y%m%d') || '.txt' AS path FROM docs),
pp AS (SELECT doc_id, path, string_split_regex(regexp_extract(path, '([^/]+)$', 1), '[._]') AS parts FROM fn)
SELECT doc_id, parts[1] AS ticker, parts[2] AS doc_type, CAST(strptime(parts[3], '%Y%m%d') AS DATE) AS date FROM pp""")
def file_key(spark, sf):
    """Ticker, type and date parsed from stored-filing names."""
    configure(spark)
    k = sc.file_key(st.file_names(spark, sf))
    return k.select("doc_id", "ticker", "doc_type", "date")


@register("longest_section", "WITH " + DOCS + """,
mk AS (SELECT doc_id, array_to_string(list_transform(string_split(text, chr(10)), lambda ln, i:
         'Item ' || CAST((i - 1) % 4 + 1 AS VARCHAR) || '. ' || ln), '°') AS text FROM docs),
pc AS (SELECT doc_id, unnest(string_split(lower(text), '°')) AS piece FROM mk),
wd AS (SELECT doc_id, string_split_regex(regexp_replace(piece, '^\\s+|\\s+$', '', 'g'), '\\s+') AS words FROM pc
       WHERE starts_with(piece, 'item ')),
it AS (SELECT doc_id, regexp_replace(words[2], '[.:,]', '', 'g') AS item, array_to_string(words[3:], ' ') AS text
       FROM wd WHERE len(words) > 1)
SELECT doc_id, item, md5(first(text ORDER BY length(text) DESC, text DESC)) AS text_md5,
       max(length(text)) AS n_chars FROM it GROUP BY doc_id, item""")
def longest_section(spark, sf):
    """Sections split on the degree sign, keyed by item, longest kept."""
    configure(spark)
    s = sc.longest_sections(st.section_marked(spark, sf))
    return s.select("doc_id", "item", F.md5("text").alias("text_md5"),
                    F.length("text").cast("bigint").alias("n_chars"))


SENT = "WITH " + DOCS + f""",
sp AS (SELECT doc_id, lang, unnest(string_split_regex(text, '{tx.SENTENCE_SPLIT}')) AS sentence,
         unnest(range(0, len(string_split_regex(text, '{tx.SENTENCE_SPLIT}')))) AS sent_id FROM docs),
sn AS (SELECT doc_id, lang, sent_id, list_filter(regexp_extract_all(lower(sentence), '{W1}', 1),
         lambda t: regexp_full_match(t, '\\p{{L}}+') AND NOT list_contains({STOPS}, t)) AS tokens FROM sp)"""


@register("sentences", SENT + """
SELECT doc_id, sent_id, array_to_string(tokens, ' ') AS tokens FROM sn WHERE len(tokens) >= 5""")
def sentences(spark, sf):
    """Sentences with their cleaned tokens, at least 5 tokens."""
    configure(spark)
    s = ng.sentence_table(st.documents(spark, sf), min_tokens=5)
    return s.select("doc_id", F.col("sent_id").cast("bigint").alias("sent_id"),
                    F.array_join("tokens", " ").alias("tokens"))


@register("sentences_per_group", SENT + """
SELECT lang, count(*) AS n_sentences FROM sn WHERE len(tokens) >= 5 GROUP BY lang""")
def sentences_per_group(spark, sf):
    """Number of kept sentences per language (the reference's
    sentences per item)."""
    configure(spark)
    s = ng.sentence_table(st.documents(spark, sf), min_tokens=5, group="lang")
    return s.groupBy("lang").agg(F.count(F.lit(1)).alias("n_sentences"))


@register("vocab_counts", SENT + """
SELECT token, count(*) AS n FROM (SELECT unnest(tokens) AS token FROM sn WHERE len(tokens) >= 5) GROUP BY token""")
def vocab_counts(spark, sf):
    """Token frequencies over the kept sentences."""
    configure(spark)
    return ng.vocab_counts(ng.sentence_table(st.documents(spark, sf), min_tokens=5))


@register("token_clean", "WITH " + DOCS + f"""
SELECT doc_id, len(regexp_extract_all(text, '{W1}', 1)) AS doc_len,
  len(list_filter(regexp_extract_all(lower(text), '{W1}', 1),
      lambda t: regexp_full_match(t, '\\p{{L}}+') AND NOT list_contains({STOPS}, t))) AS n_clean FROM docs""")
def token_clean(spark, sf):
    """Document length in \\w+ tokens and the count left after
    removing stop words and non-alphabetic tokens."""
    configure(spark)
    d = st.documents(spark, sf)
    return d.select("doc_id", tx.doc_len("text").cast("bigint").alias("doc_len"),
                    F.size(tx.clean_tokens(tx.tokens(F.lower("text")))).cast("bigint").alias("n_clean"))


LEX_CTE = f""",
tok AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '{W2}', 1)) AS term FROM docs),
cnt AS (SELECT doc_id, term, count(*) AS tf FROM tok GROUP BY ALL),
vocab AS (SELECT DISTINCT term AS word FROM cnt),
cand AS (""" + "\n  UNION ALL ".join(
    f"SELECT word, {i} AS rule, substring(word, 1, length(word) - {len(suf)}) || '{rep}' AS lemma FROM vocab "
    f"WHERE ends_with(word, '{suf}') AND length(word) > {len(suf) + 1}"
    for i, (suf, rep) in enumerate(bw.LEMMA_RULES)) + f"""),
lem AS (SELECT word, arg_min(lemma, rule) AS lemma FROM cand WHERE lemma IN (SELECT word FROM vocab) GROUP BY word),
ncnt AS (SELECT doc_id, coalesce(l.lemma, c.term) AS term, CAST(sum(tf) AS BIGINT) AS tf FROM cnt c LEFT JOIN lem l ON l.word = c.term
         WHERE NOT list_contains({STOPS}, coalesce(l.lemma, c.term)) GROUP BY ALL),
lw AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '{W2}', 1)) AS word FROM documents),
lw3 AS (SELECT word FROM lw WHERE length(word) >= 3),
lex0 AS (SELECT word, {SENTS}[ascii(word) % 6 + 1] AS sentiment FROM lw3
         UNION SELECT word, {SENTS}[length(word) % 6 + 1] FROM lw3 WHERE length(word) >= 10),
lex AS (SELECT DISTINCT coalesce(l.lemma, x.word) AS word, sentiment FROM lex0 x LEFT JOIN lem l USING (word)),
ndoc AS (SELECT count(*) AS n FROM docs),
dfq AS (SELECT term, count(*) AS df FROM ncnt GROUP BY term),
tfw AS (SELECT c.doc_id, x.sentiment, c.term, c.tf, c.tf * (ln((1 + n) / (1 + df)) + 1) AS w
        FROM ncnt c JOIN lex x ON x.word = c.term JOIN dfq USING (term), ndoc),
tfidf AS (SELECT doc_id, sentiment, term, tf, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id, sentiment)) AS tfidf FROM tfw)"""
TF_SQL = "WITH " + DOCS + LEX_CTE


class Corpus:
    """Shared Spark inputs of the bag-of-words jobs.  Vocabulary, lemmas,
    bags of lemmatised terms, lexicon with IDF, and the documents' sums are
    tables that the session's jobs share, each built when a job asks for it."""

    def __init__(self, spark, sf):
        configure(spark)
        self.docs = st.documents(spark, sf)
        self.share = lambda name, build: shared_table(spark, sf, name, build)
        self.n = self.docs.agg(F.count(F.lit(1)).alias("n"))
        self._lexicon = lambda: st.lexicon(spark, sf, self.vocab)

    @property
    def vocab(self):
        """(term) before lemmas."""
        return self.share("vocabulary", lambda: bw.vocabulary(self.docs))

    @property
    def lemmas(self):
        return self.share("lemmas", lambda: bw.lemma_table(self.vocab))

    @property
    def bags(self):
        """(doc_id, bag): lemmatised terms without stop words, and their counts."""
        return self.share("bags", lambda: bw.bags(bw.normalised_counts(bw.term_counts(self.docs), self.lemmas)))

    @property
    def counts(self):
        """(doc_id, term, tf)."""
        return bw.terms_of(self.bags)

    @property
    def frequencies(self):
        return self.share("frequencies", lambda: bw.document_frequencies(self.counts))

    @property
    def lex(self):
        return self.share("lexicon", lambda: bw.normalised_lexicon(self._lexicon(), self.lemmas))

    @property
    def weights(self):
        return self.share("weights", lambda: bw.term_weights(self.lex, self.frequencies, self.n))

    @property
    def sums(self):
        return self.share("sums", lambda: bw.tfidf_sums(self.counts, self.weights))

    def tfidf(self, lex=None, bags=None):
        """tf-idf of the lexicon or of another one, of all bags or of some."""
        weights, sums = self.weights if lex is None else None, None
        if lex is not None:
            weights = cut_lineage(bw.term_weights(lex, self.frequencies, self.n))
            sums = bw.tfidf_sums(self.counts, weights)
        return bw.tfidf(self.bags if bags is None else bags, weights, self.sums if sums is None else sums)

    def scores(self):
        """The scores of every filing and list."""
        return self.share("scores", lambda: bw.sentiment_scores(self.docs, self.sums))

    def pairs(self):
        # (date, doc_id) as one number: any doc_id of 64 bits stays below 10**19
        days = F.datediff("date", F.lit("1970-01-01").cast("date")).cast("decimal(10,0)")
        return bw.pairs(self.docs.withColumn("ord", days * F.lit(Decimal(10 ** 19)) + F.col("doc_id").cast("decimal(19,0)")))


@register("lemmas", TF_SQL + "\nSELECT word, lemma FROM lem")
def lemmas(spark, sf):
    """Word -> lemma by suffix rules checked against the vocabulary."""
    return Corpus(spark, sf).lemmas


@register("bow", TF_SQL + "\nSELECT c.doc_id, x.sentiment, c.term, c.tf FROM ncnt c JOIN lex x ON x.word = c.term")
def bow(spark, sf):
    """Lemmatised, stop-word-free counts over each sentiment vocabulary."""
    c = Corpus(spark, sf)
    return bw.bag_of_words(c.counts, c.weights).select("doc_id", "sentiment", "term", "tf")


@register("lexicon_stats", TF_SQL + """,
multi AS (SELECT word FROM lex GROUP BY word HAVING count(*) > 1)
SELECT sentiment, count(*) AS n_words, count(*) FILTER (WHERE word IN (SELECT word FROM multi)) AS n_shared
FROM lex GROUP BY sentiment""")
def lexicon_stats(spark, sf):
    """Words per sentiment list and how many sit in several lists."""
    return bw.lexicon_stats(Corpus(spark, sf).lex)


@register("tfidf", TF_SQL + "\nSELECT doc_id, sentiment, term, round(tfidf, 8) AS tfidf FROM tfidf")
def tfidf(spark, sf):
    """Tf-idf per sentiment vocabulary, corpus-wide IDF, L2 rows."""
    return Corpus(spark, sf).tfidf().select("doc_id", "sentiment", "term", r8("tfidf"))


@register("tfidf_min_max_df", "WITH " + DOCS + LEX_CTE.replace(
    "tfw AS (SELECT c.doc_id, x.sentiment, c.term, c.tf, c.tf * (ln((1 + n) / (1 + df)) + 1) AS w\n"
    "        FROM ncnt c JOIN lex x ON x.word = c.term JOIN dfq USING (term), ndoc)",
    "vx AS (SELECT term AS word, 'all' AS sentiment FROM dfq, ndoc WHERE df / n >= 0.01 AND df / n <= 0.95),\n"
    "tfw AS (SELECT c.doc_id, x.sentiment, c.term, c.tf, c.tf * (ln((1 + n) / (1 + df)) + 1) AS w\n"
    "        FROM ncnt c JOIN vx x ON x.word = c.term JOIN dfq USING (term), ndoc)") +
    "\nSELECT doc_id, term, round(tfidf, 8) AS tfidf FROM tfidf")
def tfidf_min_max_df(spark, sf):
    """Tf-idf over corpus words present in 1 %-95 % of the documents."""
    c = Corpus(spark, sf)
    v = bw.df_filtered_vocab(c.frequencies, c.n, 0.01, 0.95)
    return c.tfidf(v).select("doc_id", "term", r8("tfidf"))


@register("tfidf_combined", TF_SQL + f""",
first_s AS (SELECT word, arg_min(sentiment, list_position({SENTS}, sentiment)) AS first FROM lex GROUP BY word)
SELECT t.doc_id, t.sentiment, t.term, round(t.tfidf, 8) AS tfidf FROM tfidf t
JOIN first_s f ON f.word = t.term WHERE t.sentiment = f.first""")
def tfidf_combined(spark, sf):
    """Merged sentiment matrices, a shared word kept by the first list."""
    c = Corpus(spark, sf)
    keep, _ = bw.combined(c.tfidf(), c.lex)
    return keep.select("doc_id", "sentiment", "term", r8("tfidf"))


@register("lexicon_overlap", TF_SQL + f""",
first_s AS (SELECT word, arg_min(sentiment, list_position({SENTS}, sentiment)) AS first FROM lex GROUP BY word)
SELECT sentiment, count(*) AS removed FROM lex JOIN first_s USING (word) WHERE sentiment <> first GROUP BY sentiment""")
def lexicon_overlap(spark, sf):
    """Words removed from each list by the first-list-wins merge."""
    return bw.overlap(Corpus(spark, sf).lex)


PAIRS = """,
pr AS (SELECT ticker, lag(doc_id) OVER (PARTITION BY ticker ORDER BY date, doc_id) AS doc_a, doc_id AS doc_b FROM docs
       QUALIFY doc_a IS NOT NULL),
prs AS (SELECT pr.*, unnest(""" + SENTS + """) AS sentiment FROM pr)"""


@register("jaccard_neighbours", TF_SQL + PAIRS + """,
ts AS (SELECT DISTINCT c.doc_id, x.sentiment, c.term FROM ncnt c JOIN lex x ON x.word = c.term),
sz AS (SELECT doc_id, sentiment, count(*) AS n FROM ts GROUP BY ALL),
it AS (SELECT p.doc_a, p.doc_b, a.sentiment, count(*) AS inter FROM pr p JOIN ts a ON a.doc_id = p.doc_a
       JOIN ts b ON b.doc_id = p.doc_b AND b.sentiment = a.sentiment AND b.term = a.term GROUP BY ALL)
SELECT p.ticker, p.doc_a, p.doc_b, p.sentiment, round(coalesce(inter, 0) /
  NULLIF(coalesce(sa.n, 0) + coalesce(sb.n, 0) - coalesce(inter, 0), 0), 8) AS jaccard
FROM prs p LEFT JOIN it USING (doc_a, doc_b, sentiment)
LEFT JOIN sz sa ON sa.doc_id = p.doc_a AND sa.sentiment = p.sentiment
LEFT JOIN sz sb ON sb.doc_id = p.doc_b AND sb.sentiment = p.sentiment""")
def jaccard_neighbours(spark, sf):
    """Jaccard similarity of consecutive filings of a ticker, per list."""
    c = Corpus(spark, sf)
    j = bw.jaccard(c.bags, c.weights, c.sums, cut_lineage(c.pairs()))
    return j.select("ticker", "doc_a", "doc_b", "sentiment", r8("jaccard"))


@register("cosine_neighbours", TF_SQL + PAIRS + """,
dt AS (SELECT p.doc_a, p.doc_b, a.sentiment, sum(a.tfidf * b.tfidf) AS dot FROM pr p JOIN tfidf a ON a.doc_id = p.doc_a
       JOIN tfidf b ON b.doc_id = p.doc_b AND b.sentiment = a.sentiment AND b.term = a.term GROUP BY ALL),
nr AS (SELECT doc_id, sentiment, sqrt(sum(tfidf * tfidf)) AS nrm FROM tfidf GROUP BY ALL)
SELECT p.ticker, p.doc_a, p.doc_b, p.sentiment, round(coalesce(dot, 0) / (na.nrm * nb.nrm), 8) AS cosine
FROM prs p LEFT JOIN dt USING (doc_a, doc_b, sentiment)
LEFT JOIN nr na ON na.doc_id = p.doc_a AND na.sentiment = p.sentiment
LEFT JOIN nr nb ON nb.doc_id = p.doc_b AND nb.sentiment = p.sentiment""")
def cosine_neighbours(spark, sf):
    """Cosine similarity of consecutive filings' tf-idf rows, per list."""
    c = Corpus(spark, sf)
    j = bw.cosine(c.bags, c.weights, c.sums, cut_lineage(c.pairs()))
    return j.select("ticker", "doc_a", "doc_b", "sentiment", r8("cosine"))


SCORE_CTE = f""",
base AS (SELECT doc_id, ticker, date, lang, len(regexp_extract_all(text, '{W1}', 1)) AS doc_len,
           unnest({SENTS}) AS sentiment FROM docs),
ss AS (SELECT doc_id, sentiment, sum(tfidf) AS score FROM tfidf GROUP BY ALL),
scores AS (SELECT b.*, coalesce(s.score, 0) AS score, coalesce(s.score, 0) / NULLIF(doc_len, 0) AS score_scaled
           FROM base b LEFT JOIN ss s USING (doc_id, sentiment))"""
SCORE = TF_SQL + SCORE_CTE


@register("sentiment_score", SCORE + """
SELECT doc_id, sentiment, doc_len, round(score, 8) AS score, round(score_scaled, 10) AS score_scaled FROM scores""")
def sentiment_score(spark, sf):
    """Raw and length-scaled sentiment score per filing and list."""
    c = Corpus(spark, sf)
    s = c.scores()
    return s.select("doc_id", "sentiment", "doc_len", r8("score"), F.round("score_scaled", 10).alias("score_scaled"))


@register("sentiment_change", SCORE + PAIRS + """
SELECT p.ticker, p.doc_b AS doc_id, b.sentiment, round(b.score / NULLIF(a.score, 0) - 1, 8) AS score_change
FROM pr p JOIN scores a ON a.doc_id = p.doc_a JOIN scores b ON b.doc_id = p.doc_b AND b.sentiment = a.sentiment""")
def sentiment_change(spark, sf):
    """Change of a filing's score against the ticker's previous filing."""
    c = Corpus(spark, sf)
    s = c.scores()
    pr = c.pairs()
    a = s.select(F.col("doc_id").alias("doc_a"), "sentiment", F.col("score").alias("sa"))
    b = s.select(F.col("doc_id").alias("doc_b"), "sentiment", F.col("score").alias("sb"))
    j = pr.join(a, "doc_a").join(b, ["doc_b", "sentiment"])
    return j.select("ticker", F.col("doc_b").alias("doc_id"), "sentiment",
                    r8(F.try_divide("sb", "sa") - 1, "score_change"))


@register("score_length_corr", SCORE + """
SELECT sentiment, round(CASE WHEN isnan(corr(score, doc_len)) THEN NULL ELSE corr(score, doc_len) END, 8) AS corr_len FROM scores GROUP BY sentiment""")
def score_length_corr(spark, sf):
    """Correlation of the raw score with document length per list."""
    c = Corpus(spark, sf)
    s = c.scores()
    return s.groupBy("sentiment").agg(r8(nn(stats.corr("score", "doc_len")), "corr_len"))


@register("score_corr_by_ticker", SCORE + """
SELECT sentiment, ticker, round(""" + "CASE WHEN isnan(corr(score, doc_len)) THEN NULL ELSE corr(score, doc_len) END" + """, 8) AS corr_len
FROM scores GROUP BY sentiment, ticker""")
def score_corr_by_ticker(spark, sf):
    """Score-length correlation within each ticker."""
    c = Corpus(spark, sf)
    s = c.scores()
    return s.groupBy("sentiment", "ticker").agg(r8(nn(stats.corr("score", "doc_len")), "corr_len"))


@register("sentiment_alpha", SCORE + """,
ya AS (SELECT *, CAST(date_trunc('year', date) AS DATE) AS year FROM scores),
dm AS (SELECT *, score_scaled - avg(score_scaled) OVER (PARTITION BY sentiment, year, lang) AS d FROM ya),
rk AS (SELECT *, rank() OVER (PARTITION BY sentiment, year ORDER BY round(d, 10))
         + (count(*) OVER (PARTITION BY sentiment, year, round(d, 10)) - 1) / 2.0 AS r FROM dm WHERE d IS NOT NULL),
z AS (SELECT *, (r - avg(r) OVER (PARTITION BY sentiment, year)) / NULLIF(stddev_samp(r) OVER (PARTITION BY sentiment, year), 0) AS zz FROM rk)
SELECT doc_id, sentiment, year, round(zz * CASE WHEN sentiment IN ('positive', 'interesting') THEN 1 ELSE -1 END, 8) AS alpha FROM z""")
def sentiment_alpha(spark, sf):
    """Signed sentiment alpha per list, filings re-stamped
    to 1 January, sector = language."""
    c = Corpus(spark, sf)
    s = c.scores().withColumn("year", F.trunc("date", "year"))
    a = bw.sentiment_alpha(s.filter(F.col("score_scaled").isNotNull()))
    return a.select("doc_id", "sentiment", "year", r8("alpha"))


NG = SENT + """,
s5 AS (SELECT doc_id, sent_id, tokens FROM sn WHERE len(tokens) >= 5),
uni AS (SELECT token, count(*) AS n FROM (SELECT unnest(tokens) AS token FROM s5) GROUP BY token),
tot AS (SELECT sum(n) AS total FROM uni),
bg AS (SELECT doc_id, sent_id, unnest(range(0, len(tokens) - 1)) AS i, tokens FROM s5 WHERE len(tokens) > 1),
bi AS (SELECT tokens[i + 1] AS a, tokens[i + 2] AS b, count(*) AS count FROM bg GROUP BY ALL HAVING count(*) >= 5),
ph AS (SELECT a, b, count, ln((count / total) / ((ua.n / total) * (ub.n / total))) / (-ln(count / total)) AS score
       FROM bi JOIN uni ua ON ua.token = a JOIN uni ub ON ub.token = b, tot)"""


@register("phrases_npmi", NG + "\nSELECT a, b, count, round(score, 8) AS score FROM ph WHERE score > 0.3")
def phrases_npmi(spark, sf):
    """Bigram phrases by normalised PMI (count >= 5, score > 0.3)."""
    configure(spark)
    s = ng.sentence_table(st.documents(spark, sf), min_tokens=5)
    return ng.detect_phrases(s, 5, 0.3).select("a", "b", "count", r8("score"))


APPLIED = NG + """,
acc AS (SELECT a, b FROM ph WHERE score > 0.3),
fl AS (SELECT g.doc_id, g.sent_id, g.i, g.tokens, (acc.a IS NOT NULL) AS hit FROM bg g
       LEFT JOIN acc ON acc.a = g.tokens[g.i + 1] AND acc.b = g.tokens[g.i + 2]),
isl AS (SELECT *, i - sum(CASE WHEN hit THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id, sent_id ORDER BY i
          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS grp FROM fl),
run AS (SELECT *, CASE WHEN hit THEN row_number() OVER (PARTITION BY doc_id, sent_id, grp, hit ORDER BY i) END AS k FROM isl),
st_ AS (SELECT doc_id, sent_id, i FROM run WHERE hit AND k % 2 = 1),
tk AS (SELECT s.doc_id, s.sent_id, unnest(range(0, len(s.tokens))) AS j, s.tokens FROM s5 s),
out AS (SELECT tk.doc_id, tk.sent_id, tk.j,
          CASE WHEN a.i IS NOT NULL THEN tokens[j + 1] || '_' || tokens[j + 2] ELSE tokens[j + 1] END AS tok,
          (b.i IS NOT NULL) AS dropped
        FROM tk LEFT JOIN st_ a ON a.doc_id = tk.doc_id AND a.sent_id = tk.sent_id AND a.i = tk.j
        LEFT JOIN st_ b ON b.doc_id = tk.doc_id AND b.sent_id = tk.sent_id AND b.i = tk.j - 1)"""


@register("phrases_applied", APPLIED + """
SELECT doc_id, sent_id, string_agg(tok, ' ' ORDER BY j) AS tokens FROM out WHERE NOT dropped GROUP BY ALL""")
def phrases_applied(spark, sf):
    """Accepted bigrams merged greedily left to right in every sentence."""
    configure(spark)
    s = ng.stored(ng.sentence_table(st.documents(spark, sf), min_tokens=5))
    out = ng.apply_phrases(s, ng.detect_phrases(s, 5, 0.3))
    return out.select("doc_id", F.col("sent_id").cast("bigint").alias("sent_id"),
                      F.array_join("tokens", " ").alias("tokens"))


@register("phrase_catalogue", APPLIED + """,
m5 AS (SELECT doc_id, sent_id, list(tok ORDER BY j) AS tokens FROM out WHERE NOT dropped GROUP BY ALL),
u2 AS (SELECT token, count(*) AS n FROM (SELECT unnest(tokens) AS token FROM m5) GROUP BY token),
t2 AS (SELECT sum(n) AS total FROM u2),
g2 AS (SELECT tokens[i + 1] AS a, tokens[i + 2] AS b, count(*) AS count FROM (
         SELECT unnest(range(0, len(tokens) - 1)) AS i, tokens FROM m5 WHERE len(tokens) > 1) GROUP BY ALL HAVING count(*) >= 5),
p2 AS (SELECT a, b, count, ln((count / total) / ((ua.n / total) * (ub.n / total))) / (-ln(count / total)) AS score
       FROM g2 JOIN u2 ua ON ua.token = a JOIN u2 ub ON ub.token = b, t2),
both_ AS (SELECT a, b, score, count, 2 AS length FROM ph WHERE score > 0.3
          UNION ALL SELECT a, b, score, count, 3 FROM p2 WHERE score > 0.3)
SELECT replace(a, '_', ' ') || ' ' || replace(b, '_', ' ') AS phrase, round(score, 8) AS score, count,
  CAST(length AS INTEGER) AS length, replace(replace(a, '_', ' ') || ' ' || replace(b, '_', ' '), ' ', '_') AS ngram FROM both_""")
def phrase_catalogue(spark, sf):
    """Two detection passes (phrases up to three words) with
    blank and underscore spellings, score and length."""
    configure(spark)
    s = ng.sentence_table(st.documents(spark, sf), min_tokens=5)
    return ng.phrase_passes(s, 3, 5, 0.3).select("phrase", r8("score"), "count", "length", "ngram")


@register("label_by_membership", TF_SQL + f"""
SELECT word, arg_max(sentiment, list_position({SENTS}, sentiment)) AS label FROM lex GROUP BY word""")
def label_by_membership(spark, sf):
    """One label per lexicon word by list membership, a later list
    overriding an earlier one."""
    c = Corpus(spark, sf)
    pr = F.array_position(F.array(*[F.lit(s) for s in st.SENTIMENTS]), F.col("sentiment"))
    return c.lex.groupBy("word").agg(F.max_by("sentiment", pr).alias("label"))


@register("filing_returns", "WITH " + DOCS + ",\n" + __import__("factorspark.queries.sqlkit", fromlist=["PW"]).PW.strip()
          + ",\n" + __import__("factorspark.queries.sqlkit", fromlist=["CAL"]).CAL.strip() + f""",
ta AS (SELECT DISTINCT ticker, CAST(regexp_extract(ticker, '(\\d+)$', 1) AS BIGINT) + 1 AS asset FROM docs),
yr AS (SELECT asset, year(date) AS year, max_by(close, date) AS close FROM bars GROUP BY ALL),
yf AS (SELECT asset, year, lead(close) OVER (PARTITION BY asset ORDER BY year) / NULLIF(close, 0) - 1 AS fwd_1y FROM yr),
nx AS (SELECT f.date, min(c.session_idx) AS next_idx FROM (SELECT DISTINCT date FROM docs) f
       JOIN cal c ON c.date >= f.date GROUP BY f.date),
f5 AS (SELECT asset, session_idx, {__import__("factorspark.queries.sqlkit", fromlist=["fwd"]).fwd('close', 5)} AS fwd_5 FROM p)
SELECT d.doc_id, CAST(len(regexp_extract_all(d.text, '{W1}', 1)) AS BIGINT) AS doc_len,
  round(yf.fwd_1y, 8) AS fwd_1y, round(f5.fwd_5, 8) AS fwd_5
FROM docs d JOIN ta USING (ticker)
LEFT JOIN yf ON yf.asset = ta.asset AND yf.year = year(d.date)
LEFT JOIN nx ON nx.date = d.date
LEFT JOIN f5 ON f5.asset = ta.asset AND f5.session_idx = nx.next_idx""")
def filing_returns(spark, sf):
    """Filing features joined to the ticker's returns: the next
    year's return (filing re-stamped to 1 January) and the 5-session return
    from the first session on or after the filing date."""
    from pyspark.sql import Window
    from ..operators import ts
    from ..sources import panels
    from ..session import small_dim
    from .common import pw
    configure(spark)
    docs = st.documents(spark, sf)
    bars = pw(spark, sf)
    cal = panels.calendar(bars)
    p = panels.with_session(bars, cal)
    ta = st.ticker_assets(docs)
    yr = bars.groupBy("asset", F.year("date").alias("year")).agg(F.max_by("close", "date").alias("close"))
    yf = yr.select("asset", "year", (F.try_divide(F.lead("close").over(
        Window.partitionBy("asset").orderBy("year")), F.col("close")) - 1).alias("fwd_1y"))
    # first session on/after each filing day: a window on the small
    # (filing days + sessions) table, then a bounded broadcast
    days = docs.select("date").distinct().select("date", F.lit(None).cast("int").alias("session_idx"))
    u = days.unionByName(cal.select("date", "session_idx"))
    w = Window.orderBy("date", F.col("session_idx").asc_nulls_first()).rowsBetween(0, Window.unboundedFollowing)
    nx = (u.withColumn("next_idx", F.first("session_idx", ignorenulls=True).over(w))
          .filter(F.col("session_idx").isNull()).select("date", "next_idx"))
    f5 = p.select("asset", F.col("session_idx").alias("next_idx"), ts.fwd_return("close", 5).alias("fwd_5"))
    d = (docs.select("doc_id", "ticker", "date", tx.doc_len("text").cast("bigint").alias("doc_len"))
         .join(ta, "ticker").withColumn("year", F.year("date"))
         .join(yf, ["asset", "year"], "left")
         .join(small_dim(nx, panels.CALENDAR_BOUND), "date", "left")
         .join(f5, ["asset", "next_idx"], "left"))
    return d.select("doc_id", "doc_len", r8("fwd_1y"), r8("fwd_5"))
