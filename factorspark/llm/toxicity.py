"""Operator 6, toxicity: a convolutional text classifier trained in numpy.

A word's vector is the sum of hashed embeddings of the word and of its first
four and six bytes.  Filters of widths one to three run over the words; the
largest response of each over the whole text goes through a rectifier into a
logistic unit.  Gradients flow to the places of the maxima alone, so a step
touches few embeddings; all parameters are trained by Adagrad.  Embeddings of
fewer than ``MIN_TEXTS`` training texts stay zero.

Training, in one task, uses a bounded sample of the labelled rows: of each class the
``train_rows`` with the smallest id hashes, texts up to ``train_chars``
characters, none of them from the fifth of the ids that is kept apart.  All
other labelled rows, whole texts, calibrate a threshold for each language: of
those with at least ``precision`` the one with the best F1, or none is
rejected.  They are scored in a Spark job without a shuffle of texts; what
returns are counts by language, label and bin of the score.  The sample takes
more of the rarer class, so each class weighs what it has with the trained
rows: precision is that of the labels' own share.  Languages with fewer than
``min_positive`` toxic rows have the threshold of all rows together.  The
language chooses the threshold and is no input of the score.

Scoring streams over the documents, whole texts, without a shuffle; the model
has a fixed size (2 MB).

Defined cases: a null or empty text scores as padding alone; without labels
of both classes every score is the share of toxic labels (0 without labels);
rows that repeat an id score one by one, and the one with the smallest text is
trained on; of labels that repeat an id the largest counts; labels that are null, or of no document, are left out; further
columns are kept by ``reject``; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import frugal, prepare, query, table, texts
from .words import SPACED, U64, Words

#: The training sample's bounds: rows of each class, characters of a text.
TRAIN_ROWS, TRAIN_CHARS = 3000, 100_000
#: Bins of the score for each unit of its log-odds.
BINS = 128

BUCKETS, DIM, FILTERS, WIDTHS = 1 << 16, 8, 8, (1, 2, 3)
PREFIXES = (4, 6)
EPOCHS, BATCH, RATE, SEED = 4, 32, 0.1, 7
#: Steps of training at least, however few the rows.
STEPS = 600
PAD = max(WIDTHS) - 1
#: Training texts that an embedding must occur in; others are as padding, so
#: that words of a single text can't be learnt by heart.
MIN_TEXTS = 3
#: Words that are scored at a time.
SLICE = 1 << 15

SCORE = "_llm_score"


def features(column) -> tuple[np.ndarray, np.ndarray]:
    """(ids, first): embedding numbers of every word, and where texts begin.
    Each text ends in ``PAD`` words without a vector (number 0)."""
    w = Words(column, SPACED, True, prefixes=PREFIXES)
    n = len(w.first) - 1
    first = w.first + PAD * np.arange(n + 1)
    ids = np.zeros((int(first[-1]), 1 + len(PREFIXES)), np.int32)
    at = np.arange(len(w.hash)) + PAD * np.repeat(np.arange(n), np.diff(w.first))
    for j, h in enumerate((w.hash, *w.prefix)):
        ids[at, j] = (h >> U64(20)).astype(np.int64) % BUCKETS + 1
    return ids, first


def gathered(column, size: int = 500) -> tuple[np.ndarray, np.ndarray]:
    """``features`` of many texts, some at a time."""
    found = [features(column.slice(i, size)) for i in range(0, len(column), size)]
    first = np.cumsum(np.concatenate([[0], *(np.diff(f) for _, f in found)]))
    return np.concatenate([i for i, _ in found]), first


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Network:
    """The classifier; ``embed[0]`` is the vector of padding and stays zero."""

    def __init__(self, share: float = 0.0, seed: int = SEED):
        rng = np.random.default_rng(seed)
        draw = lambda scale, *size: rng.normal(0, scale, size).astype(np.float32)
        self.share, self.rng = share, rng
        self.embed = draw(0.1, BUCKETS + 1, DIM)
        self.embed[0] = 0
        self.filters = [draw(0.3, k, DIM, FILTERS) for k in WIDTHS]
        self.shift = np.zeros(FILTERS * len(WIDTHS), np.float32)
        self.out = draw(0.1, FILTERS * len(WIDTHS))
        self.bias = np.zeros(1, np.float32)
        self.trained = False

    def _vectors(self, ids):
        x = self.embed[ids[:, 0]]
        for j in range(1, ids.shape[1]):
            x += self.embed[ids[:, j]]
        return x

    def _respond(self, x, first):
        """Of each width: responses at every place; places whose filter would
        reach into the next text count for nothing."""
        for k, w in zip(WIDTHS, self.filters):
            z = x @ w[0]
            for j in range(1, k):
                z[:-j] += x[j:] @ w[j]
                z[first[1:] - j] = -np.inf
            yield z, np.maximum.reduceat(z, first[:-1], axis=0)

    def logit(self, ids, first):
        if not self.trained:
            return np.full(len(first) - 1, np.log((self.share + 1e-6) / (1 - self.share + 1e-6)))
        out = []
        i = 0
        while i < len(first) - 1:
            j = max(int(np.searchsorted(first, first[i] + SLICE, "right")) - 1, i + 1)
            own = first[i:j + 1] - first[i]
            x = self._vectors(ids[first[i]:first[j]])
            pooled = np.concatenate([p for _, p in self._respond(x, own)], axis=1)
            out.append(np.maximum(pooled + self.shift, 0) @ self.out + self.bias)
            i = j
        return np.concatenate(out).astype(np.float64) if out else np.zeros(0)

    def _step(self, ids, first, y, state):
        x, n = self._vectors(ids), len(first) - 1
        responses = list(self._respond(x, first))
        pooled = np.concatenate([p for _, p in responses], axis=1) + self.shift
        hidden = np.maximum(pooled, 0)
        g = (_sigmoid(hidden @ self.out + self.bias) - y).astype(np.float32) / n
        back = g[:, None] * self.out * (pooled > 0)
        owner = np.repeat(np.arange(n), np.diff(first))
        rows, grads = [], []
        for q, (k, w, (z, p)) in enumerate(zip(WIDTHS, self.filters, responses)):
            r, c = np.nonzero(z == p[owner])
            _, one = np.unique(owner[r] * FILTERS + c, return_index=True)    # the first of equal maxima
            r, c = r[one], c[one]
            own = back[owner[r], q * FILTERS + c]
            gw = np.zeros_like(w)
            for j in range(k):
                np.add.at(gw[j].T, c, own[:, None] * x[r + j])
                rows.append(r + j)
                grads.append(own[:, None] * w[j][:, c].T)
            self._move(w, gw, state[q])
        used, inverse = np.unique(ids[np.concatenate(rows)], return_inverse=True)
        ge = np.zeros((len(used), DIM), np.float32)
        np.add.at(ge, inverse.reshape(-1), np.repeat(np.concatenate(grads), ids.shape[1], axis=0))
        ge[used == 0] = 0
        seen = state["embed"]
        seen[used] += (ge * ge).mean(1, keepdims=True)
        self.embed[used] -= RATE * ge / np.sqrt(seen[used])
        self._move(self.out, hidden.T @ g, state["out"])
        self._move(self.shift, back.sum(0), state["shift"])
        self._move(self.bias, g.sum(keepdims=True), state["bias"])

    @staticmethod
    def _move(p, g, seen):
        seen += g * g
        p -= RATE * g / np.sqrt(seen)

    def train(self, ids, first, y, epochs: int = EPOCHS):
        like = lambda p: np.full_like(p, 1e-3)
        texts = np.zeros(len(self.embed), np.int64)
        for a, z in zip(first, first[1:]):
            texts[np.unique(ids[a:z])] += 1
        self.embed[texts < MIN_TEXTS] = 0
        ids[(texts < MIN_TEXTS)[ids]] = 0
        state = {q: like(w) for q, w in enumerate(self.filters)}
        state |= {"out": like(self.out), "shift": like(self.shift), "bias": like(self.bias),
                  "embed": np.full((len(self.embed), 1), 1e-3, np.float32)}
        size = np.diff(first)
        for _ in range(max(epochs, -(-STEPS * BATCH // len(y)))):
            order = self.rng.permutation(len(y))
            for i in range(0, len(order), BATCH):
                k = order[i:i + BATCH]
                own = np.r_[0, np.cumsum(size[k])]
                self._step(np.concatenate([ids[first[d]:first[d + 1]] for d in k]), own, y[k], state)
        self.trained = True
        return self

    def dumps(self) -> bytes:
        """The trained parameters, one after the other."""
        return b"".join(np.ascontiguousarray(p, np.float32).tobytes() for p in self._parameters())

    @classmethod
    def loads(cls, raw: bytes) -> Network:
        out, at = cls(), 0
        for p in out._parameters():
            p[...] = np.frombuffer(raw, np.float32, p.size, at).reshape(p.shape)
            at += p.nbytes
        out.trained = True
        return out

    def _parameters(self):
        return [self.embed, *self.filters, self.shift, self.out, self.bias]

    def score(self, column) -> np.ndarray:
        return _sigmoid(self.logit(*features(column)))


def best_threshold(scores: np.ndarray, y: np.ndarray, precision: float, weight=None, low=None, high=None) -> float:
    """Of the thresholds that reach the precision the one with the best F1,
    half-way between two scores; 1, which no score reaches, if there is none.
    An entry can stand for ``weight`` rows in a bin ``scores``, whose scores
    lie between ``low`` and ``high``."""
    o = np.argsort(-scores, kind="stable")
    s, w = scores[o], np.ones(len(o), int) if weight is None else weight[o]
    low, high = s if low is None else low[o], s if high is None else high[o]
    hits, n = np.cumsum(y[o] * w), np.cumsum(w)
    ends = np.r_[s[1:] != s[:-1], True]          # equal scores are told apart by none
    fine = ends & (hits >= precision * n) & (hits > 0)
    if not fine.any():
        return 1.0
    k = int(np.argmax(np.where(fine, 2 * hits / (n + (y[o] * w).sum()), -1)))
    rest = s[k + 1:]
    return float((low[s == s[k]].min() + (high[s == rest[0]].max() if len(rest) else 0)) / 2)


class Classifier:
    """The trained network, the thresholds by language, and that of others."""

    def __init__(self, network: Network, thresholds: dict[str, float], other: float):
        self.network, self.thresholds, self.other = network, thresholds, other

    def threshold(self, lang):
        out = F.lit(self.other)
        for k, t in self.thresholds.items():
            out = F.when(lang.eqNullSafe(F.lit(k)), F.lit(t)).otherwise(out)
        return out


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        label_col: str = "toxic", train_rows: int = TRAIN_ROWS, train_chars: int = TRAIN_CHARS,
        min_positive: int = 20, precision: float = 0.9) -> Classifier:
    """Train on the labelled rows of ``labels`` (id, 0/1); the caller leaves
    out what is not to be learnt from."""
    prepare(docs.sparkSession)
    known = (labels.select(labels[id_col].cast("long").alias("id"), labels[label_col].cast("int").alias("y"))
             .where("id IS NOT NULL AND y IS NOT NULL").groupBy("id").agg((F.max("y") > 0).cast("int").alias("y"))
             .withColumn("h", F.xxhash64("id")).withColumn("apart", F.pmod("h", F.lit(5)) == 0))
    picked = None
    for y in (0, 1):
        own = known.where((F.col("y") == y) & ~F.col("apart")).orderBy("h", "id").limit(train_rows)
        picked = own if picked is None else picked.unionAll(own)
    lang = docs[lang_col] if lang_col in docs.columns else F.lit(None)
    d = docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].cast("string").alias("text"),
                    lang.cast("string").alias("lang"))
    # At most 2 * train_rows ids: a bounded side.
    rows = (d.where(F.length("text") <= train_chars).join(F.broadcast(picked), "id")
            .groupBy("h", "id", "y").agg(F.min("text").alias("text")))
    trained = (rows.repartition(1).sortWithinPartitions("h", "id")
               .mapInArrow(frugal(_train), "network binary, ids binary").first())
    if trained is None:
        both = d.join(known, "id").agg(F.avg("y")).first()[0]
        return Classifier(Network(float(both or 0.0)), {}, 0.5)
    fitted = docs.sparkSession.createDataFrame(
        pa.table({"id": np.frombuffer(trained["ids"], np.int64)}))
    return _calibrated(Network.loads(trained["network"]), d, known, fitted, min_positive, precision)


def _train(batches):
    """The network of the sample's rows, which one task holds: at most twice
    ``train_rows`` texts of ``train_chars`` characters, made into numbers batch
    by batch."""
    found, y, own = [], [], []
    for batch in batches:
        found.append(gathered(batch.column("text")))
        y.append(batch.column("y").to_numpy())
        own.append(batch.column("id").to_numpy())
    y = np.concatenate(y).astype(np.float32) if y else np.zeros(0, np.float32)
    if not 0 < y.sum() < len(y):
        return
    first = np.cumsum(np.concatenate([[0], *(np.diff(f) for _, f in found)]))
    ids = np.concatenate([i for i, _ in found])
    del found
    network = Network().train(ids, first, y)
    yield pa.RecordBatch.from_arrays(
        [pa.array([network.dumps()], pa.binary()), pa.array([np.concatenate(own).tobytes()], pa.binary())],
        ["network", "ids"])


def _calibrated(network: Network, d: DataFrame, known: DataFrame, fitted: DataFrame, min_positive: int,
                precision: float) -> Classifier:
    """Thresholds from all labelled rows of ``d`` that are not ``fitted``."""
    score = F.col(SCORE)
    seen = (_scored(d, "text", network).select("id", "lang", score)
            .join(known.select("id", "y"), "id").join(F.broadcast(fitted.withColumn("own", F.lit(True))), "id", "left"))
    found = (seen.withColumn("own", F.col("own").isNotNull())
             .withColumn("bin", F.floor(F.log(score / (1 - score)) * BINS))
             .groupBy("own", "lang", "y", "bin")
             .agg(F.count(F.lit(1)).alias("n"), F.min(score).alias("low"), F.max(score).alias("high")).toArrow())
    own, y, bins, n, low, high = (found.column(c).to_numpy(zero_copy_only=False) for c in ("own", "y", "bin", "n", "low", "high"))
    langs = np.array(found.column("lang").to_pylist(), object)
    weight = np.zeros(len(n))
    for k in (0, 1):
        rest = (y == k) & ~own
        weight[rest] = n[rest] * (n[y == k].sum() / max(n[rest].sum(), 1))
    of = lambda at: best_threshold(bins[at], y[at], precision, weight[at], low[at], high[at])
    thresholds = {}
    for k in sorted({x for x in langs[~own] if x is not None}):
        at = (langs == k) & ~own
        if n[at & (y == 1)].sum() >= min_positive:
            thresholds[k] = of(at)
    return Classifier(network, thresholds, of(~own) if (y[~own] == 1).any() else 0.5)


def _scored(docs: DataFrame, text_col: str, network: Network) -> DataFrame:
    """``docs``, all columns, and ``SCORE``."""
    prepare(docs.sparkSession)

    def run(batches):
        for batch in batches:
            s = pa.array(network.score(batch.column(text_col)), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, s], [*batch.schema.names, SCORE])

    return docs.mapInArrow(frugal(run), T.StructType([*docs.schema.fields, T.StructField(SCORE, T.DoubleType())]))


def toxicity(docs: DataFrame, model: Classifier, id_col: str = "doc_id", text_col: str = "text",
             lang_col: str = "lang") -> DataFrame:
    """doc_id, score (0 to 1), threshold (the language's), toxic (score at or
    above it), one row per document."""
    lang = docs[lang_col] if lang_col in docs.columns else F.lit(None)
    d = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"),
                    model.threshold(lang.cast("string")).alias("threshold"))
    return _scored(d, "text", model.network).select(
        "doc_id", F.col(SCORE).alias("score"), "threshold", (F.col(SCORE) >= F.col("threshold")).alias("toxic"))


def reject(docs: DataFrame, model: Classifier, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``docs``, all columns, without the documents that are toxic by their
    language's threshold."""
    lang = F.col(lang_col).cast("string") if lang_col in docs.columns else F.lit(None).cast("string")
    return _scored(docs, text_col, model.network).where(
        F.col(SCORE) < model.threshold(lang)).drop(SCORE)


def held_out(doc_id):
    """Whether the contract keeps a row's label from the model."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5)) == 0


def fit_on(spark, sf_dir: str, docs: DataFrame) -> Classifier:
    labels = table(spark, sf_dir, "labels")
    return fit(docs, labels.where(~held_out(labels["doc_id"])))


@query("op6_toxicity")
def op6_toxicity(spark, sf_dir):
    """Toxicity scores of all documents, learnt from the rows not held out."""
    docs = table(spark, sf_dir, "documents")
    s = toxicity(docs, fit_on(spark, sf_dir, docs))
    return s.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score",
                    (F.col("score") >= 0.5).cast("int").alias("predicted"), "threshold", "toxic")
