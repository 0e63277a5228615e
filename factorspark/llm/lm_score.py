"""Operator 8, language-model scores by deleted interpolation.

The model mixes maximum-likelihood estimates of a bigram, a unigram and the
uniform distribution over the vocabulary and one unknown word,

    p(w | v) = l2[b] c(v w) / c(v) + l1[b] c(w) / N + l0[b] / (V + 1),

with weights for each bucket ``b`` of the context's frequency (its binary
logarithm).  The weights are learned by expectation-maximisation on held-out
counts: a fold of the training documents is deleted from the counts and its
tokens, summed up in cells of (bucket, bigram estimate, unigram estimate) an
eighth of an octave wide, are what the weights must explain.  The final counts
are those of all training documents.

Counts are of the whole corpus and stay distributed.  Tasks turn documents
into chunks: a vocabulary of word hashes and the tokens as numbers into it,
cut off by a checkpoint.  A chunk asks for the counts of its distinct words and
bigrams, as sorted hash arrays dealt to blocks by hash range; a block adds up
what all chunks have, each key once a chunk however frequent it is, and answers
each chunk in its own order.  The chunk's tokens then meet the answers and are
scored.  The driver gets sums, the cells (bounded in number) and no counts.

A word is ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased, known by 64 bits of
hash; each text ends in one end token, which is also what a null or empty text
consists of.  Defined cases besides: rows that repeat an id are scored one by
one and each counts in training; without training documents ``score`` and
``base_score`` are those of unknown words; without documents in the deleted
fold the weights are equal; further columns are ignored; an empty table gives
no rows.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import FLUSH_WORDS, cut_lineage, frugal, parts, prepare, query, table
from .words import SPACED, U64, Words, mix, planes, unplanes

END, START = U64(0xE7D5A1), U64(0x57A127)
#: What a document is for the counts: not learned from, kept, or in the deleted fold.
OTHER, KEPT, DELETED = 0, 1, 2
#: Of how many training documents one is in the deleted fold.
FOLD = 8
#: Buckets of the context's frequency; cells to an octave, and octaves at most.
BUCKETS, FINE, OCTAVES = 32, 8, 40
ROUNDS = 100
#: Rows of a chunk's answers after the chunk itself.
CHUNK, ANSWER, STAT = 0, 1, 2

_FIELDS = ("a", "b", "c", "d", "e")
_COLUMNS = "chunk long, kind int, grams int, block int, " + ", ".join(f"{n} binary" for n in _FIELDS)
_SCHEMA = pa.schema([("chunk", pa.int64()), ("kind", pa.int32()), ("grams", pa.int32()), ("block", pa.int32()),
                     *((n, pa.binary()) for n in _FIELDS)])


def _zip(a: np.ndarray) -> bytes:
    return zlib.compress(planes(a), 1)


def _unzip(raw: bytes, dtype) -> np.ndarray:
    return unplanes(zlib.decompress(raw), dtype)


def _batches(rows):
    for r in rows:
        yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(r, _SCHEMA)], schema=_SCHEMA)


def _chunks(flush: int):
    """Documents -> chunks; those of the deleted fold in chunks of their own."""
    def pack(held, chunk, deleted):
        hashes, sizes, ids, kinds = (np.concatenate(x) for x in zip(*held))
        vocab, number, count = np.unique(hashes, return_inverse=True, return_counts=True)
        order = np.argsort(-count, kind="stable")            # frequent words get small numbers
        rank = np.empty(len(vocab), np.uint32)
        rank[order] = np.arange(len(vocab), dtype=np.uint32)
        return (chunk, CHUNK, int(deleted), 0, planes(ids), _zip(sizes.astype(np.uint32)), kinds.tobytes(),
                _zip(rank[number]), planes(vocab[order]))

    def run(batches):
        held: dict[bool, list] = {False: [], True: []}
        words = {False: 0, True: 0}
        me, made = TaskContext.get().partitionId(), 0
        for batch in batches:
            w = Words(batch.column("text"), SPACED, True)
            kinds = batch.column("kind").to_numpy().astype(np.uint8)
            ids = batch.column("doc_id")
            sizes = np.diff(w.first) + 1
            owner = np.repeat(np.arange(len(kinds)), sizes)
            tokens = np.empty(len(owner), U64)
            last = np.cumsum(sizes) - 1
            body = np.ones(len(owner), bool)
            body[last] = False
            tokens[body], tokens[last] = w.hash, END
            none = ids.is_null().to_numpy(zero_copy_only=False)
            ids = ids.fill_null(0).to_numpy().astype(np.int64)
            for deleted in (False, True):
                mine = (kinds == DELETED) == deleted
                if mine.any():
                    held[deleted].append((tokens[mine[owner]], sizes[mine], ids[mine], (kinds + 4 * none).astype(np.uint8)[mine]))
                    words[deleted] += int(sizes[mine].sum())
                if words[deleted] >= flush:
                    yield from _batches([pack(held[deleted], me << 24 | made, deleted)])
                    held[deleted], words[deleted], made = [], 0, made + 1
        for deleted in (False, True):
            if held[deleted]:
                yield from _batches([pack(held[deleted], me << 24 | made, deleted)])
                made += 1
    return run


class Chunk:
    """A chunk's tokens and its distinct words and bigrams, sorted by hash."""

    def __init__(self, row):
        self.ids = unplanes(row["a"], np.int64)
        self.sizes = _unzip(row["b"], np.uint32).astype(np.int64)
        kinds = np.frombuffer(row["c"], np.uint8)
        self.null, self.kinds = kinds >= 4, kinds & 3
        number = _unzip(row["d"], np.uint32)
        vocab = unplanes(row["e"], U64)
        order = np.argsort(vocab)
        rank = np.empty(len(vocab), np.int64)
        rank[order] = np.arange(len(vocab))
        self.words, self.word = vocab[order], rank[number]
        self.first = np.cumsum(self.sizes) - self.sizes
        #: The word before each token, by number; -1 at a text's start.
        self.before = np.r_[-1, self.word[:-1]]
        self.before[self.first] = -1
        left = np.where(self.before < 0, START, self.words[self.before])
        pair = mix(left * U64(0x9E3779B97F4A7C15) ^ mix(self.words[self.word] + U64(1)))
        self.pairs, self.pair = np.unique(pair, return_inverse=True)

    def counts(self):
        """(keys, kept, deleted) for words, then for bigrams."""
        kind = np.repeat(self.kinds, self.sizes)
        for keys, at in ((self.words, self.word), (self.pairs, self.pair)):
            yield keys, *(np.bincount(at[kind == k], minlength=len(keys)).astype(np.uint32) for k in (KEPT, DELETED))


def _block(keys: np.ndarray, n: int) -> np.ndarray:
    """Where the keys of each block begin: blocks are ranges of hashes."""
    edge = np.array([(k << 64) // n for k in range(n)], dtype=object)
    return np.r_[np.searchsorted(keys, edge.astype(U64)), len(keys)]


def _ask(n: int):
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                for grams, (keys, kept, deleted) in enumerate(Chunk(row).counts(), 1):
                    cut = _block(keys, n)
                    rows = []
                    for k in range(n):
                        a, z = cut[k], cut[k + 1]
                        if a < z:
                            step = np.r_[keys[a:a + 1], np.diff(keys[a:z])]
                            rows.append((row["chunk"], ANSWER, grams, k, planes(step), _zip(kept[a:z]),
                                         _zip(deleted[a:z]), None, None))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, f.type) for c, f in zip(zip(*rows), _SCHEMA)], schema=_SCHEMA)
    return run


def _answer(batches):
    """A block: counts over all chunks, and each chunk's answer: the counts
    without the deleted fold, and all."""
    asked: dict[int, list] = {1: [], 2: []}
    for batch in batches:
        for r in batch.to_pylist():
            asked[r["grams"]].append((r["chunk"], r["block"], np.cumsum(unplanes(r["a"], U64), dtype=U64),
                                      _unzip(r["b"], np.uint32), _unzip(r["c"], np.uint32)))
    for grams, own in asked.items():
        if not own:
            continue
        keys = np.concatenate([x[2] for x in own])
        order = np.argsort(keys, kind="stable")
        new = np.r_[True, keys[order][1:] != keys[order][:-1]]
        at = np.empty(len(keys), np.int64)
        at[order] = np.cumsum(new) - 1
        size = int(new.sum())
        kept = np.bincount(at, np.concatenate([x[3] for x in own]), size).astype(np.uint64)
        all_ = kept + np.bincount(at, np.concatenate([x[4] for x in own]), size).astype(np.uint64)
        if grams == 1:
            known = [int((c > 0).sum()) for c in (kept, all_)]
            yield from _batches([(None, STAT, 1, own[0][1], np.array(known, np.int64).tobytes(), *[None] * 4)])
        lo = 0
        for chunk, block, mine, *_ in own:
            k = at[lo:lo + len(mine)]
            lo += len(mine)
            yield from _batches([(chunk, ANSWER, grams, block, _zip(kept[k]), _zip(all_[k]), *[None] * 3)])


def _met(batches, which: str):
    """Chunks with their answers: (chunk, word counts, bigram counts)."""
    chunk, counts = None, {1: [], 2: []}
    for batch in batches:
        for r in batch.to_pylist():
            if r["kind"] == CHUNK:
                if chunk is not None:
                    yield chunk, np.concatenate(counts[1]), np.concatenate(counts[2])
                chunk, counts = Chunk(r), {1: [], 2: []}
            else:
                counts[r["grams"]].append(_unzip(r[which], np.uint64).astype(np.float64))
    if chunk is not None:
        yield chunk, np.concatenate(counts[1]), np.concatenate(counts[2])


def _estimates(chunk: Chunk, words, pairs, texts: float, tokens: float):
    """(bucket, bigram estimate, unigram estimate) of every token."""
    context = np.where(chunk.before < 0, texts, words[chunk.before])
    bucket = np.where(context > 0, np.minimum(np.floor(np.log2(np.maximum(context, 1))) + 1, BUCKETS - 1), 0)
    two = np.where(context > 0, pairs[chunk.pair] / np.maximum(context, 1), 0)
    return bucket.astype(np.int64), two, words[chunk.word] / max(tokens, 1)


def _cell(p: np.ndarray) -> np.ndarray:
    """0 for an estimate of 0, else its logarithm in steps of 1 / FINE octave."""
    with np.errstate(divide="ignore"):
        k = np.round(-np.log2(p) * FINE)
    return np.where(p > 0, np.minimum(k, FINE * OCTAVES - 2) + 1, 0).astype(np.int64)


def _cells(texts: float, tokens: float):
    side = FINE * OCTAVES
    schema = pa.schema([("cell", pa.int64()), ("n", pa.int64())])

    def run(batches):
        for chunk, words, pairs in _met(batches, "a"):
            bucket, two, one = _estimates(chunk, words, pairs, texts, tokens)
            cell, n = np.unique((bucket * side + _cell(two)) * side + _cell(one), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(n.astype(np.int64))], schema=schema)
    return run


def expectation_maximisation(cell: np.ndarray, n: np.ndarray, vocabulary: int, rounds: int = ROUNDS) -> np.ndarray:
    """Weights (bucket, [uniform, unigram, bigram]) that explain the cells."""
    side = FINE * OCTAVES
    value = np.r_[0.0, 2.0 ** (-np.arange(side - 1) / FINE)]
    bucket = cell // side // side
    f = np.stack([np.full(len(cell), 1 / (vocabulary + 1)), value[cell % side], value[cell // side % side]], axis=1)
    weights = np.full((BUCKETS, 3), 1 / 3)
    for _ in range(rounds):
        share = weights[bucket] * f
        share *= (n / share.sum(axis=1))[:, None]
        # One token more for each part keeps every weight above zero.
        total = np.stack([np.bincount(bucket, share[:, k], BUCKETS) for k in range(3)], axis=1) + 1 / 3
        weights = total / total.sum(axis=1, keepdims=True)
    return weights


_SCORES = "doc_id long, n_tokens long, n_known long, base_score double, score double"


def _scores(weights: np.ndarray, texts: float, tokens: float, vocabulary: int):
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                        ("base_score", pa.float64()), ("score", pa.float64())])

    def run(batches):
        for chunk, words, pairs in _met(batches, "b"):
            bucket, two, one = _estimates(chunk, words, pairs, texts, tokens)
            w = weights[bucket]
            p = w[:, 0] / (vocabulary + 1) + w[:, 1] * one + w[:, 2] * two
            count = words[chunk.word]
            base = np.log10((count + 0.5) / (tokens + 0.5 * (vocabulary + 1)))
            add = lambda x: np.add.reduceat(x, chunk.first)
            yield pa.RecordBatch.from_arrays(
                [pa.array(chunk.ids, mask=chunk.null), pa.array(chunk.sizes), pa.array(add((count > 0).astype(np.int64))),
                 pa.array(add(base)), pa.array(add(np.log10(p)))], schema=schema)
    return run


def _meet(chunks: DataFrame, answers: DataFrame, n: int) -> DataFrame:
    """Each chunk, followed by its answers by block, in one task."""
    place = F.pmod(F.shiftright("chunk", 24) + F.pmod("chunk", F.lit(1 << 24)) * 31, F.lit(n)).cast("int")
    return (chunks.unionAll(answers).repartitionById(n, place)
            .sortWithinPartitions("chunk", "kind", "block"))


def lm_score(docs: DataFrame, learned, id_col: str = "doc_id", text_col: str = "text",
             flush: int = FLUSH_WORDS) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score; one row per
    input row.  ``learned`` (boolean column of ``docs``): which to learn from."""
    spark = prepare(docs.sparkSession)
    n = parts(spark)
    fold = F.pmod(F.xxhash64(docs[id_col].cast("long")), F.lit(FOLD)) == 0
    kind = F.when(~F.coalesce(learned, F.lit(False)), OTHER).when(fold, DELETED).otherwise(KEPT)
    chunks = cut_lineage(docs.select(
        docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"), kind.alias("kind"))
        .mapInArrow(frugal(_chunks(flush)), _COLUMNS))
    answers = cut_lineage(chunks.mapInArrow(frugal(_ask(n)), _COLUMNS).repartitionById(n, F.col("block"))
                          .mapInArrow(frugal(_answer), _COLUMNS))
    # Sums: known words without and with the deleted fold; texts and tokens of each kind.
    known = np.zeros(2, np.int64)
    for r in answers.where(F.col("kind") == STAT).select("a").collect():         # one row a block
        known += np.frombuffer(r.a, np.int64)
    answers = answers.where(F.col("kind") == ANSWER)

    def sums(batches):
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                kinds, sizes = np.frombuffer(r["c"], np.uint8) & 3, _unzip(r["b"], np.uint32)
                rows += [(k, int((kinds == k).sum()), int(sizes[kinds == k].sum())) for k in (KEPT, DELETED)]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], ["k", "texts", "tokens"])

    size = {KEPT: (0, 0), DELETED: (0, 0)} | {
        r.k: (r.texts, r.tokens) for r in chunks.select("b", "c").mapInArrow(frugal(sums), "k long, texts long, tokens long")
        .groupBy("k").agg(F.sum("texts").alias("texts"), F.sum("tokens").alias("tokens")).collect()}

    apart = chunks.where(F.col("grams") == 1)                # the deleted fold's chunks
    asked = answers.join(apart.select("chunk"), "chunk", "left_semi").select(answers.columns)
    # At most BUCKETS * (FINE * OCTAVES) ** 2 cells, a few ten thousand in practice.
    cells = (_meet(apart, asked, n).mapInArrow(frugal(_cells(*size[KEPT])), "cell long, n long")
             .groupBy("cell").agg(F.sum("n").alias("n")).toArrow())
    weights = expectation_maximisation(cells.column("cell").to_numpy(), cells.column("n").to_numpy(), int(known[0]))
    texts, tokens = (a + b for a, b in zip(size[KEPT], size[DELETED]))
    scored = _meet(chunks, answers, n).mapInArrow(frugal(_scores(weights, texts, tokens, int(known[1]))), _SCORES)
    return scored.select("doc_id", "n_tokens", "n_known", F.lit(tokens).cast("long").alias("train_tokens"),
                         "base_score", "score")


@query("op8_lm_score")
def op8_lm_score(spark, sf_dir):
    """Bigram model of the documents not held out; scores of all documents."""
    docs = table(spark, sf_dir, "documents")
    kept_out = lambda c: F.pmod(F.crc32(c.cast("string").cast("binary")), F.lit(5)) == 1
    s = lm_score(docs, ~kept_out(docs["doc_id"]))
    return s.select("doc_id", F.coalesce(kept_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
                    "n_tokens", "n_known", "train_tokens", "base_score", "score")
