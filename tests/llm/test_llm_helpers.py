"""Vectorised words and unit-wise tokens against plain Python."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from factorspark.llm.automaton import Matcher
from factorspark.llm.tokens import Encoder
from factorspark.llm.words import ALNUM, BLOCK, LINES, SPACED, Words, kgrams, long_grams, planes, unplanes

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TEXTS = ["Ab céD  x", "", None, " \n z9-Q", "a" * 300_000 + " b", "b a", "A" * 300_000, "x" * BLOCK, "x" * BLOCK + " y",
         "日本 語　x\u0085y", "one two " * 80_000, "q\r\nr\n\n"]


@pytest.mark.parametrize("sep, pattern, lower", [
    (SPACED, r"[^\x20\x09-\x0D]+", True), (SPACED, r"[^\x20\x09-\x0D]+", False),
    (ALNUM, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", True), (LINES, r"[^\r\n]+", False)])
def test_words(sep, pattern, lower):
    w = Words(pa.array(TEXTS), sep, lower)
    fold = lambda t: t.translate(LOWER) if lower else t
    known = {}
    for i, t in enumerate(TEXTS):
        got = [fold(w.buf[a:z].tobytes().decode()) for a, z in zip(w.start[w.first[i]:w.first[i + 1]],
                                                                    w.end[w.first[i]:w.first[i + 1]])]
        assert got == re.findall(pattern, fold(t or ""))
        for g, h in zip(got, w.hash[w.first[i]:w.first[i + 1]]):
            assert known.setdefault(g, h) == h
    assert len(set(known.values())) == len(known)


def test_grams_depend_on_their_words_alone():
    h = np.random.default_rng(0).integers(0, 1 << 63, 200).astype(np.uint64)
    h[100:150] = h[10:60]
    for f, k in ((kgrams, 5), (long_grams, 50)):
        g = f(h, k)
        assert len(g) == 201 - k and g[10] == g[100]
        assert len(set(g.tolist())) == len(g) - (51 - k)


def test_planes():
    for t in (np.uint32, np.int64, np.uint64):
        a = np.array([0, 1, 255, 256, 70000], t)
        assert (unplanes(planes(a), t) == a).all()


def test_units_make_the_ids_of_whole_texts():
    r = random.Random(1)
    bits = [" ", "  ", "\n", "a", "é", "日", "b", ",", ".", "!", '"', "'", "'s", "'ll", "×", "÷", "É", "　", "1",
            "\u0085", "\x1c", "\t", "​", "\U0001f600", "İ", "<|endoftext|>", "x" * 300]
    texts = ["".join(r.choice(bits) for _ in range(r.randrange(0, 12))) for _ in range(3000)]
    encoder = Encoder()
    for _ in range(2):                            # the second time from the table
        ids, first = encoder.batch(pa.array(texts))
        for i, t in enumerate(texts):
            want = encoder.tokenizer.encode(t, add_special_tokens=False).ids
            assert ids[first[i]:first[i + 1]].tolist() == want, t
            assert encoder.bytes[want].sum() == len(t.encode())


def test_automaton():
    r = random.Random(5)
    for _ in range(200):
        letters, n = "abc"[:r.choice([1, 2, 3])], r.choice([2, 3, 4])
        make = lambda k: " ".join(r.choice(letters) for _ in range(k))
        items = [(i, make(r.randrange(0, 12))) for i in range(r.randrange(1, 6))]
        docs = [make(r.randrange(0, 30)) + (" zz " if r.random() < 0.5 else " ") + make(r.randrange(0, 15))
                for _ in range(5)]
        grams = {}
        for i, t in items:
            w = t.split()
            for p in range(max(len(w) - n + 1, 1) if w else 0):
                grams.setdefault(tuple(w[p:p + n]), set()).add(i)
        found = Matcher(items, n).match(Words(pa.array(docs), ALNUM, True))
        for k, t in enumerate(docs):
            w, hit, own = t.split(), set(), set()
            for g, s in grams.items():
                for p in range(len(w) - len(g) + 1):
                    if tuple(w[p:p + len(g)]) == g:
                        hit |= set(range(p, p + len(g)))
                        own |= s
            spans, got = found.get(k, ([], set()))
            assert {q for a, z in spans for q in range(a, z)} == hit and got == own
