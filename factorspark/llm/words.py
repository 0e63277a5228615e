"""Vectorised words of Arrow text columns: byte offsets and 64-bit hashes.

Both word classes used by the operators are defined on bytes: every byte of a
multi-byte UTF-8 character is at least 0x80, so splitting at ASCII separators
is exact without decoding.  Work is done block by block (``BLOCK`` bytes, cut
at a separator or a document's end), so memory does not depend on how long a
text is.  Word hashes are polynomial hashes with random byte values, taken
from prefix sums, then mixed; they depend on the word alone.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK = 1 << 18
U64 = np.uint64
_MUL = U64(0x9E3779B97F4A7C15)


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser: spreads every bit of ``h`` (uint64) over the whole word."""
    h = h ^ (h >> U64(30))
    h *= U64(0xBF58476D1CE4E5B9)
    h ^= h >> U64(27)
    h *= U64(0x94D049BB133111EB)
    h ^= h >> U64(31)
    return h


def _powers(base: int, n: int) -> np.ndarray:
    p = np.full(n, base, dtype=U64)
    p[0] = 1
    return np.multiply.accumulate(p)


_BASE = 0xD6E8FEB86659FD93                       # odd, so it has an inverse modulo 2**64
_POW = _powers(_BASE, BLOCK)
_INV = _powers(pow(_BASE, -1, 1 << 64), BLOCK)
_BYTE = mix(np.arange(1, 257, dtype=U64) * _MUL)


def _fold(values: np.ndarray) -> np.ndarray:
    """The byte values with A-Z read as a-z."""
    v = values.copy()
    v[0x41:0x5B] = values[0x61:0x7B]
    return v


_LOWER = _fold(_BYTE)


def _separators(kept) -> np.ndarray:
    sep = np.ones(256, dtype=bool)
    for a, b in kept:
        sep[a:b + 1] = False
    return sep


#: ``[^\x20\x09-\x0D]+``
SPACED = _separators([(0x00, 0x08), (0x0E, 0x1F), (0x21, 0xFF)])
#: Lines that are not empty: whatever stands between line breaks.
LINES = _separators([(0x00, 0x09), (0x0B, 0x0C), (0x0E, 0xFF)])
#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after lower-casing A-Z
ALNUM = _separators([(0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)])


def text_buffer(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow string column; a null text is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offs, data = column.buffers()
    offs = np.frombuffer(offs, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    buf = np.frombuffer(data, dtype=np.uint8)[offs[0]:offs[-1]] if data is not None else np.zeros(0, np.uint8)
    return buf, offs - offs[0]


class Words:
    """Words of a batch: byte ``start``/``end``, ``hash``, and ``first`` (index
    of each document's first word, with the total at the end)."""

    def __init__(self, column, sep: np.ndarray, lower: bool, prefixes: tuple[int, ...] = ()):
        self.buf, self.offs = text_buffer(column)
        values = _LOWER if lower else _BYTE
        starts, ends, hashes, heads = [], [], [], [[] for _ in prefixes]
        for i, j in self._blocks(sep):
            st, en, hh, pre = _block(self.buf[i:j], self.offs, i, j, sep, values, prefixes)
            starts.append(st)
            ends.append(en)
            hashes.append(hh)
            for out, p in zip(heads, pre):
                out.append(p)
        cat = lambda xs, t: np.concatenate(xs) if xs else np.zeros(0, t)
        self.start, self.end = cat(starts, np.int64), cat(ends, np.int64)
        self.hash = cat(hashes, U64)
        self.prefix = [cat(x, U64) for x in heads]
        self.first = np.searchsorted(self.start, self.offs)

    def _blocks(self, sep):
        i, n = 0, len(self.buf)
        while i < n:
            j = min(i + BLOCK, n)
            if j < n:
                cut = np.flatnonzero(sep[self.buf[i:j]])
                edge = self.offs[np.searchsorted(self.offs, j, "right") - 1]
                back = max(int(cut[-1]) + 1 + i if len(cut) else i, int(edge))
                if back > i:
                    j = back
                else:                            # one word longer than a block
                    j = int(self.offs[np.searchsorted(self.offs, i, "right")])
                    for k in range(i, j, BLOCK):
                        cut = np.flatnonzero(sep[self.buf[k:min(k + BLOCK, j)]])
                        if len(cut):
                            j = k + int(cut[0])
                            break
            yield i, j
            i = j


def _block(b, offs, i, j, sep, values, prefixes):
    n = j - i
    word = ~sep[b]
    a, z = np.searchsorted(offs, [i, j + 1])
    edge = np.zeros(n + 1, dtype=bool)
    edge[offs[a:z] - i] = True
    head, tail = np.empty(n, dtype=bool), np.empty(n, dtype=bool)
    head[0] = tail[-1] = True
    np.logical_not(word[:-1], out=head[1:])
    np.logical_not(word[1:], out=tail[:-1])
    head |= edge[:-1]
    tail |= edge[1:]
    head &= word
    tail &= word
    st, en = np.flatnonzero(head), np.flatnonzero(tail) + 1
    if n > BLOCK:                                # one giant word
        h = np.array([int.from_bytes(hashlib.blake2b(_bytes(b[s:e], values), digest_size=8).digest(), "little")
                      for s, e in zip(st, en)], dtype=U64)
        return st + i, en + i, h, [h] * len(prefixes)
    v = values[b]
    v *= _POW[:n]
    c = np.cumsum(v)
    base = c[st] - v[st]
    inv = _INV[st]
    h = (c[en - 1] - base) * inv
    h += (en - st).astype(U64) * _MUL
    pre = [mix((c[np.minimum(st + k, en) - 1] - base) * inv ^ U64(k)) for k in prefixes]
    return st + i, en + i, mix(h), pre


def _bytes(b: np.ndarray, values: np.ndarray) -> bytes:
    raw = b.tobytes()
    return raw.lower() if values is _LOWER else raw


_G = 0xA0761D6478BD642F                          # odd


def kgrams(h: np.ndarray, k: int, seed: int = 0) -> np.ndarray:
    """Hash of the ``k`` consecutive word hashes from each position (the last
    ``k - 1`` positions have none); callers drop grams that cross documents."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, U64)
    g = pow(_G, 2 * seed + 1, 1 << 64)
    out = np.zeros(n, U64)
    for j in range(k):
        t = h[j:j + n] * U64(pow(g, j + 1, 1 << 64))
        t ^= t >> U64(29)                        # not linear in the words
        out += t * U64(pow(g, 2 * j + 1, 1 << 64))
    return mix(out)


def long_grams(h: np.ndarray, k: int) -> np.ndarray:
    """As ``kgrams`` for large ``k``, by prefix sums in constant time a word."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, U64)
    p = _powers(_G, len(h))
    c = np.zeros(len(h) + 1, U64)
    np.cumsum(h * p, out=c[1:])
    return mix((c[k:] - c[:-k]) * _powers(pow(_G, -1, 1 << 64), n))


def planes(a: np.ndarray) -> bytes:
    """Integers as byte planes, least significant first: planes of zeros and of
    slowly changing bytes vanish under the shuffle's own compression."""
    return np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.dtype.itemsize).T.tobytes()


def unplanes(raw: bytes, dtype) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(size, -1).T).view(dtype).reshape(-1)
