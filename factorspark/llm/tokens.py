"""Token ids of whole texts by a byte-level BPE file, one unit at a time.

A unit starts at an ASCII blank that follows a character which is surely not
white space, and at an ASCII mark after a letter.  The pre-tokenizer of
byte-level BPE always cuts there (none of its patterns goes from a non-blank to
a blank or from a letter to a mark, and none looks to the left), so a text's
ids are those of its units in order.  Units repeat much more than
texts do: a worker keeps the ids of the units it has met in a table of fixed
size with two slots for each, of which a newer unit takes a free one or else
the second, and hands only the others to the tokenizer.
"""

from __future__ import annotations

import os

import numpy as np

from .words import BLOCK, U64, _BASE, _BYTE, _INV, _MUL, _POW, mix, text_buffer

_BLANK = np.zeros(256, bool)
_BLANK[[0x20, 9, 10, 11, 12, 13]] = True
_PLAIN = np.zeros(256, bool)
_PLAIN[0x21:0x7F] = True
_LEAD2 = np.zeros(256, bool)                     # leads of two-byte characters without white space
_LEAD2[0xC3:0xE0] = True
_LEAD3 = np.zeros(256, bool)                     # and of three-byte ones
_LEAD3[0xE4:0xEE] = True

#: ASCII marks that never share a token with a letter before them (an
#: apostrophe may start a contraction, which is a pattern of its own).
_MARK = np.zeros(256, bool)
_MARK[[ord(c) for c in "!\"#$%&()*+,-./:;<=>?@[\\]^_`{}~"]] = True
_LETTER = np.zeros(256, bool)
_LETTER[0x41:0x5B] = _LETTER[0x61:0x7B] = True
_LATIN = np.zeros(256, bool)                     # second bytes of Latin letters after 0xC3
_LATIN[0x80:0xC0] = True
_LATIN[[0x97, 0xB7]] = False

_SLOTS = 1 << 21
_KEPT_IDS = 1 << 23


def vocabulary(path: str | None = None) -> str:
    """The tokenizer file; by default the public byte-level BPE one."""
    if path:
        return path
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def unit_starts(buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Byte positions where units start; every non-empty text starts one."""
    start = np.zeros(len(buf) + 1, bool)
    if len(buf) > 1:
        before = _PLAIN[buf[:-1]]
        high = buf[:-1] >= 0x80
        before[1:] |= high[1:] & _LEAD2[buf[:-2]]
        before[2:] |= high[2:] & high[1:-1] & _LEAD3[buf[:-3]]
        start[1:-1] = _BLANK[buf[1:]] & before
        letter = _LETTER[buf[:-1]]
        letter[1:] |= _LATIN[buf[1:-1]] & (buf[:-2] == 0xC3)
        start[1:-1] |= _MARK[buf[1:]] & letter
    start[offs] = True
    return np.flatnonzero(start[:-1])


def unit_hashes(buf: np.ndarray, start: np.ndarray) -> np.ndarray:
    end = np.r_[start[1:], len(buf)]
    out = np.empty(len(start), U64)
    i = 0
    while i < len(start):
        j = max(int(np.searchsorted(end, start[i] + BLOCK, "right")), i + 1)
        lo, hi = int(start[i]), int(end[j - 1])
        if hi - lo > BLOCK:                      # one giant unit
            import hashlib
            out[i] = int.from_bytes(hashlib.blake2b(buf[lo:hi].tobytes(), digest_size=8).digest(), "little")
        else:
            v = _BYTE[buf[lo:hi]]
            v *= _POW[:hi - lo]
            c = np.cumsum(v)
            s, e = start[i:j] - lo, end[i:j] - lo
            h = (c[e - 1] - c[s] + v[s]) * _INV[s]
            h += (e - s).astype(U64) * _MUL
            out[i:j] = mix(h)
        i = j
    return out


class Encoder:
    """Ids of a batch of texts; ``bytes`` has the bytes that each id stands for,
    so running sums of them are the tokens' byte offsets."""

    def __init__(self, path: str | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(vocabulary(path))
        #: Bytes of each token: the vocabulary writes a byte as one character.
        names = self.tokenizer.get_vocab(with_added_tokens=True)
        self.bytes = np.zeros(max(names.values()) + 1, np.int64)
        self.bytes[list(names.values())] = [len(x) for x in names]
        for token in self.tokenizer.get_added_tokens_decoder().values():
            raw = np.frombuffer(token.content.encode(), np.uint8)
            if len(unit_starts(raw, np.array([0, len(raw)]))) > 1:
                raise ValueError(f"added token {token.content!r} is not within a unit")
        self._clear()

    def _clear(self):
        self.key = np.zeros(_SLOTS, U64)
        self.row = np.full(_SLOTS, -1, np.int32)
        self.first = np.zeros(1, np.int64)       # of each row's ids
        self.ids = np.zeros(0, np.int32)

    def _learn(self, buf, start, end, new):
        """Encode the units ``new``: those that stand between plain characters
        as one text, cut again at their known byte lengths."""
        a, z = start[new], end[new]
        mid = _BLANK[buf[a]] & _PLAIN[buf[z - 1]] & (z - a < 256)   # wherever it stands it starts a unit
        order = np.r_[np.flatnonzero(mid), np.flatnonzero(~mid)]
        sizes, flat = [], []
        for i in range(0, int(mid.sum()), 1024):
            k = order[i:min(i + 1024, int(mid.sum()))]
            text = b"".join([buf[x:y].tobytes() for x, y in zip(a[k].tolist(), z[k].tolist())])
            ids = np.array(self.tokenizer.encode_batch_fast([text.decode()], add_special_tokens=False)[0].ids, np.int32)
            cut = np.searchsorted(np.cumsum(self.bytes[ids]), np.cumsum(z[k] - a[k])) + 1
            sizes.append(np.diff(np.r_[0, cut]))
            flat.append(ids)
        k = order[int(mid.sum()):]
        if len(k):
            units = [buf[x:y].tobytes().decode() for x, y in zip(a[k].tolist(), z[k].tolist())]
            found = self.tokenizer.encode_batch_fast(units, add_special_tokens=False)
            sizes.append(np.array([len(x.ids) for x in found]))
            flat.extend(np.array(x.ids, np.int32) for x in found)
        size = np.concatenate(sizes)
        rows = np.empty(len(new), np.int64)
        rows[order] = np.arange(len(new)) + len(self.first) - 1
        self.first = np.r_[self.first, self.first[-1] + np.cumsum(size)]
        self.ids = np.concatenate([self.ids, *flat])
        return rows

    def batch(self, column):
        """(ids, first): all ids in order, and where each text's begin."""
        buf, offs = text_buffer(column)
        if len(self.ids) > _KEPT_IDS:
            self._clear()
        start = unit_starts(buf, offs)
        end = np.r_[start[1:], len(buf)]
        h = unit_hashes(buf, start) if len(start) else np.zeros(0, U64)
        slot = (h >> U64(43)).astype(np.int32)
        row = np.where(self.key[slot] == h, self.row[slot], -1)
        miss = np.flatnonzero(row < 0)
        second = (h[miss] & U64(_SLOTS - 1)).astype(np.int32)
        row[miss] = np.where(self.key[second] == h[miss], self.row[second], -1)
        miss = miss[row[miss] < 0]
        if len(miss):
            _, lead, inverse = np.unique(h[miss], return_index=True, return_inverse=True)
            new = miss[lead]
            rows = self._learn(buf, start, end, new)
            put = np.where(self.row[slot[new]] < 0, slot[new], (h[new] & U64(_SLOTS - 1)).astype(np.int32))
            self.key[put], self.row[put] = h[new], rows
            row[miss] = rows[inverse]
        a, size = self.first[row], np.diff(self.first)[row] if len(row) else np.zeros(0, np.int64)
        total = np.cumsum(size)
        n = int(total[-1]) if len(total) else 0
        take = np.arange(n) + np.repeat(a - (total - size), size)
        bounds = np.r_[0, total]
        first = bounds[np.searchsorted(start, offs)]
        return self.ids[take], first
