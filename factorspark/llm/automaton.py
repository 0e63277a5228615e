"""Generalised suffix automaton of word sequences, with the windows marked."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from .words import ALNUM, U64, Words, kgrams


class Automaton:
    """All substrings of the items; ``window`` words of an item, or the whole
    of a shorter one, make a hit.

    ``link`` leads to the longest proper suffix in another state and
    ``length`` is the longest string of a state.  ``items[s]`` are the items
    in which the window that ends in state ``s`` occurs; ``short[s]`` the
    (length, item) of short items that are suffixes of what ``s`` stands for.
    """

    def __init__(self, items: list[tuple[object, list[int]]], window: int):
        self.window = window
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        for _, words in items:
            last = 0
            for w in words:
                last = self._extend(last, w)
        self._mark(items)

    def _state(self, length: int, link: int, out: dict[int, int]) -> int:
        self.next.append(out)
        self.link.append(link)
        self.length.append(length)
        return len(self.link) - 1

    def _split(self, p: int, q: int, w: int) -> int:
        """The state of the strings of ``q`` no longer than those from ``p``."""
        if self.length[q] == self.length[p] + 1:
            return q
        c = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = c
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = c
            p = self.link[p]
        return c

    def _extend(self, last: int, w: int) -> int:
        if w in self.next[last]:                 # another item got here before
            return self._split(last, self.next[last][w], w)
        s, p = self._state(self.length[last] + 1, 0, {}), last
        while p >= 0 and w not in self.next[p]:
            self.next[p][w] = s
            p = self.link[p]
        if p >= 0:
            self.link[s] = self._split(p, self.next[p][w], w)
        return s

    def _mark(self, items) -> None:
        n, size = self.window, len(self.link)
        own: list[set] = [set() for _ in range(size)]
        short: list[list] = [[] for _ in range(size)]
        for item, words in items:
            s = 0
            for w in words:
                s, t = self.next[s][w], self.next[s][w]
                while t > 0 and item not in own[t] and len(words) >= n:
                    own[t].add(item)
                    t = self.link[t]
            if 0 < len(words) < n:
                short[s].append((len(words), item))
        self.at: list[int] = [-1] * size         # the state that holds a state's window
        self.items, self.short = own, short
        for s in sorted(range(1, size), key=self.length.__getitem__):
            up = self.link[s]
            if self.length[s] >= n:
                self.at[s] = s if self.length[up] < n else self.at[up]
            if up > 0 and short[up]:
                short[s] = short[s] + short[up]

    def stream(self, words) -> tuple[list[tuple[int, int]], set]:
        """Hit spans [start, end) of a word sequence, and the items hit."""
        nxt, link, length, at, n = self.next, self.link, self.length, self.at, self.window
        s = long = 0
        spans, found = [], set()
        for j, w in enumerate(words):
            while s and w not in nxt[s]:
                s = link[s]
                long = length[s]
            if w in nxt[s]:
                s = nxt[s][w]
                long += 1
            else:
                continue
            reach = 0
            if long >= n:
                reach = n
                found |= self.items[at[s]]
            for k, item in self.short[s]:
                if k <= long:
                    reach = max(reach, k)
                    found.add(item)
            if reach:
                a = j + 1 - reach
                while spans and spans[-1][1] >= a:
                    a = min(a, spans.pop()[0])
                spans.append((a, j + 1))
        return spans, found


class Matcher:
    """An automaton with exact filters that find, for a whole batch at once,
    the stretches of words it has to stream: every match of at least
    ``least`` words lies in a run of words (of word pairs) of the items."""

    def __init__(self, rows: list[tuple[object, str]], window: int):
        words = Words(pa.array([t for _, t in rows], pa.string()), ALNUM, True)
        cut = list(zip(words.first, words.first[1:]))
        seqs = [words.hash[a:b].tolist() for a, b in cut]
        kept = [(i, s) for (i, _), s in zip(rows, seqs) if s]
        self.auto = Automaton(kept, window)
        self.least = min([window, *(len(s) for _, s in kept)])
        self.pairs = self.least > 1
        grams = kgrams(words.hash, 2) if self.pairs else words.hash
        if self.pairs and len(grams):
            inside = np.ones(len(words.hash), bool)
            inside[words.first[1:] - 1] = False  # pairs that cross two items
            grams = grams[inside[:-1]]
        self.grams = np.unique(grams)
        self.table = np.zeros(1 << 20, bool)
        self.table[(self.grams >> U64(44)).astype(np.int64)] = True

    def stretches(self, words: Words):
        """(document, first word, last word + 1) of the batch's candidates."""
        h = words.hash
        if not len(self.grams) or len(h) < 1 + self.pairs:
            return []
        g = kgrams(h, 2) if self.pairs else h
        hit = self.table[(g >> U64(44)).astype(np.int64)]
        at = np.flatnonzero(hit)
        k = np.minimum(np.searchsorted(self.grams, g[at]), len(self.grams) - 1)
        at = at[self.grams[k] == g[at]]
        doc = np.searchsorted(words.first, at, "right") - 1
        if self.pairs:
            inside = at + 1 < words.first[doc + 1]
            at, doc = at[inside], doc[inside]
        if not len(at):
            return []
        new = np.flatnonzero((np.diff(at) != 1) | (np.diff(doc) != 0)) + 1
        a, z = np.r_[0, new], np.r_[new, len(at)]
        long = z - a + self.pairs >= self.least
        return zip(doc[a[long]].tolist(), at[a[long]].tolist(), (at[z[long] - 1] + 1 + self.pairs).tolist())

    def match(self, words: Words) -> dict[int, tuple[list[tuple[int, int]], set]]:
        """By document of the batch: word spans [start, end) and items."""
        out: dict[int, tuple[list[tuple[int, int]], set]] = {}
        for doc, a, z in self.stretches(words):
            spans, found = self.auto.stream(words.hash[a:z].tolist())
            if spans:
                own = out.setdefault(doc, ([], set()))
                base = a - int(words.first[doc])
                own[0].extend((s + base, e + base) for s, e in spans)
                own[1].update(found)
        return out
