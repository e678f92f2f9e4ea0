"""Prefix tables for merge-type tokenizers (byte-pair and SentencePiece BPE).

A greedy merge encoding has a local property: a token sequence is the encoding of its text
exactly if each adjacent pair of tokens is the encoding of the pair's own text (no merge
ever crosses a boundary that no pair alone would cross). Hence each prefix of a text has
one *last token*: the only token that ends there and is compatible with the last token of
the prefix before it. The table of last tokens is filled left to right from the matches of
an Aho-Corasick automaton over the vocabulary and memoised pair tests; token counts of
every prefix and, walking backwards, the ids of any prefix follow from it without encoding
again.
"""

from __future__ import annotations

import heapq

import ahocorasick

PAIR_LIMIT = 3_000_000


class Memo:
    """A bounded memo table of two generations: entries not asked for during a whole
    generation are forgotten."""

    def __init__(self, limit: int):
        self.new: dict = {}
        self.old: dict = {}
        self.limit = limit

    def missed(self, key, make):
        """The value of a key that ``new`` does not hold."""
        value = self.old.get(key)
        if value is None:
            value = make(key)
        if len(self.new) >= self.limit:
            self.turn()
        self.new[key] = value
        return value

    def turn(self) -> None:
        self.old = dict(self.new)
        self.new.clear()  # the same dict object, which callers hold


class MergeTable:
    """``tokens``: text -> id over some alphabet of single-character units.
    ``rank_of(a, b)``: the order in which two neighbours merge (smaller first; leftmost
    first among equals), or None if they never do."""

    def __init__(self, tokens: dict[str, int], rank_of):
        self.tokens = tokens
        self.rank_of = rank_of
        self.text_of = {i: t for t, i in tokens.items()}
        self.longest = max(map(len, tokens), default=1)
        self._pairs: dict[int, bool] = {}
        self._base = max(tokens.values(), default=0) + 2  # ids and the mark for "no token before"
        self._automaton = ahocorasick.Automaton()
        for text, i in tokens.items():
            self._automaton.add_word(text, (i, len(text)))
        self._automaton.make_automaton()

    def merge(self, text: str) -> list[str]:
        """Plain greedy merging; only for the short texts of single tokens and pairs."""
        n = len(text)
        part = list(text)
        nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
        rank_of = self.rank_of
        heap = [(r, i, part[i], part[i + 1]) for i in range(n - 1)
                if (r := rank_of(part[i], part[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = nxt[i] if part[i] is not None else n
            if part[i] != a or j >= n or part[j] != b:
                continue
            part[i], part[j] = a + b, None
            nxt[i] = k = nxt[j]
            if k < n:
                prv[k] = i
                if (r := rank_of(part[i], part[k])) is not None:
                    heapq.heappush(heap, (r, i, part[i], part[k]))
            h = prv[i]
            if h >= 0 and (r := rank_of(part[h], part[i])) is not None:
                heapq.heappush(heap, (r, h, part[h], part[i]))
        return [p for p in part if p is not None]

    def _test(self, key: int) -> bool:
        """Whether a token pair (a * base + b) is the encoding of its joined text; a token
        with none before it has to be its own encoding (some entries are unreachable)."""
        if len(self._pairs) >= PAIR_LIMIT:
            self._pairs.clear()
        a, b = divmod(key, self._base)
        want = [self.text_of[i] for i in (a, b) if i != self._base - 1]
        ok = self._pairs[key] = self.merge("".join(want)) == want
        return ok

    def table(self, text: str) -> tuple[list[int], list[int]]:
        """(last, count): at each position, the last token of the prefix that ends there and
        the number of its tokens. Every unit of ``text`` must be a token by itself."""
        base, pairs = self._base, self._pairs
        n = len(text)
        last, count = [-1] * n, [0] * n
        last.append(base - 1)  # what index -1 finds: nothing before the first token
        count.append(0)
        for end, (token, length) in self._automaton.iter(text):  # longest first at each end
            if last[end] < 0:
                before = end - length
                key = last[before] * base + token
                ok = pairs.get(key)
                if ok is None:
                    ok = self._test(key)
                if ok:
                    last[end] = token
                    count[end] = count[before] + 1
        del last[-1], count[-1]
        return last, count

    def backward(self, last: list[int]) -> list[int]:
        """The ids of the whole text, recovered from its end."""
        ids, at, text_of = [], len(last) - 1, self.text_of
        while at >= 0:
            ids.append(last[at])
            at -= len(text_of[last[at]])
        ids.reverse()
        return ids
