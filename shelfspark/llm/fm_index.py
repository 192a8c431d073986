"""A bidirectional FM-index over a delimited vocabulary, and its search scheme for one error.

The words stand in one text, a delimiter around each. ``Side`` holds the suffix ranks of that text (or of the
reversed text) as a wavelet matrix over its Burrows-Wheeler transform: a pattern is an interval of ranks, and
putting a symbol before it is one walk down the matrix. ``FmIndex`` keeps both directions in step, so that a
pattern can first grow to one side and then to the other. All queries of a batch move together.
"""

from __future__ import annotations

import numpy as np

#: Query positions of a batch: bounds the search nodes that are alive at once.
POSITIONS = 20_000


def suffix_ranks(text: np.ndarray, longest: int) -> np.ndarray:
    """Start of each suffix of ``text`` in order; a suffix ends at its first delimiter (0), equal ones go by place.

    Eight symbols are compared at first, then twice as many each round, until the longest word is covered.
    """
    n, base, h = len(text), int(text.max()) + 1, 8
    key, ended = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=bool)
    for j in range(h):
        sym = np.zeros(n, dtype=np.int64)
        sym[:max(n - j, 0)] = text[j:]
        sym[ended] = 0
        ended |= sym == 0
        key = key * base + sym
    rank = np.unique(key, return_inverse=True)[1]
    while h <= longest:
        after = np.zeros(n, dtype=np.int64)
        after[:n - h] = rank[h:] + 1
        after[ended] = 0
        rank = np.unique(rank * np.int64(n + 1) + after, return_inverse=True)[1]
        done = np.ones(n, dtype=bool)
        done[:n - h] = ended[h:]
        ended |= done
        h *= 2
    return np.argsort(rank, kind="stable")


class Side:
    """Suffix-rank intervals of one direction of the text."""

    def __init__(self, text: np.ndarray, sigma: int, longest: int, starts: np.ndarray, names: np.ndarray):
        sa = suffix_ranks(text, longest)
        self.sigma, self.bwt = sigma, text[sa - 1]
        first = np.flatnonzero(self.bwt == 0)
        #: word of each rank that a delimiter precedes, in the order of those ranks; -1: the text's begin, no word
        self.words = np.where(sa[first] == 0, -1, names[np.searchsorted(starts, sa[first])])
        self.bits = max(1, int(sigma - 1).bit_length())
        self.zeros, self.n_zeros, seq = [], [], self.bwt
        for b in range(self.bits - 1, -1, -1):
            one = (seq >> b) & 1 == 1
            z = np.zeros(len(seq) + 1, dtype=np.int32)
            np.cumsum(~one, out=z[1:])
            self.zeros.append(z)
            self.n_zeros.append(int(z[-1]))
            seq = np.concatenate([seq[~one], seq[one]])
        every = np.arange(sigma)
        self.shift = np.zeros(sigma, dtype=np.int64)
        less = np.concatenate([[0], np.cumsum(np.bincount(self.bwt, minlength=sigma))[:-1]])
        self.shift = less - self._walk(every, np.zeros(sigma, dtype=np.int64))
        self.size = len(text)

    def _walk(self, sym, at):
        for k, b in enumerate(range(self.bits - 1, -1, -1)):
            z = self.zeros[k][at]
            at = np.where((sym >> b) & 1 == 1, self.n_zeros[k] + at - z, z)
        return at.astype(np.int64)

    def grow(self, sym, lo, hi):
        """The intervals of the patterns with ``sym`` put before them."""
        return self._walk(sym, lo) + self.shift[sym], self._walk(sym, hi) + self.shift[sym]

    def smaller(self, sym, lo, hi):
        """How many ranks of the intervals are preceded by a smaller symbol."""
        count = np.zeros(len(sym), dtype=np.int64)
        for k, b in enumerate(range(self.bits - 1, -1, -1)):
            zl, zh = self.zeros[k][lo].astype(np.int64), self.zeros[k][hi].astype(np.int64)
            one = (sym >> b) & 1 == 1
            count += np.where(one, zh - zl, 0)
            lo = np.where(one, self.n_zeros[k] + lo - zl, zl)
            hi = np.where(one, self.n_zeros[k] + hi - zh, zh)
        return count

    def before(self, lo, hi):
        """(interval number, symbol) of every symbol but the delimiter that precedes a rank of the intervals."""
        wide = hi - lo > self.sigma
        n, s = np.flatnonzero(~wide), np.flatnonzero(wide)
        ranks = lo[n].repeat((hi - lo)[n]) + _counting((hi - lo)[n])
        pair = np.unique(n.repeat((hi - lo)[n]) * np.int64(self.sigma) + self.bwt[ranks])
        node, sym = pair // self.sigma, pair % self.sigma
        if len(s):
            many, each = s.repeat(self.sigma), np.tile(np.arange(self.sigma), len(s))
            a, b = self.grow(each, lo[many], hi[many])
            node, sym = np.concatenate([node, many[b > a]]), np.concatenate([sym, each[b > a]])
        return node[sym > 0], sym[sym > 0]

    def whole(self, lo, hi):
        """(interval number, word) of the words that the intervals' patterns are, from the delimiter on."""
        zero = np.zeros(len(lo), dtype=np.int64)
        a, b = self.grow(zero, lo, hi)      # delimiters have the smallest symbol: their ranks count from 0
        node, word = np.arange(len(lo)).repeat(b - a), self.words[a.repeat(b - a) + _counting(b - a)]
        return node[word >= 0], word[word >= 0]


def _counting(sizes: np.ndarray) -> np.ndarray:
    """0, 1, .. size - 1 for each size."""
    return np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def _codes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all words one after another, and lengths."""
    flat = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32)
    return flat, np.fromiter(map(len, words), dtype=np.int64, count=len(words))


class FmIndex:
    """Index of distinct, non-empty words."""

    def __init__(self, words: list[str]):
        flat, lens = _codes(words)
        self.n, self.symbols = len(words), np.unique(flat)
        text = np.zeros(len(flat) + len(words) + 1, dtype=np.int64)
        starts = np.cumsum(lens + 1) - lens
        text[starts.repeat(lens) + _counting(lens)] = np.searchsorted(self.symbols, flat) + 1
        sigma, longest = len(self.symbols) + 1, int(lens.max())
        names = np.arange(len(words))
        self.forward = Side(text, sigma, longest, starts, names)
        self.backward = Side(text[::-1].copy(), sigma, longest, (len(text) - starts - lens)[::-1], names[::-1])

    def near(self, words: list[str], left: bool) -> tuple[np.ndarray, np.ndarray]:
        """(query, word) numbers, each once: words of the index with exactly one code point inserted, deleted or
        replaced that share the query's left half (or right half) exactly. The left half is the shorter one."""
        if not words or not self.n:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        flat, lens = _codes(words)
        at = np.searchsorted(self.symbols, flat)
        known = self.symbols[np.minimum(at, len(self.symbols) - 1)] == flat
        codes = np.where(known, at + 1, -1)
        ends = np.cumsum(lens)
        out = []
        batch = (ends - 1) // POSITIONS
        for b in np.unique(batch):
            i = np.flatnonzero(batch == b)
            part, n = codes[ends[i[0]] - lens[i[0]]:ends[i[-1]]], lens[i]
            if left:
                q, w = _search(self.forward, self.backward, part, n, n // 2)
            else:
                turned = (np.cumsum(n) - 1).repeat(n) - _counting(n)
                q, w = _search(self.backward, self.forward, part[turned], n, n - n // 2)
            out.append(np.unique(i[q] * np.int64(self.n) + w))
        pair = np.concatenate(out)
        return pair // self.n, pair % self.n


def _search(inner: Side, outer: Side, codes: np.ndarray, lens: np.ndarray, half: np.ndarray):
    """Match each query's first ``half`` symbols without error, then the rest with one.

    The half grows from its last symbol back to the delimiter in ``inner``, while the interval of the same pattern
    in ``outer`` is kept in step; from there the pattern grows to the other side in ``outer``.
    """
    first = np.cumsum(lens) - lens
    q = np.arange(len(lens))
    lo, hi = np.zeros(len(q), dtype=np.int64), np.full(len(q), inner.size)
    at = np.zeros(len(q), dtype=np.int64)
    for t in range(1, int(half.max()) + 1):
        go = np.flatnonzero(half[q] >= t)
        sym = codes[first[q[go]] + half[q[go]] - t]
        ok = sym > 0
        a, b, o = np.zeros(len(go), dtype=np.int64), np.zeros(len(go), dtype=np.int64), at[go]
        a[ok], b[ok] = inner.grow(sym[ok], lo[go[ok]], hi[go[ok]])
        o[ok] += inner.smaller(sym[ok], lo[go[ok]], hi[go[ok]])
        lo[go], hi[go], at[go] = a, b, o
        keep = hi > lo
        q, lo, hi, at = q[keep], lo[keep], hi[keep], at[keep]
    a, b = inner.grow(np.zeros(len(q), dtype=np.int64), lo, hi)
    q, lo, hi = q[b > a], at[b > a], (at + b - a)[b > a]
    start, rest = first + half, lens - half
    made = []
    for j in range(int(rest.max()) + 1):             # q, lo, hi: no error so far, j symbols of the rest matched
        node, sym = outer.before(lo, hi)
        a, b = outer.grow(sym, lo[node], hi[node])
        place = np.full(len(node), j)
        made.append((q[node], a, b, place))                                              # inserted
        more = rest[q] > j
        want = np.where(more, codes[np.minimum(start[q] + j, len(codes) - 1)], 0)
        other = more[node] & (sym != want[node])
        made.append((q[node][other], a[other], b[other], place[other] + 1))              # replaced
        made.append((q[more], lo[more], hi[more], np.full(int(more.sum()), j + 1)))      # deleted
        go = more & (want > 0)
        q, want = q[go], want[go]
        lo, hi = outer.grow(want, lo[go], hi[go])
        q, lo, hi = q[hi > lo], lo[hi > lo], hi[hi > lo]
    q, lo, hi, j = (np.concatenate(x) for x in zip(*made, strict=True))
    found = []
    while len(q):
        end = rest[q] == j
        node, word = outer.whole(lo[end], hi[end])
        found.append((q[end][node], word))
        q, lo, hi, j = q[~end], lo[~end], hi[~end], j[~end]
        sym = codes[start[q] + j]
        q, lo, hi, j, sym = q[sym > 0], lo[sym > 0], hi[sym > 0], j[sym > 0], sym[sym > 0]
        lo, hi = outer.grow(sym, lo, hi)
        keep = hi > lo
        q, lo, hi, j = q[keep], lo[keep], hi[keep], j[keep] + 1
    if not found:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))
