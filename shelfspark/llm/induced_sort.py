"""Suffix order and common prefixes of one shard by external induced sorting.

The suffixes that start at leftmost smaller places (LMS) are sorted first: their substrings by one
induction, then, where substrings repeat, by the reduced string of their names. From them two
scans induce all others: the suffix before a scanned one goes to the queue of its first
character, larger types ascending, smaller types descending. A queue is a bulk priority queue:
characters order the queues, arrival orders a queue, so entries are popped in blocks, never one by
one. An entry carries its place and the length of the prefix that it shares with the entry before
it in its queue: one more than the least such value between the two entries that induced them,
which a sparse table over the popped block answers. Queues beyond ``MEMORY`` bytes go to unnamed
files of the task, which vanish with it, as Spark's own spills do.

Common prefixes count up to ``cap``; suffixes are ordered by that many characters at least.
"""

from __future__ import annotations

import tempfile
from collections import deque

import numpy as np

#: Bytes of all queues that stay in memory; entries that are popped at a time.
MEMORY, BLOCK = 96 << 20, 1 << 19
_MULT = np.uint64(0x9E3779B97F4A7C15)


class Queues:
    """First-in first-out queues of (place, common prefix) for each character, on disk beyond MEMORY bytes."""

    def __init__(self, chars: int):
        self.parts = [deque() for _ in range(chars)]
        self.held, self.file = 0, None

    def push(self, c: int, pos: np.ndarray, lcp: np.ndarray) -> None:
        self.held += pos.nbytes + lcp.nbytes
        self.parts[c].append((pos, lcp))
        if self.held > MEMORY:
            self._spill()

    def _spill(self) -> None:
        if self.file is None:
            self.file = tempfile.TemporaryFile()
        self.file.seek(0, 2)
        for q in self.parts:
            for i, part in enumerate(q):
                if len(part) == 2:
                    at = self.file.tell()
                    self.file.write(part[0].tobytes())
                    self.file.write(part[1].tobytes())
                    q[i] = (at, len(part[0]), part[0].dtype)
        self.held = 0

    def pop(self, c: int):
        """Blocks of a queue, those that are pushed to it meanwhile included; what waits is popped together."""
        while self.parts[c]:
            got, n = [], 0
            while self.parts[c] and n < BLOCK:
                part = self.parts[c].popleft()
                if len(part) == 2:
                    self.held -= part[0].nbytes + part[1].nbytes
                else:
                    at, size, kind = part
                    self.file.seek(at)
                    part = (np.frombuffer(self.file.read(size * kind.itemsize), dtype=kind),
                            np.frombuffer(self.file.read(2 * size), dtype=np.uint16))
                got.append(part)
                n += len(part[0])
            yield tuple(np.concatenate(x) if len(got) > 1 else x[0] for x in zip(*got, strict=True))


class Minima:
    """Least values of ranges of an array."""

    def __init__(self, a: np.ndarray):
        self.levels, step = [a], 1
        while 2 * step <= len(a):
            last = self.levels[-1]
            self.levels.append(np.minimum(last[:-step], last[step:]))
            step *= 2

    def least(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Of a[lo..hi], lo <= hi."""
        out = np.empty(len(lo), dtype=self.levels[0].dtype)
        level = np.frexp((hi - lo + 1).astype(np.float64))[1] - 1
        for k in np.unique(level):
            m = level == k
            t = self.levels[k]
            out[m] = np.minimum(t[lo[m]], t[hi[m] - (1 << int(k)) + 1])
        return out


class Sorter:
    def __init__(self, text: np.ndarray, cap: int):
        """text: unsigned 16-bit characters, the last one 0 and none below it."""
        self.t, self.n, self.cap = text, len(text), cap
        self.chars = int(text.max()) + 1
        kind = np.int32 if self.n < 2 ** 31 else np.int64
        # types: a place is small if its suffix is smaller than the next one
        less = np.zeros(self.n, dtype=bool)
        less[:-1] = text[:-1] < text[1:]
        same = np.zeros(self.n, dtype=bool)
        same[:-1] = text[:-1] == text[1:]
        ends = np.flatnonzero(~same)
        less[-1] = True
        self.small = np.repeat(less[ends], np.diff(ends, prepend=-1))
        lms = np.flatnonzero(self.small[1:] & ~self.small[:-1]) + 1
        self.lms = lms.astype(kind)
        self.padded = np.concatenate([text, np.zeros(cap + 4, dtype=np.uint16)])

    def shared(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Common prefixes of pairs of suffixes, up to cap, by words of four characters."""
        words = np.lib.stride_tricks.as_strided(self.padded.view(np.uint16), (self.n + self.cap, 4), (2, 2))
        out = np.full(len(a), self.cap, dtype=np.int64)
        live = np.arange(len(a))
        a, b = a.astype(np.int64), b.astype(np.int64)
        for off in range(0, self.cap, 4):
            if not len(live):
                break
            diff = words[np.minimum(a[live] + off, self.n)] != words[np.minimum(b[live] + off, self.n)]
            hit = diff.any(axis=1)
            out[live[hit]] = off + diff[hit].argmax(axis=1)
            live = live[~hit]
        return np.minimum(out, self.cap).astype(np.uint16)

    def _give(self, queues: Queues, gap: np.ndarray, c: int, pos, lcp, take) -> None:
        """Pushes the places before ``pos`` whose character passes ``take``; gap: least prefix since a queue's last push."""
        before = pos - 1
        ok = pos > 0
        ch = self.t[np.maximum(before, 0)]
        ok &= take(ch, c)
        at = np.flatnonzero(ok)
        low = lcp.min() if len(lcp) else self.cap
        if not len(at):
            np.minimum(gap, low, out=gap)
            return
        order = np.argsort(ch[at], kind="stable")
        at, ch = at[order], ch[at][order]
        first = np.flatnonzero(np.concatenate(([True], ch[1:] != ch[:-1])))
        lo = np.concatenate(([0], at[:-1] + 1))
        lo[first] = 0
        table = Minima(lcp)
        got = table.least(lo, at)
        heads = ch[first]
        got[first] = np.minimum(got[first], gap[heads])
        np.minimum(gap, low, out=gap)
        last = np.append(first[1:], len(at)) - 1
        tail = at[last] + 1
        rest = np.full(len(tail), self.cap, dtype=np.uint16)
        some = tail < len(lcp)
        rest[some] = table.least(tail[some], np.full(int(some.sum()), len(lcp) - 1))
        gap[heads] = rest
        new = np.minimum(got + np.uint16(1), self.cap).astype(np.uint16)
        for a, b, d in zip(first, last + 1, heads, strict=True):
            queues.push(int(d), before[at[a:b]], new[a:b])

    def induce(self, seeds: np.ndarray, seed_lcp: np.ndarray):
        """For each character: the ascending places and prefixes of the larger type, the descending ones of the smaller."""
        ch = self.t[seeds]
        bounds = np.searchsorted(ch, np.arange(self.chars + 1))
        queues, gap, large = Queues(self.chars), np.zeros(self.chars, dtype=np.uint16), [None] * self.chars
        one = lambda a, b: self.shared(np.asarray([a]), np.asarray([b]))[0]
        for c in range(self.chars):
            gap[:] = 0
            done, end = [], None
            for pos, lcp in queues.pop(c):
                lcp = lcp.copy()
                if end is None:
                    lcp[0] = 0
                self._give(queues, gap, c, pos, lcp, lambda x, c: x >= c)
                done.append((pos, lcp))
                end = pos[-1]
            large[c] = done
            for i in range(bounds[c], bounds[c + 1], BLOCK):
                j = min(i + BLOCK, bounds[c + 1])
                lcp = seed_lcp[i:j].copy()
                if i == bounds[c]:
                    lcp[0] = 0 if end is None else one(end, seeds[i])
                self._give(queues, gap, c, seeds[i:j], lcp, lambda x, c: x > c)
        queues, small = Queues(self.chars), [None] * self.chars
        for c in range(self.chars - 1, -1, -1):
            gap[:] = 0
            done, end = [], None
            for pos, lcp in queues.pop(c):
                lcp = lcp.copy()
                if end is None:
                    lcp[0] = 0
                self._give(queues, gap, c, pos, lcp, lambda x, c: x <= c)
                done.append((pos, lcp))
                end = pos[-1]
            small[c] = done
            prefix = None
            for pos, lcp in reversed(large[c]):
                # descending: a value goes with the entry below it
                down = np.empty(len(pos), dtype=np.uint16)
                down[1:] = lcp[:0:-1]
                if prefix is None:
                    prefix = 0 if end is None else one(end, pos[-1])
                down[0] = prefix
                self._give(queues, gap, c, pos[::-1], down, lambda x, c: x < c)
                prefix = lcp[0]
        return large, small

    def _seed_order(self) -> np.ndarray:
        """LMS places in the order of their suffixes."""
        lms = self.lms
        if len(lms) < 2:
            return lms
        by_char = lms[np.argsort(self.t[lms], kind="stable")]
        by_char = np.concatenate(([lms[-1]], by_char[by_char != lms[-1]]))   # the end is the least
        _, small = self.induce(by_char, np.zeros(len(by_char), dtype=np.uint16))
        is_lms = np.zeros(self.n, dtype=bool)
        is_lms[lms] = True
        parts = [pos[is_lms[pos]][::-1] for c in range(self.chars) for pos, _ in reversed(small[c])]
        order = np.concatenate([lms[-1:], *parts])
        # names: equal substrings get one name
        with np.errstate(over="ignore"):
            power = np.cumprod(np.full(self.n, _MULT | np.uint64(1)))
            inverse = np.cumprod(np.full(self.n, np.uint64(pow(int(_MULT) | 1, -1, 1 << 64))))
            sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum((self.t.astype(np.uint64) + np.uint64(1)) * power)))
            nth = np.searchsorted(lms, order)
            stop = np.append(lms[1:], self.n - 1)[nth] + 1
            digest = (sums[stop] - sums[order]) * inverse[order]
        new = np.ones(len(order), dtype=bool)
        new[1:] = (digest[1:] != digest[:-1]) | ((stop - order)[1:] != (stop - order)[:-1])
        rank = np.empty(len(lms), dtype=np.int64)
        rank[nth] = np.cumsum(new)
        k = 1
        while rank.max() < len(lms) and k < self.cap:     # a substring has two characters at least
            key = rank * (len(lms) + 2) + np.concatenate((rank[k:], np.zeros(min(k, len(rank)), dtype=np.int64)))[:len(rank)]
            at = np.argsort(key, kind="stable")
            step = np.concatenate(([1], (key[at][1:] != key[at][:-1]).astype(np.int64)))
            rank[at] = np.cumsum(step)
            k *= 2
        return lms[np.argsort(rank, kind="stable")]

    def repeated(self) -> np.ndarray:
        """Places whose first cap characters also stand at another place."""
        out = np.zeros(self.n, dtype=bool)
        seeds = self._seed_order()
        lcp = np.zeros(len(seeds), dtype=np.uint16)
        lcp[1:] = self.shared(seeds[:-1], seeds[1:])
        large, small = self.induce(seeds, lcp)
        for c in range(self.chars):
            end = None
            for pos, lcp in large[c]:
                out[pos[lcp >= self.cap]] = True
                near = np.flatnonzero(lcp >= self.cap)
                out[pos[near[near > 0] - 1]] = True
                if end is not None and lcp[0] >= self.cap:
                    out[end] = True
                end = pos[-1]
            top, end = end, None
            for pos, lcp in small[c]:
                out[pos[lcp >= self.cap]] = True
                near = np.flatnonzero(lcp >= self.cap)
                out[pos[near[near > 0] - 1]] = True
                if end is not None and lcp[0] >= self.cap:
                    out[end] = True
                end = pos[-1]
            if top is not None and end is not None and self.shared(np.asarray([top]), np.asarray([end]))[0] >= self.cap:
                out[[top, end]] = True
        return out


def repeated_places(text: np.ndarray, cap: int) -> np.ndarray:
    """Of a text of 16-bit characters whose last is 0: the places whose first ``cap`` characters stand elsewhere too."""
    return Sorter(text, cap).repeated()
