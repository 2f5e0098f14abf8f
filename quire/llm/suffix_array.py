"""Suffix arrays by induced sorting, and permuted common prefixes, as numpy passes.

The array is built by the induced-sorting scheme: suffixes are classified as smaller (S) or larger (L) than their
successor, the leftmost S suffixes are sorted by inducing, named, sorted recursively as a shorter string, and the whole
array is induced from their order, L suffixes left to right and S suffixes right to left. Reading the array puts each
suffix's predecessor at the next free place of its own bucket; here whole batches of buckets are read at once. A batch
goes as far as no suffix in it puts another one into it, so what it holds is complete when its turn comes, and its
predecessors are dealt to their buckets by one stable sort of their symbols. Runs of one symbol follow from their last
place: in its bucket a longer run comes after (L) or before (S) every shorter one. The same passes serve any number
of symbols, from the bytes of the text down to the names of the last level.
"""

from __future__ import annotations

import numpy as np


def smaller(s: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the next one (the last symbol is the least and alone, so it is)."""
    step = np.sign(np.diff(s.astype(np.int64)))
    out = np.ones(len(s), bool)
    if len(step):
        at = np.where(step != 0, np.arange(len(step)), len(step) - 1)
        at = np.minimum.accumulate(at[::-1])[::-1]  # where the run of equal symbols ends
        out[:-1] = step[at] > 0
    return out


def dealt(symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The stable order by symbol, each one's rank among its equals, and the different symbols with their counts."""
    order = np.argsort(symbol, kind="stable")
    own = symbol[order]
    first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
    n = np.diff(first, append=len(own))
    return order, np.arange(len(own)) - np.repeat(first, n), own[first], n


class Direction:
    """One of the two passes. Left to right it fills the L suffixes of each bucket, read with the leftmost S suffixes;
    right to left, over the mirrored alphabet, it fills the S suffixes, read with the L suffixes.

    symbol: of each place, so that buckets are read in ascending order; kind: the suffixes to fill.
    """

    def __init__(self, symbol: np.ndarray, k: int, kind: np.ndarray):
        n = len(symbol)
        self.symbol, self.k = symbol, k
        equal = np.zeros(n, bool)
        equal[:-1] = symbol[:-1] == symbol[1:]
        self.last = kind & ~equal  # the last place of a run: put there by a suffix of another bucket
        run = np.flatnonzero(np.concatenate([[True], ~equal[:-1]]))
        self.back = np.arange(n) - np.repeat(run, np.diff(run, append=n)) + 1  # length of the run up to each place
        self.filled = np.bincount(symbol[kind], minlength=k)
        self.ends = np.bincount(symbol[self.last], minlength=k)  # of those, last places
        self.runs = np.concatenate([[0], np.cumsum(self.filled - self.ends)])
        self.cuts = self._batches(np.flatnonzero(self.last[:-1]))

    def _batches(self, j: np.ndarray) -> list[int]:
        """Edges of the batches: from b up to the least symbol that a suffix of b or more puts something into."""
        least = np.full(self.k + 1, self.k)
        np.minimum.at(least, self.symbol[j + 1], self.symbol[j])
        least = np.minimum.accumulate(least[::-1])[::-1].tolist()
        out = [0]
        while out[-1] < self.k:
            out.append(least[out[-1]])
        return out

    def fill(self, given: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The filled and the given suffixes (in order) as they are read, and which of them were filled."""
        symbol = self.symbol
        extra = np.bincount(symbol[given], minlength=self.k)
        size = self.filled + extra
        start = np.concatenate([[0], np.cumsum(size)])
        out = np.zeros(int(start[-1]), np.int64)
        of_given = symbol[given]
        at = np.arange(len(given)) - (np.cumsum(extra) - extra)[of_given] + (start[:-1] + self.filled)[of_given]
        out[at] = given
        own = np.ones(len(out), bool)
        own[at] = False
        free = start[:-1].copy()
        for a, b in zip(self.cuts, self.cuts[1:], strict=False):
            lo, hi = start[a], start[b]
            if lo == hi:
                continue
            if self.runs[a] < self.runs[b]:
                self._runs(out, start, a, b)
            j = out[lo:hi] - 1
            j = j[self.last[j]]  # of place 0 this asks the end symbol, which is never filled
            if not len(j):
                continue
            order, rank, c, n = dealt(symbol[j])
            out[np.repeat(free[c], n) + rank] = j[order]
            free[c] += n
        return out, own

    def _runs(self, out: np.ndarray, start: np.ndarray, a: int, b: int) -> None:
        """The suffixes of buckets a to b-1 that lie within a run, from those at its last place."""
        c = np.flatnonzero(self.filled[a:b] > self.ends[a:b]) + a
        n = self.ends[c]
        bucket = np.repeat(c, n)
        rank = np.arange(len(bucket)) - np.repeat(np.cumsum(n) - n, n)
        last = out[start[bucket] + rank]
        more = self.back[last] - 1
        which = np.repeat(np.arange(len(last)), more)
        step = np.arange(len(which)) - np.repeat(np.cumsum(more) - more, more) + 1
        order = np.lexsort((which, step, bucket[which]))
        which, step = which[order], step[order]
        n = self.filled[c] - self.ends[c]
        place = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(start[c] + self.ends[c], n)
        out[place] = last[which] - step


def names(s: np.ndarray, sorted_lms: np.ndarray, lms: np.ndarray) -> tuple[np.ndarray, int]:
    """Names of the substrings between leftmost S suffixes, in text order, and how many differ."""
    length = np.diff(np.append(lms, len(s) - 1)) + 1
    number = np.zeros(len(s), np.int64)
    number[lms] = np.arange(len(lms))
    own = length[number[sorted_lms]]
    a, b = sorted_lms[:-1], sorted_lms[1:]
    differs = own[:-1] != own[1:]
    live = np.flatnonzero(~differs)
    d = 0
    while len(live):
        live = live[own[live] > d]
        n = np.minimum(own[live] - d, max(1, d // 4))  # so many symbols at once
        ends = np.cumsum(n)
        step = np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - n, n) + d
        unlike = np.flatnonzero(s[np.repeat(a[live], n) + step] != s[np.repeat(b[live], n) + step])
        x = np.zeros(len(live), bool)
        x[np.searchsorted(ends, unlike, "right")] = True
        differs[live[x]] = True
        live = live[~x]
        d += max(1, d // 4)
    name = np.concatenate([[0], np.cumsum(differs)])
    out = np.zeros(len(lms), np.int64)
    out[number[sorted_lms]] = name
    return out, int(name[-1]) + 1


def suffix_array(s: np.ndarray, k: int) -> np.ndarray:
    """Suffix array of symbols 0 to k-1; the last symbol must be 0 and the only one."""
    if len(s) == 1:
        return np.zeros(1, np.int64)
    small = smaller(s)
    lms = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    left = Direction(s, k, ~small)
    rising = small.copy()
    rising[-1] = False  # the end symbol has its place
    right = Direction(k - 1 - s, k, rising)

    def induced(seeds: np.ndarray) -> np.ndarray:
        """The array that follows from the leftmost S suffixes in their order."""
        read, own = left.fill(seeds)
        read, _ = right.fill(np.append(read[own][::-1], len(s) - 1))
        return read[::-1]

    if len(lms) > 1:
        rough = induced(lms[np.argsort(s[lms], kind="stable")])
        is_lms = np.zeros(len(s), bool)
        is_lms[lms] = True
        name, different = names(s, rough[is_lms[rough]], lms)
        if different < len(lms):
            lms = lms[suffix_array(name, different)]
        else:
            order = np.empty(len(lms), np.int64)
            order[name] = np.arange(len(lms))
            lms = lms[order]
    return induced(lms)


FAR = 256  # symbols after which common prefixes are compared one by one


def shared(text: np.ndarray, a: int, b: int) -> int:
    """How many symbols are the same from two places on."""
    most, done, step = len(text) - max(a, b), 0, FAR
    while done < most:
        step = min(2 * step, most - done)
        unlike = text[a + done : a + done + step] != text[b + done : b + done + step]
        at = int(unlike.argmax())
        if unlike[at]:
            return done + at
        done += step
    return most


def common_prefixes(text: np.ndarray, sa: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(phi, plcp): for each place its predecessor in the array (-1 for the first) and their common prefix.

    A place whose predecessor's left neighbour has the same symbol shares all but one symbol of the place before it;
    only the others are compared, eight symbols at a time and far ones in doubled steps, and the rest follows from them.
    """
    n = len(text)
    phi = np.full(n, -1, np.int64)
    phi[sa[1:]] = sa[:-1]
    place = np.arange(n)
    plain = (phi > 0) & (place > 0)
    plain[plain] = text[place[plain] - 1] == text[phi[plain] - 1]
    start = np.flatnonzero(~plain & (phi >= 0))
    padded = np.concatenate([text.astype(np.uint8), np.zeros(16, np.uint8)])
    words = np.zeros(n + 8, np.uint64)
    for b in range(8):
        words |= padded[b : b + n + 8].astype(np.uint64) << np.uint64(8 * b)
    length = np.zeros(n, np.int64)
    live, d = start, 0
    while len(live):
        a, b = live + d, phi[live] + d
        inside = np.maximum(a, b) < n
        live, a, b = live[inside], a[inside], b[inside]
        same = words[a] == words[b]
        x = words[a[~same]] ^ words[b[~same]]
        low = np.zeros(len(x), np.int64)
        rest = np.ones(len(x), bool)
        for i in range(7):
            rest &= (x >> np.uint64(8 * i)) & np.uint64(255) == 0
            low += rest
        ends = live[~same]
        length[ends] = np.minimum(d + low, n - np.maximum(ends, phi[ends]))
        live = live[same]
        length[live] = np.minimum(d + 8, n - np.maximum(live, phi[live]))
        d += 8
        if d >= FAR:  # few are left, and these may go on for long: one by one, in pieces of doubled length
            for i in live.tolist():
                length[i] = d + shared(text, i + d, int(phi[i]) + d)
            break
    head = np.where(plain, -1, place)
    head = np.maximum.accumulate(head)
    return phi, np.maximum(0, length[head] - (place - head))
