"""Suffixes of a string in order, with their common prefixes, by external induced sorting.

Every suffix is either smaller than the one that begins behind it (S) or larger (L). If the S suffixes that follow an
L suffix are in order, then one pass upwards over the first characters finds the order of all L suffixes, and one pass
downwards that of all S suffixes: a suffix, once it comes out of the queue, puts its predecessor in. Each tuple in the
queue holds a suffix and its common prefix with the tuple before it, which is one more than the smallest common prefix
on the way between the two suffixes that put them in.

First characters come out in order only, so the priority queue is a list of tuples per character; lists beyond a
memory limit are moved to a temporary file, which has no name and goes with the task. The S suffixes to start with are
ordered by recursion on the string of their names, as long as its characters are frequent enough to be handled in
blocks, and by prefix doubling otherwise.

Common prefixes are exact up to `cap`; suffixes that agree on more than that may come in any order.
"""

from __future__ import annotations

import tempfile
from collections import defaultdict
from collections.abc import Iterator

import numpy as np

MEMORY = 256 << 20
BLOCK = 1 << 18
FREQUENT = 512


class TupleQueue:
    """(suffix, common prefix) tuples by first character, in order of arrival; long lists wait on disk."""

    def __init__(self, memory: int):
        self.memory, self.held = memory, 0
        self.lists: dict[int, list] = defaultdict(list)
        self.file = None

    def push(self, key: int, suffixes: np.ndarray, prefixes: np.ndarray) -> None:
        self.lists[key].append((suffixes, prefixes))
        self.held += suffixes.nbytes + prefixes.nbytes
        if self.held > self.memory:
            self._spill()

    def _spill(self) -> None:
        if self.file is None:
            self.file = tempfile.TemporaryFile()
        for parts in self.lists.values():
            waiting = [i for i, p in enumerate(parts) if isinstance(p[0], np.ndarray)]
            for i in waiting:
                suffixes, prefixes = parts[i]
                self.file.seek(0, 2)
                parts[i] = (self.file.tell(), len(suffixes))
                self.file.write(suffixes.tobytes() + prefixes.tobytes())
        self.held = 0

    def _loaded(self, part: tuple) -> tuple[np.ndarray, np.ndarray]:
        if isinstance(part[0], np.ndarray):
            self.held -= part[0].nbytes + part[1].nbytes
            return part
        at, n = part
        self.file.seek(at)
        data = self.file.read(6 * n)
        return np.frombuffer(data, np.int32, n), np.frombuffer(data, np.int16, n, 4 * n)

    def pop(self, key: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Blocks of the list; what is pushed to it meanwhile comes too."""
        while parts := self.lists.pop(key, None):
            taken: list = []
            size = 0
            for part in parts:
                taken.append(self._loaded(part))
                size += len(taken[-1][0])
                if size >= BLOCK:
                    yield tuple(np.concatenate(x) for x in zip(*taken))
                    taken, size = [], 0
            if taken:
                yield tuple(np.concatenate(x) for x in zip(*taken))

    def pop_reversed(self, key: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for part in reversed(self.lists.pop(key, [])):
            yield self._loaded(part)


def _range_minima(values: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Smallest of values[first : last + 1] for many ranges, from minima over powers of two."""
    if not len(first):
        return values[:0]
    level = np.frexp((last - first + 1).astype(np.float64))[1] - 1
    found = np.zeros(len(first), values.dtype)
    table, width = values, 1
    for k in range(int(level.max()) + 1):
        here = np.flatnonzero(level == k)
        if len(here):
            found[here] = np.minimum(table[first[here]], table[last[here] - width + 1])
        if len(table) > width:
            table = np.minimum(table[:-width], table[width:])
        width *= 2
    return found


class Inducer:
    """One level of the recursion over a string whose last character is its only 0."""

    def __init__(self, text: np.ndarray, cap: int, memory: int):
        self.text, self.cap, self.memory = text, cap, memory
        n = len(text)
        step = np.sign(np.diff(text.astype(np.int64)))
        place = np.where(step != 0, np.arange(n - 1), n)
        self.run_end = np.append(np.minimum.accumulate(place[::-1])[::-1], n - 1).astype(np.int32)
        self.is_s = np.ones(n, bool)
        self.is_s[:-1] = step[np.minimum(self.run_end[:-1], n - 2)] > 0
        self.starts = np.flatnonzero(self.is_s[1:] & ~self.is_s[:-1]).astype(np.int32) + 1
        self.characters = np.unique(text)

    def names(self) -> np.ndarray:
        """Rank of the stretch from each start to the next one among all of them."""
        starts, text = self.starts, self.text
        m = len(starts)
        sizes = np.diff(starts, append=len(text) - 1) + 1
        bits = int(text.max() + 2).bit_length()
        per = 63 // bits
        pad = (1 << bits) - 1

        def key(which: np.ndarray, offset: int) -> np.ndarray:
            found = np.zeros(len(which), np.int64)
            for k in range(offset, offset + per):
                inside = sizes[which] > k
                # a stretch that has ended is larger than one that goes on
                found = found << bits | np.where(inside, text[np.minimum(starts[which] + k, len(text) - 1)], pad)
            return found

        _, rank, counts = np.unique(key(np.arange(m), 0), return_inverse=True, return_counts=True)
        rank = (np.cumsum(counts) - counts)[rank]
        offset = per
        tied = np.flatnonzero((np.bincount(rank, minlength=m)[rank] > 1) & (sizes > offset))
        while len(tied):
            group = np.zeros(m + 1, bool)
            group[rank[tied]] = True
            tied = np.flatnonzero(group[rank])
            rank[tied] = _refined(rank[tied], key(tied, offset))
            offset += per
            tied = tied[(np.bincount(rank[tied], minlength=m)[rank[tied]] > 1) & (sizes[tied] > offset)]
        return np.unique(rank, return_inverse=True)[1]

    def ordered_starts(self) -> tuple[np.ndarray, np.ndarray]:
        """The starts in order of their suffixes, and the common prefix of each with the one before."""
        names = self.names()
        m = len(names)
        if m > FREQUENT and names.max() * FREQUENT < m:
            order = np.zeros(m, np.int64)
            common = np.zeros(m, np.int64)
            at = m
            above = None
            for suffixes, prefixes in descending(np.append(names + 1, 0).astype(np.int32), self.cap, self.memory):
                if above is not None:
                    common[at] = prefixes[0]
                order[at - len(suffixes):at] = suffixes[::-1]
                common[at - len(suffixes) + 1:at] = prefixes[1:][::-1]
                at -= len(suffixes)
                above = suffixes[-1]
        else:
            order, common = _doubled(names, self.cap)
        return self.starts[order], self._common(order, common)

    def _common(self, order: np.ndarray, names_in_common: np.ndarray) -> np.ndarray:
        """Common prefixes in characters: the stretches of equal names, and what the next two stretches share."""
        m, n, text = len(order), len(self.text), self.text
        one, two = order[:-1], order[1:]
        a, b = np.minimum(one + names_in_common[1:], m - 1), np.minimum(two + names_in_common[1:], m - 1)
        found = (self.starts[a] - self.starts[one]).astype(np.int64)
        open_ = np.flatnonzero((found < self.cap) & (a != b))
        at, to = self.starts[a[open_]].astype(np.int64), self.starts[b[open_]].astype(np.int64)
        while len(open_):
            same = (text[np.minimum(at, n - 1)] == text[np.minimum(to, n - 1)]) & (at < n) & (to < n) & (found[open_] < self.cap)
            open_, at, to = open_[same], at[same] + 1, to[same] + 1
            found[open_] += 1
        return np.minimum(np.append(0, found), self.cap).astype(np.int16)

    def _seam(self, one: int, two: int) -> int:
        """Common prefix of an L and an S suffix with the same first character: it is that character repeated."""
        return int(min(self.run_end[one] - one, self.run_end[two] - two, self.cap - 1)) + 1

    def _induce(self, queue: TupleQueue, carry: np.ndarray, suffixes: np.ndarray, prefixes: np.ndarray, want_s: bool) -> None:
        """Puts the predecessors of a block of the wanted type into the queue."""
        before = np.maximum(suffixes - 1, 0)
        chosen = np.flatnonzero((suffixes > 0) & (self.is_s[before] == want_s))
        lowest = np.minimum.accumulate(prefixes)
        if len(chosen):
            code = np.searchsorted(self.characters, self.text[before[chosen]])
            order = np.argsort(code.astype(np.uint16) if len(self.characters) < 65536 else code, kind="stable")
            code, at = code[order], chosen[order]
            fresh = np.append(True, code[1:] != code[:-1])
            common = np.empty(len(at), np.int16)
            common[fresh] = np.minimum(carry[code[fresh]], lowest[at[fresh]])
            later = np.flatnonzero(~fresh)
            common[later] = _range_minima(prefixes, at[later - 1] + 1, at[later])
            common = np.minimum(common + 1, self.cap).astype(np.int16)
            begins = np.flatnonzero(fresh)
            ends = np.append(begins[1:], len(at))
            new = before[at].astype(np.int32)
            for begin, end in zip(begins.tolist(), ends.tolist()):
                queue.push(int(code[begin]), new[begin:end], common[begin:end])
            np.minimum(carry, lowest[-1], out=carry)
            behind = np.minimum.accumulate(prefixes[::-1])[::-1]
            last = at[ends - 1]
            carry[code[begins]] = np.where(last + 1 < len(prefixes), behind[np.minimum(last + 1, len(prefixes) - 1)], self.cap)
        else:
            np.minimum(carry, lowest[-1], out=carry)

    def descending(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """All suffixes but the last character, largest first, each with its common prefix with the one before."""
        starts, common = self.ordered_starts()
        first = np.searchsorted(self.characters, self.text[starts])
        cuts = np.searchsorted(first, np.arange(len(self.characters) + 1))
        queue, larger = TupleQueue(self.memory), TupleQueue(self.memory)
        for code in range(len(self.characters)):
            carry, last = np.zeros(len(self.characters), np.int16), None
            for suffixes, prefixes in queue.pop(code):
                prefixes = prefixes.copy()
                if last is None:
                    prefixes[0] = 0
                last = int(suffixes[-1])
                larger.push(code, suffixes, prefixes)
                self._induce(queue, carry, suffixes, prefixes, want_s=False)
            for begin in range(cuts[code], cuts[code + 1], BLOCK):
                part = slice(begin, min(begin + BLOCK, cuts[code + 1]))
                prefixes = common[part].copy()
                if begin == cuts[code]:
                    prefixes[0] = 0 if last is None else self._seam(last, int(starts[begin]))
                self._induce(queue, carry, starts[part], prefixes, want_s=False)
        del starts, common
        queue = TupleQueue(self.memory)
        for code in range(len(self.characters) - 1, 0, -1):
            carry, last = np.zeros(len(self.characters), np.int16), None
            for suffixes, prefixes in queue.pop(code):
                prefixes = prefixes.copy()
                if last is None:
                    prefixes[0] = 0
                last = int(suffixes[-1])
                yield suffixes, prefixes
                self._induce(queue, carry, suffixes, prefixes, want_s=True)
            above = None  # the common prefix of the last suffix of a block with the first of the next
            for suffixes, prefixes in larger.pop_reversed(code):
                down = np.empty(len(suffixes), np.int16)
                down[1:] = prefixes[1:][::-1]
                down[0] = above if above is not None else 0 if last is None else self._seam(int(suffixes[-1]), last)
                above = prefixes[0]
                suffixes = suffixes[::-1]
                yield suffixes, down
                self._induce(queue, carry, suffixes, down, want_s=True)


def _refined(rank: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Ranks after a further key; a rank is the number of smaller ones, so groups keep their places."""
    order = np.lexsort((key, rank))
    sorted_rank, sorted_key = rank[order], key[order]
    new_group = np.append(True, sorted_rank[1:] != sorted_rank[:-1])
    new = new_group.copy()
    new[1:] |= sorted_key[1:] != sorted_key[:-1]
    place = np.arange(len(order))
    group_at = np.maximum.accumulate(np.where(new_group, place, 0))
    found = np.empty_like(rank)
    found[order] = sorted_rank + np.maximum.accumulate(np.where(new, place, 0)) - group_at
    return found


def _doubled(names: np.ndarray, cap: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes of a string and the characters they share with the one before, by prefix doubling."""
    m = len(names)
    counts = np.bincount(names)
    rank = (np.cumsum(counts) - counts)[names]
    ranks, width = [rank], 1
    while width < cap:
        tied = np.flatnonzero(np.bincount(rank, minlength=m)[rank] > 1)
        if not len(tied):
            break
        behind = tied + width
        key = np.where(behind < m, rank[np.minimum(behind, m - 1)] + 1, 0)
        rank = rank.copy()
        rank[tied] = _refined(rank[tied], key)
        ranks.append(rank)
        width *= 2
    order = np.argsort(rank, kind="stable")
    one, two = order[:-1], order[1:]
    common = np.zeros(len(one), np.int64)
    for step in range(len(ranks) - 1, -1, -1):
        a, b = one + common, two + common
        same = (a < m) & (b < m) & (ranks[step][np.minimum(a, m - 1)] == ranks[step][np.minimum(b, m - 1)])
        common[same] += 1 << step
    return order, np.append(0, common)


def descending(text: np.ndarray, cap: int, memory: int = MEMORY) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Suffixes of a string of non-negative integers that ends in its only 0, largest first, with common prefixes.

    Yields blocks (suffixes, common prefix of each with the suffix before it, at most `cap`); the 0 itself is left out.
    """
    if len(text) > 1:
        yield from Inducer(text, cap, memory).descending()
