"""Pieces of text that a byte-pair tokenizer merges on its own, found for a whole slice of texts at once.

The two patterns follow the tokenizer files: words with a space before them (`SPACED`), and words without white space
and with single digits (`BARE`). Both know the English endings after an apostrophe. Piece hashes let a task handle
every distinct piece once.

Only texts of plain characters (printable ASCII, tab, line feed, and the letters from U+00C0 to U+024F) are cut here,
as nothing about these depends on a Unicode version; `is_plain` tells, and callers hand the other texts to the library.
"""

from __future__ import annotations

from functools import cache

import numpy as np

from aeropanel.llm.texts import LETTER, MARK, NUMBER, OTHER, SPACE, Slice, class_table, span_hashes

SPACED, BARE = "spaced", "bare"
# fixed values: endings that are pieces after an apostrophe
SHORT_ENDINGS, LONG_ENDINGS = "stmd", ("re", "ve", "ll")


@cache
def _kinds() -> np.ndarray:
    table = class_table().copy()
    table[table == MARK] = OTHER
    return table


@cache
def _plain() -> np.ndarray:
    plain = np.zeros(0x110000, bool)
    plain[0x20:0x7F] = True
    plain[[0x09, 0x0A]] = True
    plain[0xC0:0x250] = True
    plain[[0xD7, 0xF7, 0x130]] = False
    return plain


def plain_texts(part: Slice) -> np.ndarray:
    """Which texts of a slice hold plain characters only."""
    odd = np.zeros(len(part.points) + 1, np.int64)
    np.cumsum(~_plain()[part.points], out=odd[1:])
    return odd[part.bounds[1:]] == odd[part.bounds[:-1]]


def cut(points: np.ndarray, bounds: np.ndarray, pattern: str) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of all pieces, in order; none crosses a bound."""
    n = len(points)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    kinds = _kinds()[points]
    edge = np.zeros(n + 1, bool)
    edge[bounds] = True
    edge[0] = edge[n] = True
    edge[1:n] |= kinds[1:] != kinds[:-1]
    if pattern == BARE:
        edge[:-1] |= kinds == NUMBER
    at = np.flatnonzero(edge)
    starts, ends = at[:-1].copy(), at[1:].copy()
    kind = kinds[starts]
    text_start = np.zeros(n + 1, bool)
    text_start[bounds] = True
    follows = np.zeros(len(starts), bool)  # the next run is of the same text
    follows[:-1] = ~text_start[starts[1:]]
    extra = [np.zeros((2, 0), np.int64)]
    if pattern == SPACED:
        gap = np.flatnonzero((kind == SPACE) & follows)
        joins = points[ends[gap] - 1] == 0x20
        starts[gap[joins] + 1] -= 1
        alone = gap[~joins & (ends[gap] - starts[gap] > 1)]
        extra.append(np.stack([ends[alone] - 1, ends[alone]]))
        ends[gap[joins]] -= 1
        ends[alone] -= 1
    mark = np.flatnonzero((kind[:-1] == OTHER) & (kind[1:] == LETTER) & follows[:-1] & (ends[:-1] - starts[:-1] == 1))
    mark = mark[points[starts[mark]] == 0x27]
    if len(mark):
        letters = starts[mark + 1]
        first, second = points[letters], points[np.minimum(letters + 1, n - 1)]
        two = (ends[mark + 1] - letters > 1) & np.logical_or.reduce(
            [(first == ord(e[0])) & (second == ord(e[1])) for e in LONG_ENDINGS])
        taken = np.where(np.isin(first, [ord(c) for c in SHORT_ENDINGS]), 1, np.where(two, 2, 0))
        ends[mark] += taken
        starts[mark + 1] += taken
    keep = ends > starts
    if pattern == BARE:
        keep &= kind != SPACE
    both = np.concatenate([np.stack([starts[keep], ends[keep]]), *extra], axis=1)
    both = both[:, np.argsort(both[0], kind="stable")] if len(extra) > 1 and extra[1].size else both
    return both[0], both[1]



def gather(pool: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The stretches `pool[begins[i] : begins[i] + sizes[i]]` one after another."""
    ends = np.cumsum(sizes)
    return pool[np.arange(ends[-1] if len(ends) else 0) + np.repeat(begins - ends + sizes, sizes)]
