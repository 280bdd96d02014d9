"""Suffix order and longest-previous-factor arrays of concatenated strings, in numpy."""

from __future__ import annotations

import numpy as np


def concatenate(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of all parts, each followed by a separator of its own, and where each part begins."""
    lengths = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts))
    begins = np.cumsum(lengths + 1) - lengths - 1
    symbols = np.empty(int(lengths.sum()) + len(parts), dtype=np.int64)
    ends = begins + lengths
    inside = np.ones(len(symbols), dtype=bool)
    inside[ends] = False
    symbols[inside] = np.frombuffer(b"".join(parts), dtype=np.uint8).astype(np.int64) + len(parts) + 1
    symbols[ends] = np.arange(1, len(parts) + 1)
    return symbols, begins


def suffix_order(symbols: np.ndarray, depth: int | None = None, levels: list[tuple[int, np.ndarray]] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(order, rank): the suffixes sorted by their first `depth` symbols (all if None), equal ones by position.

    Prefix doubling: ranks by h symbols give ranks by up to 2h of them, beginning with as many
    symbols as fit in one integer. Suffixes that agree in the symbols compared have the same
    rank. levels, if given, gets (h, ranks by h symbols) of every step.
    """
    n = len(symbols)
    if not n:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    depth = n if depth is None else min(depth, n)
    bits = int(symbols.max()).bit_length()
    h = max(1, min(62 // bits, depth))
    key = symbols.copy()
    for j in range(1, h):
        key <<= bits
        key[: n - j] |= symbols[j:]
    order = np.argsort(key)
    rank = _ranks(key, order)
    while True:
        if levels is not None:
            levels.append((h, rank))
        if h >= depth or rank[order[-1]] == n - 1:
            return np.argsort(rank * n + np.arange(n)), rank
        step = min(h, depth - h)
        ahead = np.zeros(n, dtype=np.int64)
        ahead[: n - step] = rank[step:] + 1
        key = rank * (n + 1) + ahead
        order = np.argsort(key)
        rank = _ranks(key, order)
        h += step


def _ranks(key: np.ndarray, order: np.ndarray) -> np.ndarray:
    ordered = key[order]
    rank = np.empty(len(key), dtype=np.int64)
    rank[order] = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
    return rank


def previous_smaller(values: np.ndarray) -> np.ndarray:
    """For each place of a list of different numbers >= 0 the last place before it with a smaller number, or -1.

    All places look one to the left and follow each other's answers while these are too large;
    where that takes many rounds, one pass with a stack finds all.
    """
    n = len(values)
    found = np.arange(-1, n - 1)
    known = np.append(values, -1)  # place -1 is the last
    active = np.arange(n)
    spent = 0  # a round costs about as much as a few hundred places
    while spent <= 8 * n + 1000:
        active = active[known[found[active]] > values[active]]
        if not len(active):
            return found
        found[active] = found[found[active]]
        spent += len(active) + 300
    stack: list[int] = []
    listed = values.tolist()
    for i, x in enumerate(listed):
        while stack and listed[stack[-1]] > x:
            stack.pop()
        found[i] = stack[-1] if stack else -1
        stack.append(i)
    return found


def common_prefix(symbols: np.ndarray, levels: list[tuple[int, np.ndarray]], depth: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common prefix, up to `depth`, of the suffixes at a and b, which differ and end in separators of their own.

    Ranks by h symbols tell whether h symbols agree: from the deepest level down each is tried
    once, then single symbols.
    """
    shared = np.zeros(len(a), dtype=np.int64)
    for h, rank in reversed(levels):
        shared += np.where(rank[a + shared] == rank[b + shared], h, 0) if h < depth else 0
    last = levels[-1]
    for _ in range(min(levels[0][0], depth) - 1):
        going = symbols[a + shared] == symbols[b + shared]
        if not going.any():
            break
        shared += going
    if last[0] >= depth:
        shared = np.where(last[1][a] == last[1][b], depth, np.minimum(shared, depth))
    return shared


def longest_previous_factors(symbols: np.ndarray, depth: int | None = None, shorter: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(factor, source): for each position the length, up to `depth`, of the longest string from there that also starts earlier, and a place where it does (-1 if none).

    Of the suffixes that start earlier, one that shares most lies at the previous or the next
    smaller position in suffix order. The symbols come from `concatenate`. Sorting stops at
    the depth; suffixes that agree so far lie in order of position. Without `shorter`, factors
    that don't reach the depth aren't measured and count as 0.
    """
    n = len(symbols)
    factor, source = np.zeros(n, dtype=np.int64), np.full(n, -1, dtype=np.int64)
    if not n:
        return factor, source
    levels: list[tuple[int, np.ndarray]] = []
    order, rank = suffix_order(symbols, depth, levels if shorter else None)
    before = previous_smaller(order)
    after = n - 1 - previous_smaller(order[::-1])[::-1]
    for near, none in ((before, -1), (after, n)):
        place = np.flatnonzero(near != none)
        at, other = order[place], order[near[place]]
        if shorter:
            shared = common_prefix(symbols, levels, n if depth is None else depth, at, other)
        else:
            agree = rank[at] == rank[other]
            at, other = at[agree], other[agree]
            shared = np.full(len(at), depth)
        better = shared > factor[at]
        factor[at[better]], source[at[better]] = shared[better], other[better]
    return factor, source


def repeated_starts(symbols: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(later, any): positions from which `length` symbols also start earlier, and anywhere else.

    Of several such positions each but the first has one of them as its source, the second has the first.
    """
    factor, source = longest_previous_factors(symbols, length, shorter=False)
    later = factor >= length
    anywhere = later.copy()
    anywhere[source[later]] = True
    return later, anywhere
