"""Suffix arrays by induced sorting, and permuted longest common prefixes."""

from __future__ import annotations

import numpy as np

# Up to this many symbols a whole bucket is induced at a time; beyond, one suffix at a time.
WIDE = 2048


def suffix_array(text: np.ndarray, symbols: int) -> np.ndarray:
    """Start positions of all suffixes in order. ``text`` ends with its only 0; all symbols are below ``symbols``."""
    n = len(text)
    if n <= 2:
        return np.arange(n - 1, -1, -1)
    smaller = _smaller(text)
    leftmost = np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1
    induce = _induce_buckets if symbols <= WIDE else _induce_single
    first = induce(text, smaller, leftmost, symbols)
    is_leftmost = np.zeros(n, bool)
    is_leftmost[leftmost] = True
    ordered = first[is_leftmost[first]]
    names = _names(text, leftmost, ordered)
    count = int(names.max()) + 1
    if count < len(leftmost):
        ordered = leftmost[suffix_array(names, count)]
    return induce(text, smaller, ordered, symbols)


def _smaller(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the next one; the last is."""
    step = np.sign(np.diff(text.astype(np.int64)))
    # Equal neighbours are as the first unequal pair to their right.
    at = np.where(step != 0, np.arange(len(step)), len(step))
    at = np.minimum.accumulate(at[::-1])[::-1]
    return np.append(np.append(step, 1)[at] > 0, True)


def _names(text: np.ndarray, leftmost: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """Ranks of the substrings between leftmost-smaller positions, in text order; equal substrings share a rank."""
    following = np.append(leftmost[1:], len(text) - 1)
    sizes = following - leftmost + 1
    place = np.empty(len(text), np.int64)
    place[leftmost] = np.arange(len(leftmost))
    at = place[ordered]
    size = sizes[at]
    equal = size[1:] == size[:-1]
    left = np.flatnonzero(equal)
    step = 0
    # Compare neighbours symbol by symbol, only as long as they agree.
    while len(left):
        inside = step < size[left + 1]
        same = ~inside
        a, b = ordered[left] + step, ordered[left + 1] + step
        same[inside] = text[a[inside]] == text[b[inside]]
        equal[left[~same]] = False
        left, step = left[same & inside], step + 1
    names = np.empty(len(leftmost), np.int64)
    names[at] = np.concatenate([[0], np.cumsum(~equal)])
    return names


def _edges(text: np.ndarray, symbols: int) -> tuple[np.ndarray, np.ndarray]:
    ends = np.cumsum(np.bincount(text, minlength=symbols))
    return np.append(0, ends[:-1]), ends


def _induce_buckets(text: np.ndarray, smaller: np.ndarray, leftmost: np.ndarray, symbols: int) -> np.ndarray:
    """Induce the order of all suffixes from that of the leftmost-smaller ones, bucket by bucket.

    Within a bucket, suffixes that are induced into the bucket itself make the next wave; there are as many waves as the bucket's
    symbol repeats in a row.
    """
    starts, ends = _edges(text, symbols)
    found = np.full(len(text), -1, np.int64)
    heads, tails = starts.copy(), ends.copy()

    def put(suffixes: np.ndarray, forward: bool) -> None:
        symbol = text[suffixes]
        count = np.bincount(symbol, minlength=symbols)
        order = np.argsort(symbol, kind="stable")
        own = symbol[order]
        rank = np.arange(len(order)) - (np.cumsum(count) - count)[own]
        if forward:
            found[heads[own] + rank] = suffixes[order]
            heads[:] += count
        else:
            found[tails[own] - 1 - rank] = suffixes[order]
            tails[:] -= count

    def before(suffixes: np.ndarray, wanted: bool) -> np.ndarray:
        suffixes = suffixes[suffixes > 0] - 1
        return suffixes[smaller[suffixes] == wanted]

    symbol = text[leftmost]
    count = np.bincount(symbol, minlength=symbols)
    seeds = leftmost[np.argsort(symbol, kind="stable")]
    seed_ends = np.cumsum(count)
    used = np.flatnonzero(ends > starts)
    for c in used:
        at = starts[c]
        while at < heads[c]:
            wave, at = found[at : heads[c]], heads[c]
            put(before(wave, False), True)
        put(before(seeds[seed_ends[c] - count[c] : seed_ends[c]], False), True)
    larger_ends = heads.copy()
    found[0] = len(text) - 1
    tails[0] = 0
    for c in used[::-1]:
        at = ends[c]
        while at > tails[c]:
            wave, at = found[tails[c] : at][::-1], tails[c]
            put(before(wave, True), False)
        put(before(found[starts[c] : larger_ends[c]][::-1], True), False)
    return found


def _induce_single(text: np.ndarray, smaller: np.ndarray, leftmost: np.ndarray, symbols: int) -> np.ndarray:
    """The same one suffix at a time, for texts of many symbols."""
    starts, ends = (edge.tolist() for edge in _edges(text, symbols))
    symbol, small = text.tolist(), smaller.tolist()
    found = [-1] * len(symbol)
    tails = list(ends)
    for suffix in leftmost[::-1].tolist():
        c = symbol[suffix]
        tails[c] -= 1
        found[tails[c]] = suffix
    heads = list(starts)
    for at in range(len(found)):
        suffix = found[at] - 1
        if suffix >= 0 and not small[suffix]:
            c = symbol[suffix]
            found[heads[c]] = suffix
            heads[c] += 1
    tails = list(ends)
    for at in range(len(found) - 1, -1, -1):
        suffix = found[at] - 1
        if suffix >= 0 and small[suffix]:
            c = symbol[suffix]
            tails[c] -= 1
            found[tails[c]] = suffix
    found[0] = len(symbol) - 1
    return np.array(found, np.int64)


def common_prefixes(text: np.ndarray, order: np.ndarray, limit: int) -> np.ndarray:
    """For each position, the longest common prefix with its neighbour before it in ``order``, up to ``limit``; in text order.

    Where the symbols before both suffixes agree, the value is one less than that of the position before. Only the other
    positions are compared.
    """
    n = len(text)
    neighbour = np.full(n, -1, np.int64)
    neighbour[order[1:]] = order[:-1]
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = (neighbour[1:] > 0) & (neighbour[1:] == neighbour[:-1] + 1) & (text[:-1] == text[neighbour[1:] - 1])
    heads = np.flatnonzero(~before)
    values = _agree(text, heads, neighbour[heads], limit)
    owner = np.cumsum(~before) - 1
    return np.maximum(values[owner] - (np.arange(n) - heads[owner]), 0)


def _agree(text: np.ndarray, a: np.ndarray, b: np.ndarray, limit: int) -> np.ndarray:
    """How many symbols agree from each pair of positions on; a neighbour of -1 agrees on none. Not cut at ``limit`` for runs."""
    n = len(text)
    values = np.zeros(len(a), np.int64)
    left = np.flatnonzero(b >= 0)
    data = text.astype(np.int32)
    size = 16
    while len(left):
        x, y = a[left] + values[left], b[left] + values[left]
        room = np.minimum(n - np.maximum(x, y), size)
        offset = np.arange(size)
        inside = offset < room[:, None]
        same = (data[np.minimum(x[:, None] + offset, n - 1)] == data[np.minimum(y[:, None] + offset, n - 1)]) & inside
        run = np.where(same.all(axis=1), size, same.argmin(axis=1))
        values[left] += run
        left = left[run == size]
        # Few pairs agree for long; those that do are compared in longer steps.
        size = min(512, size * 2) if len(left) * size < (1 << 20) else size
    return values
