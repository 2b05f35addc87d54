"""Links between token sets by dual traversal of a tree of signatures.

Leaves hold a few sets as token bitmaps; every node holds the OR of the bitmaps below it and the
range of their sizes. A pair of nodes is left out when no sizes in their ranges are near enough,
when the bitmaps share too few bits for the least overlap that a link needs, or when all sets of
both are linked already, directly or by way of others.
"""

from __future__ import annotations

import numpy as np

LEAF, FAN = 16, 8
#: Bits of a bitmap at most. Up to there each shared token has a bit of its own.
WIDTH = 1 << 16


class _Labels:
    def __init__(self, n: int):
        self.of = np.arange(n)

    def union(self, a: int, b: int) -> None:
        x, y = self.of[a], self.of[b]
        if x != y:
            self.of[self.of == max(x, y)] = min(x, y)


def _bitmaps(rows: np.ndarray, bits: np.ndarray, n: int, words: int) -> np.ndarray:
    flat = np.zeros(n * words, dtype=np.uint64)
    np.bitwise_or.at(flat, rows * words + (bits >> 6), np.uint64(1) << (bits & 63).astype(np.uint64))
    return flat.reshape(n, words)


def linked(sets: list[np.ndarray], sides: np.ndarray, percent: int) -> np.ndarray:
    """A label for each set: equal where a chain of links joins them.

    sets: sorted distinct 64-bit tokens. Two sets link when 100 * intersection >= percent * union.
    sides: 0 or 1; if both occur, only pairs of one set from either side are compared.
    """
    n = len(sets)
    labels = _Labels(n)
    if n < 2:
        return labels.of
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    tokens = np.concatenate(sets)
    rows = np.repeat(np.arange(n), sizes)
    _, column, count = np.unique(tokens, return_inverse=True, return_counts=True)
    common = count[column] > 1
    column, rows = column[common], rows[common]
    if not len(column):
        return labels.of
    order = np.sort(np.unique(column))
    column = np.searchsorted(order, column)
    least = np.full(n, len(order), dtype=np.int64)
    np.minimum.at(least, rows, column)
    # Neighbours in the tree: of similar size, then with the same least token.
    step = np.log(100.0 / percent)
    band = np.floor(np.log(np.maximum(sizes, 1)) / step) if step > 0 else sizes
    place = np.lexsort((least, band, sides))
    back = np.empty(n, dtype=np.int64)
    back[place] = np.arange(n)
    rows = back[rows]
    sizes, sides = sizes[place], sides[place]
    width = min(len(order), WIDTH)
    exact = width == len(order)
    words = (width + 63) // 64
    bits = column if exact else column % width
    leaf_bits = _bitmaps(rows, bits, n, words)
    # Of tokens that share a bit, a set may have several: what popcounts can miss at most.
    missed = 0
    if not exact:
        pair = rows * np.int64(width) + bits
        value, times = np.unique(pair, return_counts=True)
        extra = np.zeros(n, dtype=np.int64)
        np.add.at(extra, value // width, times - 1)
        missed = int(extra.max())
        by_row = np.argsort(rows, kind="stable")
        cuts = np.searchsorted(rows[by_row], np.arange(n + 1))
        own = [np.sort(column[by_row[cuts[i] : cuts[i + 1]]]) for i in range(n)]
    # Each side has leaves of its own, so that a node lies on one side.
    both = bool(sides.any()) and not bool(sides.all())
    edges = [0, int((sides == 0).sum()), n] if both else [0, n]
    spans = [(a, min(a + LEAF, hi)) for lo, hi in zip(edges, edges[1:]) for a in range(lo, hi, LEAF)]
    side_of = [int(sides[a]) for a, _ in spans]

    def up(level):
        groups, i = [], 0
        while i < len(level):
            j = i + 1
            while j < len(level) and j - i < FAN and level[j][5] == level[i][5]:
                j += 1
            part = level[i:j]
            groups.append((part[0][0], part[-1][1], np.bitwise_or.reduce([x[2] for x in part]), min(x[3] for x in part), max(x[4] for x in part), part[0][5], part))
            i = j
        return groups

    level = [
        (a, b, np.bitwise_or.reduce(leaf_bits[a:b], axis=0), int(sizes[a:b].min()), int(sizes[a:b].max()), s, None)
        for (a, b), s in zip(spans, side_of)
    ]
    while len(level) > (2 if both else 1):
        above = up(level)
        if len(above) == len(level):
            break
        level = above
    of = labels.of
    todo = [(x, y) for i, x in enumerate(level) for y in level[i:] if not both or x[5] != y[5]]
    while todo:
        x, y = todo.pop()
        if x[4] * 100 < percent * y[3] or y[4] * 100 < percent * x[3]:
            continue
        if of[x[0]] == of[y[0]] and (of[x[0] : x[1]] == of[x[0]]).all() and (of[y[0] : y[1]] == of[y[0]]).all():
            continue
        need = percent * (x[3] + y[3]) / (100 + percent)
        if x is not y and int(np.bitwise_count(x[2] & y[2]).sum()) + missed < need:
            continue
        if x[6] is None and y[6] is None:
            inter = np.bitwise_count(leaf_bits[x[0] : x[1], None, :] & leaf_bits[None, y[0] : y[1], :]).sum(axis=2, dtype=np.int64)
            total = sizes[x[0] : x[1], None] + sizes[None, y[0] : y[1]]
            near = (inter + missed) * (100 + percent) >= percent * total
            if x is y:
                near &= np.arange(x[1] - x[0])[:, None] < np.arange(y[1] - y[0])[None, :]
            for i, j in zip(*np.nonzero(near)):
                a, b = x[0] + i, y[0] + j
                if of[a] == of[b]:
                    continue
                if not exact:
                    shared = len(np.intersect1d(own[a], own[b], assume_unique=True))
                    if shared * (100 + percent) < percent * (sizes[a] + sizes[b]):
                        continue
                labels.union(a, b)
            continue
        xs, ys = x[6] or [x], y[6] or [y]
        if x is y:
            todo += [(p, q) for i, p in enumerate(xs) for q in xs[i:]]
        else:
            todo += [(p, q) for p in xs for q in ys]
    out = np.empty(n, dtype=np.int64)
    out[place] = of
    # Name each class by its first member in the caller's order.
    _, first, inverse = np.unique(out, return_index=True, return_inverse=True)
    return first[inverse]
