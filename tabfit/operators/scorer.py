"""Scoring of large ensembles by leaf masks, on Arrow batches.

A CASE expression per tree is the fastest form for few trees, but its code grows with
the ensemble: past 64 KB Spark gives up compiling the stage as a whole, and past 8 KB
the JVM stops compiling the method.  Here an ensemble is data, not code (the bit-vector
method of Lucchese et al., 2015): a feature's thresholds, of all trees together, cut its
values into codes, and a table gives, for each tree, feature and code, the leaves that the
tests of that feature leave possible.  The leaf that a row reaches is the leftmost one
that all features of the tree leave possible.  A batch of rows costs a few array
operations per tree and feature, whatever the depth of the tests.

Leaf values are added tree by tree in the order of the CASE form, so both give the same
margins to the bit.
"""

from __future__ import annotations

import math

import numpy as np

#: Rows scored together.
ROWS_AT_ONCE = 16_384
_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


class LeafMasks:
    """Tables of an ensemble: ``trees`` (with ``cls``, ``splits`` and ``leaves``), ``base`` margins
    and the features in the order in which their values are given."""

    def __init__(self, trees, base: list[float], features: list[int]):
        self.base = list(base)
        place = {f: i for i, f in enumerate(features)}
        thresholds: list[set[float]] = [set() for _ in features]
        for t in trees:
            for f, _, thr, *_ in t.splits.values():
                thresholds[place[f]].add(thr)
        # an infinite threshold parts what is there from what is missing: all codes lie below it
        self.cuts = [np.array(sorted(v for v in s if not math.isinf(v))) for s in thresholds]
        self.trees = [self._tables(t, place) for t in trees]

    def _tables(self, tree, place: dict[int, int]):
        order: list[int] = []           # leaves from left to right
        span: dict[int, tuple[int, int]] = {}

        def walk(node: int) -> None:
            first = len(order)
            if node in tree.leaves:
                order.append(node)
            else:
                walk(2 * node + 1)
                walk(2 * node + 2)
            span[node] = first, len(order)

        walk(0)
        words = -(-len(order) // 64)
        tables: dict[int, np.ndarray] = {}
        for node, (f, _, thr, _, _, default_left) in tree.splits.items():
            i = place[f]
            cuts = self.cuts[i]
            if i not in tables:
                tables[i] = np.full((words, len(cuts) + 2), _ALL)
            # codes: number of thresholds at or below the value; the last one is "missing"
            right = np.arange(len(cuts) + 2) > (len(cuts) if math.isinf(thr) else np.searchsorted(cuts, thr))
            right[-1] = not default_left
            lo, hi = span[2 * node + 1]  # the left leaves, which a row that goes right cannot reach
            for w in range(words):
                bits = sum(1 << (b - 64 * w) for b in range(max(lo, 64 * w), min(hi, 64 * w + 64)))
                tables[i][w, right] &= ~np.uint64(bits)
        values = np.array([tree.leaves[n][0] for n in order])
        return tree.cls, sorted(tables.items()), values, words

    def margins(self, columns: list[np.ndarray]) -> np.ndarray:
        """Margins (classes, rows) of rows given feature by feature; NaN is missing."""
        n = len(columns[0]) if columns else 0
        out = np.empty((len(self.base), n))
        for lo in range(0, n, ROWS_AT_ONCE):
            self._part([c[lo:lo + ROWS_AT_ONCE] for c in columns], out[:, lo:lo + ROWS_AT_ONCE])
        return out

    def _part(self, columns: list[np.ndarray], out: np.ndarray) -> None:
        out[:] = np.array(self.base)[:, None]
        codes = []
        for x, cuts in zip(columns, self.cuts):
            c = np.searchsorted(cuts, x, side="right")
            c[np.isnan(x)] = len(cuts) + 1
            codes.append(c)
        for cls, tables, values, words in self.trees:
            if not tables:
                out[cls] += values[0]
                continue
            leaf = found = None
            for w in range(words):
                live = None
                for i, table in tables:
                    m = table[w][codes[i]]
                    live = m if live is None else live & m
                low = live & (~live + np.uint64(1))      # the leftmost leaf: the lowest bit
                at = (low.astype(np.float64).view(np.int64) >> 52) - 1023 + 64 * w
                leaf = at if leaf is None else np.where(found, leaf, at)
                found = low > 0 if found is None else found | (low > 0)
                if w + 1 < words and found.all():
                    break
            out[cls] += values[leaf]
