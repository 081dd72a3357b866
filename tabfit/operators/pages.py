"""Quantised pages of training rows, and what a task computes on them.

A page holds up to ``PAGE_ROWS`` rows of one set as a few binary columns: labels,
row ids, margins, and the bins of the features (a byte each where all bin numbers fit).
Pages are rows of a DataFrame, and records of an RDD while trees grow, so Spark
partitions, caches and checkpoints them; a task works on whole pages with numpy,
without a Python step per row.

*Dense* pages hold a matrix of bins, feature by feature.  *Sparse* pages hold only the
entries that are present, sorted by feature; a million features that are absent from
a row cost it nothing.  An absent or missing value has no bin: it is left out of
the histograms, and each split sends it to the side that gains most.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa

PAGE_ROWS = 16_384
#: A task keeps a dense histogram of at most this many slots; a larger one is kept
#: as the slots seen.
DENSE_SLOTS = 1 << 22
#: Elements of a temporary array over rows and features.
CHUNK = 1 << 22
HESS_FLOOR = 1e-16

PAGE_SCHEMA = ("set string, n int, rid binary, y binary, m binary, bins binary, feat binary, row binary")
_PAGE_NAMES = [x.split()[0] for x in PAGE_SCHEMA.split(", ")]
ROW_SCHEMA = "set string, rid long, y double, m array<double>"
BEST_FIELDS = ("t", "f", "bin", "default_left", "gain", "GL", "HL", "GR", "HR", "Gt", "Ht")
#: Slots of a node that one record of a histogram holds.
PIECE_SLOTS = 1 << 20
#: Up to this many slots, a node's sums from several tasks are kept as arrays over all of them.
NODE_SLOTS = 1 << 16
#: Rows of a page while trees grow, slots that features counted together share, and slots so used in all.
GROWING_ROWS, JOINT_SLOTS, ALL_JOINT_SLOTS = 1 << 16, 1 << 15, 1 << 22
#: Groups of features that may still grow.
OPEN_GROUPS = 8
#: Trees of up to this many splits are followed by masks of rows, larger ones by tables over nodes.
MASKED_SPLITS = 64


class Bins:
    """Bin edges of all features, in one array."""

    def __init__(self, edges: list[list[float]]):
        self.count = np.array([len(e) for e in edges], dtype=np.int64)
        self.edges = np.array([v for e in edges for v in e], dtype=np.float64)
        self.at = np.concatenate(([0], np.cumsum(self.count)))
        # slots: one more than edges, and one for missing values
        self.slot = np.concatenate(([0], np.cumsum(self.count + 2)))
        self.kind = "<u1" if not len(self.count) or self.count.max() + 1 < 256 else "<u2"

    def __len__(self) -> int:
        return len(self.count)

    def of(self, f: int) -> np.ndarray:
        return self.edges[self.at[f]:self.at[f + 1]]

    def codes(self, f: int, values: np.ndarray) -> np.ndarray:
        """Bin of each value (edges at or below it); NaN gets the slot after the last bin."""
        c = np.searchsorted(self.of(f), values, side="right")
        c[np.isnan(values)] = self.count[f] + 1
        return c.astype(np.uint16)


@dataclass
class Page:
    """One page in memory."""
    n: int
    rid: np.ndarray
    y: np.ndarray
    m: np.ndarray | None              # (points * classes, n), none before the first round
    bins: np.ndarray                  # dense: (features, n); sparse: one per entry
    feat: np.ndarray | None = None    # sparse: feature and row of every entry, by feature
    row: np.ndarray | None = None

    def column(self, f: int, bins: Bins) -> np.ndarray:
        """The bins of one feature for all rows."""
        if self.feat is None:
            return self.bins[f]
        lo, hi = np.searchsorted(self.feat, (f, f + 1))
        out = np.full(self.n, bins.count[f] + 1, dtype=np.uint16)
        out[self.row[lo:hi]] = self.bins[lo:hi]
        return out


def page_of(record: tuple, features: int) -> Page:
    """The page of a record ``set, n, rid, y, m, bins, feat, row``."""
    _, n, rid, y, m, bins, feat, row = record

    def array(buffer, kind):
        return None if buffer is None else np.frombuffer(buffer, dtype=kind)

    feat, row, m = array(feat, "<i4"), array(row, "<i4"), array(m, "<f8")
    entries = features * n if feat is None else len(feat)
    bins = array(bins, "<u1" if len(bins) == entries else "<u2")
    return Page(n, np.zeros(n, "<i8") if rid is None else array(rid, "<i8"), array(y, "<f8"), None if m is None else m.reshape(-1, n),
                bins.reshape(features, n) if feat is None else bins, feat, row)


def read_pages(batch: pa.RecordBatch, features: int) -> Iterator[Page]:
    c = [batch.column(name) for name in _PAGE_NAMES]
    for i in range(batch.num_rows):
        yield page_of((None, c[1][i].as_py(), *[x[i].as_buffer() if x[i].is_valid else None for x in c[2:]]), features)


def _page_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int32()] + [pa.binary()] * 6
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], _PAGE_NAMES)


def _sparse_entries(batch: pa.RecordBatch, width: int, missing: float | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, feature and value of the entries of ``ind``, ``val`` (sparse) or ``val`` alone
    (dense, ``ind`` null) that are neither missing nor NaN."""
    val, ind = batch.column("val"), batch.column("ind")
    sizes = np.diff(val.offsets.to_numpy())
    row = np.repeat(np.arange(batch.num_rows), sizes)
    first = val.offsets[0].as_py()
    v = val.values.slice(first, len(row)).to_numpy(zero_copy_only=False).astype(np.float64)
    f = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)  # dense: the place
    given = np.array(ind.is_valid())
    if given.any():
        isz = np.diff(ind.offsets.to_numpy())
        f[np.repeat(given, sizes)] = ind.values.slice(ind.offsets[0].as_py(), int(isz.sum())).to_numpy(zero_copy_only=False)
    if len(f) and (f.max() >= width or f.min() < 0):
        raise ValueError(f"feature index outside 0 to {width - 1}")
    ok = ~np.isnan(v)
    if missing is not None:
        ok &= v != missing
    return row[ok], f[ok], v[ok]


def build_pages(batches: Iterator[pa.RecordBatch], bins: Bins, sparse: bool, missing: float | None) -> Iterator[pa.RecordBatch]:
    """Pages of the rows ``set, rid, y, ind, val``."""
    width = len(bins)
    for whole in batches:
        sets = np.array(whole.column("set").to_pylist(), dtype=object)
        for name in sorted(set(sets)):
            rows = np.flatnonzero(sets == name)
            for lo in range(0, len(rows), PAGE_ROWS):
                part = whole.take(pa.array(rows[lo:lo + PAGE_ROWS]))
                n = part.num_rows
                rid = part.column("rid").to_numpy(zero_copy_only=False).astype("<i8")
                y = part.column("y").to_numpy(zero_copy_only=False).astype("<f8")
                if sparse:
                    row, feat, v = _sparse_entries(part, width, missing)
                    order = np.lexsort((row, feat))
                    row, feat, v = row[order], feat[order], v[order]
                    code = np.zeros(len(v), dtype=np.uint16)
                    # features without an edge have one bin: only the others are looked up
                    for f in np.unique(feat[bins.count[feat] > 0]):
                        a, b = np.searchsorted(feat, (f, f + 1))
                        code[a:b] = bins.codes(f, v[a:b])
                    yield _page_batch([(name, n, rid.tobytes(), y.tobytes(), None, code.astype(bins.kind).tobytes(),
                                        feat.astype("<i4").tobytes(), row.astype("<i4").tobytes())])
                else:
                    val = part.column("val")
                    sizes = np.diff(val.offsets.to_numpy())
                    if (sizes != width).any():
                        raise ValueError(f"all rows need {width} features")
                    x = val.values.slice(val.offsets[0].as_py(), n * width).to_numpy(zero_copy_only=False)
                    x = x.astype(np.float64).reshape(n, width)
                    if missing is not None:
                        x = np.where(x == missing, np.nan, x)
                    code = np.stack([bins.codes(f, x[:, f]) for f in range(width)]) if width else np.empty((0, n), np.uint16)
                    yield _page_batch([(name, n, rid.tobytes(), y.tobytes(), None, code.astype(bins.kind).tobytes(), None, None)])


def merged(records: Iterable[tuple], features: int, with_id: bool) -> Iterator[tuple]:
    """The records of pages with the dense ones of a set and a partition joined to ``GROWING_ROWS`` rows (fewer of
    many features) or little more, and without row ids if they are not asked for."""
    most = min(GROWING_ROWS, CHUNK // max(1, features))
    held: dict[str, list[tuple]] = {}

    def joined(name: str) -> tuple:
        part = held.pop(name)
        bins = np.concatenate([page_of(x, features).bins for x in part], axis=1)
        return (name, sum(x[1] for x in part), b"".join(x[2] for x in part) if with_id else None,
                b"".join(x[3] for x in part), None, bins.tobytes(), None, None)

    for record in records:
        if record[6] is not None or record[4] is not None:
            yield (*record[:2], record[2] if with_id else None, *record[3:])
            continue
        name = record[0]
        held.setdefault(name, []).append(record)
        if sum(x[1] for x in held[name]) >= most:
            yield joined(name)
    for name in list(held):
        yield joined(name)


# ------------------------------------------------------------------ gradients
def gradients(objective: str, m: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and second derivatives of the loss, (classes, n), at margins of that shape."""
    if objective.startswith("reg:"):
        return m - y, np.ones_like(m)
    if objective.startswith("binary:"):
        p = np.negative(m)
        with np.errstate(over="ignore"):
            np.exp(p, out=p)
        p += 1.0
        np.divide(1.0, p, out=p)
        h = 1 - p
        h *= p
        return p - y, np.maximum(h, HESS_FLOOR, out=h)
    e = np.exp(m - m.max(axis=0))
    p = e / e.sum(axis=0)
    return p - (np.arange(len(m))[:, None] == y), np.maximum(2.0 * p * (1 - p), HESS_FLOOR)


def scores(objective: str, m: np.ndarray, reads: str) -> np.ndarray:
    """What a metric ``reads`` at the margins of an objective with one margin a row."""
    if objective.startswith("reg:"):
        return m
    with np.errstate(over="ignore"):
        p = 1.0 / (1.0 + np.exp(-m))
    return p if reads == "probability" else np.where(p <= 0.5, 0.0, 1.0)


def sampled(rid: np.ndarray, rnd: int, seed: int, share: float) -> np.ndarray | None:
    """Rows in the sample of a round, by a hash of their id; None: all."""
    if share >= 1.0:
        return None
    z = rid.view(np.uint64) ^ np.uint64((rnd * 0x9E3779B97F4A7C15 + seed * 0xC2B2AE3D27D4EB4F) & (2 ** 64 - 1))
    for k in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB):
        z = (z ^ (z >> np.uint64(30))) * np.uint64(k)
    z ^= z >> np.uint64(31)
    return (z >> np.uint64(11)).astype(np.float64) * 2.0 ** -53 < share


def route(page: Page, splits: dict[int, tuple], bins: Bins, columns: dict) -> np.ndarray:
    """The node that every row has reached in a tree grown so far.  One comparison per
    row and level; ``columns`` remembers the bins of features already read from sparse pages."""
    if page.feat is None:
        return _route_dense(page, splits, bins)
    node = np.zeros(page.n, dtype=np.int64)
    level = [0] if 0 in splits else []
    while level:
        nxt = []
        for k in level:
            f, b, default_left = splits[k][0], splits[k][1], splits[k][5]
            if f not in columns:
                columns[f] = page.column(f, bins)
            rows = np.flatnonzero(node == k)
            code = columns[f][rows]
            left = code <= b
            if default_left:
                left |= code > bins.count[f]
            node[rows] = np.where(left, 2 * k + 1, 2 * k + 2)
            nxt += [c for c in (2 * k + 1, 2 * k + 2) if c in splits]
        level = nxt
    return node


def _route_dense(page: Page, splits: dict[int, tuple], bins: Bins) -> np.ndarray:
    """The same on a matrix of bins: all nodes of a level in one step, by tables over nodes."""
    node = np.zeros(page.n, dtype=np.int64)
    if not splits:
        return node
    top = 2 * max(splits) + 3
    first, cut, absent = (np.zeros(top, dtype=np.int64) for _ in range(3))
    child = np.repeat(np.arange(top), 2)        # a leaf keeps its rows
    for k, s in splits.items():
        first[k], cut[k], child[2 * k], child[2 * k + 1] = s[0] * page.n, s[1], 2 * k + 2, 2 * k + 1
        # bins above this are missing values that go left
        absent[k] = bins.count[s[0]] if s[5] else 1 << 16
    flat, rows = page.bins.reshape(-1), np.arange(page.n)
    some_left = any(s[5] for s in splits.values())
    for _ in range((max(splits) + 1).bit_length()):
        code = flat.take(first.take(node) + rows)
        left = code <= cut.take(node)
        if some_left:
            left |= code > absent.take(node)
        node = child.take(2 * node + left)
    return node


def numbered(page: Page, splits: dict[int, tuple], bins: Bins, columns: dict, number: np.ndarray) -> np.ndarray:
    """``number`` (by node) of the node that every row has reached; of up to 255 different ones as bytes."""
    if page.feat is not None or len(splits) > MASKED_SPLITS or not len(number) or number.max() > 255 or number.min() < 0:
        return number.take(route(page, splits, bins, columns))
    out = np.zeros(page.n, dtype=np.uint8)
    stack: list[tuple[int, np.ndarray | None]] = [(0, None)]
    while stack:
        k, rows = stack.pop()
        if k not in splits:
            out += np.uint8(number[k]) if rows is None else rows.view(np.uint8) * np.uint8(number[k])
            continue
        f, b, default_left = splits[k][0], splits[k][1], splits[k][5]
        right = page.bins[f] > b
        if default_left:
            right &= page.bins[f] <= int(bins.count[f])
        left = ~right
        if rows is not None:
            left &= rows
            right &= rows
        stack += [(2 * k + 1, left), (2 * k + 2, right)]
    return out


@dataclass
class Growing:
    """What tasks need to know of one tree under growth."""
    tree: int                       # point * classes + class
    splits: dict[int, tuple]        # node -> (feature, bin, ..., default_left)
    open: np.ndarray                # nodes of this level whose split is sought


@dataclass
class Level:
    """One level of all trees of a round."""
    width: int                      # nodes that a tree may have: t = tree * width + node
    rnd: int
    classes: int
    base: list[np.ndarray]          # base margin by point
    objectives: list[str]
    seeds: list[int]
    shares: list[float]
    trees: list[Growing] = field(default_factory=list)


class Joint:
    """Features whose bins are counted together: one count over the combinations of their bins (and of
    missing values) and of ``nodes`` nodes and one more place serves all of them.  ``groups``: features, widths, slots."""

    def __init__(self, bins: Bins, nodes: int, trees: int):
        self.nodes, self.first = nodes, bins.slot[:-1]
        most = min(JOINT_SLOTS, ALL_JOINT_SLOTS // max(1, trees * len(bins)))
        self.groups: list[tuple[list[int], list[int], int]] = []
        for f in np.argsort(-bins.count, kind="stable").tolist():
            w = int(bins.count[f]) + 2
            for i in range(max(0, len(self.groups) - OPEN_GROUPS), len(self.groups)):
                features, widths, size = self.groups[i]
                if size * w <= most:
                    self.groups[i] = ([*features, f], [*widths, w], size * w)
                    break
            else:
                self.groups.append(([f], [w], (nodes + 1) * w))


class _Totals:
    """Sums by slot, dense up to ``DENSE_SLOTS``, else as the slots seen."""

    def __init__(self, slots: int):
        self.slots, self.dense, self.parts, self.held = slots, slots <= DENSE_SLOTS, [], 0
        self.joint, self.of = [], None
        if self.dense:
            self.g, self.h, self.n = np.zeros(slots), np.zeros(slots), np.zeros(slots, dtype=np.int64)

    def add(self, key: np.ndarray, g: np.ndarray, h: np.ndarray | None) -> None:
        """``h`` of None: ones."""
        if self.dense:
            n = np.bincount(key, minlength=self.slots)
            self.g += np.bincount(key, weights=g, minlength=self.slots)
            self.h += n if h is None else np.bincount(key, weights=h, minlength=self.slots)
            self.n += n
            return
        ones = np.ones(len(key), dtype=np.int64)
        self._reduce(key, g, ones if h is None else h, ones)

    def add_page(self, local: np.ndarray, codes: np.ndarray, g: np.ndarray, h: np.ndarray | None, joint: Joint) -> None:
        """Rows of a dense page; ``local`` is the place of a row's node, or the number of nodes for
        a row that adds nothing."""
        if not self.joint:
            self.of = joint
            self.joint = [(np.zeros(size, dtype=np.int64), np.zeros(size, float if h is None else complex)) for _, _, size in joint.groups]
        if h is not None:   # both sums in one pass
            both = np.empty(len(g), dtype=complex)
            both.real, both.imag = g, h
            g = both
        for (n, sums), (features, widths, size) in zip(self.joint, joint.groups):
            key = local.astype(np.uint16 if size <= 1 << 16 else np.int64)
            for f, w in zip(features, widths):
                key *= key.dtype.type(w)
                key += codes[f]
            key = key.astype(np.intp)
            n += np.bincount(key, minlength=size)
            np.add.at(sums, key, g)

    def _apart(self) -> None:
        """Sums by slot from those of the features counted together."""
        for (n, sums), (features, widths, _) in zip(self.joint, self.of.groups):
            parts = [n, sums.real, sums.imag] if sums.dtype == complex else [n, sums, n]
            cells = np.stack(parts).reshape(3, self.of.nodes + 1, *widths)[:, :-1]
            for i, (f, w) in enumerate(zip(features, widths)):
                each, first = cells, int(self.of.first[f])
                # the features before and behind this one are summed over
                each = each.reshape(3, self.of.nodes, -1, w, math.prod(widths[i + 1:])).sum(axis=4).sum(axis=2)
                for own, new in zip((self.n, self.g, self.h), each):
                    own.reshape(self.of.nodes, -1)[:, first:first + w - 1] += new[:, :w - 1].astype(own.dtype)
        self.joint = []

    def by_node(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Sums over all rows by node, of rows counted by ``add_page``."""
        n, sums = (v.reshape(self.of.nodes + 1, -1).sum(axis=1)[:-1] for v in self.joint[0])
        at = np.flatnonzero(n)
        return at, sums.real[at], (sums.imag if sums.dtype == complex else n.astype(float))[at], n[at]

    def _reduce(self, key, g, h, n):
        at, inverse = np.unique(key, return_inverse=True)
        self.parts.append((at, np.bincount(inverse, weights=g, minlength=len(at)),
                           np.bincount(inverse, weights=h, minlength=len(at)),
                           np.bincount(inverse, weights=n, minlength=len(at)).astype(np.int64)))
        self.held += len(at)
        if self.held > DENSE_SLOTS and len(self.parts) > 1:
            key, g, h, n = (np.concatenate(x) for x in zip(*self.parts))
            self.parts, self.held = [], 0
            self._reduce(key, g, h, n)

    def found(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        if self.joint:
            self._apart()
        if self.dense:
            at = np.flatnonzero(self.n)
            return at, self.g[at], self.h[at], self.n[at]
        if len(self.parts) > 1:
            key, g, h, n = (np.concatenate(x) for x in zip(*self.parts))
            self.parts, self.held = [], 0
            self._reduce(key, g, h, n)
        return self.parts[0] if self.parts else tuple(np.empty(0, d) for d in (np.int64, float, float, np.int64))


def histograms(records: Iterable[tuple], level: Level, bins: Bins) -> Iterator[tuple]:
    """Sums of gradients, hessians and rows of a partition of pages: records ``t, (G, H, n,
    slots, G, H, n)`` with the sums over all rows of node ``t``, then those by slot (feature
    and bin) of the values present.  A node has as many records as its slots need, however
    many rows or hot values the partition holds."""
    slots = int(bins.slot[-1])
    totals = [_Totals(len(t.open) * slots) for t in level.trees]
    nodes = [_Totals(len(t.open) + 1) for t in level.trees]   # one more for rows that add nothing
    joints: dict[int, Joint] = {}
    slot_of = bins.slot[:-1].astype(np.int64)
    for record in records:
        page = page_of(record, len(bins))
        columns: dict[int, np.ndarray] = {}
        derived: dict[int, tuple] = {}
        for tree, total, every in zip(level.trees, totals, nodes):
            p, k = divmod(tree.tree, level.classes)
            if p not in derived:
                m = (np.repeat(level.base[p][:, None], page.n, axis=1) if page.m is None
                     else page.m[p * level.classes:(p + 1) * level.classes])
                derived[p] = (*gradients(level.objectives[p], m, page.y),
                              sampled(page.rid, level.rnd, level.seeds[p], level.shares[p]))
            g, h, mask = derived[p]
            # a hessian of 1 adds up to the number of rows
            ones = level.objectives[p].startswith("reg:")
            none = len(tree.open)
            place = np.full(level.width, none, dtype=np.int64)
            place[tree.open] = np.arange(none)
            local = numbered(page, tree.splits, bins, columns, place)
            if mask is not None:
                local[~mask] = none
            live = np.count_nonzero(local != none)
            if not live:
                continue
            if page.feat is None and total.dense and 2 * live > page.n:
                gr, hr, lr = g[k], None if ones else h[k], local
            else:
                rows = np.flatnonzero(local != none)
                gr, hr, lr = g[k][rows], None if ones else h[k][rows], local[rows].astype(np.int64)
            joint = page.feat is None and total.dense and len(bins) > 0
            if not joint:   # else they follow from the slots
                every.add(lr, gr, hr)
            if page.feat is not None:
                at = local[page.row] != none
                e = page.row[at]
                total.add(local[e].astype(np.int64) * slots + slot_of[page.feat[at]] + page.bins[at], g[k][e], None if ones else h[k][e])
            elif joint:
                codes = page.bins if len(lr) == page.n else page.bins.take(rows, axis=1)
                if none not in joints:
                    joints[none] = Joint(bins, none, len(level.trees))
                total.add_page(lr, codes, gr, hr, joints[none])
            else:
                whole = live == page.n
                for f in range(len(bins)):
                    code = page.bins[f] if whole else page.bins[f].take(rows)
                    ok = code <= bins.count[f]  # a missing value adds nothing
                    total.add(lr[ok] * slots + (slot_of[f] + code[ok].astype(np.int64)), gr[ok], None if ones else hr[ok])
    for tree, total, every in zip(level.trees, totals, nodes):
        sums_of = total.by_node() if total.joint else every.found()
        at, g, h, n = total.found()
        where, slot = np.divmod(at, slots) if slots else (at, at)
        bounds = np.searchsorted(where, np.arange(len(tree.open) + 1))
        for i, eg, eh, en in zip(*sums_of):
            if i == len(tree.open):
                continue
            lo, hi = bounds[i], bounds[i + 1]
            sums = (float(eg), float(eh), int(en))
            for x in range(lo, max(hi, lo + 1), PIECE_SLOTS):
                s = slice(x, min(hi, x + PIECE_SLOTS))
                yield tree.tree * level.width + int(tree.open[i]), (*sums, slot[s], g[s], h[s], n[s])
                sums = (0.0, 0.0, 0)


# --------------------------------------------------------------- split search
def rounded(gain: np.ndarray) -> np.ndarray:
    """Gains to 11 significant digits: splits that are equal but for the last bits of
    their sums, which depend on the order of summation, tie."""
    with np.errstate(divide="ignore", invalid="ignore"):
        mag = np.where(np.isfinite(gain) & (gain != 0), 10.0 ** np.floor(np.log10(np.abs(gain))), 1.0)
        return np.round(gain / mag, 10) * mag


def best_of_node(f, b, G, H, n, total, lam: float, mcw: float) -> tuple | None:
    """The best split of a node from its histogram, sorted by feature and bin, and its
    ``total`` (G, H, rows): (f, bin, default_left, gain, GL, HL, GR, HR), or None.

    Each cut is tried with the missing values on the right and, where there are any,
    on the left.  Ties go to the least feature, bin, then missing on the right."""
    if not len(f):
        return None
    start = np.concatenate(([True], f[1:] != f[:-1]))
    group = np.cumsum(start) - 1
    begin = np.flatnonzero(start)
    place = np.arange(len(f)) - begin[group]
    GL, HL, nL = G.copy(), H.copy(), np.cumsum(n)
    nL = nL - (nL[begin] - n[begin])[group]
    # sums run feature by feature, so they are the same whatever other features hold
    most = int(place.max()) + 1
    if len(begin) * most <= 8 * len(f) + 4096:
        for v in (GL, HL):
            grid = np.zeros((len(begin), most))
            grid[group, place] = v
            v[:] = np.cumsum(grid, axis=1)[group, place]
    else:
        order = np.argsort(place, kind="stable")
        bounds = np.searchsorted(place[order], np.arange(1, most + 1))
        for j in range(len(bounds) - 1):
            i = order[bounds[j]:bounds[j + 1]]
            GL[i] += GL[i - 1]
            HL[i] += HL[i - 1]
    last = np.concatenate((begin[1:], [len(f)])) - 1
    nP = nL[last][group]
    gap = total[2] - nP                                   # rows without a value
    Gt = np.where(gap > 0, total[0], GL[last][group])
    Ht = np.where(gap > 0, total[1], HL[last][group])
    Gm, Hm = Gt - GL[last][group], Ht - HL[last][group]
    out = None
    for left in (False, True):
        gl, hl, cl = (GL + Gm, HL + Hm, nL + gap) if left else (GL, HL, nL)
        gr, hr = Gt - gl, Ht - hl
        ok = (cl > 0) & (total[2] - cl > 0) & (hl >= mcw) & (hr >= mcw) & (hl > 0) & (hr > 0)
        if left:
            ok &= gap > 0
        if not ok.any():
            continue
        gain = np.full(len(f), -np.inf)
        gain[ok] = (gl[ok] ** 2 / (hl[ok] + lam) + gr[ok] ** 2 / (hr[ok] + lam) - Gt[ok] ** 2 / (Ht[ok] + lam))
        score = rounded(gain)
        i = int(np.argmax(score))  # the first of equals: rows are sorted by feature and bin
        rank = (-score[i], int(f[i]), int(b[i]), left)
        if out is None or rank < out[0]:
            out = rank, (int(f[i]), int(b[i]), left, float(gain[i]), float(gl[i]), float(hl[i]), float(gr[i]), float(hr[i]))
    return out[1] if out else None


class _Node:
    """The histogram of a node, from its records: added up slot by slot, or, of very many
    slots, held as records with about twice the distinct slots at most."""

    def __init__(self, slots: int):
        self.sums, self.held, self.rows, self.limit = [0.0, 0.0, 0], [], 0, CHUNK
        self.dense = [np.zeros(slots), np.zeros(slots), np.zeros(slots, dtype=np.int64)] if slots <= NODE_SLOTS else None

    def add(self, record: tuple) -> None:
        for i in range(3):
            self.sums[i] += record[i]
        if self.dense:
            for own, new in zip(self.dense, record[4:]):
                own[record[3]] += new   # a record names a slot once
            return
        self.held.append(record[3:])
        self.rows += len(record[3])
        if self.rows > self.limit:
            self.held = [self.slots()]
            self.rows = len(self.held[0][0])
            self.limit = max(CHUNK, 2 * self.rows)

    def slots(self) -> tuple[np.ndarray, ...]:
        """Slots with rows in order, and their sums."""
        if self.dense:
            at = np.flatnonzero(self.dense[2])
            return at, *[v[at] for v in self.dense]
        if len(self.held) == 1:
            return self.held[0]
        at, G, H, n = (np.concatenate(c) for c in zip(*self.held))
        slot, where = np.unique(at, return_inverse=True)
        out = [np.bincount(where, weights=v, minlength=len(slot)) for v in (G, H, n)]
        return slot, out[0], out[1], out[2].astype(np.int64)


def best_splits(records: Iterable[tuple], bins: Bins, width: int, classes: int, lam: list[float],
                mcw: list[float]) -> Iterator[tuple]:
    """One record ``BEST_FIELDS`` per node; the partition holds all records of its nodes' histograms."""
    nodes: dict[int, _Node] = {}
    for t, record in records:
        if t not in nodes:
            nodes[t] = _Node(int(bins.slot[-1]))
        nodes[t].add(record)
    for t in sorted(nodes):
        node = nodes.pop(t)
        slot, G, H, n = node.slots()
        f = np.searchsorted(bins.slot, slot, side="right") - 1
        p = t // width // classes
        best = best_of_node(f, slot - bins.slot[f], G, H, n, node.sums, lam[p], mcw[p])
        yield t, *(best or (None,) * 8), node.sums[0], node.sums[1]


# -------------------------------------------------------------------- margins
def add_trees(records: Iterable[tuple], trees: list[tuple[int, dict, dict]], base: np.ndarray,
              bins: Bins) -> Iterator[tuple]:
    """Pages with the leaf values of ``trees`` (tree number, splits, leaves) added to the margins."""
    values = []
    for number, splits, leaves in trees:
        place, value = np.zeros(max(leaves) + 1, dtype=np.int64), np.zeros(len(leaves))
        for i, (node, v) in enumerate(leaves.items()):
            place[node], value[i] = i, v[0]
        values.append((number, splits, place, value))
    for record in records:
        page = page_of(record, len(bins))
        m = np.repeat(base[:, None], page.n, axis=1) if page.m is None else page.m.copy()
        columns: dict[int, np.ndarray] = {}
        for number, splits, place, value in values:
            m[number] += value.take(numbered(page, splits, bins, columns, place))
        yield (*record[:4], m.astype("<f8").tobytes(), *record[5:])


def rows_of(batches: Iterator[pa.RecordBatch], features: int, first: int, classes: int) -> Iterator[pa.RecordBatch]:
    """The rows of pages with the margins of one point (its classes from ``first`` on)."""
    for batch in batches:
        for name, page in zip(batch.column("set").to_pylist(), read_pages(batch, features)):
            m = page.m[first:first + classes].T.reshape(-1)
            margins = pa.ListArray.from_arrays(pa.array(np.arange(page.n + 1, dtype=np.int32) * classes), pa.array(m))
            yield pa.RecordBatch.from_arrays([pa.array([name] * page.n), pa.array(page.rid), pa.array(page.y), margins],
                                             ["set", "rid", "y", "m"])
