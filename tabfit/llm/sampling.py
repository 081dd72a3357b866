"""Operator 5: sampled SentencePiece segmentations and lossless decoding.

The lattice of a text holds every way to write it with the pieces of a model.  A
segmentation is drawn with probability proportional to the product of its pieces'
weights (a piece of merge rank ``r`` weighs ``(r + 2) ** -alpha``): forward
filtering sums the weights of all ways to each position, and backward sampling
walks from the end, choosing each piece by its share.  The random number at a
position depends only on the row key, the seed and that position, so a row's
segmentation is the same whatever the partitions, batches or retries.

No piece spans the start of a run of spaces or a line break, so the lattice falls
apart there and forward filtering runs once per distinct unit; backward sampling
runs for many units at once in numpy.  Characters without a piece are written as
the pieces of their UTF-8 bytes, so decoding gives the text back exactly.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabfit.llm.common import ship, table, text_or_empty

MODEL = "piece_bpe_32k.model"
ALPHA, SEED = 1.0, 17
SPACE = "▁"
#: Units remembered by a worker, and the length from which one is not remembered.
UNITS_KEPT, LONG_UNIT = 250_000, 200
#: Units up to this length are filtered together.
TOGETHER = 40
_UNIT = re.compile(r"\n| *[^ \n]+| +")


def model_path(name: str = MODEL) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def _mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BASE, _LENGTH = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93


def _rolled(text: str) -> int:
    """Polynomial hash of a string and its length, modulo 2 ** 64."""
    h = 0
    for c in text:
        h = (h * _BASE + ord(c) + 1) % (1 << 64)
    return (h ^ (len(text) * _LENGTH)) % (1 << 64)


class Pieces:
    """The pieces of a model, their weights, and how each is decoded."""

    def __init__(self, path: str, alpha: float = ALPHA):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = sp.get_piece_size()
        self.ids: dict[str, tuple[int, float]] = {}
        self.byte = [0] * 256
        self.raw: list[bytes] = []
        for i in range(self.size):
            p = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte[int(p[3:5], 16)] = i
                self.raw.append(bytes([int(p[3:5], 16)]))
            elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                self.raw.append(b"")
            else:
                text = p.replace(SPACE, " ")
                self.raw.append(text.encode())
                # a score is minus the merge rank; bytes count as the last rank
                self.ids[text] = (i, float((2.0 - sp.get_score(i)) ** -alpha))
        self.longest = max(map(len, self.ids), default=1)
        # hash of every piece, to look up many substrings at once
        known = sorted(self.ids.items())
        h = np.array([_rolled(t) for t, _ in known], dtype=np.uint64)
        order = np.argsort(h)
        self.hashes = h[order]
        self.hash_id = np.array([v[0] for _, v in known], dtype=np.int64)[order]
        self.hash_weight = np.array([v[1] for _, v in known])[order]
        self.byte_weight = float((2.0 + self.size) ** -alpha)

    def decode(self, ids: list[int]) -> str:
        """The text of a segmentation (its first space was put there by encoding)."""
        return b"".join(map(self.raw.__getitem__, ids))[1:].decode("utf-8", "surrogatepass")


class Sampler:
    """Filtered lattices of the units met so far, as flat arrays.

    Node ``k`` is a position in a unit.  Its incoming edges stand together from
    ``start[k]`` on, longest piece first, with their running shares in ``cum``
    (1 for the last), so a uniform number picks an edge in a step or two."""

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        self.reset()

    def reset(self) -> None:
        self.unit: dict[str, int] = {}  # number of a unit
        self.count = self.nodes = self.edges = 0
        self.end = np.empty(1 << 14, dtype=np.int64)  # by unit: node at its end, length
        self.length = np.empty(1 << 14, dtype=np.int64)
        self.start = np.empty(1 << 16, dtype=np.int64)
        self.cum = np.empty(1 << 16)
        self.piece = np.empty(1 << 16, dtype=np.int64)
        self.back = np.empty(1 << 16, dtype=np.int64)
        self.spelled: list[list[int]] = []

    def _fit(self, names: tuple[str, ...], need: int) -> None:
        """Room for ``need`` entries in the named arrays."""
        for name in names:
            old = getattr(self, name)
            if need > len(old):
                new = np.empty(max(need, 2 * len(old)), dtype=old.dtype)
                new[:len(old)] = old
                setattr(self, name, new)

    def _add(self, units: list[str], size: np.ndarray, node: np.ndarray, first: np.ndarray,
             cum: np.ndarray, piece: np.ndarray, back: np.ndarray) -> None:
        """Append units (their lengths) and their edges; ``node`` is the target of
        each edge counted from the first of these units, ``first`` marks the first
        edge of a node."""
        n, m, k = len(units), len(cum), int(size.sum()) + len(units)
        self._fit(("end", "length"), self.count + n)
        self._fit(("start",), self.nodes + k)
        self._fit(("cum", "piece", "back"), self.edges + m)
        self.unit.update(zip(units, range(self.count, self.count + n)))
        self.end[self.count:self.count + n] = self.nodes + np.cumsum(size) + np.arange(n)
        self.length[self.count:self.count + n] = size
        self.start[self.nodes + node[first]] = self.edges + np.nonzero(first)[0]
        at = slice(self.edges, self.edges + m)
        self.cum[at], self.piece[at], self.back[at] = cum, piece, back
        self.count, self.nodes, self.edges = self.count + n, self.nodes + k, self.edges + m

    def _spell(self, char: str) -> tuple[int, float]:
        b = char.encode("utf-8", "surrogatepass")
        self.spelled.append([self.pieces.byte[x] for x in b])
        return self.pieces.size + len(self.spelled) - 1, self.pieces.byte_weight ** len(b)

    def learn(self, units: list[str]) -> None:
        """Filter the lattices of new units: short ones together, long ones alone."""
        short = [u for u in units if len(u) <= TOGETHER]
        for lo in range(0, len(short), 20_000):
            self._learn_many(short[lo:lo + 20_000])
        for u in units:
            if len(u) > TOGETHER:
                self._learn_long(u)

    def _learn_many(self, units: list[str]) -> None:
        p = self.pieces
        text = "".join(units)
        cp = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64) + np.uint64(1)
        size = np.fromiter(map(len, units), dtype=np.int64, count=len(units))
        stop = np.cumsum(size)
        owner = np.repeat(np.arange(len(units)), size)
        at = np.arange(len(cp))
        room = stop[owner] - at
        node0 = at + owner  # node before each character: one more node per unit
        h = np.zeros(len(cp), dtype=np.uint64)
        start, step, piece, weight = [], [], [], []
        live = at
        for n in range(1, p.longest + 1):
            live = live[room[live] >= n]
            if not len(live):
                break
            h[live] = h[live] * np.uint64(_BASE) + cp[live + n - 1]
            key = h[live] ^ np.uint64(n * _LENGTH % (1 << 64))
            i = np.minimum(np.searchsorted(p.hashes, key), len(p.hashes) - 1)
            hit = p.hashes[i] == key
            start.append(live[hit])
            step.append(np.full(int(hit.sum()), n))
            piece.append(p.hash_id[i[hit]])
            weight.append(p.hash_weight[i[hit]])
            if n == 1 and not hit.all():
                miss = live[~hit]
                spelled = [self._spell(text[k]) for k in miss.tolist()]
                start.append(miss)
                step.append(np.ones(len(miss), dtype=np.int64))
                piece.append(np.array([x for x, _ in spelled], dtype=np.int64))
                weight.append(np.array([x for _, x in spelled]))
        start, step, piece, weight = map(np.concatenate, (start, step, piece, weight))
        source = node0[start]
        target = source + step
        depth = start + step - (stop - size)[owner[start]]  # position of the target in its unit
        order = np.lexsort((-step, target))
        source, target, depth, step, piece, weight = (x[order] for x in (source, target, depth, step, piece, weight))
        total = np.zeros(len(cp) + len(units))
        total[(stop - size) + np.arange(len(units))] = 1.0
        by_depth = np.argsort(depth, kind="stable")
        edge = np.concatenate(([0], np.cumsum(np.bincount(depth, minlength=int(size.max()) + 1))))
        for d in range(1, int(size.max()) + 1):
            e = by_depth[edge[d]:edge[d + 1]]
            t = target[e]
            first = np.concatenate(([0], np.nonzero(np.diff(t))[0] + 1))
            total[t[first]] = np.add.reduceat(total[source[e]] * weight[e], first)
        share = total[source] * weight / total[target]
        first = np.concatenate(([True], np.diff(target) > 0))
        run = np.cumsum(share)
        before = (run - share)[first][np.cumsum(first) - 1]
        last = np.concatenate((first[1:], [True]))
        cum = np.where(last, 1.0, run - before)
        self._add(units, size, target, first, cum, piece, step)

    def _learn_long(self, unit: str) -> None:
        p, n = self.pieces, len(unit)
        total = [1.0]
        cum, piece, back, node = [], [], [], []
        for j in range(1, n + 1):
            into = []
            # only shares matter: the sums of the last few positions are kept in range
            top = max(total[max(0, j - p.longest):])
            if top < 1e-100:
                for i in range(max(0, j - p.longest), j):
                    total[i] /= top
            for i in range(max(0, j - p.longest), j):
                got = p.ids.get(unit[i:j])
                if got is not None:
                    into.append((total[i] * got[1], got[0], j - i))
            if unit[j - 1] not in p.ids:
                k, w = self._spell(unit[j - 1])
                into.append((total[j - 1] * w, k, 1))
            s = sum(w for w, _, _ in into)
            total.append(s)
            run = 0.0
            for w, k, step in into:
                run += w / s
                cum.append(run)
                piece.append(k)
                back.append(step)
                node.append(j)
            cum[-1] = 1.0
        at = np.array(node)
        self._add([unit], np.array([n]), at, np.concatenate(([True], np.diff(at) > 0)), np.array(cum),
                  np.array(piece), np.array(back))

    def sample(self, texts: list[str], keys: np.ndarray) -> list[np.ndarray]:
        """Piece ids of each text; ``keys``: unsigned 64-bit seeds of the rows."""
        split = [_UNIT.findall(" " + t) if t else [] for t in texts]
        if len(self.unit) > UNITS_KEPT or self.edges > 30 * UNITS_KEPT:
            self.reset()
        new = set().union(*split).difference(self.unit)
        if new:
            self.learn(sorted(new))
        counts = np.array([len(u) for u in split], dtype=np.int64)
        number = np.fromiter(map(self.unit.__getitem__, chain.from_iterable(split)), dtype=np.int64,
                             count=int(counts.sum()))
        node, left = self.end[number], self.length[number]
        place = np.cumsum(left)  # where each unit ends, over all texts
        edge = np.concatenate(([0], place))
        stop = edge[np.cumsum(counts)]
        origin = np.concatenate(([0], stop))[:-1]
        owner = np.repeat(np.arange(len(texts)), counts)
        key, first = keys[owner], origin[owner]
        chosen = np.full(int(edge[-1]), -1, dtype=np.int64)  # piece that starts at each place
        live = np.arange(len(node))
        while len(live):
            h = _mix(key[live] + (place[live] - first[live]).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
            u = (h >> np.uint64(11)).astype(np.float64) / float(1 << 53)
            e = self.start[node[live]]
            more = np.nonzero(u >= self.cum[e])[0]
            while len(more):
                e[more] += 1
                more = more[u[more] >= self.cum[e[more]]]
            step = self.back[e]
            place[live] -= step
            node[live] -= step
            left[live] -= step
            chosen[place[live]] = self.piece[e]
            live = live[left[live] > 0]
        out: list[np.ndarray] = []
        for lo, hi in zip(origin.tolist(), stop.tolist()):
            ids = chosen[lo:hi]
            ids = ids[ids >= 0]
            if len(ids) and ids.max() >= self.pieces.size:
                ids = np.array([x for k in ids.tolist() for x in (
                    self.spelled[k - self.pieces.size] if k >= self.pieces.size else (k,))], dtype=np.int64)
            out.append(ids)
        for u in {u for units in split for u in units if len(u) > LONG_UNIT}:
            self.unit.pop(u, None)
        return out


_SAMPLERS: dict[tuple[str, float], Sampler] = {}


def _sampler(path: str, alpha: float) -> Sampler:
    """One per worker process and model."""
    if (path, alpha) not in _SAMPLERS:
        _SAMPLERS[path, alpha] = Sampler(Pieces(path, alpha))
    return _SAMPLERS[path, alpha]


def _chunks(texts: list[str], chars: int = 400_000) -> Iterator[tuple[int, int]]:
    lo = n = 0
    for i, t in enumerate(texts):
        n += len(t)
        if n >= chars or i == len(texts) - 1:
            yield lo, i + 1
            lo, n = i + 1, 0


def encode(docs: DataFrame, key: str = "doc_id", text: str = "text", out: str = "piece_ids",
           path: str | None = None, alpha: float = ALPHA, seed: int = SEED) -> DataFrame:
    """``docs`` with ``out``, the sampled segmentation of the whole text (array of
    ids).  Null and empty texts have no pieces; a null key is a key of its own;
    rows with equal key and text get equal pieces.  Row-local: no shuffle."""
    ship(docs.sparkSession)
    path = path or model_path()

    @F.pandas_udf("array<int>")
    def pieces(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        sampler = _sampler(path, alpha)
        for keys, texts in parts:
            k, t = keys.to_numpy(np.int64).view(np.uint64), texts.tolist()
            got: list[np.ndarray] = []
            for lo, hi in _chunks(t):
                got += sampler.sample(t[lo:hi], k[lo:hi])
            yield pd.Series([g.astype(np.int32) for g in got], dtype=object)

    return docs.withColumn(out, pieces(F.xxhash64(F.col(key).cast("string"), F.lit(seed)), text_or_empty(text)))


def decode(docs: DataFrame, ids: str = "piece_ids", out: str = "decoded", path: str | None = None) -> DataFrame:
    """``docs`` with ``out``, the text of the pieces in ``ids`` (null or empty: empty)."""
    ship(docs.sparkSession)
    path = path or model_path()

    @F.pandas_udf("string")
    def text(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        pieces = _sampler(path, ALPHA).pieces
        for s in parts:
            yield pd.Series([pieces.decode(x.tolist()) if x is not None and len(x) else "" for x in s], dtype=object)

    return docs.withColumn(out, text(F.col(ids)))


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its sampled pieces, their number and CRC, and whether decoding them gives
    back the whole text (null: empty).  The seed of a row is its doc_id: rows of one
    id and text have one segmentation; a null id is a seed of its own."""
    docs = table(spark, sf_dir, "documents").select("doc_id", text_or_empty("text").alias("text"))
    ship(spark)
    path = model_path()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = _sampler(path, ALPHA)
        for b in batches:
            t = b.column(2).to_pylist()
            keys = b.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
            for lo, hi in _chunks(t):
                pieces = sampler.sample(t[lo:hi], keys[lo:hi])
                crc = [zlib.crc32(ids.astype("<u4").tobytes()) for ids in pieces]
                same = [(sampler.pieces.decode(ids.tolist()) if len(ids) else "") == s for s, ids in zip(t[lo:hi], pieces)]
                n = np.array([len(ids) for ids in pieces], dtype=np.int64)
                offsets = pa.array(np.concatenate(([0], np.cumsum(n))).astype(np.int32))
                flat = np.concatenate(pieces).astype(np.int32) if n.sum() else np.empty(0, np.int32)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, hi - lo), pa.array(n), pa.array(crc, pa.int64()), pa.array(same),
                     pa.ListArray.from_arrays(offsets, pa.array(flat))],
                    ["doc_id", "n_pieces", "ids_crc32", "lossless", "piece_ids"])

    seeded = docs.select("doc_id", F.xxhash64(F.col("doc_id").cast("string"), F.lit(SEED)), "text")
    return seeded.mapInArrow(digest, "doc_id long, n_pieces long, ids_crc32 long, lossless boolean, piece_ids array<int>")
