"""Operator 2: toxicity by subword-bag embeddings and a linear softmax.

A word is the bag of its character n-grams (hashed) and itself; its vector is the
mean of their embeddings, so an unseen misspelling shares most of its vector with
the word it stands for.  A text is the mean of its words' vectors, and a linear
softmax over it gives the class probabilities.  Embeddings and softmax are trained
jointly in numpy on a bounded sample of labelled rows.

A toxic text is mostly made of harmless words, so a long text is scored by its
windows of ``WINDOW`` words as well: its logit is the greatest over the windows,
in training as in scoring.  Because the softmax is linear, a word adds one number
to the logit of its window; tasks remember that number per word, and a text costs
one lookup per word, whole texts included.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabfit.llm.common import ship, table, text_or_empty

BUCKETS = 1 << 16
DIM = 8
GRAMS = (3, 4, 5)
WINDOW = 64
#: Bound of the training sample: labelled rows of each class at most.
SAMPLE_PER_CLASS = 2_500
THRESHOLD = 0.3
WORDS_KEPT = 400_000


#: Punctuation around a word.
_EDGES = ".,;:!?\"'()[]{}|#*$%&<>-"
_PRIME = np.uint64(0x100000001B3)


def bare(word: str) -> str:
    """A word in lower case without the punctuation around it ("" if that is all)."""
    return word.lower().strip(_EDGES)


def word_buckets(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed ids of each (bare) word and of its character n-grams, and how many
    ids each word has.  The ids of a word stand together; all words at once."""
    marked = [f"<{w}>" for w in words]
    size = np.fromiter(map(len, marked), dtype=np.int64, count=len(marked))
    cp = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    end = np.cumsum(size)
    owner = np.repeat(np.arange(len(marked)), size)
    left = np.repeat(end, size) - np.arange(len(cp))  # letters from here to the word's end
    ids = [np.fromiter((xxhash.xxh32_intdigest(m.encode("utf-8", "surrogatepass")) for m in marked),
                       dtype=np.int64, count=len(marked)) % BUCKETS]
    owners = [np.arange(len(marked))]
    for n in GRAMS:
        at = np.nonzero(left >= n)[0]
        h = np.full(len(at), np.uint64(n))
        for i in range(n):
            h = (h ^ cp[at + i]) * _PRIME
            h ^= h >> np.uint64(27)
        ids.append((h % np.uint64(BUCKETS)).astype(np.int64))
        owners.append(owner[at])
    who = np.concatenate(owners)
    order = np.argsort(who, kind="stable")
    return np.concatenate(ids)[order], np.bincount(who, minlength=len(marked))


def tokens(text: str) -> list[str]:
    return text.split()


@dataclass
class ToxicityModel:
    """``weight[b]``: what bucket ``b`` adds to the logit (embedding times the
    difference of the softmax rows); ``bias``: the logit of a text without words."""

    weight: np.ndarray
    bias: float

    def word_scores(self, words: list[str]) -> np.ndarray:
        ids, n = word_buckets(words)
        return np.add.reduceat(self.weight[ids], np.cumsum(n) - n) / n

    def logits(self, texts: list[str], known: dict) -> np.ndarray:
        """``known``: scores of words met before; those of new words are added."""
        out = np.empty(len(texts))
        for lo in range(0, len(texts), 64):
            split = [tokens(t) for t in texts[lo:lo + 64]]
            new = list(set(chain.from_iterable(split)).difference(known))
            if len(known) + len(new) > WORDS_KEPT:
                known.clear()
                new = list(set(chain.from_iterable(split)))
            for at in range(0, len(new), 20_000):
                part = new[at:at + 20_000]
                known.update(zip(part, self.word_scores([bare(w) for w in part]).tolist()))
            for i, words in enumerate(split):
                s = np.fromiter(map(known.__getitem__, words), dtype=np.float64, count=len(words))
                s = s[_fresh(s)]
                out[lo + i] = self.bias + (float(_windows(s).max()) if words else 0.0)
        return out


def _fresh(values: np.ndarray) -> np.ndarray:
    """Mask without the direct repetitions: a word said many times over counts once."""
    return np.concatenate(([True], values[1:] != values[:-1])) if len(values) else np.zeros(0, bool)


def _starts(n: int) -> np.ndarray:
    """First words of the half-overlapping windows of a text of ``n`` words."""
    if n <= WINDOW:
        return np.zeros(1, dtype=np.int64)
    return np.unique(np.append(np.arange(0, n - WINDOW, WINDOW // 2), n - WINDOW))


def _windows(scores: np.ndarray) -> np.ndarray:
    """Mean word score of each window.  A window shorter than ``WINDOW`` words is
    filled up with neutral words, so one word cannot decide a short text alone."""
    at, size = _starts(len(scores)), min(len(scores), WINDOW)
    run = np.concatenate(([0.0], np.cumsum(scores)))
    return (run[at + size] - run[at]) / max(size, WINDOW // 4)


def train(texts: list[str], labels: np.ndarray, weights: np.ndarray, epochs: int = 8, batch: int = 64,
          least_steps: int = 800, rate: float = 0.15, decay: float = 1e-4, seed: int = 5) -> ToxicityModel:
    """Joint training of embeddings and softmax with Adagrad, ``epochs`` times
    through the sample and for ``least_steps`` batches at least.  Each step takes, of
    every text of the batch, the window with the greatest logit so far."""
    rng = np.random.default_rng(seed)
    vocab: dict[str, int] = {}
    docs = [np.array([vocab.setdefault(bare(w), len(vocab)) for w in tokens(t)], dtype=np.int32) for t in texts]
    docs = [d[_fresh(d)] for d in docs]
    # part by part: the driver holds the ids of the vocabulary, not what they are made from
    names, parts, counts = list(vocab), [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
    del vocab
    for lo in range(0, len(names), 20_000):
        b, n = word_buckets(names[lo:lo + 20_000])
        parts.append(b.astype(np.int32))
        counts.append(n)
    ids, per_word = np.concatenate(parts), np.concatenate(counts)
    del names, parts, counts
    offsets = np.concatenate(([0], np.cumsum(per_word)))
    emb = rng.uniform(-1.0 / DIM, 1.0 / DIM, (BUCKETS, DIM))
    soft = rng.uniform(-0.1, 0.1, (DIM, 2))
    prior = float((weights * labels).sum() / max(weights.sum(), 1e-9)) if len(labels) else 0.5
    prior = min(max(prior, 1e-3), 1 - 1e-3)
    bias = np.array([np.log(1 - prior), np.log(prior)])
    sq_emb, sq_soft, sq_bias = np.full(BUCKETS, 1e-3), np.full(soft.shape, 1e-3), np.full(2, 1e-3)

    def word_vectors(words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        n = offsets[words + 1] - offsets[words]
        at = np.repeat(offsets[words] - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
        grams = ids[at]
        starts = np.concatenate(([0], np.cumsum(n)[:-1]))
        return np.add.reduceat(emb[grams], starts, axis=0) / n[:, None], grams, n

    live = np.array([i for i, d in enumerate(docs) if len(d)], dtype=np.int64)
    # a small sample is read more often
    rounds = max(epochs, -(-least_steps // max(1, -(-len(live) // batch)))) if len(live) else 0
    for _ in range(rounds):
        rng.shuffle(live)
        # score of every word under the model so far, to choose windows
        per_gram = (emb @ (soft[:, 1] - soft[:, 0])).astype(np.float32)[ids]
        word_scores = np.add.reduceat(per_gram, offsets[:-1]) / np.diff(offsets)
        del per_gram
        for lo in range(0, len(live), batch):
            rows = live[lo:lo + batch]
            parts = []
            for r in rows:
                d = docs[r]
                w = _windows(word_scores[d])
                at = _starts(len(d))[int(w.argmax())]
                parts.append(d[at:at + WINDOW])
            sizes = np.array([max(len(p), WINDOW // 4) for p in parts], dtype=np.float64)
            words, back = np.unique(np.concatenate(parts), return_inverse=True)
            vec, grams, n = word_vectors(words)
            lens = np.array([len(p) for p in parts])
            starts = np.concatenate(([0], np.cumsum(lens)[:-1]))
            hidden = np.add.reduceat(vec[back], starts, axis=0) / sizes[:, None]
            z = hidden @ soft + bias
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(rows)), labels[rows]] -= 1.0
            p *= weights[rows][:, None]
            g_hidden = (p @ soft.T) / sizes[:, None]
            g_soft, g_bias = hidden.T @ p, p.sum(axis=0)
            g_vec = np.zeros_like(vec)
            np.add.at(g_vec, back, np.repeat(g_hidden, lens, axis=0))
            touched, pos = np.unique(grams, return_inverse=True)
            g_emb = np.zeros((len(touched), DIM))
            np.add.at(g_emb, pos, np.repeat(g_vec / n[:, None], n, axis=0))
            g_emb += decay * emb[touched]
            sq_emb[touched] += (g_emb ** 2).mean(axis=1)
            emb[touched] -= rate * g_emb / np.sqrt(sq_emb[touched])[:, None]
            sq_soft += g_soft ** 2
            soft -= rate * g_soft / np.sqrt(sq_soft)
            sq_bias += g_bias ** 2
            bias -= rate * g_bias / np.sqrt(sq_bias)
    return ToxicityModel((emb @ (soft[:, 1] - soft[:, 0])).astype(np.float64), float(bias[1] - bias[0]))


def held_out(key: Column) -> Column:
    return (F.crc32(key.cast("string").cast("binary")) % 4) == 2


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
        per_class: int = SAMPLE_PER_CLASS) -> ToxicityModel:
    """Train on at most ``per_class`` labelled rows of each class, taken by a hash
    of the key among rows that are not held out, and weighted so that the classes
    count as in all labelled rows.  Rows without a label or key are not used; a key
    labelled more than once is toxic if any label says so.  With one class only (or
    no labels) the model is the prior."""
    lab = (labels.where(F.col(label).isNotNull() & F.col(key).isNotNull()).where(~held_out(F.col(key)))
           .groupBy(key).agg(F.max(F.col(label).cast("int")).alias("__y")))
    counts = {r["__y"]: r["count"] for r in lab.groupBy("__y").count().collect()}  # two rows
    if not counts:
        return ToxicityModel(np.zeros(BUCKETS), 0.0)
    # bounded: 2 * per_class keys
    parts = [lab.where(F.col("__y") == y).orderBy(F.xxhash64(F.col(key).cast("string")), key).limit(per_class)
             for y in sorted(counts)]
    chosen = parts[0]
    for p in parts[1:]:
        chosen = chosen.unionByName(p)
    rows = (docs.select(key, text_or_empty(text).alias("__t")).join(F.broadcast(chosen), key)
            .dropDuplicates([key]).orderBy(key))
    texts, ys = [], []
    for r in rows.toLocalIterator():
        texts.append(r["__t"])
        ys.append(r["__y"])
    y = np.array(ys, dtype=np.int64)
    total = sum(counts.values())
    taken = {c: max(int((y == c).sum()), 1) for c in counts}
    weights = np.array([counts[c] / total * len(y) / taken[c] for c in ys])
    share = counts.get(1, 0) / total
    if not 0 < share < 1:
        return ToxicityModel(np.zeros(BUCKETS), 6.0 if share else -6.0)
    return train(texts, y, weights)


def score(docs: DataFrame, model: ToxicityModel, text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with ``out``, the probability of the toxic class of the whole text
    (null, empty: that of a text without words).  Row-local: no shuffle."""
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)  # fixed size: BUCKETS numbers

    @F.pandas_udf("double")
    def toxic(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m = shared.value
        known: dict[str, float] = {}
        for s in parts:
            z = m.logits(s.tolist(), known)
            yield pd.Series(1.0 / (1.0 + np.exp(-np.clip(z, -40, 40))))

    return docs.withColumn(out, toxic(text_or_empty(text)))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity of all documents, learnt from the labels of those not held out; an empty
    text (or null) gets the score of a text without words, a null key is not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, table(spark, sf_dir, "labels"))
    scored = score(docs, model)
    return scored.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
                         "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
