"""Subword vectors: hashed features of words, documents as averages of them, and training in numpy.

A word's features are the word itself and its character n-grams (with edge marks), hashed into one table of learned
vectors; its vector is their mean.  A linear softmax over two classes reads an average of word vectors.  For
scoring, table and softmax fold into one number a feature (the difference of the two logits), so a model is 1 MB and a
batch of texts costs one pass over its different words.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelsift.llm.sampling import smallest
from reelsift.llm.textkit import hash_spans, mix, words

BUCKETS = 1 << 18
SLICE = 1 << 20  # text bytes scored at once
NGRAMS = (3, 4, 5)
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class Bags:
    """Words of some texts: ``code`` numbers the different words, whose features are flat in ``feature`` / ``at``."""

    off: np.ndarray
    code: np.ndarray
    feature: np.ndarray
    at: np.ndarray
    hashes: np.ndarray
    word_hash: np.ndarray

    def word_means(self, value: np.ndarray) -> np.ndarray:
        """Mean of a per-feature number over each different word's features."""
        if not len(self.hashes):
            return np.zeros(0)
        return np.add.reduceat(value[self.feature].astype(np.float64), self.at[:-1]) / np.diff(self.at)


def bags(texts: pa.Array, lower: bool, buckets: int = BUCKETS, ngrams: tuple[int, ...] = NGRAMS) -> Bags:
    w = words(texts)
    h = hash_spans(w, lower)
    kinds = pa.array(h).dictionary_encode()  # numbered in order of appearance
    code, hashes = kinds.indices.to_numpy().astype(np.int64), kinds.dictionary.to_numpy()
    first = np.empty(len(hashes), np.int64)
    first[code[::-1]] = np.arange(len(h))[::-1]
    feature, at = word_features(w.data, w.start[first], w.end[first], hashes.astype(np.uint64), lower, buckets, ngrams)
    return Bags(w.off, code, feature, at, hashes, h)


def without_runs(b: Bags) -> Bags:
    """The same with a run of one word counted once."""
    n = np.diff(b.off)
    owner = np.repeat(np.arange(len(n)), n)
    keep = np.ones(len(b.code), bool)
    keep[1:] = (b.code[1:] != b.code[:-1]) | (owner[1:] != owner[:-1])
    off = np.concatenate([[0], np.cumsum(np.bincount(owner[keep], minlength=len(n)))])
    return Bags(off, b.code[keep], b.feature, b.at, b.hashes, b.word_hash[keep])


def word_features(data: np.ndarray, start: np.ndarray, end: np.ndarray, hashes: np.ndarray, lower: bool, buckets: int, ngrams: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Feature buckets of each word, flat, with offsets: the word, then its n-grams of characters."""
    if not len(start):
        return np.zeros(0, np.int32), np.zeros(1, np.int64)
    n = end - start
    room = np.concatenate([[0], np.cumsum(n + 2)])
    flat = np.full(room[-1], 0x3C, np.uint8)  # <word>
    inner = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    flat[np.repeat(room[:-1] + 1, n) + inner] = data[np.repeat(start, n) + inner]
    flat[room[1:] - 1] = 0x3E
    if lower:
        flat[(flat >= 65) & (flat <= 90)] += 32
    head = (flat & 0xC0) != 0x80  # first byte of a character
    point = np.frombuffer(flat.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32).astype(np.uint64)
    length = np.add.reduceat(head.astype(np.int64), room[:-1])
    begin = np.concatenate([[0], np.cumsum(length)])
    last = np.repeat(begin[1:], length)
    owner = np.repeat(np.arange(len(length)), length)
    found, whose = [hashes], [np.arange(len(length))]
    acc = np.zeros(len(point), np.uint64)
    place = np.arange(len(point))
    for k in range(1, max(ngrams) + 1):
        m = len(point) - k + 1
        if m <= 0:
            break
        acc = mix(acc[:m] * _SPREAD + point[k - 1 :])
        if k in ngrams:
            inside = place[:m] + k <= last[:m]
            found.append(acc[inside] + np.uint64(k))
            whose.append(owner[:m][inside])
    whose, found = np.concatenate(whose), np.concatenate(found)
    order = np.argsort(whose, kind="stable")
    counts = np.bincount(whose, minlength=len(length))
    return (found[order] % np.uint64(buckets)).astype(np.int32), np.concatenate([[0], np.cumsum(counts)])


def labelled_rows(docs: DataFrame, labels: DataFrame, label: str, per_class: int, most_chars: int, seed: int) -> DataFrame:
    """doc_id, label, text to learn from: of each class the ``per_class`` rows of smallest hash, without the held-out fold
    (crc32 of the doc_id as text mod 5 = 0), without texts over ``most_chars``.  Bounded, so one task can hold it; the
    ids are picked from the labels alone and the texts come by one map-side join.  A repeated id teaches its smallest text,
    so the sample does not depend on the layout."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1)).where(F.crc32(F.col("doc_id").cast("string")) % 5 != 0)
    known = known.groupBy("doc_id").agg(F.min(label).alias("label"))
    order = F.xxhash64("doc_id", F.lit(seed))
    ids = smallest(known.where("label = 0"), order, per_class).unionByName(smallest(known.where("label = 1"), order, per_class))
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", text.alias("text")).where(F.length("text") <= most_chars).join(F.broadcast(ids), "doc_id")
    return rows.groupBy("doc_id", "label").agg(F.min("text").alias("text"))


def _in_order(rows: Iterable[tuple]) -> tuple[list[str], np.ndarray]:
    rows = sorted(rows)
    return [r[1] for r in rows], np.array([r[2] for r in rows], np.int64)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int, most_chars: int, seed: int) -> tuple[list[str], np.ndarray]:
    """Texts and labels of ``labelled_rows``, in the order of their ids."""
    return _in_order((r["doc_id"], r["text"], r["label"]) for r in labelled_rows(docs, labels, label, per_class, most_chars, seed).collect())


def trained(train: Callable[[list[str], np.ndarray], tuple[np.ndarray, float]], *sample) -> tuple[np.ndarray, float]:
    """The folded model that ``train`` makes of the ``labelled_sample``, in one task: neither the texts nor the training's
    memory, of which Python gives little back, come to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = [b.select(["doc_id", "text", "label"]).to_pydict() for b in batches]
        folded, bias = train(*_in_order(r for c in columns for r in zip(c["doc_id"], c["text"], c["label"], strict=True)))
        yield pa.RecordBatch.from_arrays([pa.array([folded.astype(np.float32).tobytes()]), pa.array([float(bias)])], names=["folded", "bias"])

    rows = labelled_rows(*sample).coalesce(1).mapInArrow(run, "folded binary, bias double").collect()
    if not rows:  # no sample at all: Spark runs no task
        folded, bias = train(*_in_order(()))
        return folded.astype(np.float32), bias
    return np.frombuffer(bytes(rows[0]["folded"]), np.float32), rows[0]["bias"]


class Model:
    """Feature vectors and a two-class softmax, trained by stochastic gradient descent (Adagrad steps)."""

    def __init__(self, buckets: int, dim: int, rng: np.random.Generator):
        self.table = rng.uniform(-1, 1, (buckets, dim)).astype(np.float32) / dim
        self.out = (rng.standard_normal((dim, 2)) / np.sqrt(dim)).astype(np.float32)
        self.bias = np.zeros(2, np.float32)
        self.seen = np.full(buckets, 1e-8, np.float32)
        self.seen_out = 1e-8

    def folded(self) -> tuple[np.ndarray, float]:
        """Per feature the difference of the logits it adds, and the bias: all that scoring needs."""
        return self.table @ (self.out[:, 1] - self.out[:, 0]), float(self.bias[1] - self.bias[0])

    def step(self, feature: np.ndarray, weight: np.ndarray, owner: np.ndarray, label: np.ndarray, rate: float, importance: np.ndarray) -> float:
        """One minibatch: document ``owner`` averages its features with ``weight``; returns the mean loss."""
        n, dim = len(label), self.table.shape[1]
        rows = self.table[feature]
        hidden = np.stack([np.bincount(owner, rows[:, j] * weight, n) for j in range(dim)], axis=1)
        logit = hidden @ self.out + self.bias
        logit -= logit.max(axis=1, keepdims=True)
        p = np.exp(logit)
        p /= p.sum(axis=1, keepdims=True)
        loss = -np.log(np.maximum(p[np.arange(n), label], 1e-9)).mean()
        p[np.arange(n), label] -= 1
        p *= (importance / n)[:, None]
        back = (p @ self.out.T).astype(np.float32)
        uniq, place = np.unique(feature, return_inverse=True)
        grad = np.stack([np.bincount(place, back[owner, j] * weight, len(uniq)) for j in range(dim)], axis=1)
        self.seen[uniq] += (grad**2).mean(axis=1)
        self.table[uniq] -= (rate * grad / np.sqrt(self.seen[uniq])[:, None]).astype(np.float32)
        step_out, step_bias = hidden.T @ p, p.sum(axis=0)
        self.seen_out += float((step_out**2).mean() + (step_bias**2).mean())
        self.out -= (rate * step_out / np.sqrt(self.seen_out)).astype(np.float32)
        self.bias -= (rate * step_bias / np.sqrt(self.seen_out)).astype(np.float32)
        return float(loss)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))
