"""Quality classifier: hashed word and character n-gram vectors averaged over a document, softmax, numpy SGD.

Beside its own features, a word that repeats its predecessor and a word inside a three-word window that occurs twice in
the text add a reserved feature each: word n-grams that the text shares with itself.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelsift.llm.subword import BUCKETS, SLICE, Bags, Model, bags, sigmoid, trained
from reelsift.llm.textkit import mix, shingles, slices

PER_CLASS = 1_500  # labelled texts of each class to learn from
MOST_CHARS = 200_000  # longer texts are scored, but not learnt from
DIM = 8
EPOCHS = 6
BATCH = 64  # texts a step; fewer where there are under 3200 to learn from
RATE = 0.1
SEED = 41
THRESHOLD = 0.3
REPEATS = 2  # reserved features: same as the word before, in a repeated window


def repeats(b: Bags) -> np.ndarray:
    """(words, 2) marks of the reserved features."""
    h, n = b.word_hash, np.diff(b.off)
    owner = np.repeat(np.arange(len(n)), n)
    out = np.zeros((len(h) + 2, REPEATS), bool)
    out[1 : len(h), 0] = (h[1:] == h[:-1]) & (owner[1:] == owner[:-1])
    s, s_off = shingles(h, b.off, 3)
    k = np.diff(s_off)
    whose = np.repeat(np.arange(len(n)), k)
    place = np.arange(len(s)) - np.repeat(s_off[:-1], k) + np.repeat(b.off[:-1], k)
    key = mix(s + whose.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(key)
    same = key[order][1:] == key[order][:-1]
    twice = np.zeros(len(s), bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    for j in range(3):
        out[place[twice] + j, 1] = True
    return out[: len(h)]


def document_features(b: Bags, marks: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per text its different features and their weights in the average (0 to buckets-1 hashed, then the reserved)."""
    out = []
    size = np.diff(b.at)
    for i in range(len(b.off) - 1):
        code = b.code[b.off[i] : b.off[i + 1]]
        if not len(code):
            out.append((np.zeros(0, np.int64), np.zeros(0)))
            continue
        kinds, count = np.unique(code, return_counts=True)
        index = np.concatenate([b.feature[b.at[c] : b.at[c + 1]] for c in kinds])
        weight = np.repeat(count / size[kinds] / len(code), size[kinds])
        own = marks[b.off[i] : b.off[i + 1]].mean(axis=0)
        feature, place = np.unique(np.concatenate([index, BUCKETS + np.arange(REPEATS)]), return_inverse=True)
        out.append((feature, np.bincount(place, np.concatenate([weight, own]), len(feature))))
    return out


def train(texts: list[str], label: np.ndarray, epochs: int = EPOCHS, dim: int = DIM, seed: int = SEED) -> tuple[np.ndarray, float]:
    """Folded model.  Without both classes it scores the share of the class there is (0.5 without any)."""
    if not len(label) or label.min() == label.max():
        share = (label.sum() + 1) / (len(label) + 2)
        return np.zeros(BUCKETS + REPEATS), float(np.log(share / (1 - share)))
    rng = np.random.default_rng(seed)
    model = Model(BUCKETS + REPEATS, dim, rng)
    rows = []
    for a in range(0, len(texts), 200):
        b = bags(pa.array(texts[a : a + 200], pa.large_string()), lower=False)
        rows += [(f.astype(np.int32), w.astype(np.float32)) for f, w in document_features(b, repeats(b))]
    weight = np.where(label == 1, 0.5 / label.mean(), 0.5 / (1 - label.mean()))
    for e in range(epochs):
        order = rng.permutation(len(rows))
        batch = min(BATCH, max(8, len(rows) // 50))
        for a in range(0, len(order), batch):
            part = order[a : a + batch]
            owner = np.repeat(np.arange(len(part)), [len(rows[i][0]) for i in part])
            model.step(np.concatenate([rows[i][0] for i in part]), np.concatenate([rows[i][1] for i in part]), owner, label[part], RATE * (1 - e / epochs), weight[part])
    return model.folded()


def score_texts(texts: pa.Array, folded: np.ndarray, bias: float) -> np.ndarray:
    b = bags(texts, lower=False)
    n = np.diff(b.off)
    owner = np.repeat(np.arange(len(n)), n)
    word = b.word_means(folded[:BUCKETS])[b.code] if len(b.code) else np.zeros(0)
    word = word + repeats(b) @ folded[BUCKETS:]
    return sigmoid(np.bincount(owner, word, len(n)) / np.maximum(n, 1) + bias)


def quality_scores(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs`` (doc_id, text).

    Only the text is scored; a text without words gets the model's bias.  Null doc_ids are not held out; repeated rows
    give a row each.  Labels (doc_id, quality) outside 0 and 1 are ignored, the smallest counts where they contradict.
    """
    folded, bias = trained(train, docs, labels, "quality", per_class, MOST_CHARS, SEED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", SLICE):
            s = score_texts(b.column("text"), folded, bias)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"), pa.array(s), pa.array((s >= threshold).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    return docs.select("doc_id", "text", held.alias("held_out")).mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def accepted(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` (with all their columns) that score ``threshold`` or more: one map over the table."""
    folded, bias = trained(train, docs, labels, "quality", per_class, MOST_CHARS, SEED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", SLICE):
            yield b.filter(pa.array(score_texts(b.column("text"), folded, bias) >= threshold))

    return docs.mapInArrow(run, docs.schema)
