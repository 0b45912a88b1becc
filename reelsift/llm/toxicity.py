"""Toxicity: bags of subword vectors averaged into a linear softmax, so that unseen misspellings share n-gram vectors.

A text is cut into bags of 8 words.  A single insult is lost in the average of a long text, so the text's score is that
of its most toxic bag, and training, after three passes over some bags of each, follows that bag.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelsift.llm.subword import SLICE, Bags, Model, bags, sigmoid, trained, without_runs
from reelsift.llm.textkit import slices

PER_CLASS = 3_000
BUCKETS = 1 << 18
NGRAMS = (3, 4, 5)
MOST_CHARS = 200_000
BAG = 8
DIM = 8
EPOCHS = 20
ANY_EPOCHS = 3  # passes over some bags of each text before the worst one is known
ANY_BAGS = 16
MIN_DOCS = 3
BATCH = 64  # texts a step; fewer where there are under 3200 to learn from
RATE = 0.25
SEED = 43
THRESHOLD = 0.5


def bag_edges(off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First word of each bag (with the end), and the text of each bag."""
    n = np.diff(off)
    k = -(-n // BAG)
    owner = np.repeat(np.arange(len(n)), k)
    begin = off[:-1][owner] + (np.arange(len(owner)) - np.repeat(np.cumsum(k) - k, k)) * BAG
    return np.append(begin, off[-1]), owner


def worst_bags(b: Bags, value: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per text with words: its number, the first and last word of the bag with the largest mean, and per text the mean."""
    edge, owner = bag_edges(b.off)
    n = len(b.off) - 1
    best = np.full(n, -np.inf)
    if not len(owner):
        return np.zeros((0, 3), np.int64), best, owner
    mean = np.add.reduceat(b.word_means(value)[b.code], edge[:-1]) / np.diff(edge)
    order = np.lexsort((-mean, owner))
    first = order[np.concatenate([[True], owner[order][1:] != owner[order][:-1]])]
    best[owner[first]] = mean[first]
    return np.stack([owner[first], edge[first], edge[first + 1]], axis=1), best, owner


def feature_documents(parts: list[Bags]) -> np.ndarray:
    """In how many texts each feature occurs."""
    out = np.zeros(BUCKETS, np.int64)
    for b in parts:
        for lo, hi in zip(b.off[:-1], b.off[1:], strict=True):
            kinds = np.unique(b.code[lo:hi])
            if len(kinds):
                out[np.unique(np.concatenate([b.feature[b.at[c] : b.at[c + 1]] for c in kinds]))] += 1
    return out


def bag_features(b: Bags, lo: int, hi: int, spread: np.ndarray, number: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of the words ``lo`` to ``hi``, their shares in the bag's average, and the bag's number."""
    code = b.code[lo:hi]
    size = b.at[code + 1] - b.at[code]
    feature = np.concatenate([b.feature[b.at[c] : b.at[c + 1]] for c in code])
    known = spread[feature] >= MIN_DOCS
    return feature[known], np.repeat(1 / size / len(code), size)[known], np.full(int(known.sum()), number)


def train(texts: list[str], label: np.ndarray, epochs: int = EPOCHS, dim: int = DIM, seed: int = SEED) -> tuple[np.ndarray, float]:
    """Folded model.  Without both classes it scores the share of the class there is (0.5 without any)."""
    if not len(label) or label.min() == label.max():
        share = (label.sum() + 1) / (len(label) + 2)
        return np.zeros(BUCKETS), float(np.log(share / (1 - share)))
    rng = np.random.default_rng(seed)
    model = Model(BUCKETS, dim, rng)
    parts = [without_runs(bags(pa.array(texts[a : a + 200], pa.large_string()), lower=True, buckets=BUCKETS, ngrams=NGRAMS)) for a in range(0, len(texts), 200)]
    spread = feature_documents(parts)
    model.table[spread < MIN_DOCS] = 0  # a feature of one or two texts says who wrote them, not what is toxic
    weight = np.ones(len(label))
    for e in range(epochs):
        value, _ = model.folded()
        rows = []
        for p, b in enumerate(parts):
            if e < ANY_EPOCHS:  # some bags of every text, and in another epoch others
                edge, owner = bag_edges(b.off)
                order = np.lexsort((rng.random(len(owner)), owner))
                place = np.arange(len(owner)) - np.searchsorted(owner, owner)
                pick = order[place < ANY_BAGS]
                chosen = np.stack([owner[pick], edge[pick], edge[pick + 1]], axis=1)
            else:
                chosen = worst_bags(b, value)[0]
            rows += [(p, int(i), int(lo), int(hi)) for i, lo, hi in chosen]
        order = rng.permutation(len(rows))
        batch = min(BATCH, max(8, len(rows) // 50))
        for a in range(0, len(order), batch):
            part = [rows[i] for i in order[a : a + batch]]
            feature, share, owner = zip(*(bag_features(parts[p], lo, hi, spread, k) for k, (p, _, lo, hi) in enumerate(part)), strict=True)
            who = np.array([200 * p + i for p, i, _, _ in part])
            model.step(np.concatenate(feature), np.concatenate(share), np.concatenate(owner), label[who], RATE * (1 - e / epochs), weight[who])
    return model.folded()


def score_texts(texts: pa.Array, folded: np.ndarray, bias: float) -> np.ndarray:
    """Probability of the worst bag; a text without words has none and scores 0."""
    _, best, _ = worst_bags(without_runs(bags(texts, lower=True, buckets=BUCKETS, ngrams=NGRAMS)), folded)
    return np.where(np.isfinite(best), sigmoid(np.where(np.isfinite(best), best, 0) + bias), 0.0)


def toxicity_scores(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs`` (doc_id, text).

    Only the text is scored; a text without words scores 0.  Null doc_ids are not held out; repeated rows give a row
    each.  Labels (doc_id, toxic) outside 0 and 1 are ignored, the smallest counts where they contradict.
    """
    folded, bias = trained(train, docs, labels, "toxic", per_class, MOST_CHARS, SEED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", SLICE):
            s = score_texts(b.column("text"), folded, bias)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"), pa.array(s), pa.array((s >= threshold).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    return docs.select("doc_id", "text", held.alias("held_out")).mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def harmless(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` (with all their columns) that score under ``threshold``: one map over the table."""
    folded, bias = trained(train, docs, labels, "toxic", per_class, MOST_CHARS, SEED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", SLICE):
            yield b.filter(pa.array(score_texts(b.column("text"), folded, bias) < threshold))

    return docs.mapInArrow(run, docs.schema)
