"""Quality rules with an isolation forest on their statistics.

Every text gives a few rule statistics (word and symbol counts, repeated lines and word windows, capitals, ...).  They are
measured by what they exceed: nothing within the range of the labelled good rows, beyond it the distance in units of that
range, on a log scale; otherwise trees would split within the noise of ordinary texts before they split off anything odd.
A forest of random splits isolates unusual documents on short paths; each of its trees grows, as the method has it, on a
few hundred rows drawn from the whole table.  Ranges and the path-length threshold come from all labelled rows, which stay
a table: the driver sees counts by score and the values next to a quantile.  The forest is a few hundred kilobytes and
goes to every task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelsift.llm.sampling import smallest
from reelsift.llm.scratch import written
from reelsift.llm.textkit import Words, buffers, hash_spans, mix, shingles, slices, words

TREES = 200
TREE_ROWS = 256
SCORE_PLACES = 6  # to which labelled rows are counted by score
FALSE_REJECTS = 0.005  # share of good labelled rows that a threshold may reject at most
SEED = 29

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
#: Statistics that the forest sees.  The number of words is none: long texts are no fault, short ones fail the base rules.
RATIOS = ["symbol_ratio", "dup_line_ratio", "repeat_ratio", "upper_ratio", "mark_ratio", "same_word_ratio", "odd_word_ratio", "word_length"]
BOTH_SIDES = ["word_length"]  # odd when small as well
RANGE = 0.999  # quantile of the good rows where a statistic's ordinary range ends
LEAST_RANGE = 0.01  # unit of statistics whose good rows hardly differ


def _table(chars: str | list[int]) -> np.ndarray:
    t = np.zeros(256, bool)
    t[[ord(c) for c in chars] if isinstance(chars, str) else chars] = True
    return t


_SYMBOL = _table("#*$%&|<>")
_UPPER, _LETTER = _table(list(range(65, 91))), _table([*range(65, 91), *range(97, 123), *range(128, 256)])
_MARK = _table("!?#*$%&|<>{}[]\\~^=_+")
_HEAD = np.ones(256, bool)
_HEAD[128:192] = False  # continuation bytes of UTF-8


def _per_text(flags: np.ndarray, off: np.ndarray) -> np.ndarray:
    c = np.concatenate([[0], np.cumsum(flags)])
    return c[off[1:]] - c[off[:-1]]


def _duplicated(values: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each value: whether it equals another one of the same text; whether it equals an earlier one."""
    key = mix(values + owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    both, later = np.zeros(len(key), bool), np.zeros(len(key), bool)
    both[order[1:][same]] = both[order[:-1][same]] = True
    later[order[1:][same]] = True
    return both, later


def statistics(texts: pa.Array) -> dict[str, np.ndarray]:
    """The rule statistics of each text; null counts as empty."""
    w = words(texts)
    off, data = buffers(texts)
    n, owner, h = w.count, w.owner, hash_spans(w)
    inside = np.zeros(len(data) + 1, np.int8)
    np.add.at(inside, w.start, 1)
    np.add.at(inside, w.end, -1)
    solid = np.cumsum(inside[:-1]).astype(bool)

    cut = np.flatnonzero(data == 10)
    edge = np.zeros(len(data) + 1, bool)
    edge[off] = edge[cut] = edge[cut + 1] = True
    point = np.flatnonzero(edge)
    begin, end = point[:-1], point[1:]  # lines, and the line feeds between them
    lines = Words(begin, end, np.searchsorted(begin, off), data, off)
    total = np.concatenate([[0], np.cumsum(solid)])
    full = total[end] > total[begin]
    line_owner = lines.owner[full]
    _, again = _duplicated(hash_spans(Words(begin[full], end[full], lines.off, data, off)), line_owner)

    s, s_off = shingles(h, w.off, 3)
    long = np.repeat(n >= 3, np.diff(s_off))
    first_word = (np.arange(len(s)) - np.repeat(s_off[:-1], np.diff(s_off)) + np.repeat(w.off[:-1], np.diff(s_off)))[long]
    found, _ = _duplicated(s[long], np.repeat(np.arange(len(n)), np.diff(s_off))[long])
    covered = np.zeros(len(h) + 2, bool)
    for j in range(3):
        covered[first_word[found] + j] = True
    same = np.zeros(len(h), bool)
    same[1:] = (h[1:] == h[:-1]) & (owner[1:] == owner[:-1])
    letters = np.concatenate([[0], np.cumsum(_LETTER[data])])
    odd = letters[w.end] == letters[w.start]  # words without any letter

    out = {
        "n_words": n,
        "word_chars": _per_text(solid & _HEAD[data], off),
        "n_symbols": _per_text(_SYMBOL[data], off),
        "n_dup_lines": np.bincount(line_owner, again, len(n)).astype(np.int64),
        "n_repeat_words": np.bincount(owner, covered[: len(h)], len(n)).astype(np.int64),
    }
    some, chars = np.maximum(n, 1), np.maximum(out["word_chars"], 1)
    ratios = {
        "symbol_ratio": out["n_symbols"] / chars,
        "dup_line_ratio": out["n_dup_lines"] / np.maximum(np.bincount(line_owner, minlength=len(n)), 1),
        "repeat_ratio": out["n_repeat_words"] / some,
        "upper_ratio": _per_text(_UPPER[data], off) / chars,
        "mark_ratio": _per_text(_MARK[data], off) / some,
        "same_word_ratio": np.bincount(owner, same, len(n)) / some,
        "odd_word_ratio": np.bincount(owner, odd, len(n)) / some,
        "word_length": out["word_chars"] / some,
    }
    return out | ratios


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in slices(batches, "text"):
        s = statistics(b.column("text"))
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(pa.array(s[c].astype(np.int64)) for c in COUNTS), *(pa.array(s[c].astype(np.float64)) for c in RATIOS)], names=["doc_id", *COUNTS, *RATIOS])


def rule_statistics(docs: DataFrame) -> DataFrame:
    schema = ", ".join(["doc_id long", *(f"{c} long" for c in COUNTS), *(f"{c} double" for c in RATIOS)])
    return docs.select("doc_id", "text").mapInArrow(_batches, schema)


def exact_quantiles(df: DataFrame, columns: list[str], qs: list[float]) -> np.ndarray | None:
    """(quantile, column) values as ``np.quantile`` has them, over all rows of ``df``; None without rows.

    A sketch brackets each quantile; exact counts below the bracket and by value inside it then settle it.
    """
    n = df.count()
    if not n:
        return None
    accuracy = max(10_000, min(1_000_000, n // 1000))
    margin = 3 / accuracy + 2 / n  # the sketch's error, and the ranks next to a quantile
    edges = [max(0.0, q - margin) for q in qs] + [min(1.0, q + margin) for q in qs]
    near = df.agg(*[F.percentile_approx(c, edges, accuracy).alias(c) for c in columns]).first()
    places = [(c, q, near[c][i], near[c][i + len(qs)]) for i, q in enumerate(qs) for c in columns]
    below = df.agg(*[F.sum((F.col(c) < lo).cast("bigint")).alias(f"b{j}") for j, (c, _, lo, _) in enumerate(places)]).first()
    marked = F.array(*[F.struct(F.lit(j).alias("j"), F.when(F.col(c).between(lo, hi), F.col(c)).alias("v")) for j, (c, _, lo, hi) in enumerate(places)])
    inside = df.select(F.explode(marked).alias("m")).where("m.v is not null").groupBy("m.j", "m.v").count().toPandas().sort_values(["j", "v"])
    out = []
    for j, (_, q, lo, _) in enumerate(places):
        part = inside[inside["j"] == j]
        v, upto = part["v"].to_numpy(), below[f"b{j}"] + np.cumsum(part["count"].to_numpy())
        at = q * (n - 1)
        a, b = (v[min(np.searchsorted(upto, i, "right"), len(v) - 1)] for i in (int(np.floor(at)), int(np.ceil(at))))
        t = at - np.floor(at)
        out.append(a + (b - a) * t if t < 0.5 else b - (b - a) * (1 - t))  # to the last bit as numpy: a row on the edge lies inside
    return np.array(out).reshape(len(qs), len(columns))


class Excess:
    """How far statistics lie outside the range of good rows: log(1 + distance / width of that side), 0 inside."""

    def __init__(self, good: np.ndarray):
        if not len(good):
            good = np.zeros((1, len(RATIOS)))
        self._set(*(np.quantile(good, q, axis=0) for q in (1 - RANGE, 0.5, RANGE)))

    @classmethod
    def of(cls, good: DataFrame) -> Excess:
        """The same from a table of all good rows."""
        quantiles = exact_quantiles(good, RATIOS, [1 - RANGE, 0.5, RANGE])
        if quantiles is None:
            return cls(np.zeros((0, len(RATIOS))))
        new = cls.__new__(cls)
        new._set(*quantiles)
        return new

    def _set(self, low: np.ndarray, middle: np.ndarray, high: np.ndarray) -> None:
        self.low, self.high = low, high
        self.above, self.below = np.maximum(high - middle, LEAST_RANGE), np.maximum(middle - low, LEAST_RANGE)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        both = [RATIOS.index(c) for c in BOTH_SIDES]
        up, down = np.maximum(x - self.high, 0) / self.above, np.maximum(self.low - x, 0) / self.below
        return np.log1p(np.concatenate([up, down[:, both]], axis=1))


class Forest:
    """Isolation trees in flat arrays (node 2i+1 and 2i+2 below node i).  Each draws ``rows`` rows of ``x``, other ones
    than every other tree if there are enough."""

    def __init__(self, x: np.ndarray, trees: int = TREES, rows: int = TREE_ROWS, seed: int = SEED):
        rng = np.random.default_rng(seed)
        rows = min(rows, len(x))
        self.depth = max(1, int(np.ceil(np.log2(max(rows, 2)))))
        nodes = 2 ** (self.depth + 1) - 1
        self.feature = np.zeros((trees, nodes), np.int8)
        self.split = np.full((trees, nodes), np.nan)
        self.length = np.zeros((trees, nodes))
        self.norm = _average(rows)
        dealt = rng.permutation(len(x)) if len(x) >= trees * max(rows, 1) else None
        for t in range(trees):
            own = rng.choice(len(x), rows, replace=False) if dealt is None else dealt[t * rows : (t + 1) * rows]
            self._grow(rng, t, 0, 0, x[own] if rows else x)

    def _grow(self, rng: np.random.Generator, t: int, node: int, level: int, x: np.ndarray) -> None:
        low, high = (x.min(axis=0), x.max(axis=0)) if len(x) else (np.zeros(0), np.zeros(0))
        wide = np.flatnonzero(high > low)
        self.length[t, node] = level + _average(len(x))
        if level == self.depth or not len(wide):
            return
        f = rng.choice(wide)
        cut = rng.uniform(low[f], high[f])
        self.feature[t, node], self.split[t, node] = f, cut
        left = x[:, f] < cut
        self._grow(rng, t, 2 * node + 1, level + 1, x[left])
        self._grow(rng, t, 2 * node + 2, level + 1, x[~left])

    def score(self, x: np.ndarray) -> np.ndarray:
        """2 ** -(mean path / its expectation): near 1 for rows that few splits isolate."""
        total, rows = np.zeros(len(x)), np.arange(len(x))
        for t in range(len(self.feature)):
            at = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                cut = self.split[t, at]
                inner = ~np.isnan(cut)
                below = 2 * at + 1 + (x[rows, self.feature[t, at]] >= cut)
                at = np.where(inner, below, at)
            total += self.length[t, at]
        return 2.0 ** (-total / len(self.feature) / max(self.norm, 1e-9))


def _average(n: int) -> float:
    return 0.0 if n < 2 else 2 * (np.log(n - 1) + np.euler_gamma) - 2 * (n - 1) / n if n > 2 else 1.0


def threshold(score: np.ndarray, good: np.ndarray, false_rejects: float = FALSE_REJECTS) -> float:
    """The score above which a row is rejected: the cut with the most bad rows caught less good rows lost, among those
    that lose at most ``false_rejects`` of the good rows.  Without both kinds of labels nothing is rejected."""
    cuts, at = np.unique(score, return_inverse=True)
    return counted_threshold(cuts, np.bincount(at[good], minlength=len(cuts)), np.bincount(at[~good], minlength=len(cuts)), false_rejects)


def counted_threshold(cuts: np.ndarray, good: np.ndarray, bad: np.ndarray, false_rejects: float = FALSE_REJECTS) -> float:
    """``threshold`` from the numbers of good and bad rows at each of the scores ``cuts`` (ascending)."""
    if not good.sum() or not bad.sum():
        return np.inf
    lost, caught = 1 - np.cumsum(good) / good.sum(), 1 - np.cumsum(bad) / bad.sum()
    gain = np.where(lost <= false_rejects, caught - lost, -1)
    i = int(np.argmax(gain))
    above = cuts[i + 1] if i + 1 < len(cuts) else cuts[i]
    return float((cuts[i] + above) / 2)


def base_failed():
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def quality_rules(docs: DataFrame, labels: DataFrame, trees: int = TREES, labelled_rows: int | None = None, false_rejects: float = FALSE_REJECTS) -> DataFrame:
    """doc_id, the five counts, base_failed, anomaly, kept for every row of ``docs`` (doc_id, text).

    A null or empty text has zero counts and fails the base rules.  Repeated rows and null doc_ids give a row each.
    Labels: doc_id, quality; rows with nulls are ignored, of an id with several labels the smallest counts; without
    labels of both kinds only the base rules decide.  Calibration leaves out rows with crc32(doc_id) mod 5 = 0 and takes
    all others, unless the caller bounds them by ``labelled_rows``.  An empty table gives no rows.
    """
    stats = written(rule_statistics(docs).withColumn("base_failed", base_failed()))
    usable = stats.where("not base_failed")
    known = labels.where("doc_id is not null and quality is not null").where(F.crc32(F.col("doc_id").cast("string")) % 5 != 0)
    known = known.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    if labelled_rows is not None:
        known = smallest(known, F.xxhash64("doc_id", F.lit(SEED + 1)), labelled_rows)
    # one row an id
    rows = written(usable.join(known, "doc_id").groupBy("doc_id").agg(F.min(F.struct("quality", *RATIOS)).alias("r")).select("r.*"))
    excess = Excess.of(rows.where("quality = 1"))
    # as many rows of the whole table as the trees take
    pick = smallest(usable, F.xxhash64("doc_id", F.lit(SEED)), trees * TREE_ROWS, *RATIOS).select(*RATIOS).toPandas()
    forest = Forest(excess(pick.to_numpy(np.float64)), trees)

    def score_labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.stack([b.column(c).to_numpy() for c in RATIOS], axis=1)
            good = b.column("quality").to_numpy(zero_copy_only=False) == 1
            yield pa.RecordBatch.from_arrays([pa.array(np.round(forest.score(excess(x)), SCORE_PLACES)), pa.array(good)], names=["score", "good"])

    counts = rows.mapInArrow(score_labelled, "score double, good boolean").groupBy("score").agg(F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("bad"))
    counts = counts.toPandas().sort_values("score")  # at most 10 ** SCORE_PLACES rows, whatever the table's size
    cut = counted_threshold(*(counts[c].to_numpy() for c in ("score", "good", "bad")), false_rejects)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.stack([b.column(c).to_numpy() for c in RATIOS], axis=1)
            score = forest.score(excess(x))
            failed = np.array(b.column("base_failed").to_pylist(), bool)
            columns = [b.column(c) for c in ["doc_id", *COUNTS, "base_failed"]]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(score), pa.array(~failed & (score <= cut))], names=["doc_id", *COUNTS, "base_failed", "anomaly", "kept"])

    schema = ", ".join(["doc_id long", *(f"{c} long" for c in COUNTS), "base_failed boolean, anomaly double, kept boolean"])
    return stats.mapInArrow(judge, schema)
