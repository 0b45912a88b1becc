"""Cross-tokenizer alignment: groups of tokens of two vocabularies that cover the same bytes.

A fragment is what a byte range of a document knows of its alignment: the tokens that end in it, split at the places
where tokens of both kinds end into an open prefix, closed groups, and an open suffix.  Fragments of neighbouring ranges
compose (the left one's suffix and the right one's prefix become one more group, or stay open), and composing is
associative.  A short document is one range.  A long one is cut into ranges that different tasks tokenize, each from the
nearest place before it where no token can cross, and a tree of compositions over Spark tasks puts them together.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelsift.llm.scratch import written
from reelsift.llm.textkit import slices

LONG_BYTES = 1 << 16  # a longer text is cut into ranges
RANGE_BYTES = 1 << 15
FAN = 8  # fragments that one task composes at a level of the tree
BROADCAST_ROWS = 2_000_000  # counts of pairs that go to all tasks (16 bytes each); more are joined by a shuffle
B_BITS = 15  # of a B id in a pair; A's have the other 16 bits of an int


def vocabularies() -> tuple[str, str]:
    """Default places of A's ranks (the vocabulary of ``byte_bpe_50k.json``) and of B's model."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("piece_bpe_32k.model")


class Coders:
    """Both tokenizers, and each id's bytes."""

    def __init__(self, a_path: str, b_path: str):
        import public_tokenizers
        import sentencepiece
        import tiktoken

        with open(a_path, "rb") as f:
            ranks = {base64.b64decode(x): int(y) for x, y in (line.split() for line in f if line.strip())}
        self.a = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.a_bytes = [b""] * (max(ranks.values()) + 1)
        for x, i in ranks.items():
            self.a_bytes[i] = x
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        # no piece goes on with a space after another character: B's tokens never cross such a place
        self.b_splits_at_space = not any("▁" in p.lstrip("▁") for p in pieces)
        for size, bits in ((len(self.a_bytes), 31 - B_BITS), (len(self.b_bytes), B_BITS)):
            if size > 1 << bits:
                raise ValueError(f"{size} ids do not fit into {bits} bits of a pair")
        # an id's text within its group, and as the group's last of its kind
        self.a_text = [f"{i}," for i in range(len(self.a_bytes))], [f"{i}|" for i in range(len(self.a_bytes))]
        self.b_text = [f"{i}," for i in range(len(self.b_bytes))], [f"{i};" for i in range(len(self.b_bytes))]
        self.a_size = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_size = np.array([len(x) for x in self.b_bytes], np.int64)

    def tokens(self, text: str, start: int = 0) -> Tokens | None:
        """A's tokens of space + text and B's of text, None if either's bytes are not space + text.  ``start``: bytes
        before the text's space."""
        want = b" " + text.encode()
        a, b = self.a.encode_ordinary(" " + text), self.b.encode(text)
        if b"".join(map(self.a_bytes.__getitem__, a)) != want or b"".join(map(self.b_bytes.__getitem__, b)) != want:
            return None
        a, b = np.array(a, np.int64), np.array(b, np.int64)
        return Tokens(a, b, start + np.cumsum(self.a_size[a]), start + np.cumsum(self.b_size[b]))


def coders(paths: tuple[str, str]) -> Coders:
    import tiktoken

    # kept with the library, which stays loaded in a worker: this module's own state arrives anew with each task
    kept = tiktoken.__dict__.setdefault("_aligned_coders", {})
    if paths not in kept:
        kept[paths] = Coders(*paths)
    return kept[paths]


@dataclass
class Tokens:
    """Ids of both kinds with their ends, as byte offsets in space + text of the document."""

    a: np.ndarray
    b: np.ndarray
    a_end: np.ndarray
    b_end: np.ndarray

    def between(self, low: float, high: float) -> Tokens:
        """The tokens that end in (low, high]."""
        i, j = np.searchsorted(self.a_end, [low, high], "right")
        k, m = np.searchsorted(self.b_end, [low, high], "right")
        return Tokens(self.a[i:j], self.b[k:m], self.a_end[i:j], self.b_end[k:m])

    def __add__(self, other: Tokens) -> Tokens:
        return Tokens(*(np.concatenate([getattr(self, f), getattr(other, f)]) for f in FIELDS))


FIELDS = ("a", "b", "a_end", "b_end")
NONE = Tokens(*(np.zeros(0, np.int64),) * 4)


@dataclass
class Closed:
    """What is known of closed groups: their tokens, groups and links by number, their text (each group ends with ;), the
    linked ids (A id << B_BITS | B id) and how often each is linked."""

    n_a: int = 0
    n_b: int = 0
    groups: int = 0
    links: int = 0
    text: str = ""
    pairs: np.ndarray = field(default_factory=lambda: NONE.a)
    times: np.ndarray = field(default_factory=lambda: NONE.a)


def closed(t: Tokens, cuts: np.ndarray, both: Coders) -> Closed:
    """Groups of whole tokens that end at ``cuts``."""
    if not len(t.a):
        return Closed()
    # tokens whose byte ranges overlap share exactly one stretch between two ends
    ends = np.union1d(t.a_end, t.b_end)
    key = t.a[np.searchsorted(t.a_end, ends)] << B_BITS | t.b[np.searchsorted(t.b_end, ends)]
    pairs, times = np.unique(key, return_counts=True)
    ga, gb = np.searchsorted(cuts, t.a_end), np.searchsorted(cuts, t.b_end)
    # a token's place in the text: after all tokens of earlier groups, and in its own group A before B
    out = np.empty(len(ga) + len(gb), object)
    for ids, group, texts, before in ((t.a, ga, both.a_text, np.searchsorted(gb, ga, "left")), (t.b, gb, both.b_text, np.searchsorted(ga, gb, "right"))):
        last = np.append(group[1:] != group[:-1], True).tolist()
        out[np.arange(len(group)) + before] = [texts[z][i] for i, z in zip(ids.tolist(), last, strict=True)]
    return Closed(len(t.a), len(t.b), len(cuts), len(ends), "".join(out.tolist()), pairs, times)


def merged(parts: list[Closed]) -> Closed:
    parts = [p for p in parts if p.groups]
    if len(parts) < 2:
        return parts[0] if parts else Closed()
    pairs, back = np.unique(np.concatenate([p.pairs for p in parts]), return_inverse=True)
    times = np.bincount(back, np.concatenate([p.times for p in parts]), len(pairs)).astype(np.int64)
    return Closed(*(sum(getattr(p, f) for p in parts) for f in ("n_a", "n_b", "groups", "links")), "".join(p.text for p in parts), pairs, times)


@dataclass
class Fragment:
    """What a byte range knows.  Without a place where tokens of both kinds end (``cut``) all its tokens are the prefix.
    The document's beginning is such a place.  ``bad``: some tokens' bytes are not the text's, so the whole document
    counts as one without tokens."""

    prefix: Tokens
    middle: Closed
    suffix: Tokens
    cut: bool
    bad: bool = False


EMPTY = Fragment(NONE, Closed(), NONE, False)


def fragment(tokens: Tokens | None, low: int, high: int, both: Coders) -> Fragment:
    """The range (low, high] from tokens around it: a token belongs to the range that holds its end."""
    if tokens is None:
        return Fragment(NONE, Closed(), NONE, False, True)
    t = tokens.between(low, high)
    cuts = np.intersect1d(t.a_end, t.b_end, assume_unique=True)
    cuts = cuts if low else np.append(0, cuts)
    if not len(cuts):
        return Fragment(t, Closed(), NONE, False)
    return Fragment(t.between(-1, cuts[0]), closed(t.between(cuts[0], cuts[-1]), cuts[1:], both), t.between(cuts[-1], np.inf), True)


def compose(parts: list[Fragment], both: Coders) -> Fragment:
    """Neighbouring fragments, in order, as one; associative, with EMPTY as its unit."""
    prefix, open_, middle, cut = [NONE], [NONE], [], False
    for p in parts:
        if not p.cut:
            (open_ if cut else prefix).append(p.prefix)
            continue
        if cut:  # the group that both sides left open ends at p's first cut
            t = reduce(Tokens.__add__, [*open_, p.prefix])
            middle.append(closed(t, t.a_end[-1:], both))
        else:
            prefix.append(p.prefix)
        middle.append(p.middle)
        open_, cut = [p.suffix], True
    return Fragment(reduce(Tokens.__add__, prefix), merged(middle), reduce(Tokens.__add__, open_), cut, any(p.bad for p in parts))


_SAFE = re.compile(r"(?<=\S) (?=\S)")


def ranges(text: str, size: int, safe: bool = True) -> Iterator[tuple[int, int, int, str]]:
    """(number, low, high, start, piece): byte ranges of space + text of about ``size`` bytes each, and the text to
    tokenize for each: from the last safe place at or before ``low`` to the first at or after ``high``.  Neither
    tokenizer's tokens cross a space between two other characters."""
    whole = " " + text  # whose bytes the offsets count
    point = np.frombuffer(whole.encode("utf-32-le"), np.uint32)
    byte_at = np.concatenate([[0], np.cumsum(1 + (point >= 0x80) + (point >= 0x800) + (point >= 0x10000))])
    spots = np.array([0] + [m.start() + 1 for m in _SAFE.finditer(text)] * safe)
    spot_bytes, total = byte_at[spots], int(byte_at[-1])
    for n, low in enumerate(range(0, total, size)):
        high = min(total, low + size)
        first, after = int(np.searchsorted(spot_bytes, low, "right")) - 1, int(np.searchsorted(spot_bytes, high, "left"))
        end = spots[after] if after < len(spots) else len(whole)
        yield n, low, high, int(spot_bytes[first]), whole[spots[first] + 1 : end]


DOCS = "rid long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<int>, times array<int>"
_INTS, _LONGS = pa.list_(pa.int32()), pa.list_(pa.int64())


def _documents(rids: pa.Array, ids: pa.Array, found: list[Fragment]) -> pa.RecordBatch:
    """Rows of whole documents; one that is bad or empty has no tokens."""
    done = [Closed() if f.bad else f.middle for f in found]
    sha = [hashlib.sha256(d.text[:-1].encode()).hexdigest() if d.groups else "" for d in done]
    numbers = [pa.array([getattr(d, c) for d in done], pa.int64()) for c in ("n_a", "n_b", "groups", "links")]
    lists = [pa.array([getattr(d, c).astype(np.int32) for d in done], _INTS) for c in ("pairs", "times")]
    return pa.RecordBatch.from_arrays([rids, ids, *numbers, pa.array(sha, pa.string()), *lists], names=["rid", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"])


def _whole(paths: tuple[str, str]):
    """Documents that are one range."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = coders(paths)
        for b in slices(batches, "text", 1 << 19):
            texts = b.column("text").to_pylist()
            yield _documents(b.column("rid"), b.column("doc_id"), [fragment(both.tokens(t), 0, 1 << 40, both) if t else EMPTY for t in texts])

    return run


RANGES = "rid long, doc_id long, part long, low long, high long, start long, text string"


def _cut(size: int, paths: tuple[str, str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        safe = coders(paths).b_splits_at_space
        for b in slices(batches, "text", 1):
            rid, doc_id, text = b.column("rid")[0].as_py(), b.column("doc_id")[0].as_py(), b.column("text")[0].as_py()
            for part, low, high, start, piece in ranges(text, size, safe):
                columns = [[rid], [doc_id], [part], [low], [high], [start]]
                yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in columns), pa.array([piece], pa.string())], names=["rid", "doc_id", "part", "low", "high", "start", "text"])

    return run


_OPEN = [f"{side}_{f}" for side in ("prefix", "suffix") for f in FIELDS]
FRAGMENTS = "rid long, doc_id long, part long, cut boolean, bad boolean, n_a long, n_b long, n_groups long, links long, text string, pairs array<int>, times array<int>, " + ", ".join(
    f"{c} array<long>" for c in _OPEN
)


def _row(rid: int, doc_id: int | None, part: int, f: Fragment) -> pa.RecordBatch:
    m = f.middle
    columns = {
        "rid": pa.array([rid], pa.int64()), "doc_id": pa.array([doc_id], pa.int64()), "part": pa.array([part], pa.int64()), "cut": pa.array([f.cut]), "bad": pa.array([f.bad]),
        "n_a": pa.array([m.n_a], pa.int64()), "n_b": pa.array([m.n_b], pa.int64()), "n_groups": pa.array([m.groups], pa.int64()), "links": pa.array([m.links], pa.int64()), "text": pa.array([m.text]),
        "pairs": pa.array([m.pairs.astype(np.int32)], _INTS), "times": pa.array([m.times.astype(np.int32)], _INTS),
    } | {f"{side}_{c}": pa.array([getattr(getattr(f, side), c)], _LONGS) for side in ("prefix", "suffix") for c in FIELDS}
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def _read(t: pa.Table, i: int) -> Fragment:
    ints = lambda c: t[c][i].values.to_numpy().astype(np.int64)
    prefix, suffix = (Tokens(*(ints(f"{side}_{c}") for c in FIELDS)) for side in ("prefix", "suffix"))
    middle = Closed(*(t[c][i].as_py() for c in ("n_a", "n_b", "n_groups", "links", "text")), ints("pairs"), ints("times"))
    return Fragment(prefix, middle, suffix, t["cut"][i].as_py(), t["bad"][i].as_py())


def _fragments(paths: tuple[str, str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = coders(paths)
        for b in slices(batches, "text", 1):
            rid, doc_id, part, low, high, start, text = (b.column(c)[0].as_py() for c in ("rid", "doc_id", "part", "low", "high", "start", "text"))
            yield _row(rid, doc_id, part, fragment(both.tokens(text, start), low, high, both))

    return run


def _composed(paths: tuple[str, str]):
    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by("part")
        whole = compose([_read(t, i) for i in range(t.num_rows)], coders(paths))
        return pa.Table.from_batches([_row(t["rid"][0].as_py(), t["doc_id"][0].as_py(), t["part"][0].as_py() // FAN, whole)])

    return run


def _finished(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        t = pa.Table.from_batches([b])
        if t.num_rows:
            yield _documents(b.column("rid"), b.column("doc_id"), [_read(t, i) for i in range(t.num_rows)])


def long_documents(docs: DataFrame, paths: tuple[str, str], size: int = RANGE_BYTES) -> DataFrame:
    """Alignments of documents (rid, doc_id, text) by ranges of ``size`` bytes and a tree of compositions."""
    pieces = written(docs.mapInArrow(_cut(size, paths), RANGES))
    most = pieces.agg(F.coalesce(F.max("part"), F.lit(0))).first()[0]
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    level = pieces.repartition(parts, "rid", "part").mapInArrow(_fragments(paths), FRAGMENTS)
    while True:
        level = written(level.withColumn("_g", F.floor(F.col("part") / FAN))).groupBy("rid", "_g").applyInArrow(_composed(paths), FRAGMENTS)
        most //= FAN
        if not most:
            return level.mapInArrow(_finished, DOCS)


def aligned(docs: DataFrame, paths: tuple[str, str] | None = None, long_bytes: int = LONG_BYTES, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """rid, doc_id, n_a, n_b, n_groups, n_links, groups_sha256, and the linked ids with how often (pairs, times) of every
    row.  Written; ``rid`` tells rows of one doc_id apart."""
    paths = tuple(paths or vocabularies())
    rows = docs.select("doc_id", "text")
    long = F.coalesce(F.octet_length("text") > long_bytes, F.lit(False))
    short = rows.where(~long).withColumn("rid", F.monotonically_increasing_id()).mapInArrow(_whole(paths), DOCS)
    large = written(rows.where(long).withColumn("rid", -1 - F.monotonically_increasing_id()))
    return written(short.unionByName(long_documents(large, paths, range_bytes)) if large.take(1) else short)


def pair_counts(documents: DataFrame) -> DataFrame:
    """pair, n (documents that hold it linked), best (no pair of its A id has more)."""
    n = documents.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n"))
    n = written(n.withColumn("a", F.shiftright("pair", B_BITS)))
    top = n.groupBy("a").agg(F.max("n").alias("top"))
    return written(n.join(top, "a").select("pair", "n", (F.col("n") == F.col("top")).alias("best")))


def alignment(docs: DataFrame, paths: tuple[str, str] | None = None, long_bytes: int = LONG_BYTES, range_bytes: int = RANGE_BYTES, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256: one row for every row of ``docs``.

    Null and empty texts, and texts whose tokens' bytes are not space + text (a U+2581 in the text), have no tokens:
    zeros and ''.  Repeated rows count as documents of their own; an empty table gives no rows.  Texts of any length are
    aligned whole; a long text without a space between two other characters is tokenized whole by each of its ranges.
    """
    documents = aligned(docs, paths, long_bytes, range_bytes)
    counts = pair_counts(documents)
    if counts.count() <= broadcast_rows:
        counts = F.broadcast(counts)
    links = documents.select("rid", F.explode(F.arrays_zip("pairs", "times")).alias("z")).select("rid", F.col("z.pairs").alias("pair"), F.col("z.times").alias("times"))
    sums = links.join(counts, "pair").groupBy("rid").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("n") * F.col("times")).alias("count_sum"))
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    return documents.join(sums, "rid", "left").select("doc_id", "n_a", "n_b", "n_groups", "n_links", zero("n_best"), zero("count_sum"), "groups_sha256")
