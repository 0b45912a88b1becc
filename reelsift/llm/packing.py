"""Mixture-controlled packing: every window of sequences holds the sources in their target proportions.

Each source is a queue of documents in hash order, cut into blocks of a few thousand tokens.  A partition takes, of
every queue, the blocks whose middle falls into its share, so what one partition takes too much the next takes less.
Inside a partition a deficit round-robin deals each window (``window`` sequences): every source earns its share, the
whole tokens of its deficit are taken, the rest is carried on.  Documents are cut freely, so sequences are full; the
last tokens of a partition form sequences of descending powers of two, without padding.
"""

from __future__ import annotations

import base64
import json
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelsift.llm.numbering import totals_before
from reelsift.llm.scratch import small_table, written
from reelsift.llm.textkit import slices

LENGTH = 1024
WINDOW = 32
PART_TOKENS = 2 << 20  # a partition's tokens, more only beyond MOST_PARTS partitions
MOST_PARTS = 50_000
BLOCK_TOKENS = 1 << 14
MOST_BLOCKS = 200_000
END = 0



def vocabulary() -> str:
    """Default place of the ranks: the same vocabulary as ``byte_bpe_50k.json``."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def added_tokens(path: str) -> dict[str, int]:
    """Added tokens of the vocabulary's JSON beside a ranks file, none without a JSON.  ``tokenizers`` finds them inside
    texts too."""
    beside = f"{os.path.splitext(path)[0]}.json"
    if not os.path.exists(beside):
        return {}
    with open(beside, encoding="utf-8") as f:
        added = json.load(f).get("added_tokens", [])
    for t in added:
        if any(t[k] for k in ("single_word", "lstrip", "rstrip", "normalized")) or sum(o["content"].startswith(t["content"]) for o in added) > 1:
            raise ValueError(f"added token {t['content']!r} of {beside} is not matched by its bytes alone")
    return {t["content"]: t["id"] for t in added}


def encoder(path: str | None = None):
    """Byte-level BPE of a ranks file, with its added tokens; its ids equal those of the same vocabulary's JSON (tested)."""
    import public_tokenizers
    import tiktoken

    # kept with the library, which stays loaded in a worker: this module's own state arrives anew with each task
    kept = tiktoken.__dict__.setdefault("_encodings_by_ranks_file", {})
    if path not in kept:
        place = path or vocabulary()
        with open(place, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        kept[path] = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=added_tokens(place))
    return kept[path]


def _tokens(path: str | None, end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for b in slices(batches, "text"):
            ids = [np.append(enc.encode_to_numpy(t or "", allowed_special="all"), np.uint32(end)) for t in b.column("text").to_pylist()]
            n = np.array([len(x) for x in ids], np.int64)
            raw = pa.array([x.astype("<u2" if enc.max_token_value < 65_536 else "<u4").tobytes() for x in ids], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("source"), pa.array(n), raw], names=["doc_id", "source", "n", "ids"])
            del ids, raw
        pa.default_memory_pool().release_unused()  # the worker lives on

    return run


def tokenized(docs: DataFrame, path: str | None = None, end: int = END) -> DataFrame:
    """doc_id, source, n, ids (little-endian, 2 bytes an id where the vocabulary allows)."""
    return docs.select("doc_id", "source", "text").mapInArrow(_tokens(path, end), "doc_id long, source string, n long, ids binary")


def deal(amounts: np.ndarray, window: int) -> Iterator[np.ndarray]:
    """Tokens of each source in each window.  Deficits (what a source has earned less what it got) carry on."""
    total, got = int(amounts.sum()), np.zeros(len(amounts), np.int64)
    done = 0
    while done < total:
        size = min(window, total - done)
        done += size
        deficit = amounts * (done / total) - got
        take = np.clip(np.floor(deficit).astype(np.int64), 0, amounts - got)
        for s in np.argsort(-(deficit - take), kind="stable"):  # whole tokens still missing: largest deficits first
            if take.sum() == size:
                break
            step = 1 if take.sum() < size else 0
            take[s] += min(step, int(amounts[s] - got[s] - take[s]))
        short = size - int(take.sum())
        for s in np.argsort(deficit, kind="stable") if short < 0 else np.argsort(-(amounts - got - take), kind="stable"):
            if not short:
                break
            step = max(short, -int(take[s])) if short < 0 else min(short, int(amounts[s] - got[s] - take[s]))
            take[s] += step
            short -= step
        got += take
        yield take


def tail(n: int, length: int) -> list[int]:
    """Sequence lengths for n tokens: full ones, then the powers of two of the rest, largest first."""
    return [length] * (n // length) + [1 << i for i in reversed(range(length.bit_length())) if n % length >> i & 1]


def _pack(length: int, window: int, with_ids: bool):
    def run(table: pa.Table) -> pa.Table:
        rows = table.sort_by([("h", "ascending"), ("doc_id", "ascending"), ("n", "ascending")])
        n = rows["n"].to_numpy()
        width = rows["ids"][0].as_buffer().size // int(n[0])
        raw = np.frombuffer(b"".join(x.as_buffer() for x in rows["ids"].combine_chunks()), f"<u{width}")
        at = np.concatenate([[0], np.cumsum(n)[:-1]])  # of each document in raw
        code = rows["source"].combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy()
        kinds = int(code.max()) + 1
        queue = [np.flatnonzero(code == s) for s in range(kinds)]
        ends = [np.cumsum(n[q]) for q in queue]
        amounts = np.array([e[-1] for e in ends], np.int64)
        got = np.zeros(kinds, np.int64)
        doc, start, size = [], [], []
        for w, take in enumerate(deal(amounts, window * length)):
            for s in np.roll(np.arange(kinds), -(w % kinds)):
                a, b = int(got[s]), int(got[s] + take[s])
                if a == b:
                    continue
                i, j = (int(x) for x in np.searchsorted(ends[s], [a, b - 1], "right"))
                begin = ends[s][i : j + 1] - n[queue[s][i : j + 1]]
                lo = np.maximum(a - begin, 0)
                doc.append(queue[s][i : j + 1])
                start.append(lo)
                size.append(np.minimum(b - begin, n[queue[s][i : j + 1]]) - lo)
            got += take
        doc, start, size = np.concatenate(doc), np.concatenate(start), np.concatenate(size)
        run_at = np.cumsum(size) - size
        lengths = np.array(tail(int(n.sum()), length), np.int64)
        seq_at = np.cumsum(lengths) - lengths
        cut = np.union1d(run_at, seq_at)
        piece = np.diff(np.append(cut, n.sum()))
        k, q = np.searchsorted(run_at, cut, "right") - 1, np.searchsorted(seq_at, cut, "right") - 1
        d, begin = doc[k], start[k] + cut - run_at[k]
        ids = [raw[a : a + m].astype("<u4").tobytes() for a, m in zip(at[d] + begin, piece, strict=True)]
        first = rows["first_sequence"][0].as_py()
        out = {
            "doc_id": rows["doc_id"].combine_chunks().take(pa.array(d)),
            "start": pa.array(begin),
            "length": pa.array(piece),
            "ids_crc32": pa.array([zlib.crc32(x) for x in ids], pa.int64()),
            "doc_tokens": pa.array(n[d]),
            "sequence_id": pa.array(q + first),
            "offset": pa.array(cut - seq_at[q]),
            "source": rows["source"].combine_chunks().take(pa.array(d)),
        }
        if with_ids:
            out["ids"] = pa.array(ids, pa.binary())
        return pa.table(out)

    return run


def packed(docs: DataFrame, path: str | None = None, length: int = LENGTH, window: int = WINDOW, end: int = END, with_ids: bool = False) -> DataFrame:
    """Pieces of all documents (doc_id, source, text): doc_id, start, length, ids_crc32, doc_tokens, sequence_id,
    offset, source, and the piece's ``ids`` (little-endian 32 bits) if asked for.

    A null or empty text is the one end id.  Null sources are a queue of their own.  Repeated rows are documents of
    their own (their pieces show the same doc_id).  Sequence ids begin at 0 without gaps; an empty table has no pieces.
    """
    tokens = written(tokenized(docs, path, end))
    per = written(tokens.groupBy("source").agg(F.sum("n").alias("total")))
    total = per.agg(F.coalesce(F.sum("total"), F.lit(0))).first()[0]
    parts = int(max(1, -(-total // max(PART_TOKENS, total // MOST_PARTS))))
    grain = max(BLOCK_TOKENS, total // MOST_BLOCKS)
    h = F.xxhash64("doc_id", F.lit(23))
    per = per.select(F.col("source").alias("s"), "total", F.greatest(F.lit(1), F.ceil(F.col("total") / F.lit(grain))).cast("long").alias("blocks"))
    per = F.broadcast(per) if per.count() <= 100_000 else per
    dealt = tokens.withColumn("h", h).join(per, F.col("source").eqNullSafe(F.col("s"))).withColumn("block", F.pmod("h", F.col("blocks")))
    block = dealt.groupBy("source", "block", "total").agg(F.sum("n").alias("w"))
    middle = F.col("at") + F.col("w") / 2
    block = written(totals_before(block, "source", "block", "w").withColumn("part", F.least(F.lit(parts - 1), F.floor(middle / F.col("total") * parts)).cast("int")))
    sums = sorted(block.groupBy("part").agg(F.sum("w").alias("w")).collect())  # MOST_PARTS rows at most
    first, starts = 0, []
    for r in sums:
        starts.append((r["part"], first))
        first += r["w"] // length + (r["w"] % length).bit_count()
    where = block.join(F.broadcast(small_table(docs.sparkSession, starts, "part int, first_sequence long")), "part")
    where = where.select(F.col("source").alias("s2"), F.col("block").alias("b2"), "part", "first_sequence")
    where = F.broadcast(where) if where.count() <= 2 * MOST_BLOCKS else where
    rows = dealt.join(where, F.col("source").eqNullSafe(F.col("s2")) & (F.col("block") == F.col("b2")))
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, source string" + ", ids binary" * with_ids
    rows = rows.select("doc_id", "source", "n", "ids", "h", "first_sequence", "part")
    return rows.groupBy("part").applyInArrow(_pack(length, window, with_ids), schema)
