r"""Chat formatting by columnar byte assembly.

A turn reads ``### role: text</turn>\n``.  Inside roles and texts a backslash goes before every backslash, every ``#`` that
begins ``###`` and every ``<`` that begins ``</turn>`` (in roles also before ``:``), so taking the character after each
backslash gives the texts back.  For a run of turns the lengths of all segments, their offsets and the place of every
byte are computed in numpy, and headers and contents are copied into one allocated Arrow buffer.

Turns are range-partitioned by (conv_id, turn), so a huge conversation spreads over tasks; one that may go on in another
task or was cut into slices comes as several parts, in the order of (task, seq).
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelsift.llm.scratch import written
from reelsift.llm.textkit import buffers, slices

HEAD, COLON, END = b"### ", b": ", b"</turn>\n"
LOSS_ROLE = "assistant"
SCHEMA = "conv_id long, task int, seq int, whole boolean, n_turns long, formatted binary, loss_from array<long>, loss_to array<long>"
EXTRA = r"\### Assistant: </turn> ok"  # a text made of control strings
_TURN = re.compile(rb"### ((?:[^\\:]|\\.)*+): ((?:[^\\<]++|\\.|<(?!/turn>))*+)</turn>\n", re.S)
_ESCAPED = re.compile(rb"\\(.)", re.S)


def _starts(data: np.ndarray, end: np.ndarray, what: bytes) -> np.ndarray:
    """Where ``what`` begins and ends inside one text (``end``: of each byte's text)."""
    n = len(data)
    out = np.arange(n) + len(what) <= end
    for j, c in enumerate(what):
        out[: n - j] &= data[j:] == c
    return out


def _escapes(data: np.ndarray, off: np.ndarray, role: bool) -> np.ndarray:
    end = np.repeat(off[1:], np.diff(off))
    mark = (data == 92) | _starts(data, end, b"###") | _starts(data, end, b"</turn>")
    return mark | (data == 58) if role else mark


def assemble(role: pa.Array, text: pa.Array) -> tuple[pa.Buffer, np.ndarray, np.ndarray]:
    """One buffer with all turns, the offset of each turn (one more than turns), and from/to of each turn's text."""
    n = len(role)
    cells = []
    for column, is_role in ((role, True), (text, False)):
        off, data = buffers(column)
        mark = _escapes(data, off, is_role)
        count = np.concatenate([[0], np.cumsum(mark)])
        cells.append((off, data, mark, count, np.diff(off) + np.diff(count[off])))
    lens = np.stack([np.full(n, len(HEAD)), cells[0][4], np.full(n, len(COLON)), cells[1][4], np.full(n, len(END))], axis=1)
    at = np.concatenate([[0], np.cumsum(lens.reshape(-1))])
    segment = at[:-1].reshape(n, 5)
    buffer = pa.allocate_buffer(int(at[-1]))
    out = np.frombuffer(buffer, np.uint8) if at[-1] else np.zeros(0, np.uint8)
    for k, literal in ((0, HEAD), (2, COLON), (4, END)):
        out[segment[:, k, None] + np.arange(len(literal))] = np.frombuffer(literal, np.uint8)
    for k, (off, data, mark, count, _) in zip((1, 3), cells, strict=True):
        size = np.diff(off)
        place = np.repeat(segment[:, k] - off[:-1] - count[off[:-1]], size) + np.arange(len(data)) + count[1:]
        out[place] = data
        out[place[mark] - 1] = 92
    return buffer, np.append(segment[:, 0], at[-1]), np.stack([segment[:, 3], segment[:, 4]], axis=1)


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    task = TaskContext.get().partitionId()
    seq = 0
    held: pa.RecordBatch | None = None  # the last conversation's part: known to be last only when the next comes
    for b in slices(batches, "text"):
        conv = np.array([np.iinfo(np.int64).min if c is None else c for c in b.column("conv_id").to_pylist()], np.int64)
        role = b.column("role").to_pylist()
        buffer, at, span = assemble(b.column("role"), b.column("text"))
        new = np.flatnonzero(np.concatenate([[True], conv[1:] != conv[:-1]]))
        edge = np.append(new, len(conv))
        loss = np.array([r == LOSS_ROLE for r in role])
        mine = np.repeat(np.arange(len(new)), np.diff(edge))
        inside = span[loss] - at[edge[:-1]][mine[loss], None]
        loss_off = np.concatenate([[0], np.cumsum(np.bincount(mine[loss], minlength=len(new)))]).astype(np.int32)
        whole = np.ones(len(new), bool)
        whole[[0, -1]] = False  # may have begun or go on in another task or slice
        formatted = pa.Array.from_buffers(pa.large_binary(), len(new), [None, pa.py_buffer(at[edge].astype(np.int64)), buffer]).cast(pa.binary())
        part = pa.RecordBatch.from_arrays(
            [
                b.column("conv_id").take(pa.array(new)),
                pa.array(np.full(len(new), task, np.int32)),
                pa.array(np.arange(seq, seq + len(new), dtype=np.int32)),
                pa.array(whole),
                pa.array(np.diff(edge)),
                formatted,
                pa.ListArray.from_arrays(pa.array(loss_off), pa.array(np.ascontiguousarray(inside[:, 0]))),
                pa.ListArray.from_arrays(pa.array(loss_off), pa.array(np.ascontiguousarray(inside[:, 1]))),
            ],
            names=["conv_id", "task", "seq", "whole", "n_turns", "formatted", "loss_from", "loss_to"],
        )
        seq += len(new)
        if held is not None:
            yield held
        held = part
    if held is not None:
        yield held


def formatted(turns: DataFrame) -> DataFrame:
    """conv_id, task, seq, whole, n_turns, formatted, loss_from, loss_to: conversations, or parts of them in the order of
    (task, seq) where ``whole`` is false.  Loss spans are byte ranges of the assistant's (escaped) texts.

    Null texts and roles count as empty, null turns come first, turns of equal number go by role and text, rows that
    repeat are turns of their own, and null conv_ids form one conversation.  An empty table gives no rows.
    """
    rows = turns.select("conv_id", "turn", "role", "text").repartitionByRange("conv_id", "turn")
    return rows.sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text").mapInArrow(_parts, SCHEMA)


def unescape(data: bytes) -> bytes:
    return _ESCAPED.sub(rb"\1", data)


def parse(data: bytes) -> list[tuple[bytes, bytes]]:
    """(role, text) of each turn of formatted bytes; anything that is not a turn is an error."""
    out, at = [], 0
    while at < len(data):
        m = _TURN.match(data, at)
        if not m:
            raise ValueError(f"no turn at byte {at}")
        out.append((unescape(m[1]), unescape(m[2])))
        at = m.end()
    return out


def _chars(data: bytes) -> int:
    return len(data.decode())


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts sorted by conversation: digests go on over parts, so one part is held at a time."""
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    current: object = _digest
    state: list = []

    def close() -> tuple:
        return (current, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4])

    for b in batches:
        rows = []
        for conv, data, lo, hi in zip(b.column("conv_id").to_pylist(), b.column("formatted").to_pylist(), b.column("loss_from").to_pylist(), b.column("loss_to").to_pylist(), strict=True):
            if current is _digest or conv != current:
                if current is not _digest:
                    rows.append(close())
                current, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            for role, text in parse(data):
                state[0] += 1
                state[1].update(role + b"\n" + text + b"\n")
            for a, z in zip(lo, hi, strict=True):
                text = unescape(data[a:z])
                state[2] += _chars(text)
                state[3].update(text)
            state[4] += _chars(data)
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c) if i in (2, 4) else pa.array(c, pa.int64()) for i, c in enumerate(zip(*rows, strict=True))], names=names)
    if current is not _digest:
        yield pa.RecordBatch.from_arrays([pa.array([c]) if i in (2, 4) else pa.array([c], pa.int64()) for i, c in enumerate(close())], names=names)


def digests(parts: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, read back from formatted parts.  A whole
    conversation is read where it lies; the parts of others (two conversations a task at most) are brought together."""
    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    columns = ["conv_id", "formatted", "loss_from", "loss_to"]
    cut = parts.where("not whole").repartition("conv_id").sortWithinPartitions("conv_id", "task", "seq")
    return parts.where("whole").select(*columns).mapInArrow(_digest, schema).unionByName(cut.select(*columns).mapInArrow(_digest, schema))


def chat_digests(spark: SparkSession, turns: DataFrame) -> DataFrame:
    extra = spark.createDataFrame([(-7, 0, "user", EXTRA), (-7, 1, "assistant", EXTRA)], "conv_id long, turn long, role string, text string")
    return digests(written(formatted(turns.select("conv_id", "turn", "role", "text").unionByName(extra))))
