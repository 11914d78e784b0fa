"""Sum-of-squares packing of tokenized documents into equal windows.

A document is cut into whole windows and one rest. Rests are placed online: of
all fill levels that have room (and the empty window), take the one after which
the sum over levels of (number of windows at that level) squared is smallest.
The counts live in one array indexed by level. Windows still less full than
``min_fill`` at the end of a group are emptied and their rests laid end to end,
cut where a window is full.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, stored, text_or_empty, vocabulary
from .tokens import encoder

WINDOW = 1024
# Documents whose rests are packed together: bounds the memory of a task.
GROUP_DOCS = 4_096
MIN_FILL = 0.99
PIECE = "piece_id bigint, doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint"
PACKED = "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint"


def place(lengths: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Window number and offset of each length (1 to ``window`` - 1), placed in
    the given order, and the final fill of every window. Ties go to the
    emptiest level."""
    counts = np.zeros(window + 1, np.int64)  # windows by fill level
    open_at: list[list[int]] = [[] for _ in range(window + 1)]
    where, offset, fill = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64), []
    for i, size in enumerate(lengths.tolist()):
        top = window - size
        # change of the sum of squares, level by level
        cost = 2 * (counts[size:] - counts[:top + 1]) + 2
        cost[top] = 1 - 2 * counts[top]  # a full window is counted no more
        cost[counts[:top + 1] == 0] = np.iinfo(np.int64).max
        cost[0] = 2 * counts[size] + 1  # a new window
        level = int(np.argmin(cost))
        if level:
            counts[level] -= 1
            w = open_at[level].pop()
        else:
            w = len(fill)
            fill.append(0)
        where[i], offset[i], fill[w] = w, level, level + size
        if level + size < window:
            counts[level + size] += 1
            open_at[level + size].append(w)
    return where, offset, np.array(fill, np.int64)


def pack_rests(lengths: np.ndarray, window: int = WINDOW, min_fill: float = MIN_FILL) -> list[tuple[int, int, int, int, int]]:
    """(row, first id, length, window number, offset) of every final piece."""
    where, offset, fill = place(lengths, window)
    keep = fill >= min_fill * window
    number = np.cumsum(keep) - 1
    out, at, free = [], 0, int(keep.sum())
    for i, size in enumerate(lengths.tolist()):
        if keep[where[i]]:
            out.append((i, 0, size, int(number[where[i]]), int(offset[i])))
            continue
        first = 0
        while first < size:
            n = min(size - first, window - at % window)
            out.append((i, first, n, free + at // window, at % window))
            first, at = first + n, at + n
    return out


def cut_documents(docs: DataFrame, vocab_path: str | None = None, end_id: int = 0, window: int = WINDOW) -> DataFrame:
    """Each text's ids and the end id, cut at every ``window`` ids: pieces with
    a ``piece_id`` of their own. Null and empty texts are the end id alone."""
    vocab = vocab_path or vocabulary("byte_bpe_50k.json")
    schema = pa.schema([("piece_id", pa.int64()), ("doc_id", pa.int64()), ("start", pa.int64()),
                        ("length", pa.int64()), ("ids", pa.binary()), ("doc_tokens", pa.int64())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, n = encoder(vocab), TaskContext.get().partitionId() << 40
        end = np.array([end_id], "<u4").tobytes()
        for b in slices(batches):
            rows, size = [], 0
            for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
                ids = enc.encode_bytes(text) + end
                for start in range(0, len(ids) // 4, window):
                    piece = ids[4 * start:4 * (start + window)]
                    rows.append((n, doc_id, start, len(piece) // 4, piece, len(ids) // 4))
                    n, size = n + 1, size + len(piece) // 4
                if size >= 1 << 20:  # ids in a batch
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                    rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    kept = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text"))
    return kept.mapInArrow(cut, PIECE)


def pack_documents(docs: DataFrame, vocab_path: str | None = None, end_id: int = 0, window: int = WINDOW,
                   group_docs: int = GROUP_DOCS, min_fill: float = MIN_FILL) -> DataFrame:
    """All ids of ``docs`` in sequences of at most ``window``: per piece its
    document, place there, ids (little-endian unsigned 32-bit), ``sequence_id``
    and ``offset``.

    Texts are tokenized once into a stored table. Whole windows are sequences
    as they are; rests are dealt by hash into groups of about ``group_docs``,
    so a task's memory is bounded and a group's placement depends on nothing
    else. Repeated rows and equal doc_ids are packed as separate documents,
    null doc_ids too; an empty table gives no rows; other columns are ignored.
    """
    pieces = stored(cut_documents(docs, vocab_path, end_id, window), "pieces")
    rests = pieces.where(F.col("length") < window)
    groups = max(1, -(-rests.count() // group_docs))

    def pack(key: tuple, rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("piece_id").combine_chunks()
        done = pack_rests(rows["length"].to_numpy(), window, min_fill)
        row, first, length, number, offset = (np.array(x, np.int64) for x in zip(*done))
        taken, ids = rows.drop_columns("ids").take(row), rows["ids"].to_pylist()
        return pa.table({
            "doc_id": taken["doc_id"], "start": taken["start"].to_numpy() + first, "length": length,
            "ids": pa.array([ids[r][4 * f:4 * (f + n)] for r, f, n in zip(row, first, length)], pa.binary()),
            "doc_tokens": taken["doc_tokens"], "sequence_id": 2 * ((key[0].as_py() << 40) + number) + 1,
            "offset": offset})

    packed = rests.groupBy(F.pmod(F.xxhash64("piece_id"), F.lit(groups)).alias("group")).applyInArrow(pack, PACKED)
    whole = pieces.where(F.col("length") == window).select(
        "doc_id", "start", "length", "ids", "doc_tokens", (F.col("piece_id") * 2).alias("sequence_id"),
        F.lit(0).cast("bigint").alias("offset"))
    return whole.unionByName(packed)
