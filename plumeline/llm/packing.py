"""Packing of tokenised documents into training sequences by vector bin packing.

Every piece of a document has a demand vector (tokens, one segment, loss-bearing tokens) and every sequence a
capacity vector. The dot-product heuristic fills one sequence at a time: among the pieces that fit in
every dimension it places the one with the largest dot product of its demand and the capacity that is left,
both as shares of the limits. When no piece fits whole, the largest is cut so that the sequence
ends full. Whole ``tokens``-sized runs of long documents are sequences of their own.

A sequence whose length is a power of two needs no padding. One that cannot be filled (segment or loss
limit met, or the last of a task) is closed at the largest power of two it holds and the rest goes back to the
pool, so padding does not occur at all unless ``segments`` or ``loss`` is smaller than a power of two allows.

Each task packs the texts it reads, in pools of ``pool`` pieces: memory is bounded by one batch of texts and one
pool, texts are not shuffled, and a lost task is simply run again. ``sequence_id`` is the task number
times 2^40 plus a counter.

Defined results: a null or empty text is the end id alone. Rows with null or repeated ids are packed like
all others. ``context_col`` (optional) names a text that precedes the document without bearing loss.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumeline.llm.runtime import with_package
from plumeline.llm.textkernels import slices
from plumeline.llm.tokens import encoder


@dataclass(frozen=True)
class Limits:
    tokens: int = 1024
    segments: int = 256
    loss: int = 1024


class Pool:
    """Pieces waiting for a place, and the sequences made of them."""

    def __init__(self, limits: Limits, emit):
        self.limits, self.emit, self.pieces = limits, emit, []

    def add(self, row, start: int, ids: np.ndarray, free: int) -> None:
        """``free``: leading ids of the piece that bear no loss."""
        size = self.limits.tokens
        at = 0
        while len(ids) - at >= size and min(max(free - at, 0), size) >= size - self.limits.loss:
            self.emit([(row, start + at, ids[at:at + size])])
            at += size
        if at < len(ids):
            for i in range(at, len(ids), size):
                part = ids[i:i + size]
                self.pieces.append((row, start + i, part.copy(), min(max(free - i, 0), len(part))))

    def pack(self, last: bool) -> None:
        """Fill sequences; unless ``last``, pieces are kept back while they cannot fill one more."""
        limits, pieces = self.limits, self.pieces
        cap = np.array([limits.tokens, limits.segments, limits.loss], np.float64)
        need = np.array([[len(p[2]), 1, len(p[2]) - p[3]] for p in pieces], np.float64).reshape(-1, 3)
        alive = np.ones(len(pieces), dtype=bool)
        share = need / cap
        total = need[:, 0].sum()
        while alive.any() and (last or total >= 2 * limits.tokens):
            left, chosen = cap.copy(), []
            while left[0] > 0 and left[1] > 0 and alive.any():
                fits = alive & (need <= left).all(axis=1)
                if fits.any():
                    i = int(np.argmax(np.where(fits, share @ (left / cap), -1.0)))
                    chosen.append(pieces[i])
                    left -= need[i]
                    alive[i] = False
                    continue
                i = int(np.argmax(np.where(alive, need[:, 0], -1.0)))
                row, start, ids, free = pieces[i]
                n = int(min(left[0], free + left[2], len(ids)))
                if n < 1:
                    break
                chosen.append((row, start, ids[:n], min(free, n)))
                left -= (n, 1, n - min(free, n))
                pieces[i] = (row, start + n, ids[n:], max(free - n, 0))
                need[i] = (len(ids) - n, 1, len(ids) - n - max(free - n, 0))
                share[i] = need[i] / cap
                alive[i] = need[i, 0] > 0
            used = int(limits.tokens - left[0])
            keep = used if left[0] <= 0 else 1 << (used.bit_length() - 1)
            over = used - keep
            while over:                                       # close at a power of two
                row, start, ids, free = chosen.pop()
                back = min(over, len(ids))
                over -= back
                if back < len(ids):
                    chosen.append((row, start, ids[:-back], min(free, len(ids) - back)))
                tail = (row, start + len(ids) - back, ids[len(ids) - back:], max(free - (len(ids) - back), 0))
                pieces.append(tail)
                size = np.array([[back, 1, back - tail[3]]], np.float64)
                need, share = np.vstack([need, size]), np.vstack([share, size / cap])
                alive = np.append(alive, True)
            total -= keep
            self.emit([p[:3] for p in chosen])
        self.pieces = [p for p, a in zip(pieces, alive.tolist()) if a]


def _pack(batches, path: str, end_id: int, limits: Limits, pool: int, with_ids: bool, context: bool) -> Iterator[pa.RecordBatch]:
    """(id, text[, context]) -> pieces."""
    task = TaskContext.get()
    base = (task.partitionId() if task else 0) << 40
    made = 0
    out: list[tuple] = []

    def emit(sequence) -> None:
        nonlocal made
        at = 0
        for (doc, total), start, ids in sequence:
            raw = np.ascontiguousarray(ids, "<u4")
            out.append((doc, start, len(raw), zlib.crc32(raw), total, base + made, at, raw if with_ids else None))
            at += len(raw)
        made += 1

    def rows(id_type) -> pa.RecordBatch:
        columns = list(zip(*out))
        out.clear()
        arrays = [pa.array(columns[0], id_type)] + [pa.array(c, pa.int64()) for c in columns[1:7]]
        names = ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
        if with_ids:
            cuts = np.concatenate([[0], np.cumsum(columns[2])]).astype(np.int32)
            arrays.append(pa.ListArray.from_arrays(pa.array(cuts), pa.array(np.concatenate(columns[7]).astype(np.int32))))
            names.append("ids")
        return pa.RecordBatch.from_arrays(arrays, names)

    library, waiting, id_type = encoder(path), Pool(limits, emit), pa.int64()
    for batch in slices(batches, 1, 1 << 21):
        id_type = batch.column(0).type
        texts = [t or "" for t in batch.column(1).to_pylist()]
        ids, cuts = library.encode(texts)
        before = library.encode([t or "" for t in batch.column(2).to_pylist()]) if context else None
        for r, doc in enumerate(batch.column(0).to_pylist()):
            lead = before[0][before[1][r]:before[1][r + 1]] if context else ids[:0]
            whole = np.concatenate([lead, ids[cuts[r]:cuts[r + 1]], np.array([end_id], np.uint32)])
            waiting.add((doc, len(whole)), 0, whole, len(lead))
            if len(waiting.pieces) >= pool:
                waiting.pack(last=False)
        if out:
            yield rows(id_type)
    waiting.pack(last=True)
    if out:
        yield rows(id_type)


def pack_documents(docs: DataFrame, tokenizer: str, *, id_col: str = "doc_id", text_col: str = "text", end_id: int = 0,
                   limits: Limits = Limits(), pool: int = 2048, with_ids: bool = True, context_col: str | None = None) -> DataFrame:
    """Pieces (id, start, length, ids_crc32, doc_tokens, sequence_id, offset[, ids]) of all documents."""
    with_package(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                       *([F.col(context_col).alias("context")] if context_col else []))
    longs = [T.StructField(n, T.LongType()) for n in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")]
    ids = [T.StructField("ids", T.ArrayType(T.IntegerType()))] if with_ids else []
    schema = T.StructType([rows.schema["id"], *longs, *ids])
    return rows.mapInArrow(lambda it: _pack(it, tokenizer, end_id, limits, pool, with_ids, context_col is not None), schema)
