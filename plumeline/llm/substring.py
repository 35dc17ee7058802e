"""Substring dedup by fixed-block anchors.

A window is ``window`` consecutive words of one document; a window whose word sequence also starts in
a document with a smaller id is a repeat and all its words are removed. Windows are judged on the
input texts.

1. Index and probe. With blocks of ``(window + 1) // 2`` words every window contains one whole
   non-overlapping reference block of its document. Each map task hashes every rolling block-sized
   window of its texts; those that start at a multiple of the block length are the reference index.
   Hashes go, packed, to hash buckets, where rolling windows meet the reference blocks of other texts.
2. Extend. Around each hit the windows of full length that contain it are hashed with 80 bits: 64 of one window
   hash and 16 of another. A window is repeated if a document with a smaller id has the same one;
   overlapping repeated windows join to maximal exact repeats. Words are hashed by a kernel whose values are drawn
   for each call, and by a seeded library hash beyond 64 bytes, so no text can be written to collide; windows of
   different words are taken for equal with a chance of about n^2 / 2^81 over n windows around hits.
3. Remove. The covered words are cut from the text.

Before each shuffle a task keeps one entry per hash for a run of texts and answers the others itself,
so a passage that occurs in a third of all documents is sent once per run, not once per
document (once per text if these documents share one id that no smaller one of the run precedes). The entries
answered in a run go as a whole to one of as many groups as there are buckets, evenly over all runs. Texts are shuffled once, by a document key, and read again for steps 2 and 3.
At cluster scale ``bucket_words`` sets a bucket's memory (about 60 bytes a word) and ``slice_bytes`` the
texts a task packs together; buckets per slice should stay well below its number of words.

Defined results: null text has no words and stays null; texts with fewer words than a window are
never changed. A null id counts as larger than all others. Rows with equal ids are one document: they
never remove each other's words. Extra columns of ``docs`` pass through unchanged.
"""

from __future__ import annotations

import itertools
import secrets
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumeline.llm.runtime import shuffle_partitions, text_bytes, with_package
from plumeline.llm.textkernels import (SPACE_WORDS, byte_values, gaps, pack, release_memory, rows_of, slices, span_hashes, string_buffers, ungaps,
                                       unpack, window_hashes, window_starts, word_spans)

NO_ID = (1 << 63) - 1
_KEY = (1 << 48) - 1


def _words(column: pa.Array, seed: int):
    data, offsets = string_buffers(column)
    starts, ends, first = word_spans(data, offsets, SPACE_WORDS)
    return data, offsets, starts, ends, first, span_hashes(data, starts, ends, _values(seed))


@lru_cache(4)
def _values(seed: int) -> np.ndarray:
    return byte_values(seed)


def _grouped(hashes: np.ndarray, more: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """(order, changes): entries sorted by hash and ``more`` bits, and where a new value starts (but the first)."""
    order = np.argsort(hashes, kind="stable")
    h = hashes[order]
    changes = h[1:] != h[:-1]
    if more is not None:
        m = more[order]
        if (~changes & (m[1:] != m[:-1])).any():
            order = np.lexsort((more, hashes))
            h, m = hashes[order], more[order]
            changes = (h[1:] != h[:-1]) | (m[1:] != m[:-1])
    return order, changes


def _binaries(values: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """One binary of int32 values per run ``cuts[i]:cuts[i + 1]``."""
    raw = np.ascontiguousarray(values, dtype=np.int32)
    return pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [None, pa.py_buffer((cuts * 4).astype(np.int32)), pa.py_buffer(raw)])


def _by_text(rows: np.ndarray) -> np.ndarray:
    """Cut points of runs of equal values (ascending rows)."""
    if not len(rows):
        return np.zeros(1, np.int64)
    return np.concatenate([[0], np.flatnonzero(np.diff(rows)) + 1, [len(rows)]])


def _packs(hashes, at, rows, first, keys, ids, flags, n_buckets: int, seq: int, more=None) -> Iterator[tuple[int, bytes]]:
    """Binary packs of one slice: an entry per hash for the buckets, and the entries answered here.

    ``at`` ascending word positions, ``rows`` their texts, ``flags`` (reference block?) or None; ``more`` bits beside the hash.
    With flags an entry is answered here if two texts of the slice share its hash; without, if a
    text with a smaller id does. Texts that tie for the smallest id are all sent, one entry for each key.
    ``seq`` sets the group of the entries answered here.
    """
    order, changes = _grouped(hashes, more)
    sorted_h = hashes[order]
    lead = np.flatnonzero(np.concatenate([[True], changes])) if len(order) else np.zeros(0, np.int64)
    size = np.diff(np.concatenate([lead, [len(order)]]))
    ident = ids[rows[order]]
    least = np.minimum.reduceat(ident, lead) if len(lead) else lead
    if flags is None:
        done = ident > np.repeat(least, size)
        tied = np.flatnonzero(~done)                                          # the texts that have the smallest id
        group = np.repeat(np.arange(len(lead)), size)
        tied = tied[np.lexsort((order[tied], keys[rows[order[tied]]], group[tied]))]
        own, key = group[tied], keys[rows[order[tied]]]
        tied = tied[np.concatenate([[True], (own[1:] != own[:-1]) | (key[1:] != key[:-1])])] if len(tied) else tied
        rep, value = order[tied], sorted_h[tied]
    else:
        text = rows[order]
        several = (np.minimum.reduceat(text, lead) < np.maximum.reduceat(text, lead)) if len(lead) else lead > 0
        done = np.repeat(several, size)
        rep, value = np.minimum.reduceat(order, lead) if len(lead) else lead, sorted_h[lead]
        flag = np.logical_or.reduceat(flags[order], lead) if len(lead) else lead > 0
    solved = np.sort(order[done])
    if len(solved):
        r = rows[solved]
        cuts = _by_text(r)
        texts = r[cuts[:-1]]
        yield -1 - seq % n_buckets, pack(keys[texts], ids[texts], np.diff(cuts), (at[solved] - first[r]).astype(np.int32))
    if not len(rep):
        return
    by_place = np.argsort(rep, kind="stable")
    rep, value = rep[by_place], value[by_place]
    bucket = ((value >> np.uint64(32)) % np.uint64(n_buckets)).astype(np.int64)
    turn = np.argsort(bucket, kind="stable")
    edges = np.searchsorted(bucket[turn], np.arange(n_buckets + 1))
    for b in np.flatnonzero(np.diff(edges)).tolist():
        own = turn[edges[b]:edges[b + 1]]
        place, h = rep[own], value[own]
        r = rows[place]
        cuts = _by_text(r)
        texts = r[cuts[:-1]]
        head = (keys[texts], np.diff(cuts).astype(np.uint16 if len(own) < 1 << 16 else np.uint32), gaps(first[texts]), gaps(at[place]))
        if flags is None:
            yield b, pack(*head, ids[texts], h, more[place])
        else:
            yield b, pack(*(x.astype(np.uint64) if i == 0 else x for i, x in enumerate(head)),
                          (h & np.uint64(0xFFFFFFFF)).astype(np.uint32), np.packbits(flag[by_place][own]))


def _table(found: list[tuple[int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([b for b, _ in found], pa.int32()), pa.array([p for _, p in found], pa.binary())],
                                      ["bucket", "payload"])


def _key_and_id(batch: pa.RecordBatch, key_at: int, id_at: int) -> tuple[np.ndarray, np.ndarray]:
    return batch.column(key_at).to_numpy(), batch.column(id_at).cast(pa.int64()).fill_null(NO_ID).to_numpy()


def _turns() -> Iterator[int]:
    """A number for each slice, spread evenly over the slices of all tasks (the same when a task runs again)."""
    context = TaskContext.get()
    task = context.partitionId() if context else 0
    for i in itertools.count():
        yield ((task * 0x9E3779B97F4A7C15 + i * 0xD1B54A32D192ED03) & ((1 << 64) - 1)) >> 33


def _probe(batches, window: int, block: int, n_buckets: int, slice_bytes: int, seed: int) -> Iterator[pa.RecordBatch]:
    """(key, id, text) -> packs of rolling block windows."""
    for seq, batch in zip(_turns(), slices(batches, 2, slice_bytes)):
        keys, ids = _key_and_id(batch, 0, 1)
        *_, first, words = _words(batch.column(2), seed)
        h = window_hashes(words, block)
        rows = rows_of(first)
        use = window_starts(first, block) & (np.diff(first) >= window)[rows]
        at = np.flatnonzero(use)
        if len(at):
            rows = rows[at]
            flags = (at - first[rows]) % block == 0
            yield _table(list(_packs(h[at], at, rows, first, keys, ids, flags, n_buckets, seq)))


def _replies(keys: np.ndarray, ids: np.ndarray, counts: np.ndarray, pos: np.ndarray, n_parts: int) -> pa.Table:
    """Positions per text, packed for the part of the texts that holds its key."""
    part = keys % n_parts
    order = np.argsort(part, kind="stable")
    cuts = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
    edges = np.searchsorted(part[order], np.arange(n_parts + 1))
    out: list[tuple[int, bytes]] = []
    for b in np.flatnonzero(np.diff(edges)).tolist():
        texts = np.sort(order[edges[b]:edges[b + 1]])
        n = (cuts[texts + 1] - cuts[texts])
        at = np.repeat(cuts[texts], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        out.append((b, pack(keys[texts], ids[texts], n.astype(np.uint32), pos[at].astype(np.int32))))
    return pa.Table.from_batches([_table(out)])


def _gather(found: pa.Table) -> pa.Table:
    """One part: all positions of each text, as (key, array of (id, positions))."""
    keys, ids, counts, pos = (np.concatenate(x) for x in zip(*(unpack(p) for p in found.column("payload").to_pylist())))
    order = np.lexsort((ids, keys))
    cuts = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
    k, i, n = keys[order], ids[order], counts[order].astype(np.int64)
    at = np.repeat(cuts[order], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    same_id = np.concatenate([[True], (k[1:] != k[:-1]) | (i[1:] != i[:-1])])
    texts = np.flatnonzero(same_id)                           # one run of positions per key and id
    ends = np.concatenate([[0], np.cumsum(n)])
    runs = _binaries(pos[at], np.append(ends[texts], ends[-1]))
    lead = np.flatnonzero(np.concatenate([[True], k[texts][1:] != k[texts][:-1]]))
    items = pa.StructArray.from_arrays([pa.array(i[texts]), runs], ["id", "pos"])
    lists = pa.ListArray.from_arrays(pa.array(np.append(lead, len(texts)).astype(np.int32)), items)
    return pa.table({"key": pa.array(k[texts][lead]), "found": lists})


def _entries(payloads):
    """Entries of all packs of a bucket: (keys, ids or None) per text, and per entry text, position, values, flags or more."""
    keys, ids, text, pos, values, flags, more, n_texts = [], [], [], [], [], [], [], 0
    for p in payloads:
        k, count, base, at, *rest = unpack(p)
        t = np.repeat(np.arange(len(k)), count)
        keys.append(k.astype(np.int64))
        pos.append((ungaps(at) - ungaps(base)[t]).astype(np.int32))
        text.append((t + n_texts).astype(np.int32))
        n_texts += len(k)
        if rest[0].dtype == np.uint32:
            values.append(rest[0])
            flags.append(np.unpackbits(rest[1], count=len(at)).astype(bool))
        else:
            ids.append(rest[0])
            values.append(rest[1])
            more.append(rest[2])
    cat = lambda x: np.concatenate(x) if x else None
    return cat(keys), cat(ids), cat(text), cat(pos), cat(values), cat(flags), cat(more)


def _meet(found: pa.Table, n_parts: int) -> pa.Table:
    """One bucket: the positions of the entries that repeat, packed by part of the texts."""
    payloads = found.column("payload").to_pylist()
    if found.column("bucket")[0].as_py() < 0:
        return _replies(*(np.concatenate(x) for x in zip(*(unpack(p) for p in payloads))), n_parts)
    keys, ids, text, pos, values, flags, more = _entries(payloads)
    del payloads
    order, changes = _grouped(values, more)
    lead = np.flatnonzero(np.concatenate([[True], changes]))
    size = np.diff(np.concatenate([lead, [len(order)]]))
    if flags is not None:                                     # probes and blocks of two slices or more
        ids = np.zeros(len(keys), np.int64)
        hit = np.repeat((size > 1) & np.logical_or.reduceat(flags[order], lead), size)
    else:
        ident = ids[text[order]]
        hit = ident > np.repeat(np.minimum.reduceat(ident, lead), size)
    chosen = np.sort(order[hit])
    cuts = _by_text(text[chosen])
    texts = text[chosen][cuts[:-1]] if len(chosen) else np.zeros(0, np.int64)
    replies = _replies(keys[texts], ids[texts], np.diff(cuts), pos[chosen], n_parts)
    del order, changes, lead, size, hit, text, pos, values, flags, more
    release_memory()
    return replies


def _positions(value) -> np.ndarray:
    return np.concatenate([np.frombuffer(x, np.int32) for x in value]).astype(np.int64)


def _extend(batches, id_at: int, text_at: int, n_columns: int, window: int, block: int, n_buckets: int,
            slice_bytes: int, seed: int) -> Iterator[pa.RecordBatch]:
    """(columns, key, hits) -> packs of the full windows around hits."""
    for seq, batch in zip(_turns(), slices(batches, text_at, slice_bytes)):
        keys, ids = _key_and_id(batch, n_columns, id_at)
        *_, first, words = _words(batch.column(text_at), seed)
        short, whole = window_hashes(words, block), window_hashes(words, window, seed=1)
        more = (window_hashes(words, window, seed=2) >> np.uint64(48)).astype(np.uint16)
        step, hits = np.zeros(len(words) + window + 1, np.int64), batch.column(n_columns + 1).to_pylist()
        for r, value in enumerate(hits):
            lo, n = int(first[r]), int(first[r + 1] - first[r])
            p = _positions([x["pos"] for x in value])
            own = short[lo:lo + max(n - block + 1, 0)]
            p = np.flatnonzero(np.isin(own, own[p[p < len(own)]]))        # the same block elsewhere in the text
            a, b = np.maximum(p - (window - block), 0), np.minimum(p, n - window)
            ok = a <= b
            np.add.at(step, lo + a[ok], 1)
            np.add.at(step, lo + b[ok] + 1, -1)
        at = np.flatnonzero(np.cumsum(step)[:len(words)] > 0)
        if len(at):
            yield _table(list(_packs(whole[at], at, rows_of(first)[at], first, keys, ids, None, n_buckets, seq, more[at])))


def _cut(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, gone: np.ndarray) -> bytes:
    """The text without the words in ``gone``; white space between kept words stays where it can."""
    if gone.all():
        return b""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]])))
    parts, at = [], 0
    for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()):
        if b < len(gone):
            parts.append(data[at:starts[a]].tobytes())
            at = int(starts[b])
        else:
            parts.append(data[at:ends[a - 1]].tobytes())
            at = len(data)
    return b"".join([*parts, data[at:].tobytes()])


def _remove(batches, id_at: int, text_at: int, n_columns: int, window: int, seed: int) -> Iterator[pa.RecordBatch]:
    """(columns, key, repeats) -> columns with the new text, n_words, n_removed, removed spans."""
    for batch in slices(batches, text_at):
        column = batch.column(text_at)
        data, offsets, starts, ends, first, words = _words(column, seed)
        repeats = batch.column(n_columns + 1).to_pylist()
        _, ids = _key_and_id(batch, n_columns, id_at)
        n, removed = np.diff(first), np.zeros(batch.num_rows, np.int64)
        spans_a, spans_b, texts = [[] for _ in repeats], [[] for _ in repeats], None
        for r, value in enumerate(repeats):
            own = [x["pos"] for x in value or () if x["id"] == ids[r]]
            if not own:
                continue
            lo, hi = int(first[r]), int(first[r + 1])
            h, p = window_hashes(words[lo:hi], window, seed=1), _positions(own)
            p = np.flatnonzero(np.isin(h, h[p]))
            step = np.zeros(hi - lo + 1, np.int64)
            step[p] += 1
            np.add.at(step, p + window, -1)
            gone = np.cumsum(step)[:-1] > 0
            removed[r] = gone.sum()
            edge = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]])))
            spans_a[r], spans_b[r] = edge[::2].tolist(), edge[1::2].tolist()
            texts = texts if texts is not None else column.to_pylist()
            a = int(offsets[r])
            texts[r] = _cut(data[a:int(offsets[r + 1])], starts[lo:hi] - a, ends[lo:hi] - a, gone).decode()
        columns = [batch.column(i) for i in range(n_columns)]
        if texts is not None:
            columns[text_at] = pa.array(texts, pa.string())
        extra = [pa.array(n, pa.int64()), pa.array(removed), pa.array(spans_a, pa.list_(pa.int64())), pa.array(spans_b, pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns + extra, [f"c{i}" for i in range(n_columns)] + ["n_words", "n_removed", "span_starts", "span_ends"])


def remove_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", window: int = 13,
                   bucket_words: int = 3_000_000, slice_bytes: int = 4 << 20, part_bytes: int = 128 << 20) -> DataFrame:
    """``docs`` with repeated passages cut from the text, and a struct ``repeats``.

    ``repeats`` holds n_words and n_removed of the input text and the removed word spans.
    """
    spark = with_package(docs.sparkSession)
    block, columns, seed = (window + 1) // 2, docs.columns, secrets.randbits(62)
    rows = docs.toDF(*[f"c{i}" for i in range(len(columns))])
    id_at, text_at = columns.index(id_col), columns.index(text_col)
    n_bytes = text_bytes(docs, text_col)
    n_buckets = max(-(-n_bytes // (6 * bucket_words)), shuffle_partitions(spark), 1)
    n_parts = max(-(-n_bytes // (24 * bucket_words)), shuffle_partitions(spark), 1)    # an answer takes a quarter of a bucket's entry
    fields = list(rows.schema.fields)
    doc_id, text = F.col(f"c{id_at}"), F.col(f"c{text_at}")
    rows = rows.withColumn("key", F.xxhash64(F.coalesce(doc_id.cast("long"), F.lit(NO_ID)), text).bitwiseAND(F.lit(_KEY)))
    placed = rows.repartition(max(-(-n_bytes // part_bytes), shuffle_partitions(spark)), "key")
    inner = [f"c{i}" for i in range(len(columns))]

    packs, found = "bucket int, payload binary", "key long, found array<struct<id:long,pos:binary>>"

    def answers(entries: DataFrame) -> DataFrame:
        replies = entries.groupBy("bucket").applyInArrow(lambda t: _meet(t, n_parts), packs)
        return replies.groupBy("bucket").applyInArrow(_gather, found)

    probes = rows.select("key", doc_id.alias("id"), text.alias("text")).mapInArrow(
        lambda it: _probe(it, window, block, n_buckets, slice_bytes, seed), packs)
    # Both joins read all columns of ``placed``, so that its one shuffle serves both.
    near = placed.join(answers(probes), "key").select(*inner, "key", "found")
    windows = near.mapInArrow(lambda it: _extend(it, id_at, text_at, len(inner), window, block, n_buckets, slice_bytes, seed), packs)
    joined = placed.join(answers(windows), "key", "left").select(*inner, "key", "found")
    longs = T.ArrayType(T.LongType())
    out = T.StructType(fields + [T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()),
                                 T.StructField("span_starts", longs), T.StructField("span_ends", longs)])
    done = joined.mapInArrow(lambda it: _remove(it, id_at, text_at, len(columns), window, seed), out)
    return done.select(*[F.col(c).alias(name) for c, name in zip(inner, columns)],
                       F.struct("n_words", "n_removed", "span_starts", "span_ends").alias("repeats"))


def cut_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length_col: str | None = "n_chars",
                **options) -> DataFrame:
    """``docs`` with repeated passages cut, columns as they were; ``length_col`` (if there) follows the new text."""
    columns = docs.columns
    rows = docs.toDF(*[f"d{i}" for i in range(len(columns))])
    id_at, text_at = (f"d{columns.index(c)}" for c in (id_col, text_col))
    cut = remove_repeats(rows, id_col=id_at, text_col=text_at, **options)
    if length_col in columns:
        length = f"d{columns.index(length_col)}"
        cut = cut.withColumn(length, F.when(F.col("repeats.n_removed") > 0, F.char_length(text_at).cast(rows.schema[length].dataType))
                             .otherwise(F.col(length)))
    return cut.drop("repeats").toDF(*columns)
