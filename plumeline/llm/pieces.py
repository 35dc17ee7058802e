"""SentencePiece encoding and decoding through a table of distinct chunks.

If no piece of a model has a whitespace marker after another character, merges never cross from a visible
character to a marker. A marked text (dummy marker in front, every space a marker) can then be cut before each run
of markers, and each chunk, markers and word, is segmented on its own.

1. Ask. Each task cuts runs of about ``slice_bytes`` of texts into chunks, numbers the distinct chunks of a run and
   sends each of them once, packed by hash bucket.
2. Segment. A bucket meets the requests of all runs and segments each distinct chunk once with the library.
3. Join back. The runs are read once more as lists of chunk numbers, which meet the answers; ids are put together by
   position and decoded by the library. Reading twice costs less disk than sending the numbers through the buckets;
   a run whose content differs between the two reads (an input that is not repeatable) stops the job.

No run, bucket or answer grows with the number of documents: buckets are counted from the bytes of all texts, a chunk
that every text holds is asked for once a run, and a run is about ``slice_bytes`` of text (one text at least).
A model whose pieces can cross markers, or that changes texts before it cuts them, gets each whole text as one chunk:
the result is the same, only less is shared.

Defined results: null text is empty; an empty text has no ids and decodes to an empty text. Repeated rows give
repeated rows. Null ids stay null. Columns other than the id and the text are ignored, so their names cannot clash.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from plumeline.llm.runtime import shuffle_partitions, text_bytes, with_package
from plumeline.llm.textkernels import gaps, pack, release_memory, slices, string_buffers, ungaps, unpack

MARK = "▁"
_CHUNK = re.compile(" +[^ ]*")
_NO_ID = np.iinfo(np.int64).min


class PieceEncoder:
    """One model file in a worker: chunks of texts and their ids."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.library.get_piece_size()
        inner = re.compile(f"[^{MARK}]{MARK}")
        crossing = any(inner.search(self.library.id_to_piece(i)) for i in range(n))
        plain = self.library.normalize(" a  ﬁ ") == f"{MARK}{MARK}a{MARK}{MARK}ﬁ{MARK}"
        self.cuts = plain and not crossing
        one = len(self.library.encode("a"))
        self.lone_mark = self.library.encode("a ")[one:]

    def chunks(self, text: str) -> list[str]:
        if not text:
            return []
        return _CHUNK.findall(" " + text.replace(MARK, " ")) if self.cuts else [text]

    def segment(self, chunks: list[str]) -> list[list[int]]:
        """Ids of each chunk; the library puts one marker in front itself."""
        if not self.cuts:
            return self.library.encode(chunks, num_threads=1)
        found = self.library.encode([c[1:] for c in chunks], num_threads=1)
        return [self.lone_mark if c == " " else x for c, x in zip(chunks, found)]


_ENCODERS: dict[str, PieceEncoder] = {}


def encoder(path: str) -> PieceEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = PieceEncoder(path)
    return _ENCODERS[path]


def _strings(column: pa.Array) -> list[np.ndarray]:
    """A string column as packable arrays: bytes and lengths."""
    data, offsets = string_buffers(column)
    return [data, np.diff(offsets).astype(np.uint32)]


def _column(data: np.ndarray, sizes: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)]).astype(np.int64)
    return pa.Array.from_buffers(pa.large_string(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])


def _planes(values: np.ndarray) -> list[np.ndarray]:
    """Unsigned integers as byte planes (compress better than whole numbers)."""
    return list(np.ascontiguousarray(values.astype("<u4")).view(np.uint8).reshape(-1, 4).T[:1 + int(values.max(initial=0)).bit_length() // 8])


def _number(planes: list[np.ndarray]) -> np.ndarray:
    return sum((p.astype(np.uint32) << np.uint32(8 * i) for i, p in enumerate(planes)), np.zeros(len(planes[0]), np.uint32)).astype(np.int64)


def _bucket(chunks: pa.Array, n_buckets: int) -> np.ndarray:
    """Hash bucket of each chunk; where a chunk meets its equals, equality itself is decided on the string."""
    return np.fromiter((xxh3_64_intdigest(c) % n_buckets for c in chunks.cast(pa.large_binary()).to_pylist()), np.int64, len(chunks))


def _runs(batches, path: str, slice_bytes: int) -> Iterator[tuple]:
    """Per run of texts: its number, a check of its content, the texts' ids, their chunk counts, the distinct chunks
    (frequent ones first) and the texts as numbers of these."""
    own = encoder(path)
    for seq, batch in enumerate(slices(batches, 1, slice_bytes)):
        run = batch.column(2)[0].as_py() << 32 | seq
        check = xxh3_64_intdigest(string_buffers(batch.column(1))[0].tobytes())
        texts = [own.chunks(t or "") for t in batch.column(1).to_pylist()]
        counts = np.array([len(t) for t in texts], np.uint32)
        coded = pa.array(chain.from_iterable(texts), pa.large_string()).dictionary_encode()
        del texts
        numbers = coded.indices.to_numpy().astype(np.int64)
        often = np.argsort(-np.bincount(numbers, minlength=len(coded.dictionary)), kind="stable")
        rank = np.empty(len(often), np.int64)
        rank[often] = np.arange(len(often))
        yield (run, np.array([check], np.uint64), batch.column(0).cast(pa.int64()).fill_null(_NO_ID).to_numpy(), counts,
               coded.dictionary.take(pa.array(often)), rank[numbers])


def _numbers(batches, path: str, slice_bytes: int) -> Iterator[pa.RecordBatch]:
    """(id, text, part) -> per run: its texts as numbers."""
    for run, check, ids, counts, _, numbers in _runs(batches, path, slice_bytes):
        yield _table([(run, -1, pack(check, ids, counts, *_planes(numbers)))])


def _requests(batches, path: str, n_buckets: int, slice_bytes: int) -> Iterator[pa.RecordBatch]:
    """(id, text, part) -> per run: its distinct chunks by bucket."""
    for run, check, _, _, chunks, _ in _runs(batches, path, slice_bytes):
        bucket, rows = _bucket(chunks, n_buckets), []
        order = np.argsort(bucket, kind="stable")
        edges = np.searchsorted(bucket[order], np.arange(n_buckets + 1))
        for b in np.flatnonzero(np.diff(edges)).tolist():
            asked = order[edges[b]:edges[b + 1]]
            rows.append((run, b, pack(check, gaps(asked), *_strings(chunks.take(pa.array(asked))))))
        yield _table(rows)


def _table(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
                                       pa.array([r[2] for r in rows], pa.binary())], ["run", "bucket", "payload"])


def _segment(found: pa.Table, path: str) -> pa.Table:
    """One bucket: ids of each distinct chunk, packed for the runs that asked."""
    runs = found.column("run").to_pylist()
    asked = [unpack(p) for p in found.column("payload").to_pylist()]
    sizes = [len(a[1]) for a in asked]
    coded = pa.chunked_array([_column(a[2], a[3]) for a in asked]).combine_chunks().dictionary_encode()
    ids = encoder(path).segment(coded.dictionary.to_pylist())
    many = np.array([len(x) for x in ids], np.int64)
    flat = np.fromiter(chain.from_iterable(ids), np.int64, int(many.sum()))
    del ids
    first = np.cumsum(many) - many
    ends, codes, rows = np.cumsum(sizes), coded.indices.to_numpy(), []
    for i, run in enumerate(runs):
        own = codes[ends[i] - sizes[i]:ends[i]]
        n = many[own]
        at = np.repeat(first[own] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        rows.append((run, 0, pack(*asked[i][:2], n.astype(np.uint8 if n.max() < 256 else np.uint32), *_planes(flat[at]))))
    release_memory()
    return pa.Table.from_batches([_table(rows)])


def _join(found: pa.Table, path: str) -> pa.Table:
    """One run: ids of its texts by position, and the texts they decode to."""
    check, row_ids, counts, place = None, None, None, None
    answers, checks = [], set()
    for bucket, payload in zip(found.column("bucket").to_pylist(), found.column("payload").to_pylist()):
        parts = unpack(payload)
        if bucket < 0:
            check, row_ids, counts, place = parts[0], parts[1], parts[2].astype(np.int64), _number(parts[3:])
        else:
            checks.add(int(parts[0][0]))
            answers.append((ungaps(parts[1]), parts[2].astype(np.int64), _number(parts[3:])))
    if check is None or checks - {int(check[0])}:
        raise RuntimeError("the documents changed between two reads of one job; write them to a table first")
    asked, many, flat = (np.concatenate(x) for x in zip(*answers)) if answers else (np.zeros(0, np.int64),) * 3
    n_of, at_of = np.zeros(len(asked), np.int64), np.zeros(len(asked), np.int64)
    n_of[asked], at_of[asked] = many, np.cumsum(many) - many
    n = n_of[place]
    ends = np.cumsum(n)
    ids = flat[np.repeat(at_of[place] - (ends - n), n) + np.arange(int(n.sum()))].astype(np.int32)
    cuts = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])]
    own = encoder(path).library
    texts = [own.decode(ids[a:b].tolist()) if b > a else "" for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]
    lists = pa.LargeListArray.from_arrays(pa.array(cuts), pa.array(ids))
    release_memory()
    return pa.table({"id": pa.array(row_ids, mask=row_ids == _NO_ID), "ids": lists.cast(pa.list_(pa.int32())),
                     "decoded": pa.array(texts, pa.string())})


def encode_pieces(docs: DataFrame, model: str, *, id_col: str = "doc_id", text_col: str = "text", slice_bytes: int = 8 << 20,
                  bucket_bytes: int = 16 << 20) -> DataFrame:
    """(id, ids, decoded) of every row: ids by the SentencePiece ``model`` file without begin or end ids, and the text
    that these ids decode to. Ids are integers.

    ``bucket_bytes`` of text stand for one bucket of distinct chunks; raise it together with ``slice_bytes`` on large
    tables so that a run has many more distinct chunks than there are buckets.
    """
    spark = with_package(docs.sparkSession)
    n_buckets = max(-(-text_bytes(docs, text_col) // bucket_bytes), shuffle_partitions(spark), 1)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), F.spark_partition_id().alias("part"))
    kinds = "run long, bucket long, payload binary"
    asked = rows.mapInArrow(lambda it: _requests(it, model, n_buckets, slice_bytes), kinds)
    answers = asked.groupBy("bucket").applyInArrow(lambda t: _segment(t, model), kinds)
    numbers = rows.mapInArrow(lambda it: _numbers(it, model, slice_bytes), kinds)
    return answers.unionByName(numbers).groupBy("run").applyInArrow(lambda t: _join(t, model), "id long, ids array<int>, decoded string")
