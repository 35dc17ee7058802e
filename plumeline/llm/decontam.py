"""Benchmark decontamination: prefix-filtered set join of documents with benchmark windows.

Every item contributes its windows of ``window`` consecutive words (an item with fewer words is one
window). A window is contained in a document only if its rarest word is, so:

1. word counts of the benchmark vocabulary over *all* documents give the rarity order;
2. each window is indexed under its rarest word (the prefix of a containment of 1 has length one)
   with the offset of that word inside the window;
3. an occurrence of a prefix word proposes a window start; the positional bound (offset) and the
   length bound (the window must end inside the text) discard most proposals;
4. what is left is verified by the hash of the whole window and then word by word.

The index holds one block of at most ``block_bytes`` of benchmark text, so what is sent to executors
is bounded. A larger benchmark is probed block after block over rows that carry the hits so far.

Defined results: null or empty text has no words, no hits and is never contaminated. Items with
null or wordless text have no windows. Items that share an id count once; a null item id is
written as the empty string. Repeated document rows each get their own result row. Other columns of
either input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumeline.llm.runtime import materialize, with_package
from plumeline.llm.textkernels import (ALNUM_WORDS, LOWER, _MULT, mix, rows_of, slices, span_hashes, string_buffers,
                                       window_hashes, word_spans)

_BITS = 20


def _sieve(keys: np.ndarray) -> np.ndarray:
    """Small presence table that passes every key and few others."""
    out = np.zeros(1 << _BITS, dtype=bool)
    out[(keys & np.uint64((1 << _BITS) - 1)).astype(np.int64)] = True
    return out


def _find(sorted_keys: np.ndarray, sieve: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions in ``values`` that equal a key, and the index of that key."""
    at = np.flatnonzero(sieve[(values & np.uint64((1 << _BITS) - 1)).astype(np.int64)])
    if not len(at) or not len(sorted_keys):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    k = np.minimum(np.searchsorted(sorted_keys, values[at]), len(sorted_keys) - 1)
    hit = sorted_keys[k] == values[at]
    return at[hit], k[hit]


def _words(column: pa.Array):
    data, offsets = string_buffers(column)
    data = LOWER[data]
    starts, ends, first = word_spans(data, offsets, ALNUM_WORDS)
    return data, starts, ends, first, span_hashes(data, starts, ends)


class WindowIndex:
    """Windows of one block of benchmark items, keyed by their rarest word."""

    def __init__(self, items: list[tuple[str, str]], window: int):
        self.window = window
        self.by_id = sorted({i for i, _ in items})
        number = {x: k for k, x in enumerate(self.by_id)}
        data, starts, ends, first, hashes = _words(pa.array([t for _, t in items], pa.string()))
        self.vocabulary = np.unique(hashes)
        rows: dict[tuple[bytes, ...], set[int]] = {}
        word_hash: dict[bytes, int] = {}
        for r, (item, _) in enumerate(items):
            lo, hi = int(first[r]), int(first[r + 1])
            words = [data[s:e].tobytes() for s, e in zip(starts[lo:hi], ends[lo:hi])]
            word_hash.update(zip(words, hashes[lo:hi].tolist()))
            for p in range(max(len(words) - window + 1, min(len(words), 1))):
                rows.setdefault(tuple(words[p:p + window]), set()).add(number[item])
        self.windows = list(rows)
        self.items = [np.array(sorted(x), np.int64) for x in rows.values()]
        self._hash = word_hash

    def order_by_rarity(self, counts: dict[int, int]) -> None:
        """Index each window under its rarest word (ties: the smaller word)."""
        place: dict[int, set[tuple[int, int]]] = {}
        by_length: dict[int, list[tuple[int, int]]] = {}
        for w, words in enumerate(self.windows):
            hs = [self._hash[x] for x in words]
            off = min(range(len(hs)), key=lambda j: (counts.get(hs[j], 0), words[j], j))
            place.setdefault(hs[off], set()).add((off, len(hs)))
            whole = int(window_hashes(np.array(hs, np.uint64), len(hs), seed=1)[0])
            by_length.setdefault(len(hs), []).append((whole, w))
        self.prefix = np.array(sorted(place), np.uint64)
        self.sieve = _sieve(self.prefix)
        pairs = [sorted(place[int(k)]) for k in self.prefix]
        self.pair_first = np.concatenate([[0], np.cumsum([len(x) for x in pairs])]).astype(np.int64)
        flat = np.array([y for x in pairs for y in x], np.int64).reshape(-1, 2)
        self.offset, self.length = flat[:, 0], flat[:, 1]
        self.whole = {}
        for n, x in by_length.items():
            x.sort()
            self.whole[n] = (np.array([h for h, _ in x], np.uint64), np.array([w for _, w in x], np.int64))
        self._hash = {}

    def matches(self, data, starts, ends, first, hashes) -> tuple[np.ndarray, np.ndarray]:
        """(start word, window) of every occurrence of a window."""
        at, k = _find(self.prefix, self.sieve, hashes)
        none = np.zeros(0, np.int64)
        if not len(at):
            return none, none
        many = np.diff(self.pair_first)[k]
        pair = np.repeat(self.pair_first[k], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        text = np.repeat(np.searchsorted(first, at, side="right") - 1, many)
        start, length = np.repeat(at, many) - self.offset[pair], self.length[pair]
        ok = (start >= first[text]) & (start + length <= first[text + 1])        # positional and length bounds
        start, length = start[ok], length[ok]
        found_s, found_w = [], []
        for n in np.unique(length).tolist():
            s = np.unique(start[length == n])
            acc = np.zeros(len(s), np.uint64)
            for j in range(n):
                acc += hashes[s + j] * _MULT[(j + 37) % 256]
            keys, ids = self.whole[n]
            value = mix(acc + np.uint64(1))
            lo, hi = np.searchsorted(keys, value, side="left"), np.searchsorted(keys, value, side="right")
            for i in np.flatnonzero(hi > lo).tolist():
                p = int(s[i])
                words = tuple(data[a:b].tobytes() for a, b in zip(starts[p:p + n], ends[p:p + n]))
                for w in ids[lo[i]:hi[i]].tolist():
                    if self.windows[w] == words:                                  # exact containment
                        found_s.append(p)
                        found_w.append(w)
        return np.array(found_s, np.int64), np.array(found_w, np.int64)


def _count_words(batches, vocabulary: np.ndarray) -> Iterator[pa.RecordBatch]:
    sieve, total = _sieve(vocabulary), np.zeros(len(vocabulary), np.int64)
    for batch in slices(batches, 0):
        _, k = _find(vocabulary, sieve, _words(batch.column(0))[4])
        total += np.bincount(k, minlength=len(total))
    some = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(vocabulary[some].view(np.int64)), pa.array(total[some])], ["word", "n"])


def _runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(np.int8), [0]])))
    return edge[::2], edge[1::2]


def _probe(batches, index: WindowIndex, text_at: int, carry: bool) -> Iterator[pa.RecordBatch]:
    """Append (n_words, hit_starts, hit_ends, items) to each row; ``carry``: join earlier blocks' hits."""
    for batch in slices(batches, text_at):
        data, starts, ends, first, hashes = _words(batch.column(text_at))
        n, size = int(first[-1]), batch.num_rows
        s, w = index.matches(data, starts, ends, first, hashes)
        step = np.zeros(n + 1, np.int64)
        if len(s):
            np.add.at(step, s, 1)
            np.add.at(step, s + np.array([len(index.windows[x]) for x in w.tolist()], np.int64), -1)
        mask = np.cumsum(step)[:n] > 0
        found: dict[int, set[str]] = {}
        for r, x in zip((np.searchsorted(first, s, side="right") - 1).tolist(), w.tolist()):
            found.setdefault(r, set()).update(index.by_id[i] for i in index.items[x].tolist())
        names = batch.schema.names
        old = batch.to_pydict() if carry else None
        hit_s, hit_e, items = [], [], []
        for r in range(size):
            lo, hi = int(first[r]), int(first[r + 1])
            own, ids = mask[lo:hi], found.get(r, set())
            if carry:
                own = own.copy()
                for a, b in zip(old["hit_starts"][r], old["hit_ends"][r]):
                    own[a:b] = True
                ids = ids | set(old["items"][r])
            a, b = _runs(own) if (r in found or carry) else ((), ())
            hit_s.append(list(a))
            hit_e.append(list(b))
            items.append(sorted(ids))
        extra = [pa.array(np.diff(first), pa.int64()), pa.array(hit_s, pa.list_(pa.int64())),
                 pa.array(hit_e, pa.list_(pa.int64())), pa.array(items, pa.list_(pa.string()))]
        keep = [i for i, x in enumerate(names) if x not in ("n_words", "hit_starts", "hit_ends", "items")] if carry else range(len(names))
        yield pa.RecordBatch.from_arrays([batch.column(i) for i in keep] + extra,
                                         [names[i] for i in keep] + ["n_words", "hit_starts", "hit_ends", "items"])


def _blocks(items: DataFrame, item_col: str, text_col: str, block_bytes: int) -> tuple[DataFrame, int]:
    sized = items.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"),
                         F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    total = sized.agg(F.sum(F.octet_length("text").cast("long") + 64).alias("n")).first()["n"] or 0
    n = max(1, -(-int(total) // block_bytes))
    return sized.withColumn("block", F.pmod(F.xxhash64("item", "text"), F.lit(n))), n


def benchmark_hits(docs: DataFrame, items: DataFrame, *, text_col: str = "text", item_col: str = "item_id",
                   item_text: str = "text", window: int = 13, block_bytes: int = 8 << 20) -> DataFrame:
    """``docs`` with a struct ``benchmark_hits``: n_words, hit_starts, hit_ends (word spans), items.

    Rows and columns of ``docs`` stay as they are (no shuffle of texts).
    """
    spark = with_package(docs.sparkSession)
    # Positional names inside the job: input columns of any name cannot clash with the results.
    inner = [f"c{i}" for i in range(len(docs.columns))]
    rows = docs.toDF(*inner)
    at = docs.columns.index(text_col)
    blocked, n_blocks = _blocks(items, item_col, item_text, block_bytes)
    base = list(rows.schema.fields)
    extra = [T.StructField("n_words", T.LongType()), T.StructField("hit_starts", T.ArrayType(T.LongType())),
             T.StructField("hit_ends", T.ArrayType(T.LongType())), T.StructField("items", T.ArrayType(T.StringType()))]
    out_schema, texts, out = T.StructType(base + extra), rows.select(f"c{at}"), rows
    for b in range(n_blocks):
        block = [(r["item"], r["text"]) for r in blocked.where(F.col("block") == b).select("item", "text").collect()]
        index = WindowIndex(sorted(block), window)
        vocabulary = index.vocabulary
        counts = texts.mapInArrow(lambda it, v=vocabulary: _count_words(it, v), "word long, n long")
        counts = {r["word"] % (1 << 64): r["n"] for r in counts.groupBy("word").agg(F.sum("n").alias("n")).collect()}
        index.order_by_rarity(counts)
        out = out.mapInArrow(lambda it, x=index, c=b > 0: _probe(it, x, at, c), out_schema)
        if n_blocks > 1:
            out = materialize(out)
    hits = F.struct("n_words", "hit_starts", "hit_ends", "items").alias("benchmark_hits")
    return out.select(*[F.col(c).alias(name) for c, name in zip(inner, docs.columns)], hits)


def contamination(hits) -> dict[str, F.Column]:
    """Columns of the contamination rule: at least one word in twenty lies inside a benchmark window."""
    n_hit = F.aggregate(F.zip_with(F.col(f"{hits}.hit_ends"), F.col(f"{hits}.hit_starts"), lambda e, s: e - s),
                        F.lit(0).cast("long"), lambda a, x: a + x)
    return {"n_hit": n_hit, "contaminated": (n_hit > 0) & (n_hit * 20 >= F.col(f"{hits}.n_words"))}


def drop_contaminated(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """Rows of ``docs`` that the rule does not call contaminated, columns unchanged."""
    columns = docs.columns
    rows = docs.toDF(*[f"d{i}" for i in range(len(columns))])
    options["text_col"] = f"d{columns.index(options.get('text_col', 'text'))}"
    hit = benchmark_hits(rows, items, **options)
    return hit.where(~contamination("benchmark_hits")["contaminated"]).drop("benchmark_hits").toDF(*columns)
