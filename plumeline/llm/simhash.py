"""SimHash near-dedup by anchor-point covering.

A fingerprint has 64 bits: bit b is 1 if it is set in more than half of the XXH64 values (seed 42)
of the text's word shingles. Fingerprints that differ in at most ``max_bits`` bits are linked.

Covering: each half of the fingerprint is covered by the perfect Hamming code [31, 26] (covering radius
1; the 32nd bit of a half is left out, which only adds candidates). Two fingerprints with at most
``max_bits`` differing bits differ in at most ``t = max_bits // 2`` bits on one half. There the code word
nearest to the one (distance <= 1) is within ``1 + t`` of the other, so each fingerprint is replicated to
every code word within ``1 + t`` (16 for t = 1) and compared per anchor. All pairs are covered; nothing
is capped. The replicas are of *distinct* fingerprints, so copies do not add to them.

Inside an anchor a breadth-first sweep writes a spanning forest of the links (at most one link per
fingerprint), never all pairs. A run of more than ``_LARGE`` fingerprints is first cut by the exact
pigeonhole: pairs within ``max_bits`` agree on one of ``max_bits + 1`` slices.

Defined results: null or wordless texts have fingerprint zero, linked like any other. Texts with fewer
words than a shingle hash their whole word sequence. A null doc_id counts as larger than all others
and is returned as null. Repeated rows are in the same component. Other columns are ignored.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumeline.llm.components import connected_components
from plumeline.llm.runtime import materialize, with_package

NO_ID = (1 << 63) - 1
_LARGE = 20_000
_ROWS = 1 << 14


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """Fingerprint of one text (A-Z lower-cased, words between spaces and control separators)."""
    words = b" ".join((text or "").encode().lower().split())
    if not words:
        return 0
    gap = np.flatnonzero(np.frombuffer(words, np.uint8) == 0x20)
    starts, ends = [0, *(gap + 1).tolist()], [*gap.tolist(), len(words)]
    digest = xxhash.xxh64_intdigest
    count, n = np.zeros(64, np.int64), max(len(starts) - shingle + 1, 1)
    for i in range(0, n, _ROWS):
        j = min(i + _ROWS, n)
        if n == 1:
            values = [digest(words, 42)]
        else:
            values = [digest(words[a:b], 42) for a, b in zip(starts[i:j], ends[i + shingle - 1:j + shingle - 1])]
        bits = np.unpackbits(np.array(values, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        count += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * count > n, bitorder="little").view("<u8")[0])


def _with_fingerprint(batches, shingle: int) -> Iterator[pa.RecordBatch]:
    """(id, text hash, text) -> (id, text hash, fp)."""
    for batch in batches:
        fp = np.array([fingerprint(t, shingle) for t in batch.column(2).to_pylist()], np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fp)], ["id", "th", "fp"])


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(id, th, fp) per row; ``th`` is a hash of the text that tells rows with one id apart."""
    with_package(docs.sparkSession)
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"),
                       F.xxhash64(F.col(text_col)).alias("th"), F.col(text_col).alias("text"))
    return rows.mapInArrow(lambda it: _with_fingerprint(it, shingle), "id long, th long, fp long")


class HammingCover:
    """Anchors of the [31, 26] Hamming code within ``1 + t`` of a 31-bit word, nearest first."""

    def __init__(self, t: int):
        flips: list[list[tuple[int, int]]] = [[] for _ in range(32)]
        for weight in range(t + 2):
            for places in itertools.combinations(range(1, 32), weight):
                syndrome = 0
                for p in places:
                    syndrome ^= p
                flips[syndrome].append((weight, sum(1 << (p - 1) for p in places)))
        self.count = np.array([len(x) for x in flips], np.int64)
        self.masks = np.zeros((32, int(self.count.max())), np.uint64)
        for s, x in enumerate(flips):
            self.masks[s, :len(x)] = [m for _, m in sorted(x)]
        self.checks = [np.uint64(sum(1 << (p - 1) for p in range(1, 32) if p >> j & 1)) for j in range(5)]

    def anchors(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(index of the word, anchor, is the nearest anchor) for every replica."""
        s = np.zeros(len(words), np.int64)
        for j, check in enumerate(self.checks):
            s |= (np.bitwise_count(words & check) & 1).astype(np.int64) << j
        many = self.count[s]
        row = np.repeat(np.arange(len(words)), many)
        nth = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        return row, words[row] ^ self.masks[s[row], nth], nth == 0


def _replicate(batches, t: int) -> Iterator[pa.RecordBatch]:
    cover, low = HammingCover(t), np.uint64((1 << 31) - 1)
    for batch in batches:
        fps = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
        for i in range(0, len(fps), _ROWS):
            fp = fps[i:i + _ROWS]
            for half, word in enumerate((fp & low, (fp >> np.uint64(32)) & low)):
                row, anchor, home = cover.anchors(word)
                yield pa.RecordBatch.from_arrays(
                    [pa.array((anchor | np.uint64(half << 32)).view(np.int64)), pa.array(fp[row].view(np.int64)), pa.array(home)],
                    ["anchor", "fp", "home"])


def _forest(fps: np.ndarray, max_bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links that join the fingerprints of one run: a tree per component of the run."""
    out, left = [], fps
    while len(left) > 1:
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            x = queue.pop()
            near = np.bitwise_count(left ^ x) <= max_bits
            if near.any():
                found = left[near]
                out.append((np.full(len(found), x), found))
                queue.extend(found)
                left = left[~near]
    return out


def _links_of_run(fps: np.ndarray, max_bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    if len(fps) <= _LARGE:
        return _forest(fps, max_bits)
    out, cuts = [], np.linspace(0, 64, max_bits + 2).astype(int)
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        part = (fps >> np.uint64(a)) & np.uint64((1 << (b - a)) - 1)
        order = np.argsort(part, kind="stable")
        edge = np.flatnonzero(np.diff(part[order])) + 1
        for run in np.split(fps[order], edge):
            if len(run) > 1:
                out += _forest(run, max_bits)
    return out


def _compare(batches, max_bits: int) -> Iterator[pa.RecordBatch]:
    """Links inside each anchor; rows arrive sorted by anchor."""

    def links(anchor: np.ndarray, fp: np.ndarray, home: np.ndarray):
        first = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
        size = np.diff(np.concatenate([first, [len(anchor)]]))
        use = (size > 1) & np.logical_or.reduceat(home, first)
        two = use & (size == 2)
        a, b = fp[first[two]], fp[first[two] + 1]
        near = np.bitwise_count(a ^ b) <= max_bits
        found = [(a[near], b[near])]
        for i, n in zip(first[use & ~two].tolist(), size[use & ~two].tolist()):
            found += _links_of_run(fp[i:i + n], max_bits)
        u, v = (np.concatenate([x[k] for x in found]).view(np.int64) for k in (0, 1))
        return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

    held: list[tuple] = []                                # rows of the anchor that may go on in the next batch
    for batch in batches:
        if not batch.num_rows:
            continue
        anchor, fp, home = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
        if held and anchor[0] == anchor[-1] == held[0][0][0]:
            held.append((anchor, fp.view(np.uint64), home))
            continue
        parts = [*held, (anchor, fp.view(np.uint64), home)]
        anchor, fp, home = (np.concatenate([p[k] for p in parts]) for k in range(3))
        cut = int(np.searchsorted(anchor, anchor[-1]))
        held = [(anchor[cut:], fp[cut:], home[cut:])]
        if cut:
            yield links(anchor[:cut], fp[:cut], home[:cut])
    if held:
        yield links(*(np.concatenate([p[k] for p in held]) for k in range(3)))


def fingerprint_links(fps: DataFrame, max_bits: int = 3) -> DataFrame:
    """Links (u, v) that connect the distinct fingerprints ``fp`` within ``max_bits`` (a forest per anchor)."""
    t = max_bits // 2
    replicas = fps.select("fp").mapInArrow(lambda it: _replicate(it, t), "anchor long, fp long, home boolean")
    runs = replicas.repartition("anchor").sortWithinPartitions("anchor")
    return runs.mapInArrow(lambda it: _compare(it, max_bits), "u long, v long")


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                    max_bits: int = 3) -> DataFrame:
    """(id, th, fp, first_id, first_th) per row: the row's fingerprint and the first row of its component."""
    rows = materialize(fingerprints(docs, id_col=id_col, text_col=text_col, shingle=shingle))
    nodes = materialize(rows.groupBy("fp").agg(F.min(F.struct("id", "th")).alias("least")))
    roots = connected_components(fingerprint_links(nodes, max_bits))
    linked = roots.join(nodes, roots["node"] == nodes["fp"]).select("fp", "root", "least")
    first = linked.groupBy("root").agg(F.min("least").alias("group_least"))
    linked = linked.join(first, "root").select("fp", "group_least")
    # Written, so that the last join has a plain shuffle on both sides and a hot fingerprint can be split.
    known = materialize(nodes.join(linked, "fp", "left").select("fp", F.coalesce("group_least", "least").alias("least")))
    return rows.join(known, "fp").select("id", "th", "fp", F.col("least.id").alias("first_id"), F.col("least.th").alias("first_th"))


def drop_near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                         max_bits: int = 3) -> DataFrame:
    """``docs`` with one row left per component: the one with the smallest id (ties: by text hash)."""
    groups = near_duplicates(docs, id_col=id_col, text_col=text_col, shingle=shingle, max_bits=max_bits)
    keep = groups.where("id = first_id and th = first_th").select("id", "th").distinct()
    columns = docs.columns
    rows = docs.toDF(*[f"d{i}" for i in range(len(columns))])
    id_at, text_at = (f"d{columns.index(c)}" for c in (id_col, text_col))
    rows = rows.withColumns({"id": F.coalesce(F.col(id_at).cast("long"), F.lit(NO_ID)), "th": F.xxhash64(text_at)})
    kept = rows.join(keep, ["id", "th"], "left_semi").dropDuplicates(["id", "th"])
    return kept.select(*[F.col(f"d{i}").alias(c) for i, c in enumerate(columns)])
