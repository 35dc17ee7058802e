"""Language identification with blended-spectrum string kernels.

A text is the set of its byte n-grams (n = 1 .. ``max_n``; ASCII letters lower-cased), hashed to ``bits`` places. The
kernel of two texts is the number of n-grams present in both over the geometric mean of their set sizes.
Nyström landmarks L give each text the features K(x, L); a one-versus-rest kernel ridge regression on
them is solved in closed form on a bounded sample. A batch of texts is scored with two matrix products:
(presence x landmarks) and (features x weights).

A set of hashed n-grams fills up with the length of a text, so a text of more than ``_PIECE`` bytes is cut into
equal pieces that together hold every n-gram of it. Its margins are the means of the pieces' margins.

Fitting takes about ``per_label`` labelled rows of each label (those with the smallest hash of their id and text,
one at least; fewer of each where the labels are so many that they would pass ``max_rows`` together) and ``landmarks``
of them all, at least ``label_landmarks`` of each label, as landmarks; their presence bits go to the driver
(2^bits / 8 bytes a row). Every label is learned. Every text is learned and scored whole: the set of a long
labelled text holds the n-grams that at least half of its pieces have.

Defined results: a null text, or one without a letter, is ``und`` with score 0. With no labelled row at all
every text is ``und``. Rows without a label, and held-out rows, are not used for fitting. Other columns are
ignored; null ids are scored like others and never used for fitting.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumeline.llm.runtime import materialize, with_package
from plumeline.llm.textkernels import LOWER, slices, string_buffers

_MIX = np.uint32(0x9E3779B1)
_PIECE = 1 << 13


def presence(column: pa.Array, bits: int, max_n: int) -> np.ndarray:
    """0/1 matrix (texts x 2^bits) of hashed n-grams."""
    data, offsets = string_buffers(column)
    out = np.zeros((len(column), 1 << bits), np.uint8)
    shift = np.uint32(32 - bits)
    for r in range(len(column)):
        text = LOWER[data[offsets[r]:offsets[r + 1]]].astype(np.uint32)
        code = np.zeros(len(text), np.uint32)
        for n in range(1, max_n + 1):
            if len(text) < n:
                break
            code = code[:len(text) - n + 1] * np.uint32(257) + text[n - 1:] + np.uint32(n)
            out[r, (code * _MIX) >> shift] = 1
    return out


def pieces(column: pa.Array, max_n: int, size: int = _PIECE) -> tuple[pa.Array, np.ndarray]:
    """Equal pieces of about ``size`` bytes at most that hold all n-grams of each text, and their number per text."""
    data, offsets = string_buffers(column)
    n = np.diff(offsets).astype(np.int64)
    count = np.maximum(-(-n // size), 1)
    first = np.cumsum(count) - count
    row = np.repeat(np.arange(len(n)), count)
    k = np.arange(len(row)) - first[row]
    start = offsets[:-1][row] + n[row] * k // count[row]
    end = np.minimum(offsets[:-1][row] + n[row] * (k + 1) // count[row] + max_n - 1, offsets[1:][row])
    raw = b"".join(data[a:b].tobytes() for a, b in zip(start.tolist(), end.tolist()))
    places = np.concatenate([[0], np.cumsum(end - start)]).astype(np.int64)
    return pa.LargeStringArray.from_buffers(len(row), pa.py_buffer(places), pa.py_buffer(raw)), count


def whole_sets(column: pa.Array, bits: int, max_n: int, size: int = _PIECE) -> np.ndarray:
    """Packed presence bits of each text; of a text of several pieces, the places that at least half of them have."""
    parts, count = pieces(column, max_n, size)
    first = np.cumsum(count) - count
    out = np.zeros((len(column), max((1 << bits) // 8, 1)), np.uint8)
    short = np.flatnonzero(count == 1)
    for i in range(0, len(short), 512):
        out[short[i:i + 512]] = np.packbits(presence(parts.take(pa.array(first[short[i:i + 512]])), bits, max_n), axis=1)
    for r in np.flatnonzero(count > 1):
        held = np.zeros(1 << bits, np.int64)
        for i in range(0, count[r], 256):
            held += presence(parts.slice(first[r] + i, min(256, count[r] - i)), bits, max_n).sum(axis=0, dtype=np.int64)
        out[r] = np.packbits(2 * held >= count[r])
    return out


def _packed(batches, bits: int, max_n: int) -> Iterator[pa.RecordBatch]:
    """(label, text) -> label and presence bits of the whole text."""
    for batch in slices(batches, 1, 1 << 20):
        sets = whole_sets(batch.column(1), bits, max_n)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x.tobytes() for x in sets], pa.binary())], ["label", "grams"])


class StringKernelModel:
    """Landmarks and ridge weights of a fitted classifier."""

    def __init__(self, labels: list[str], landmarks: np.ndarray, weights: np.ndarray, bits: int, max_n: int):
        self.labels, self.landmarks, self.weights, self.bits, self.max_n = labels, landmarks, weights, bits, max_n

    def features(self, sets: np.ndarray) -> np.ndarray:
        size = np.sqrt(np.maximum(sets.sum(axis=1, dtype=np.float32), 1))[:, None]
        return (sets.astype(np.float32) @ self.landmarks) / size

    def scores(self, sets: np.ndarray) -> np.ndarray:
        k = self.features(sets)
        return k @ self.weights[:-1] + self.weights[-1]


def _fit(labels: list[str], y: np.ndarray, sets: np.ndarray, n_landmarks: int, ridge: float, bits: int, max_n: int,
         label_landmarks: int = 4) -> StringKernelModel:
    """``sets``: packed presence bits."""
    take = np.unique(np.linspace(0, len(y) - 1, min(n_landmarks, len(y))).astype(int))
    by_label = np.argsort(y, kind="stable")
    rank = np.empty(len(y), np.int64)
    rank[by_label] = np.arange(len(y)) - np.searchsorted(y[by_label], y[by_label])
    lacking = np.bincount(y[take], minlength=len(labels)) < label_landmarks
    take = np.union1d(take, np.flatnonzero(lacking[y] & (rank < label_landmarks)))
    marks = np.unpackbits(sets[take], axis=1).astype(np.float32)
    marks /= np.sqrt(np.maximum(marks.sum(axis=1), 1))[:, None]
    model = StringKernelModel(labels, np.ascontiguousarray(marks.T), np.zeros((len(take) + 1, len(labels))), bits, max_n)
    # Nyström ridge: minimise |K w + b - t|^2 + ridge w' K_LL w, each label's rows with equal total weight.
    weight = 1.0 / np.bincount(y, minlength=len(labels))[y]
    k_ll = (marks @ marks.T).astype(np.float64)
    left, right = np.zeros((len(take) + 1,) * 2), np.zeros((len(take) + 1, len(labels)))
    left[:-1, :-1] = ridge * k_ll + 1e-8 * np.eye(len(take))
    for i in range(0, len(sets), 512):
        k = model.features(np.unpackbits(sets[i:i + 512], axis=1)).astype(np.float64)
        design = np.hstack([k, np.ones((len(k), 1))])
        target = np.where(y[i:i + 512, None] == np.arange(len(labels)), 1.0, -1.0)
        left += design.T @ (design * weight[i:i + 512, None])
        right += design.T @ (target * weight[i:i + 512, None])
    model.weights = np.linalg.lstsq(left, right, rcond=None)[0].astype(np.float32)
    model.landmarks = model.landmarks.astype(np.float32)
    return model


def fit(labelled: DataFrame, *, id_col: str, text_col: str, label_col: str, per_label: int = 800, landmarks: int = 192,
        ridge: float = 1e-3, bits: int = 12, max_n: int = 4, label_landmarks: int = 4, max_rows: int = 64_000) -> StringKernelModel | None:
    """Fit on a bounded sample of the labelled rows; None if there are none."""
    rows = labelled.where(F.col(label_col).isNotNull() & F.col(text_col).isNotNull() & F.col(id_col).isNotNull())
    # Rows whose hash lies under a label's share of the hash range: about ``per_label`` each and one at least, no sort of a label.
    rows = rows.select(F.col(label_col).alias("label"), F.col(text_col).alias("text"),
                       F.pmod(F.xxhash64(F.col(id_col).cast("string"), F.col(text_col)), F.lit(1 << 40)).alias("place"))
    counts = rows.groupBy(F.col("label").alias("name")).agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("least"))
    counts = materialize(counts)
    n_labels = counts.count()
    each = min(per_label, max(max_rows // max(n_labels, 1), 1))
    share = F.greatest(F.floor(F.lit(1 << 40) / F.col("n") * each), F.col("least") + 1)
    counts = counts.select("name", share.alias("share"))
    counts = F.broadcast(counts) if n_labels <= max_rows else counts
    sample = rows.join(counts, F.col("label") == F.col("name")).where("place < share").select("label", "text")
    sample = sample.mapInArrow(lambda it: _packed(it, bits, max_n), "label string, grams binary")
    got = sorted((r["label"], bytes(r["grams"])) for r in sample.distinct().collect())
    if not got:
        return None
    order = np.random.Generator(np.random.PCG64(1)).permutation(len(got))
    got = [got[i] for i in order]
    labels = sorted({x for x, _ in got})
    number = {x: i for i, x in enumerate(labels)}
    y = np.array([number[x] for x, _ in got])
    sets = np.frombuffer(b"".join(g for _, g in got), np.uint8).reshape(len(got), -1)
    return _fit(labels, y, sets, landmarks, ridge, bits, max_n, label_landmarks)


def _predict(batches, model: StringKernelModel | None, text_at: int) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, text_at, 1 << 20):
        column = batch.column(text_at)
        names, score = ["und"] * len(column), np.zeros(len(column))
        if model is not None:
            parts, count = pieces(column, model.max_n)
            f = np.concatenate([model.scores(presence(parts.slice(i, 256), model.bits, model.max_n)) for i in range(0, len(parts), 256)])
            f = np.add.reduceat(f, np.cumsum(count) - count, axis=0) / count[:, None]
            e = np.exp(4 * (f - f.max(axis=1, keepdims=True)))
            best, share = f.argmax(axis=1), e.max(axis=1) / e.sum(axis=1)
            for r, text in enumerate(column.to_pylist()):
                if text and any(map(str.isalpha, text)):
                    names[r], score[r] = model.labels[best[r]], share[r]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(names), pa.array(score)], [*batch.schema.names, "lang_pred", "score"])


def predict(docs: DataFrame, model: StringKernelModel | None, *, text_col: str = "text") -> DataFrame:
    """``docs`` with a struct ``language`` (lang_pred, score)."""
    with_package(docs.sparkSession)
    inner, at = [f"c{i}" for i in range(len(docs.columns))], docs.columns.index(text_col)
    rows = docs.toDF(*inner)
    schema = T.StructType([*rows.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    out = rows.mapInArrow(lambda it: _predict(it, model, at), schema)
    return out.select(*[F.col(c).alias(n) for c, n in zip(inner, docs.columns)], F.struct("lang_pred", "score").alias("language"))
