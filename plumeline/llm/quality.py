"""Quality classifier by co-training of a text view and a page-metadata view.

Two judgements are learned from a label table: ``low`` (quality 0) and ``toxic`` (toxic 1). For each, two logistic
classifiers see different views of a document:

* text content: presence of words, word stems (prefixes of 4 to 6 bytes) and word endings, the most
  telling ones by a two-sample z statistic, and shares of repeated and upper-case words;
* page metadata: source, language, length, and layout (lines, line and word lengths, shares of upper case,
  digits, symbols, blanks and repeated lines), none of the words.

In each of ``rounds`` rounds each view labels the documents of an unlabelled pool it is most confident about,
and these become training rows of the *other* view. Afterwards each view's margin is calibrated on labelled
rows kept out of the fit, and a small logistic combination of the calibrated log odds (each, and the surer of
both) gives the probability.

Fitting uses a bounded sample: about ``max_labelled`` labelled and ``max_pool`` unlabelled ids (by a hash of the id), one
document of each (of an id that repeats, the one with the smallest text hash), so the rows collected stay within the bounds
however often an id occurs. Word features of fewer than four labelled documents of the whole sample are not considered; of
the others each judgement keeps its ``features`` most telling ones (a parameter). Scoring covers every document and its
whole text, in one pass without a shuffle.

Defined results: a null text is scored as the empty text. Missing metadata columns, null values and
unknown sources count as "none". Label rows that share a doc_id are merged (smallest quality, largest toxic);
null labels are unlabelled. If a judgement has no example of one class, its probability is the
observed share. Documents without an id are scored but never used for fitting.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumeline.llm.runtime import materialize, with_package
from plumeline.llm.textkernels import LOWER, SPACE_WORDS, rows_of, slices, span_hashes, string_buffers, word_spans

TARGETS = ("low", "toxic")
_STEMS, _ENDING = (4, 5, 6), 2
_SIEVE = 20
_SOURCES, _LANGS = 32, 16
_BYTES = np.arange(256)
_UPPER = (_BYTES >= 0x41) & (_BYTES <= 0x5A)
_DIGIT = (_BYTES >= 0x30) & (_BYTES <= 0x39)
_BLANK = ~SPACE_WORDS
_SYMBOL = (_BYTES < 0x80) & ~_UPPER & ~_DIGIT & ~_BLANK & ~((_BYTES >= 0x61) & (_BYTES <= 0x7A)) & ~np.isin(_BYTES, [ord(c) for c in ".,;:'\"()-?"])


class View:
    """Word and layout arrays of one slice of texts."""

    def __init__(self, column: pa.Array):
        self.data, self.offsets = string_buffers(column)
        self.starts, self.ends, self.first = word_spans(self.data, self.offsets, SPACE_WORDS)
        self.row = rows_of(self.first)
        self.lower = LOWER[self.data]
        self.whole = span_hashes(self.lower, self.starts, self.ends)

    def word_features(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(rows, hashes) of each kind of word feature, repeats included."""
        yield self.row, self.whole
        size = self.ends - self.starts
        for n in _STEMS:
            long = size > n
            yield self.row[long], span_hashes(self.lower, self.starts[long], self.starts[long] + n) ^ np.uint64(n << 56)
        long = size > _ENDING
        yield self.row[long], span_hashes(self.lower, self.ends[long] - _ENDING, self.ends[long]) ^ np.uint64(0xEE << 56)

    def shares(self) -> np.ndarray:
        """Dense part of the text view: repeated words, upper-case words, distinct words (shares per text)."""
        n_rows, words = len(self.offsets) - 1, np.maximum(np.diff(self.first), 1)
        same = np.zeros(len(self.whole), bool)
        if len(same) > 1:
            same[1:] = (self.whole[1:] == self.whole[:-1]) & (self.row[1:] == self.row[:-1])
        caps = np.concatenate([[0], np.cumsum(_UPPER[self.data])])
        shout = (caps[self.ends] - caps[self.starts]) * 2 > (self.ends - self.starts)
        count = lambda mask: np.bincount(self.row[mask], minlength=n_rows)
        out = np.stack([count(same) / words, count(shout & (self.ends - self.starts > 3)) / words], axis=1)
        return np.sqrt(out)

    def layout(self) -> np.ndarray:
        """Dense part of the metadata view that comes from the page's form."""
        size = np.maximum(np.diff(self.offsets), 1).astype(np.float64)
        def count(table):
            total = np.concatenate([[0], np.cumsum(table[self.data])])
            return np.diff(total[self.offsets]).astype(np.float64)
        lines, words = count(_BYTES == 0x0A) + 1, np.maximum(np.diff(self.first), 1)
        repeated = np.zeros(len(size))
        starts, ends, first = word_spans(self.data, self.offsets, _BYTES != 0x0A)
        h, row = span_hashes(self.data, starts, ends), rows_of(first)
        if len(h):
            key = np.unique(np.stack([row.astype(np.uint64), h], axis=1), axis=0)
            repeated = 1 - np.bincount(key[:, 0].astype(np.int64), minlength=len(size)) / np.maximum(np.diff(first), 1)
        return np.stack([np.log1p(size) / 5, np.log1p(lines) / 3, np.log1p(size / lines) / 4, np.log1p(size / words) / 2,
                         np.sqrt(count(_UPPER) / size), np.sqrt(count(_DIGIT) / size), np.sqrt(count(_SYMBOL) / size),
                         count(_BLANK) / size, repeated], axis=1)


def _one_hot(values: list, size: int) -> np.ndarray:
    out = np.zeros((len(values), size))
    out[np.arange(len(values)), [0 if v is None else 1 + zlib.crc32(str(v).encode()) % (size - 1) for v in values]] = 1
    return out


def _metadata(view: View, source: list, lang: list) -> np.ndarray:
    return np.hstack([view.layout(), _one_hot(source, _SOURCES), _one_hot(lang, _LANGS)])


def _selected(view: View, keys: np.ndarray, sieve: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, feature number) of the selected features, by row."""
    found = []
    for row, h in view.word_features():
        at = np.flatnonzero(sieve[(h & np.uint64((1 << _SIEVE) - 1)).astype(np.int64)])
        k = np.minimum(np.searchsorted(keys, h[at]), max(len(keys) - 1, 0))
        hit = keys[k] == h[at] if len(keys) else np.zeros(0, bool)
        found.append(row[at][hit] * len(keys) + k[hit])
    pair = np.unique(np.concatenate(found)).astype(np.int64)
    return pair // max(len(keys), 1), pair % max(len(keys), 1)


def _sieve_of(keys: np.ndarray) -> np.ndarray:
    out = np.zeros(1 << _SIEVE, bool)
    out[(keys & np.uint64((1 << _SIEVE) - 1)).astype(np.int64)] = True
    return out


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


class Sparse:
    """Rows of feature numbers (presence 1) with a few dense columns behind them."""

    def __init__(self, row: np.ndarray, feature: np.ndarray, dense: np.ndarray, width: int):
        self.row, self.feature, self.dense, self.width, self.n = row, feature, dense, width, len(dense)

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights=w[self.feature], minlength=self.n) + self.dense @ w[self.width:]

    def back(self, r: np.ndarray) -> np.ndarray:
        return np.concatenate([np.bincount(self.feature, weights=r[self.row], minlength=self.width), self.dense.T @ r])

    def take(self, rows: np.ndarray) -> "Sparse":
        new = np.full(self.n, -1)
        new[rows] = np.arange(len(rows))
        keep = new[self.row] >= 0
        return Sparse(new[self.row[keep]], self.feature[keep], self.dense[rows], self.width)


def _newton(a: np.ndarray, y: np.ndarray, l2: float, steps: int = 40) -> np.ndarray:
    """Ridge logistic regression on dense columns (the last is the intercept) by damped Newton steps."""
    n, w = len(y), np.zeros(a.shape[1])
    penalty = np.full(a.shape[1], l2)
    penalty[-1] = 1e-9
    loss = lambda v: np.logaddexp(0, np.where(y > 0.5, -1, 1) * (a @ v)).mean() + 0.5 * (penalty * v * v).sum()
    now = loss(w)
    for _ in range(steps):
        p = _sigmoid(a @ w)
        step = np.linalg.solve(a.T @ (a * (p * (1 - p) / n)[:, None]) + np.diag(penalty + 1e-9), a.T @ (p - y) / n + penalty * w)
        size = 1.0
        while size > 1e-4 and (new := loss(w - size * step)) > now:
            size /= 2
        if size <= 1e-4 or now - new < 1e-9:
            break
        w, now = w - size * step, new
    return w


def _fit_logistic(x: Sparse, y: np.ndarray, l2: float, steps: int = 200) -> np.ndarray:
    """Logistic weights of one view (last: intercept).

    Presence features are scaled by their log odds ratio between the classes, so that rare telling words
    count and common words do not; then accelerated gradient descent. A view without them is fitted by
    Newton steps.
    """
    if not x.width:
        return _newton(x.dense, y, l2)
    yes, no = (np.bincount(x.feature, weights=v[x.row], minlength=x.width) for v in (y, 1 - y))
    scale = np.abs(np.log((yes + 0.5) / (y.sum() + 1)) - np.log((no + 0.5) / ((1 - y).sum() + 1)))
    scale = np.concatenate([scale, np.full(x.dense.shape[1], 5.0)])
    n, w = len(y), np.zeros(len(scale))
    v = np.random.Generator(np.random.PCG64(3)).random(len(w))
    for _ in range(8):
        v = scale * x.back(x.dot(scale * v / np.linalg.norm(v)))
    rate = 1 / (0.25 * np.linalg.norm(v) / n * 1.1 + l2)
    z, t = w.copy(), 1.0
    for _ in range(steps):
        g = scale * x.back(_sigmoid(x.dot(scale * z)) - y) / n
        g[:-1] += l2 * z[:-1]
        new = z - rate * g
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        z, w, t = new + (t - 1) / t_new * (new - w), new, t_new
    return w * scale


def _platt(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of calibrated log odds (Platt's smoothed targets)."""
    pos, neg = y.sum(), len(y) - y.sum()
    target = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    spread = max(float(margin.std()), 1e-6)
    a = np.stack([margin / spread, np.ones(len(y))], axis=1)
    w = np.zeros(2)
    for _ in range(60):
        p = _sigmoid(a @ w)
        step = np.linalg.solve(a.T @ (a * (p * (1 - p))[:, None]) + 1e-2 * np.eye(2), a.T @ (p - target) + 1e-2 * w)
        w = w - step * min(1.0, 2.0 / max(np.abs(step).max(), 1e-9))
    return max(float(w[0]), 0.0) / spread, float(w[1])


@dataclass
class Judge:
    """One judgement: weights and calibration of both views."""

    prior: float
    text: np.ndarray | None = None
    meta: np.ndarray | None = None
    text_scale: tuple[float, float] = (0.0, 0.0)
    meta_scale: tuple[float, float] = (0.0, 0.0)
    mixture: np.ndarray | None = None

    def views(self, text: Sparse, meta: Sparse) -> tuple[np.ndarray, np.ndarray]:
        """Calibrated log odds of each view."""
        a, b = self.text_scale
        c, d = self.meta_scale
        return a * text.dot(self.text) + b, c * meta.dot(self.meta) + d

    def probability(self, text: Sparse, meta: Sparse) -> np.ndarray:
        if self.text is None:
            return np.full(text.n, self.prior)
        return _sigmoid(_stack(*self.views(text, meta)) @ self.mixture)


def _stack(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inputs of the combination: both calibrated log odds, the surer one, and the intercept."""
    a, b = np.clip(a, -12, 12), np.clip(b, -12, 12)
    return np.stack([a, b, np.maximum(a, b), np.ones(len(a))], axis=1)


def _co_train(text: Sparse, meta: Sparse, y: np.ndarray, rounds: int, per_round: int, l2: float) -> Judge:
    """``y``: 0, 1 or -1 (unlabelled pool)."""
    known, pool = np.flatnonzero(y >= 0), np.flatnonzero(y < 0)
    share = float(y[known].mean()) if len(known) else 0.0
    if not 0 < share < 1 or min((y == 1).sum(), (y == 0).sum()) < 4:
        return Judge(share)
    fold = np.zeros(len(known), bool)
    for c in (0, 1):
        fold[np.flatnonzero(y[known] == c)[::4]] = True        # a quarter of each class is kept for calibration
    train, check = known[~fold], known[fold]
    judge = Judge(min(max(share, 1e-4), 1 - 1e-4))
    own = {"text": (train, y[train]), "meta": (train, y[train])}
    both = {"text": text, "meta": meta}
    for r in range(rounds + 1):
        for name, x in both.items():
            rows, labels = own[name]
            w = _fit_logistic(x.take(rows), labels.astype(np.float64), l2)
            setattr(judge, name, w)
            setattr(judge, f"{name}_scale", _platt(x.take(check).dot(w), y[check]))
        if r == rounds or not len(pool):
            break
        odds = dict(zip(("text", "meta"), judge.views(text.take(pool), meta.take(pool))))
        proof = dict(zip(("text", "meta"), judge.views(text.take(check), meta.take(check))))
        used, many = np.zeros(len(pool), bool), min(per_round, len(train) // 4)
        for name, other in (("text", "meta"), ("meta", "text")):
            p, seen = _sigmoid(odds[name]), _sigmoid(proof[name])
            sure_yes, sure_no = seen > 0.95, seen < min(0.05, share / 2)
            yes = np.argsort(-p, kind="stable")[:max(int(many * share), 1)]
            no = np.argsort(p, kind="stable")[:max(int(many * (1 - share)), 1)]
            # A view teaches a class only if its confident answers hold on the rows kept out.
            yes = yes[p[yes] > 0.95] if sure_yes.sum() >= 5 and y[check][sure_yes].mean() >= 0.98 else yes[:0]
            no = no[p[no] < min(0.05, share / 2)] if sure_no.sum() >= 5 and y[check][sure_no].mean() <= 0.02 else no[:0]
            rows, labels = own[other]
            own[other] = (np.concatenate([rows, pool[yes], pool[no]]), np.concatenate([labels, np.ones(len(yes), int), np.zeros(len(no), int)]))
            used[yes] = used[no] = True
        pool = pool[~used]
    judge.mixture = _newton(_stack(*judge.views(text.take(check), meta.take(check))), y[check].astype(np.float64), 1e-3)
    return judge


@dataclass
class QualityModel:
    keys: np.ndarray                                           # hashes of the selected word features
    judges: dict[str, Judge] = field(default_factory=dict)

    def probabilities(self, view: View, source: list, lang: list) -> dict[str, np.ndarray]:
        text, meta = _matrices(view, source, lang, self.keys, self.sieve)
        return {t: self.judges[t].probability(text, meta) for t in TARGETS}

    def __post_init__(self):
        self.sieve = _sieve_of(self.keys)


def _matrices(view: View, source: list, lang: list, keys: np.ndarray, sieve: np.ndarray) -> tuple[Sparse, Sparse]:
    row, feature = _selected(view, keys, sieve)
    ones = np.ones((len(source), 1))
    none = np.zeros(0, np.int64)
    return (Sparse(row, feature, np.hstack([view.shares(), ones]), len(keys)),
            Sparse(none, none, np.hstack([_metadata(view, source, lang), ones]), 0))


def _feature_counts(batches) -> Iterator[pa.RecordBatch]:
    """(text, low, toxic) -> per word feature the documents of each class that have it."""
    kept: list[tuple[np.ndarray, np.ndarray]] = []
    for batch in slices(batches, 0, 1 << 21):
        view = View(batch.column(0))
        low, toxic = (np.array([-1 if v is None else v for v in batch.column(i).to_pylist()], np.int64) for i in (1, 2))
        h, r = (np.concatenate(x) for x in zip(*[(h, r) for r, h in view.word_features()]))
        order = np.lexsort((r, h))
        h, r = h[order], r[order]
        if not len(h):
            continue
        lead = np.concatenate([[True], (h[1:] != h[:-1]) | (r[1:] != r[:-1])])
        h, r = h[lead], r[lead]
        start = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
        classes = np.stack([low[r] == 0, low[r] == 1, toxic[r] == 0, toxic[r] == 1], axis=1).astype(np.int64)
        kept.append((h[start], np.add.reduceat(classes, start, axis=0)))
    if kept:
        h, c = np.concatenate([k for k, _ in kept]), np.concatenate([c for _, c in kept])
        order = np.argsort(h, kind="stable")
        h, c = h[order], c[order]
        start = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
        h, c = h[start], np.add.reduceat(c, start, axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), *[pa.array(c[:, i]) for i in range(4)]], ["h", "l0", "l1", "t0", "t1"])


def _extract(batches, keys: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(text, low, toxic, source, lang) -> both views of each sampled row."""
    sieve = _sieve_of(keys)
    for batch in slices(batches, 0, 1 << 21):
        text, meta = _matrices(View(batch.column(0)), batch.column(3).to_pylist(), batch.column(4).to_pylist(), keys, sieve)
        cuts = np.searchsorted(text.row, np.arange(text.n + 1))
        features = [text.feature[a:b].astype(np.int32).tobytes() for a, b in zip(cuts[:-1], cuts[1:])]
        yield pa.RecordBatch.from_arrays(
            [batch.column(1), batch.column(2), pa.array(features, pa.binary()),
             *[pa.array([x.tobytes() for x in m.dense.astype(np.float32)], pa.binary()) for m in (text, meta)]],
            ["low", "toxic", "features", "text_dense", "meta_dense"])


def _column_or_null(df: DataFrame, name: str | None) -> Column:
    return F.col(name).cast("string") if name and name in df.columns else F.lit(None).cast("string")


def fit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        lang_col: str = "lang", max_labelled: int = 12_000, max_pool: int = 8_000, features: int = 2048, rounds: int = 3,
        per_round: int = 800, min_z: float = 3.0, l2: float = 1e-4) -> QualityModel:
    with_package(docs.sparkSession)
    marks = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("label_id")).agg(
        (1 - F.min("quality")).cast("int").alias("low"), F.max("toxic").cast("int").alias("toxic"))
    n_marks, n_docs = marks.count(), docs.count()
    place = lambda c: F.pmod(F.xxhash64(F.col(c).cast("long")), F.lit(1 << 40))
    share = lambda most, n: min(1 << 40, (1 << 40) * most // max(n, 1))
    wanted, pool = share(max_labelled, n_marks), share(max_pool, n_docs)
    marks = marks.where(place("label_id") < max(wanted, pool))
    rows = docs.where(F.col(id_col).isNotNull() & (place(id_col) < max(wanted, pool))).select(
        F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        _column_or_null(docs, source_col).alias("source"), _column_or_null(docs, lang_col).alias("lang"))
    rows = rows.join(marks, F.col("id") == F.col("label_id"), "left")
    labelled = F.col("low").isNotNull() | F.col("toxic").isNotNull()
    rows = rows.where((labelled & (place("id") < wanted)) | (~labelled & (place("id") < pool)))
    one = rows.groupBy("id").agg(F.min(F.struct(F.xxhash64("text").alias("th"), "text", "low", "toxic", "source", "lang")).alias("r"))
    sample = materialize(one.select("id", *[f"r.{c}" for c in ("text", "low", "toxic", "source", "lang")]))

    counts = sample.where(labelled).select("text", "low", "toxic").mapInArrow(_feature_counts, "h long, l0 long, l1 long, t0 long, t1 long")
    counts = counts.groupBy("h").agg(*[F.sum(c).cast("double").alias(c) for c in ("l0", "l1", "t0", "t1")])
    sizes = sample.agg(*[F.count(F.when(F.col(c) == v, 1)).alias(f"{c[0]}{v}") for c in TARGETS for v in (0, 1)]).first()

    def z(c: str) -> Column:
        n0, n1 = max(sizes[f"{c}0"], 1), max(sizes[f"{c}1"], 1)
        a, b = (F.col(f"{c}1") + 0.1) / (n1 + 0.2), (F.col(f"{c}0") + 0.1) / (n0 + 0.2)
        return F.abs(a - b) / F.sqrt(a * (1 - F.least(a, F.lit(0.999))) / n1 + b * (1 - F.least(b, F.lit(0.999))) / n0)

    scored = materialize(counts.select("h", z("l").alias("zl"), z("t").alias("zt"), (F.col("l0") + F.col("l1")).alias("n")).where("n >= 4"))
    keys = {r["h"] for c in ("zl", "zt") for r in scored.where(F.col(c) >= min_z).orderBy(F.desc(c), "h").limit(features).collect()}
    keys = np.sort(np.array(sorted(keys), np.int64).view(np.uint64))

    got = sample.select("text", "low", "toxic", "source", "lang", "id").mapInArrow(
        lambda it: _extract(it, keys), "low int, toxic int, features binary, text_dense binary, meta_dense binary")
    got = sorted((tuple(r) for r in got.collect()), key=lambda r: (bytes(r[4]), bytes(r[2]), str(r[:2])))
    model = QualityModel(keys, {t: Judge(0.0) for t in TARGETS})
    if not got:
        return model
    order = np.random.Generator(np.random.PCG64(11)).permutation(len(got))
    got = [got[i] for i in order]
    lists = [np.frombuffer(r[2], np.int32) for r in got]
    row = np.repeat(np.arange(len(got)), [len(x) for x in lists])
    dense = [np.stack([np.frombuffer(r[i], np.float32) for r in got]).astype(np.float64) for i in (3, 4)]
    none = np.zeros(0, np.int64)
    text, meta = Sparse(row, np.concatenate(lists).astype(np.int64), dense[0], len(keys)), Sparse(none, none, dense[1], 0)
    for i, name in enumerate(TARGETS):
        y = np.array([-1 if r[i] is None else r[i] for r in got], np.int64)
        model.judges[name] = _co_train(text, meta, y, rounds, per_round, l2)
    return model


def _score(batches, model: QualityModel, text_at: int, source_at: int | None, lang_at: int | None) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, text_at, 1 << 21):
        none = [None] * batch.num_rows
        source, lang = (none if i is None else batch.column(i).to_pylist() for i in (source_at, lang_at))
        p = model.probabilities(View(batch.column(text_at)), source, lang)
        yield pa.RecordBatch.from_arrays([*batch.columns, *[pa.array(p[t]) for t in TARGETS]], [*batch.schema.names, *TARGETS])


def score(docs: DataFrame, model: QualityModel, *, text_col: str = "text", source_col: str = "source", lang_col: str = "lang") -> DataFrame:
    """``docs`` with a struct ``quality_scores``: probability of low quality and of toxic text, and ``keep``."""
    with_package(docs.sparkSession)
    columns = docs.columns
    inner = [f"c{i}" for i in range(len(columns))]
    at = [columns.index(c) if c in columns else None for c in (text_col, source_col, lang_col)]
    rows = docs.toDF(*inner)
    schema = T.StructType([*rows.schema.fields, *[T.StructField(t, T.DoubleType()) for t in TARGETS]])
    out = rows.mapInArrow(lambda it: _score(it, model, *at), schema)
    keep = (F.col("low") < 0.5) & (F.col("toxic") < 0.5)
    return out.select(*[F.col(c).alias(n) for c, n in zip(inner, columns)], F.struct("low", "toxic", keep.alias("keep")).alias("quality_scores"))


def drop_rejected(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """Rows of ``docs`` that are judged neither low in quality nor toxic, columns unchanged."""
    columns = docs.columns
    rows = docs.toDF(*[f"d{i}" for i in range(len(columns))])
    names = {k: f"d{columns.index(c)}" if c in columns else None
             for k, c in (("text_col", "text"), ("source_col", "source"), ("lang_col", "lang"))}
    model = fit(rows, labels, id_col=f"d{columns.index('doc_id')}", **names, **options)
    return score(rows, model, **names).where("quality_scores.keep").drop("quality_scores").toDF(*columns)
