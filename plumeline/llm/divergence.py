"""Source divergence audit by count-cell ranking.

Terms are runs of letters (bytes outside ``\\x00-\\x40 \\x5B-\\x60 \\x7B-\\x7F``), only A-Z lower-cased. Each lang keeps
the V terms found in at least ``min_docs`` of its documents. A group (lang, source), and each lang, gives a kept
term with ``count`` occurrences there p = 1 + floor(scale * (count + pseudo) / (N + pseudo * V)), N being the sum of
its counts over kept terms; p is the group's price, q the other side's and f = abs(p - q).

* Terms: f depends on (group count, lang count) alone, so terms are grouped by that cell, f is evaluated once a
  cell, equal values merge and the values are ranked by cumulative multiplicity. Only the values that can hold a
  rank up to ``top`` (at most ``top`` of them, every value has a term) are expanded again into their terms, in
  UTF-8 order; the last one's surplus is left out by a partial top-k before the shuffle.
* Pairs: sum of f over all kept terms for each other source of the lang. Kept terms go to buckets of about
  ``bucket_terms``; each bucket adds one partial sum per pair of sources (absent terms at the price of count 0), so no
  task holds a lang. The pairs of a lang's sources are the result asked for; terms are never paired.

Scale: documents are counted where they lie, with exact words, and one row per (lang, source, term) and run of texts
goes to the shuffle, however hot a source or term is. All arithmetic is exact (decimals of 38 digits, 64-bit prices).

Defined results: null text, lang or source reads as ''. A group without terms still has its pairs; with V = 0 every
pair's value is 0 and there are no term rows. Repeated rows are separate documents. A lang of one source has no
pairs. An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumeline.llm.runtime import materialize, with_package
from plumeline.llm.textkernels import slices

FLUSH = 300_000                           # distinct terms a task holds before it sends them on
BLOCK = 512                               # terms compared at a time in a bucket
_BLANK = {*range(0x00, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)}
_FOLD = bytes(0x20 if c in _BLANK else c + 32 if 0x41 <= c <= 0x5A else c for c in range(256))


def _parts(raw: bytes, size: int = 1 << 22) -> Iterator[bytes]:
    """A folded text in runs of about ``size`` bytes that never cut a term."""
    at = 0
    while at < len(raw):
        end = raw.find(b" ", at + size)
        end = len(raw) if end < 0 else end
        yield raw[at:end]
        at = end


def _sent(counts: dict[tuple[str, str], tuple[Counter, Counter]]) -> Iterator[pa.RecordBatch]:
    for (lang, source), (total, docs) in counts.items():
        terms = pa.array(list(total), pa.binary()).cast(pa.string())
        n = len(terms)
        yield pa.RecordBatch.from_arrays(
            [pa.repeat(pa.scalar(lang, pa.string()), n), pa.repeat(pa.scalar(source, pa.string()), n), terms,
             pa.array(list(total.values()), pa.int64()), pa.array([docs[t] for t in total], pa.int64())],
            ["lang", "source", "term", "n", "docs"])


def _count(batches) -> Iterator[pa.RecordBatch]:
    """(lang, source, text) -> occurrences and documents of each term per group, for a run of texts."""
    counts: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    held = 0
    for batch in slices(batches, 2):
        for lang, source, text in zip(*(c.to_pylist() for c in batch.columns)):
            total, docs = counts.setdefault((lang, source), (Counter(), Counter()))
            before, seen = len(total), set()
            for part in _parts(text.encode().translate(_FOLD)):
                words = part.split()
                total.update(words)
                seen.update(words)
            docs.update(seen)
            held += len(total) - before
            if held > FLUSH:
                yield from _sent(counts)
                counts, held = {}, 0
    yield from _sent(counts)


def _price(n: Column | str, total: str, terms: str, pseudo: int, scale: int) -> Column:
    """1 + floor(scale * (n + pseudo) / (total + pseudo * terms)), exact for counts of up to 20 digits; NULL without terms."""
    n = F.col(n) if isinstance(n, str) else n
    more = F.lit(pseudo).cast("decimal(4,0)")
    above = F.lit(scale).cast("decimal(10,0)") * (n.cast("decimal(20,0)") + more)
    below = F.col(total).cast("decimal(20,0)") + more * F.col(terms).cast("decimal(20,0)")
    return F.when(below > 0, F.lit(1).cast("long") + F.call_function("div", above, below))


def _distances(found: pa.Table) -> pa.Table:
    """One bucket of terms of a lang: sum of abs(p - q) over its terms for each pair of sources (a before b).

    Rows without a term give every source of the lang and its price of a term it does not have.
    """
    lang = found.column("lang")[0]
    base = pc.is_null(found.column("term"))
    own, rest = found.filter(base), found.filter(pc.invert(base))
    names = own.column("source").to_pylist()
    order = sorted(range(len(names)), key=lambda i: names[i].encode())
    names = [names[i] for i in order]
    floor = own.column("p").to_numpy().astype(np.int64)[order]
    place = {s: i for i, s in enumerate(names)}
    rows = np.array([place[s] for s in rest.column("source").to_pylist()], np.int64)
    codes = rest.column("term").combine_chunks().dictionary_encode()
    cols = codes.indices.to_numpy().astype(np.int64) if len(rest) else np.zeros(0, np.int64)
    price = rest.column("p").to_numpy().astype(np.int64)
    n_terms = len(codes.dictionary) if len(rest) else 0
    out = [np.zeros(len(names) - i - 1, np.int64) for i in range(len(names))]
    for lo in range(0, n_terms, BLOCK):
        here = (cols >= lo) & (cols < lo + BLOCK)
        table = np.repeat(floor[:, None], min(BLOCK, n_terms - lo), axis=1)
        table[rows[here], cols[here] - lo] = price[here]
        for i in range(len(names) - 1):
            out[i] += np.abs(table[i + 1:] - table[i]).sum(axis=1)
    n = np.arange(len(names) - 1, -1, -1)
    a = pa.array(names, pa.string()).take(pa.array(np.repeat(np.arange(len(names)), n)))
    b = pa.array(names, pa.string()).take(pa.array(np.concatenate([np.arange(i + 1, len(names)) for i in range(len(names))])))
    return pa.table({"lang": pa.repeat(lang, len(a)), "a": a, "b": b, "value": pa.array(np.concatenate(out))})


def _text(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def source_divergence(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
                      min_docs: int = 30, pseudo: int = 5, scale: int = 10 ** 9, top: int = 50,
                      bucket_terms: int = 512) -> DataFrame:
    """(lang, source, part, item, value, rank): part ``pair`` for the other sources of the lang, part ``term`` for the
    terms the source uses more than its lang."""
    with_package(docs.sparkSession)
    rows = docs.select(_text(lang_col).alias("lang"), _text(source_col).alias("source"), _text(text_col).alias("text"))
    counted = rows.mapInArrow(_count, "lang string, source string, term string, n long, docs long")
    per_group = counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    same = Window.partitionBy("lang", "term")
    kept = materialize(
        per_group.select("lang", "source", "term", "n", F.sum("n").over(same).alias("lang_n"), F.sum("docs").over(same).alias("docs"),
                         F.row_number().over(same.orderBy("source")).alias("place"))
        .where(F.col("docs") >= min_docs).drop("docs"))
    own = kept.groupBy("lang", "source").agg(F.sum("n").alias("own_total"))
    whole = kept.groupBy("lang").agg(F.sum("n").alias("lang_total"), F.count_if(F.col("place") == 1).alias("n_terms"))
    totals = materialize(
        rows.select("lang", "source").distinct().join(own, ["lang", "source"], "left").join(whole, "lang", "left")
        .select("lang", "source", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("own_total", "lang_total", "n_terms")]))
    price = lambda n, total: _price(n, total, "n_terms", pseudo, scale)

    cells = (kept.groupBy("lang", "source", "n", "lang_n").agg(F.count(F.lit(1)).alias("many")).join(totals, ["lang", "source"])
             .withColumn("value", price("n", "own_total") - price("lang_n", "lang_total")).where("value > 0")
             .select("lang", "source", "n", "lang_n", "value", "many"))
    highest = Window.partitionBy("lang", "source").orderBy(F.col("value").desc())
    values = (cells.groupBy("lang", "source", "value").agg(F.sum("many").alias("many"))
              .withColumn("place", F.row_number().over(highest)).where(F.col("place") <= top)
              .withColumn("before", F.coalesce(F.sum("many").over(highest.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
              .where(F.col("before") < top).select("lang", "source", "value"))
    chosen = cells.join(values, ["lang", "source", "value"]).select("lang", "source", "n", "lang_n", "value")
    terms = kept.join(chosen, ["lang", "source", "n", "lang_n"]).select("lang", "source", F.col("term").alias("item"), "value")
    ranked = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    terms = terms.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= top)

    most = totals.agg(F.max("n_terms")).first()[0] or 0
    n_buckets = max(1, -(-most // bucket_terms))
    bucket = F.pmod(F.xxhash64("term"), F.lit(n_buckets))
    priced = kept.join(totals, ["lang", "source"]).select("lang", "source", "term", price("n", "own_total").alias("p"), bucket.alias("bucket"))
    zero = F.coalesce(price(F.lit(0), "own_total"), F.lit(0).cast("long"))
    used = F.sequence(F.lit(0).cast("long"), F.when(F.col("n_terms") > 0, F.lit(n_buckets - 1).cast("long")).otherwise(F.lit(0).cast("long")))
    bases = totals.select("lang", "source", F.lit(None).cast("string").alias("term"), zero.alias("p"), F.explode(used).alias("bucket"))
    sums = (priced.unionByName(bases).groupBy("lang", "bucket").applyInArrow(_distances, "lang string, a string, b string, value long")
            .groupBy("lang", "a", "b").agg(F.sum("value").alias("value")))
    sides = F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item"))))
    pairs = sums.select("lang", "value", sides.alias("s")).select("lang", "s.source", "s.item", "value").withColumn("rank", F.row_number().over(ranked))
    parts = [df.select("lang", "source", F.lit(name).alias("part"), "item", F.col("value").cast("long").alias("value"), F.col("rank").cast("int").alias("rank"))
             for name, df in (("pair", pairs), ("term", terms))]
    return parts[0].unionByName(parts[1])
