"""Merkle-tree fingerprints of documents, in DataFrame functions only.

The tree has four levels: a text is cut into sections at blank lines, a section into paragraphs at line
breaks, a paragraph into pieces at sentence ends (at most ``PIECE`` characters, so one very long line is not one
leaf). A piece's digest is the SHA-256 of its text; every inner node hashes its children's digests.
The root is the fingerprint: equal texts have equal roots, and comparing two trees level by level
locates edits in the branches that differ. Separators are part of the hashed structure: texts that
differ in white space only have different roots.

Defined results: a null text is the empty text, which has a tree with one empty piece. The order for
"next document" is ascending id, null ids last, rows with equal ids by text hash; repeated
rows follow each other. Ids and texts of any size are allowed; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

PIECE = 160
#: A sentence with its end marks and the blanks behind it, or a run of end marks; none longer than PIECE + 16.
PIECE_PATTERN = r"[^.!?]{1,%d}[.!?]{0,8}[ \t]{0,8}|[.!?]{1,8}[ \t]{0,8}" % PIECE


def _hash_all(digests: Column, tag: str) -> Column:
    return F.sha2(F.concat(F.lit(tag), F.concat_ws(",", digests)), 256)


def pieces(text: Column) -> Column:
    """array(section) of array(paragraph) of array(piece text)."""
    cut = lambda p: F.when(p == "", F.array(F.lit(""))).otherwise(F.regexp_extract_all(p, F.lit(PIECE_PATTERN), F.lit(0)))
    sections = F.split(F.coalesce(text, F.lit("")), "\n\n", -1)
    return F.transform(sections, lambda s: F.transform(F.split(s, "\n", -1), cut))


def tree(text: Column) -> Column:
    """array(section) of struct(digest, paragraphs: array of struct(digest, pieces: array of digests))."""
    leaves = F.transform(pieces(text), lambda s: F.transform(s, lambda p: F.transform(p, lambda x: F.sha2(x, 256))))
    paragraphs = F.transform(leaves, lambda s: F.transform(s, lambda p: F.struct(_hash_all(p, "p").alias("digest"), p.alias("pieces"))))
    return F.transform(paragraphs, lambda s: F.struct(
        _hash_all(F.transform(s, lambda p: p["digest"]), "s").alias("digest"), s.alias("paragraphs")))


def root(sections: Column) -> Column:
    return _hash_all(F.transform(sections, lambda s: s["digest"]), "d")


def leaf_digests(sections: Column) -> Column:
    return F.flatten(F.transform(sections, lambda s: F.flatten(F.transform(s["paragraphs"], lambda p: p["pieces"]))))


def likeness(a: Column, b: Column) -> Column:
    """Share of common leaves of two trees (Dice coefficient of their distinct leaf digests), 0 to 1."""
    common = F.size(F.array_intersect(a, b))
    return 2 * common / (F.size(F.array_distinct(a)) + F.size(F.array_distinct(b)))


def differing_branches(a: Column, b: Column) -> Column:
    """Places (section, paragraph, piece) of ``a``'s leaves that have no equal branch in ``b`` at any level above.

    Sections and paragraphs with a digest that occurs in ``b`` are skipped whole.
    """
    sections = F.transform(b, lambda s: s["digest"])
    paragraphs = F.flatten(F.transform(b, lambda s: F.transform(s["paragraphs"], lambda p: p["digest"])))
    leaves = leaf_digests(b)

    def of_paragraph(i, j, p):
        marked = F.transform(p["pieces"], lambda x, k: F.when(~F.array_contains(leaves, x), F.struct(
            i.alias("section"), j.alias("paragraph"), k.alias("piece"))))
        return F.when(F.array_contains(paragraphs, p["digest"]), F.filter(marked, lambda x: F.lit(False))).otherwise(
            F.filter(marked, lambda x: x.isNotNull()))

    def of_section(s, i):
        marked = F.flatten(F.transform(s["paragraphs"], lambda p, j: of_paragraph(i, j, p)))
        return F.when(F.array_contains(sections, s["digest"]), F.filter(marked, lambda x: F.lit(False))).otherwise(marked)

    return F.flatten(F.transform(a, of_section))


def fingerprints(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with a struct ``merkle``: root and tree."""
    t = tree(F.col(text_col))
    return docs.withColumn("merkle", F.struct(t.alias("sections"))).withColumn(
        "merkle", F.struct(root(F.col("merkle.sections")).alias("root"), F.col("merkle.sections").alias("sections")))


def _longs(values: list[int]) -> Column:
    """A constant array; one literal in the plan whatever its length."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def _bounds(rows: DataFrame, bucket_rows: int, sampled: int) -> list[tuple[int, int]]:
    """Least (key, th) of each bucket, ascending; the first bucket takes everything below.

    The bounds cut a sample of the pairs evenly: about ``sampled`` distinct pairs at most, chosen by their hash and
    weighted by their rows. They decide the balance of the buckets only. At most ``sampled`` / 4 buckets.
    """
    n = rows.count()
    share = (1 << 40) * min(sampled, n) // max(n, 1)
    got = rows.where(F.pmod(F.xxhash64("key", "th"), F.lit(1 << 40)) < share).groupBy("key", "th").agg(F.count(F.lit(1)).alias("n"))
    got = sorted(tuple(r) for r in got.collect())
    step = sum(r[2] for r in got) / max(min(-(-n // bucket_rows), sampled // 4), 1)
    bounds, passed = [(-(1 << 63),) * 2], 0
    for key, th, rows_of in got:
        if passed >= step * len(bounds):
            bounds.append((key, th))
        passed += rows_of
    return bounds


def with_next_text(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", bucket_rows: int = 512,
                   sampled: int = 200_000) -> DataFrame:
    """(id, text, next_text) with the text of the next row by ascending id; the last row gets the first's.

    Rows fall into ranges of (id, text hash) of about ``bucket_rows`` rows, or as many as keep the ranges within
    ``sampled`` / 4, however the ids lie and however many rows share one. Each bucket is ordered by itself; the
    first row of every bucket is also sent to the bucket before it, which closes the gaps. Texts are
    shuffled once.
    """
    top = (1 << 63) - 1
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(top)).alias("key"), F.col(id_col).alias("id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn("th", F.xxhash64("text"))
    bounds = _bounds(rows, bucket_rows, sampled)
    keys, ths = [b[0] for b in bounds], [b[1] for b in bounds]
    run = max(math.isqrt(len(bounds)), 1)

    def reached(ks: Column, ts: Column, skip: Column) -> Column:
        return F.size(F.filter(ks, lambda k, i: (k < F.col("key")) | ((k == F.col("key")) & (F.get(ts, skip + i) <= F.col("th")))))

    # Bounds reached, in two steps: whole runs of bounds first, then inside the last run begun.
    rows = rows.withColumn("skip", (reached(_longs(keys[::run]), _longs(ths[::run]), F.lit(0)) - 1) * run)
    bucket = F.col("skip") + reached(F.slice(_longs(keys), F.col("skip") + 1, F.lit(run)), _longs(ths), F.col("skip"))
    rows = rows.select("key", "id", "th", "text", bucket.cast("long").alias("bucket"))

    firsts = rows.groupBy("bucket").agg(F.min(F.struct("key", "th")).alias("f"))
    order = Window.orderBy("bucket")                              # one row per bucket, at most sampled / 4
    firsts = firsts.select("f", F.lag("bucket").over(order).alias("before"), F.max("bucket").over(
        Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("last"))
    firsts = firsts.select(F.col("f.key").alias("key"), F.col("f.th").alias("th"), F.coalesce("before", "last").alias("to"),
                           F.col("before").isNull().alias("wraps"))
    texts = rows.select("key", "th", "text").join(firsts, ["key", "th"])
    halo = texts.groupBy("to", "wraps", "key", "th").agg(F.first("text").alias("text")).select(
        F.col("key"), F.lit(None).cast(docs.schema[id_col].dataType).alias("id"), "th", "text", F.col("to").alias("bucket"),
        F.lit(True).alias("halo"), "wraps")
    both = rows.withColumns({"halo": F.lit(False), "wraps": F.lit(False)}).unionByName(halo)
    after = Window.partitionBy("bucket").orderBy("wraps", "key", "th", "halo")
    return both.withColumn("next_text", F.lead("text").over(after)).where(~F.col("halo")).select("id", "text", "next_text")


def edited_text(text: Column, following: Column) -> Column:
    """``text`` with its last quarter of code points replaced by the first as many of ``following``."""
    n = F.char_length(text)
    k = F.floor(n / 4).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - k), F.substring(following, F.lit(1), k))
