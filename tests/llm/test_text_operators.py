"""SimHash near-dedup, substring dedup and decontamination against brute force on whole small corpora."""

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from plumeline.llm import decontam, simhash, substring
from tests.llm.conftest import words

SPACED, ALNUM = re.compile(r"[^\x20\x09-\x0D]+"), re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
BIG = (1 << 63) - 1


def lower(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")


def fingerprint(text, k=3):
    w = SPACED.findall(lower(text))
    grams = [" ".join(w[i:i + k]) for i in range(len(w) - k + 1)] or ([" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(values, max_bits=3):
    """Number of the group of each (id, fingerprint)."""
    parent = list(range(len(values)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i in range(len(values)):
        for j in range(i):
            if bin(values[i][1] ^ values[j][1]).count("1") <= max_bits:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(values))]


def components(values, max_bits=3):
    """Smallest id reachable for each (id, fingerprint)."""
    own = roots(values, max_bits)
    return [min(values[j][0] for j in range(len(values)) if own[j] == own[i]) for i in range(len(values))]


def test_simhash_matches_brute_force(docs, rows):
    got = simhash.near_duplicates(docs).collect()
    values = [(BIG if r[0] is None else r[0], fingerprint(r[1])) for r in rows]
    want = sorted((i, f - (1 << 64) if f >> 63 else f, c) for (i, f), c in zip(values, components(values)))
    assert sorted((r["id"], r["fp"], r["first_id"]) for r in got) == want


def test_simhash_keeps_one_row_per_group(wide, rows):
    kept = simhash.drop_near_duplicates(wide)
    assert kept.columns == wide.columns and kept.dtypes == wide.dtypes
    values = [(BIG if r[0] is None else r[0], fingerprint(r[1])) for r in rows]
    assert kept.count() == len(set(roots(values)))


def test_cover_reaches_every_pair_within_the_threshold():
    rng = np.random.default_rng(3)
    cover = simhash.HammingCover(1)
    x = rng.integers(0, 1 << 31, 500, dtype=np.uint64)
    for flips in (0, 1):
        y = x.copy()
        if flips:
            y ^= np.uint64(1) << rng.integers(0, 31, 500, dtype=np.uint64)
        row, anchor, home = cover.anchors(x)
        homes = dict(zip(row[home].tolist(), anchor[home].tolist()))
        row, anchor, _ = cover.anchors(y)
        reach = {}
        for r, a in zip(row.tolist(), anchor.tolist()):
            reach.setdefault(r, set()).add(a)
        assert all(homes[r] in reach[r] for r in range(500))


@pytest.mark.parametrize("max_bits", [0, 1, 2, 3, 5])
def test_links_connect_dense_groups_without_all_pairs(spark, docs, max_bits):
    rng = np.random.default_rng(max_bits)
    base = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    fps = set(base.tolist())
    for b in base[:4].tolist():                                 # dense neighbourhoods
        for _ in range(120):
            fps.add(b ^ sum(1 << int(k) for k in rng.choice(64, int(rng.integers(0, 5)), replace=False)))
    fps = sorted(fps)
    df = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long")
    links = simhash.fingerprint_links(df, max_bits).collect()
    to = lambda v: v % (1 << 64)
    assert all(bin(to(r["u"]) ^ to(r["v"])).count("1") <= max_bits for r in links)
    index = {f: i for i, f in enumerate(fps)}
    want = components([(i, f) for i, f in enumerate(fps)], max_bits)
    parent = list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for r in links:
        a, b = find(index[to(r["u"])]), find(index[to(r["v"])])
        parent[max(a, b)] = min(a, b)
    assert [find(i) for i in range(len(fps))] == want
    if max_bits == 3:
        assert len(links) < 40 * len(fps)                       # at most a tree per anchor


def test_large_run_is_cut_without_losing_links(monkeypatch):
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 30, dtype=np.uint64)
    fps = np.unique(np.concatenate([base, base ^ np.uint64(7), base ^ np.uint64(1 << 60)]))
    monkeypatch.setattr(simhash, "_LARGE", 10)
    pairs = {tuple(sorted(p)) for u, v in simhash._links_of_run(fps, 3) for p in zip(u.tolist(), v.tolist())}
    labels = components([(i, int(f)) for i, f in enumerate(fps.tolist())])
    index = {f: i for i, f in enumerate(fps.tolist())}
    assert all(labels[index[a]] == labels[index[b]] for a, b in pairs)
    assert {labels[index[a]] for a, _ in pairs} == {x for x in labels if labels.count(x) > 1}


def removed(rows, window=13):
    """Words covered by a window that also starts in a document with a smaller id."""
    lists = [(BIG if r[0] is None else r[0], SPACED.findall(r[1] or "")) for r in rows]
    least = {}
    for i, w in lists:
        for p in range(len(w) - window + 1):
            k = tuple(w[p:p + window])
            least[k] = min(least.get(k, i), i)
    out = []
    for i, w in lists:
        gone = [False] * len(w)
        for p in range(len(w) - window + 1):
            if least[tuple(w[p:p + window])] < i:
                gone[p:p + window] = [True] * window
        out.append((i, len(w), sum(gone), [x for x, g in zip(w, gone) if not g]))
    return out


@pytest.mark.parametrize("window,slice_bytes,bucket_words", [(13, 8 << 20, 3_000_000), (13, 300, 50), (4, 1000, 100), (1, 500, 100)])
def test_substring_dedup_matches_brute_force(docs, rows, window, slice_bytes, bucket_words):
    got = substring.remove_repeats(docs, window=window, slice_bytes=slice_bytes, bucket_words=bucket_words).collect()
    have = sorted((BIG if r["doc_id"] is None else r["doc_id"], r["repeats"]["n_words"], r["repeats"]["n_removed"],
                   SPACED.findall(r["text"] or "")) for r in got)
    assert have == sorted(removed(rows, window))


def test_substring_dedup_answers_all_texts_that_share_the_smallest_id_of_a_slice(spark):
    rng = random.Random(4)
    passage = words(rng, 30)
    rows = [(1, words(rng, 5) + " " + passage)]
    rows += [(i, f"{words(rng, 6)} {passage} {words(rng, 6)}") for i in [None, 9] for _ in range(20)]
    got = substring.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), slice_bytes=1500).collect()
    have = sorted((BIG if r["doc_id"] is None else r["doc_id"], r["repeats"]["n_words"], r["repeats"]["n_removed"], r["text"].split()) for r in got)
    assert have == sorted(removed(rows))


def test_substring_entries_answered_in_a_slice_go_to_many_groups(spark):
    text = words(random.Random(6), 40)
    docs = spark.range(64).repartition(16).selectExpr("id AS key", "id", f"'{text}' AS text")
    packs = docs.mapInArrow(lambda it: substring._probe(it, 13, 7, 8, 4 << 20, 3), "bucket int, payload binary")
    assert packs.where("bucket < 0").select("bucket").distinct().count() >= 4


def test_substring_dedup_keeps_columns_and_untouched_texts(docs, wide, rows):
    cut = substring.cut_repeats(wide)
    assert cut.dtypes == wide.dtypes and cut.count() == len(rows)
    out = substring.remove_repeats(docs)
    assert out.columns == [*docs.columns, "repeats"]
    same = {(r[0], r[1]) for r in rows}
    for r in out.collect():
        if not r["repeats"]["n_removed"]:
            assert (r["doc_id"], r["text"]) in same
        spans = sum(b - a for a, b in zip(r["repeats"]["span_starts"], r["repeats"]["span_ends"]))
        assert spans == r["repeats"]["n_removed"]


ITEMS = [(1, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho"),
         (2, "Short item, three!"), (3, ""), (None, "nothing here but a null id"), (4, "short ITEM three"), (3, None),
         (9, "the the the the the the the the the the the the the the")]


def decontam_docs(rows):
    extra = [(500, "x y alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu z"),
             (501, "ALPHA beta-gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho " + "w " * 400),
             (502, "a short item, three. short item three"), (503, "the " * 40), (504, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"),
             (505, "say: nothing here but a null id!")]
    return [*rows, *[(i, t, None, None, None) for i, t in extra]]


def contamination(rows, items, window=13):
    grams = {}
    for i, t in items:
        w = ALNUM.findall(lower(t))
        for p in range(max(len(w) - window + 1, min(len(w), 1))):
            grams.setdefault(tuple(w[p:p + window]), set()).add("" if i is None else str(i))
    out = []
    for i, t, *_ in rows:
        w = ALNUM.findall(lower(t))
        hit, ids = [False] * len(w), set()
        for p in range(len(w)):
            for g, own in grams.items():
                if tuple(w[p:p + len(g)]) == g:
                    ids |= own
                    hit[p:p + len(g)] = [True] * len(g)
        out.append((-1 if i is None else i, len(w), sum(hit), sorted(ids), sum(hit) > 0 and 20 * sum(hit) >= len(w)))
    return sorted(out)


@pytest.mark.parametrize("block_bytes", [8 << 20, 150])
def test_decontamination_matches_brute_force(spark, docs, rows, block_bytes):
    data = decontam_docs(rows)
    df = spark.createDataFrame(data, docs.schema).repartition(3)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    out = decontam.benchmark_hits(df, items, block_bytes=block_bytes)
    rule = decontam.contamination("benchmark_hits")
    got = out.select("doc_id", "benchmark_hits.*", *[c.alias(n) for n, c in rule.items()]).collect()
    assert sorted((-1 if r["doc_id"] is None else r["doc_id"], r["n_words"], r["n_hit"], r["items"], r["contaminated"]) for r in got) \
        == contamination(data, ITEMS)


def test_decontamination_filter_and_empty_benchmark(spark, wide, rows):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    clean = decontam.drop_contaminated(wide, items)
    assert clean.dtypes == wide.dtypes
    assert clean.count() == sum(not r[4] for r in contamination(rows, ITEMS))
    assert decontam.drop_contaminated(wide, items.limit(0)).count() == wide.count()


def test_empty_tables(empty, spark):
    assert simhash.near_duplicates(empty).count() == 0
    assert simhash.drop_near_duplicates(empty).count() == 0
    assert substring.remove_repeats(empty).count() == 0
    assert decontam.drop_contaminated(empty, spark.createDataFrame(ITEMS, "item_id long, text string")).count() == 0


def test_query_digest_of_kept_words(spark, docs, rows):
    out = substring.remove_repeats(docs)
    kept = F.trim(F.regexp_replace(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+", " "))
    got = sorted(r[0] for r in out.select(F.sha2(kept, 256)).collect())
    assert got == sorted(hashlib.sha256(" ".join(r[3]).encode()).hexdigest() for r in removed(rows))


def _twins(n: int) -> tuple[str, str]:
    """Two different words of n letters a and b that every polynomial hash modulo 2^64 takes for equal (n >= 2048)."""
    bits = [0]
    while len(bits) < n:
        bits += [1 - b for b in bits]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


def test_words_built_to_collide_are_different_words(spark):
    from plumeline.llm.substring import remove_repeats

    one, other = _twins(2048)
    tail = " ".join(f"w{i}" for i in range(12))
    df = spark.createDataFrame([(1, f"{one} {tail}"), (2, f"{other} {tail}"), (3, f"{one} {tail}")], "doc_id long, text string")
    assert {r.doc_id: r.repeats.n_removed for r in remove_repeats(df).collect()} == {1: 0, 2: 0, 3: 13}


def test_token_memory_tells_colliding_words_apart():
    import public_tokenizers

    from plumeline.llm.tokens import TextEncoder

    own = TextEncoder(public_tokenizers.path("byte_bpe_50k.json"))
    for texts in (list(_twins(2048)), [" ".join(_twins(4096)), "é" * 1500 + " " + "ñ" * 40, "", "日本 x"]):
        ids, cuts = own.encode(texts)
        assert [ids[a:b].tolist() for a, b in zip(cuts[:-1], cuts[1:])] == [own.library.encode(t, add_special_tokens=False).ids for t in texts]


def test_colliding_window_hashes_are_told_apart_by_the_other_bits():
    import numpy as np

    from plumeline.llm.substring import _grouped

    order, changes = _grouped(np.array([7, 7, 3, 7], np.uint64), np.array([1, 2, 9, 1], np.uint16))
    assert order.tolist() == [2, 0, 3, 1] and changes.tolist() == [True, False, True]
