"""Language identification, quality classifier, license scan and the pipeline: held-out accuracy and brute force."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
import corpus_pipeline
from plumeline.llm import langid, licenses, quality
from plumeline.llm.runtime import table
from tests.llm.conftest import words

SF = "/root/testdata/sf0.01"


# ---- language -------------------------------------------------------------------------------------------------------

def test_presence_kernel_counts_shared_grams():
    import pyarrow as pa
    texts = ["abcab", "ABCAB", "xyz", "", None]
    sets = langid.presence(pa.array(texts), 16, 3)
    grams = [{t.lower()[i:i + n] for n in (1, 2, 3) for i in range(len(t) - n + 1)} for t in (x or "" for x in texts)]
    assert (sets.astype(int) @ sets.T.astype(int)).tolist() == [[len(a & b) for b in grams] for a in grams]


def test_held_out_language_accuracy(spark):
    out = E.queries()["op3_language_id"](spark, SF).toPandas()
    docs = table(spark, SF, "documents").select("doc_id", "lang", "text").toPandas().merge(out, on="doc_id")
    assert len(docs) == len(out)
    assert (docs.held_out == [zlib.crc32(str(i).encode()) % 4 == 2 for i in docs.doc_id]).all()
    held = docs[docs.held_out & docs.lang.notna()]
    assert (held.lang == held.lang_pred).mean() > 0.97
    assert docs.score.between(0, 1).all()


def test_long_held_out_texts_keep_their_language(spark):
    docs = table(spark, "/root/testdata/sf0.1", "documents").where("lang is not null and text is not null").select("doc_id", "lang", "text")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    model = langid.fit(docs.where(~held), id_col="doc_id", text_col="text", label_col="lang")
    texts = docs.where(held).toPandas().groupby("lang").text.agg(lambda x: (" ".join(x) * 3)[:3_000_000])
    assert len(texts) == 4 and texts.map(len).min() > 1_000_000
    rows = [(lang, text[:n]) for lang, text in texts.items() for n in (1_000, 100_000, 1_000_000, 3_000_000)]
    out = langid.predict(spark.createDataFrame(rows, "lang string, text string"), model).select("lang", "language.lang_pred").collect()
    assert len(out) == 16 and all(r["lang"] == r["lang_pred"] for r in out)


def test_every_label_is_learned(spark):
    rng = random.Random(8)
    letters = [rng.sample("abcdefghijklmnopqrstuvwxyz", 4) for _ in range(90)]
    rows = [(i * 20 + j, f"l{i:02}", " ".join("".join(rng.choices(own, k=5)) for _ in range(30)))
            for i, own in enumerate(letters) for j in range(8 if i % 2 else 6)]
    df = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    model = langid.fit(df, id_col="doc_id", text_col="text", label_col="lang", per_label=4)
    assert model.labels == [f"l{i:02}" for i in range(90)]
    out = langid.predict(df, model).select("lang", "language.lang_pred").collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in out]) > 0.9


def test_long_labelled_texts_are_learned_whole():
    """The set of a long text: places of at least half of its pieces, not of one piece."""
    import pyarrow as pa
    rng = random.Random(4)
    texts = [words(rng, 40), "", words(rng, 60) + " " + "zq" * 300 + " " + words(rng, 60)]
    for size, several in ((1 << 13, False), (64, True)):
        sets = np.unpackbits(langid.whole_sets(pa.array(texts), 12, 4, size), axis=1)
        for text, got in zip(texts, sets):
            parts, _ = langid.pieces(pa.array([text]), 4, size)
            grams = langid.presence(parts, 12, 4)
            assert len(grams) == (max(-(-len(text.encode()) // size), 1)) and (several or len(grams) == 1)
            assert (got == (2 * grams.sum(axis=0, dtype=int) >= len(grams))).all()


def test_sample_of_many_labels_is_bounded(spark):
    df = spark.createDataFrame([(i, f"wort {i} und {i % 50}", f"l{i % 50}") for i in range(2000)], "doc_id long, text string, lang string")
    model = langid.fit(df, id_col="doc_id", text_col="text", label_col="lang", max_rows=100, label_landmarks=1)
    assert len(model.labels) == 50 and model.landmarks.shape[1] <= 192


def test_language_edge_cases(spark, wide, empty):
    model = langid.fit(wide.where("lang is not null"), id_col="doc_id", text_col="text", label_col="lang")
    out = langid.predict(wide, model)
    assert out.columns == [*wide.columns, "language"]
    for r in out.select("text", "language.*").collect():
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "und") == (not letters) and (letters or r["score"] == 0)
    assert langid.fit(empty, id_col="doc_id", text_col="text", label_col="lang") is None
    assert {r["lang_pred"] for r in langid.predict(wide, None).select("language.lang_pred").collect()} == {"und"}
    assert langid.predict(empty, model).count() == 0


# ---- quality --------------------------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def judged(spark):
    """Good prose, shouted junk and texts with one of a few abusive stems."""
    rng = random.Random(9)
    rows, labels = [], []
    for i in range(900):
        text, low, toxic = words(rng, rng.randint(30, 200)), i % 7 == 0, i % 9 == 1
        if low:
            text = " ".join(w.upper() + "!!" for w in text.split())
        if toxic:
            text = text.replace(" ", f" vulgo{rng.choice(['st', 'rn', 'x', 'mm'])} ", 3)
        rows.append((i, text, "en", f"src{i % 5}", len(text)))
        if i % 3:
            labels.append((i, 0 if low else 1, 1 if toxic else 0))
    labels += [(None, 1, 0), (5, None, None), (100000, 0, 1), labels[0]]
    return (spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), rows)


def test_unlabelled_documents_are_judged_right(judged):
    docs, labels, rows = judged
    out = {r["doc_id"]: r for r in quality.score(docs, quality.fit(docs, labels)).select("doc_id", "quality_scores.*").collect()}
    fresh = [r[0] for r in rows if r[0] % 3 == 0]
    low = [out[i]["low"] >= 0.5 for i in fresh]
    toxic = [out[i]["toxic"] >= 0.5 for i in fresh]
    assert np.mean([a == (i % 7 == 0) for a, i in zip(low, fresh)]) > 0.97
    assert np.mean([a == (i % 9 == 1) for a, i in zip(toxic, fresh)]) > 0.97
    assert all(r["keep"] == (r["low"] < 0.5 and r["toxic"] < 0.5) for r in out.values())


def test_fitted_features_do_not_depend_on_the_partitions(spark, judged):
    docs, labels, _ = judged
    names = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")
    before, found = [spark.conf.get(n) for n in names], []
    try:
        spark.conf.set(names[1], "false")
        for n in (1, 200):                                       # the sample comes out of a join with n partitions
            spark.conf.set(names[0], str(n))
            found.append(quality.fit(docs.repartition(n), labels).keys.tolist())
    finally:
        for n, v in zip(names, before):
            spark.conf.set(n, v)
    assert found[0] and found[0] == found[1]


def test_sample_is_bounded_when_ids_repeat(spark, monkeypatch):
    """One labelled id on most rows gives one sampled row, the others are sampled within the bound."""
    seen = []
    keep = quality.materialize
    monkeypatch.setattr(quality, "materialize", lambda df: seen.append(keep(df)) or seen[-1])
    rng = random.Random(8)
    rows = [(1, f"{i} " + words(rng, 5), "en", "web") for i in range(3000)] + [(i, words(rng, 8), "en", "web") for i in range(2, 400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(4)
    labels = spark.createDataFrame([(i, i % 2, i % 3 == 0 and 1 or 0) for i in range(1, 400)], "doc_id long, quality long, toxic long")
    for bound in (100, 10_000):
        seen.clear()
        quality.fit(docs, labels, max_labelled=bound, max_pool=100, rounds=1)
        got = seen[0].groupBy("id").count().collect()
        assert all(r["count"] == 1 for r in got) and len(got) <= (160 if bound == 100 else 399)
    assert {r["id"] for r in got} == set(range(1, 400))


def test_quality_edge_cases(spark, judged, wide, empty):
    docs, labels, _ = judged
    model = quality.fit(docs, labels)
    assert quality.score(wide, model).count() == wide.count()
    kept = quality.drop_rejected(wide, labels)
    assert kept.dtypes == wide.dtypes
    assert quality.drop_rejected(wide, labels.limit(0)).count() == wide.count()
    assert quality.drop_rejected(empty, labels).count() == 0
    assert quality.score(docs.select("doc_id", "text"), model).where("quality_scores.low between 0 and 1").count() == docs.count()


def test_pseudo_labels_are_exchanged_between_views():
    rng = np.random.default_rng(0)
    n = 1200
    y = rng.integers(0, 2, n)
    none = np.zeros(0, np.int64)
    dense = lambda *c: np.stack([*c, np.ones(n)], axis=1)
    a = quality.Sparse(none, none, dense(y * 2.0 - 1 + rng.normal(0, 0.4, n)), 0)
    b = quality.Sparse(none, none, dense(y * 2.0 - 1 + rng.normal(0, 0.4, n)), 0)
    known = np.where(np.arange(n) < 80, y, -1)
    judge = quality._co_train(a, b, known, rounds=3, per_round=200, l2=1e-4)
    assert ((judge.probability(a, b) >= 0.5) == y).mean() > 0.97


# ---- licenses -------------------------------------------------------------------------------------------------------

def test_license_lines_and_edited_notices_are_found_with_their_spans(spark, wide):
    rng = random.Random(3)
    mit = licenses.TEMPLATES["MIT"]
    edited = mit.replace("free of charge", "at no charge").replace("sublicense, ", "")
    rows, want = [], []
    for i, (name, body) in enumerate([("MIT", mit), ("MIT", edited), ("MIT line", "Released under the MIT License."),
                                      ("GPL-3.0 line", "this WORK is licensed under the GNU\ngeneral public license, version 3")]):
        lead = words(rng, 40) + "\né "
        rows.append((i, lead + body + "\n" + words(rng, 30)))
        want.append((i, name, len(lead), len(lead) + len(body.rstrip("."))))
    rows += [(9, None), (10, ""), (11, "permission is granted to nobody"), (12, "Released under the MIT License. x " * 3)]
    out = licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    got = {(r["id"], r["license"], r["start_char"], r["end_char"]) for r in out}
    assert set(want) <= got
    assert {r["id"] for r in out} == {0, 1, 2, 3, 12}
    assert sum(r["id"] == 12 and r["license"] == "MIT line" for r in out) == 3
    coverage = {r["id"]: r["coverage"] for r in out if r["license"] == "MIT"}
    assert coverage[0] == 1 and 0.9 < coverage[1] < 1
    assert licenses.scan_licenses(wide).count() == 0


def full_alignment(doc, template):
    """Score and matched words of the best local alignment, over the whole table."""
    h = np.zeros((len(template) + 1, len(doc) + 1), int)
    m = np.zeros_like(h)
    for i in range(1, len(template) + 1):
        for j in range(1, len(doc) + 1):
            same = doc[j - 1] == template[i - 1]
            ways = [(h[i - 1, j - 1] + (2 if same else -1), m[i - 1, j - 1] + same), (h[i - 1, j] - 1, m[i - 1, j]), (h[i, j - 1] - 1, m[i, j - 1])]
            h[i, j], m[i, j] = max(max(ways), (0, 0))
    at = np.unravel_index(np.argmax(h), h.shape)
    return int(h[at]), int(m[at])


def test_alignment_matches_a_full_table():
    rng = np.random.default_rng(2)
    for _ in range(40):
        template = rng.integers(0, 50, 30).astype(np.uint64)
        docs = [np.concatenate([rng.integers(60, 90, 5), np.delete(template, rng.integers(0, 30, 3)), rng.integers(60, 90, 5)]).astype(np.uint64)
                for _ in range(5)]
        ends = np.cumsum([len(d) for d in docs])
        first = ends - [len(d) for d in docs]
        got = licenses.align(np.concatenate(docs), first, ends, template, np.full(5, 5), 40)      # a band as wide as the table
        for doc, (words_at, places) in zip(docs, got):
            assert (doc[words_at] == template[places]).all()
            assert (np.diff(words_at) > 0).all() and (np.diff(places) > 0).all()
            span, other = words_at[-1] - words_at[0] + 1 - len(words_at), places[-1] - places[0] + 1 - len(places)
            assert 2 * len(words_at) - max(span, other) >= full_alignment(doc, template)[0] >= 2 * len(words_at) - span - other


def test_license_scan_matches_full_tables_over_all_templates(spark):
    """Every template, edited: the scan names the license that the full table over all templates names."""
    import re
    rng = random.Random(8)
    cut = {n: re.findall("[0-9a-z]+", t.lower()) for n, t in licenses.TEMPLATES.items()}
    rows, want = [], {}
    for i, name in enumerate(sorted(cut)):
        body = list(cut[name])
        naming = set(re.findall("[0-9a-z]+", name.lower().split(" ")[0]))
        if len(body) > 25:                                     # two words replaced, one left out, away from the ends
            a, b, c = sorted(rng.sample([k for k in range(8, len(body) - 8) if body[k] not in naming], 3))
            body[a], body[b] = f"zz{a}", f"zz{b}"
            del body[c]
        doc = [f"qq{k}" for k in range(rng.randrange(20))] + body + ["ww"] * rng.randrange(9)
        rows.append((i, " ".join(doc)))
        near = {n: full_alignment(body, t)[1] for n, t in cut.items() if set(t) & set(body)}
        full = {n for n in near if near[n] >= 0.6 * len(cut[n]) and set(re.findall("[0-9a-z]+", n.lower().split(" ")[0])) & set(cut[n]) <= set(body)}
        want[i] = max(full, key=lambda n: (near[n], near[n] / len(cut[n])))
        want[i] = (want[i], near[want[i]])
    out = licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).where("complete").collect()
    best = {}
    for r in out:
        best[r["id"]] = max(best.get(r["id"], (0, "")), (r["matched_words"], r["license"]))
    assert {i: (n, m) for i, (m, n) in best.items()} == want


def test_sibling_licenses_split_notices_and_partial_texts(spark):
    mpl = licenses.TEMPLATES["MPL-2.0 notice"].split()
    rows = [(0, "This work is licensed under the GNU General Public License, version 2."), (1, "Licensed under CC BY-SA 4.0"),
            (2, " ".join(mpl[:15] + ["x%d" % i for i in range(12)] + mpl[15:])), (3, "Licensed under the MIT License or the Apache License, Version 2.0"),
            (4, "This work is licensed under the GNU General Public License, version 4"), (5, licenses.TEMPLATES["MIT"][:200]),
            (6, licenses.TEMPLATES["Apache-2.0 notice"]), (7, licenses.TEMPLATES["BSD-2-Clause"]), (8, licenses.TEMPLATES["BSD-3-Clause"])]
    out = licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    of = lambda i: {(r["license"], r["complete"]) for r in out if r["id"] == i}
    assert of(0) == {("GPL-2.0 line", True)} and of(1) == {("CC-BY-SA-4.0 line", True)}
    assert [(r["license"], r["coverage"], r["parts"], r["end_word"] - r["start_word"]) for r in out if r["id"] == 2] == [("MPL-2.0 notice", 1, 2, 52)]
    assert of(3) == {("MIT licensed line", True), ("Apache-2.0 line", True)}
    assert all(not complete for _, complete in of(4)) and of(4)                     # no such version: not taken for a sibling
    assert len(of(5)) == 1 and not next(iter(of(5)))[1]
    assert of(6) == {("Apache-2.0 notice", True)} and of(7) == {("BSD-2-Clause", True)} and of(8) == {("BSD-3-Clause", True)}


def test_license_scan_of_empty_tables_and_long_words(spark, empty):
    assert licenses.scan_licenses(empty).count() == 0
    long = "a" * 5000
    rows = [(1, f"{long} Released under the MIT License. {long}"), (1, f"{long} Released under the MIT License. {long}"), (None, long)]
    out = licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert [(r["id"], r["license"], r["start_word"]) for r in out] == [(1, "MIT line", 1)] * 2
    assert licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string"), {}).count() == 0


# ---- pipeline -------------------------------------------------------------------------------------------------------

def test_every_dealt_query_is_registered():
    names = set(E.queries())
    assert all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 14)) and "pipeline" in names


def test_pipeline_stages_follow_their_operators(spark):
    from tests.llm.test_text_operators import contamination, removed, roots
    from tests.llm.test_text_operators import fingerprint
    docs = table(spark, SF, "documents").where("doc_id < 150")       # a small fixture, for the brute force
    kept = [f for _, f in corpus_pipeline.STAGES]
    rows = lambda df: sorted(tuple(r) for r in df.collect())
    one = kept[0](spark, docs, SF)
    assert one.dtypes == docs.dtypes and set(rows(one)) <= set(rows(docs))
    before = rows(one)
    two = kept[1](spark, one, SF)
    group = roots([(r[0], fingerprint(r[1])) for r in before])
    first = {}
    for r, g in zip(before, group):
        first[g] = min(first.get(g, r), r)
    assert rows(two) == sorted(first.values())
    three = kept[2](spark, two, SF)
    brute = {i: (n, kept_words) for i, _, n, kept_words in removed(rows(two))}
    for r in three.collect():
        assert r["text"].split() == brute[r["doc_id"]][1] or "\x1c" in r["text"]
    assert three.dtypes == docs.dtypes and three.count() == two.count()
    four = kept[3](spark, three, SF)
    items = [tuple(r) for r in table(spark, SF, "benchmark").select("item_id", "text").collect()]
    bad = {c[0] for c in contamination(rows(three), items) if c[4]}
    assert rows(four) == [r for r in rows(three) if r[0] not in bad]
    five = kept[4](spark, four, SF)
    assert {r["doc_id"] for r in five.select("doc_id").distinct().collect()} == {r[0] for r in rows(four)}


def test_pipeline_runs_on_odd_and_empty_tables(spark, scratch, docs, wide, empty):
    base = f"{scratch}/sf"
    for name, df in (("documents", wide), ("labels", spark.createDataFrame([], "doc_id long, quality int, toxic int")),
                     ("benchmark", spark.createDataFrame([], "item_id long, text string"))):
        df.write.parquet(f"{base}/{name}.parquet")
    assert corpus_pipeline.run(spark, base).count() > 0
    step = spark.read.parquet(f"{base}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        step = stage(spark, step, base)
    assert step.count() == 0
    assert docs.select(F.count("*")).first()[0] > 0
