"""Conversation repair, SentencePiece and source divergence against brute force, with edge cases."""

import hashlib
import itertools
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from plumeline.llm import repair as R

GRAMMAR = re.compile(r"(s?(ua)+)?\Z")


def cheapest_by_trial(classes: str) -> tuple[int, str]:
    """All edit sequences with up to two insertions in each gap."""
    gaps = [("I" * n, 2 * n, "".join(x)) for n in range(3) for x in itertools.product("ua", repeat=n)]
    ways = []
    for kind in classes:
        late = int(kind.isupper())
        own = [("D", 3, "")]
        if kind != "d":
            own += [("R", 2 + late, "u"), ("R", 2 + late, "a")]
            own += [("K", late, kind.lower())] if kind.lower() in "sua" else []
        ways.append(own)
    best = None
    for edits in itertools.product(*ways):
        for put in itertools.product(gaps, repeat=len(classes) + 1):
            cost = sum(e[1] for e in edits) + sum(g[1] for g in put)
            if best is None or cost <= best[0]:
                steps = [put[0], *(x for pair in zip(edits, put[1:]) for x in pair)]
                if GRAMMAR.match("".join(x[2] for x in steps)):
                    found = (cost, "".join(x[0] for x in steps))
                    best = found if best is None else min(best, found)
    return best


@pytest.mark.parametrize("n", [0, 1, 2, 3])
def test_repair_is_the_cheapest_edit(n):
    rng = random.Random(3)
    for classes in map("".join, itertools.product("suaxdSUAX", repeat=n)):
        if n < 3 or rng.random() < 0.06:
            assert R.repair(classes) == cheapest_by_trial(classes), classes


def test_pieces_chain_to_the_whole_parse():
    rng = random.Random(4)
    for _ in range(60):
        classes = "".join(rng.choice("suauauaxdUA") for _ in range(rng.randint(1, 40)))
        best = {0: (0, "")}
        for i in range(0, len(classes), 3):
            after = {}
            for entry, (cost, audit) in best.items():
                for end, (c, a) in R.parse(classes[i:i + 3], entry).items():
                    after[end] = min(after.get(end, (10 ** 9, "")), (cost + c, audit + a))
            best = after
        assert R.cheapest(best) == R.cheapest(R.parse(classes))


def conversation_rows():
    rng = random.Random(6)
    says = ["Hi.", "Hi", "", "  \t", "What?", "Fine!", "é.  ", None, "a.b"]
    rows = [(c, t, rng.choice(["system", "user", "assistant", "assistant", "user", None, "tool", ""]), rng.choice(says))
            for c in range(25) for t in range(rng.randint(0, 9))]
    rows += [(99, t, "user" if t % 2 == 0 else "assistant", f"turn {t % 70}" + (". " if t % 5 else "")) for t in range(140)]     # a long one
    rows += [(98, None, "user", f"same turn {i % 4}.") for i in range(30)] + [(98, 3, "assistant", "same turn 1.")] * 3
    rows += [(None, 1, "user", "No id."), (None, 2, "assistant", "No id."), (None, None, "system", "s")]
    return rows + rows[:5]


def by_trial(rows):
    groups = defaultdict(list)
    for conv, turn, role, text in rows:
        groups[conv].append((turn, " " if role is None else role, " " if text is None else text))
    out = {}
    for conv, own in groups.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, classes, counts = set(), "", Counter()
        for _, role, text in own:
            seen_before, end = (role, text) in seen, text.rstrip(" \t\n\x0b\x0c\r")[-1:]
            seen.add((role, text))
            kind = role[:1] if role[:1] in ("s", "u", "a") else "x"
            if not end or seen_before:
                counts["duplicate" if end else "blank"] += 1
                kind = "d"
            elif end not in ".!?":
                counts["truncated"] += 1
                kind = kind.upper()
            classes += kind
        cost, audit = R.cheapest(R.parse(classes))
        turns, _, _ = R.edited([r[1:] for r in own], audit)
        known = [r[0] for r in own if r[0] is not None]
        counts["illegal"] = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        assert GRAMMAR.match("".join(t["role"][:1] for t in turns))
        out[conv] = (max(known) - min(known) + 1 - len(set(known)) if known else 0, counts["blank"], counts["duplicate"], counts["truncated"],
                     counts["illegal"], cost, audit,
                     hashlib.sha256("\n".join(f"{t['role']}:{t['text']}" for t in turns).encode()).hexdigest())
    return out


@pytest.mark.parametrize("piece_turns", [4096, 16, 3])
def test_repair_of_whole_and_cut_conversations(spark, piece_turns):
    rows = conversation_rows()
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns(
        {c: F.lit(1) for c in ("conv", "piece", "place", "ends", "audit", "report")}).repartition(3)
    got = R.repaired_digests(R.repair_conversations(df, piece_turns=piece_turns)).collect()
    assert len(got) == len({r.conv_id for r in got})
    fields = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")
    assert {r.conv_id: (*(r.report[f] for f in fields), r.digest) for r in got} == by_trial(rows)


def test_repair_of_an_empty_table(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert R.repaired_digests(R.repair_conversations(df)).count() == 0


# ---- SentencePiece --------------------------------------------------------------------------------------------

MODEL = pytest.importorskip("public_tokenizers").path("piece_bpe_32k.model")
TEXTS = ["", None, " ", "  ", "   a", "a   ", "▁a▁▁ b", "\x00 a", "x" * 5000, "éé  \t\n  ", "😀 😀", "a　b ﬁ", "<s> </s> <unk>", "▁", "<0x41>",
         " " * 40 + "x" + " " * 17, "the the the", "the the the", "ab" * 1100 + " " + "ba" * 1100, "word " * 3000]


@pytest.mark.parametrize("slice_bytes, bucket_bytes", [(8 << 20, 16 << 20), (60, 500)])
def test_pieces_equal_the_library(spark, slice_bytes, bucket_bytes):
    import sentencepiece

    from plumeline.llm.pieces import encode_pieces

    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    rows = [(i if i % 7 else None, t) for i, t in enumerate(TEXTS)] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(1) for c in ("id", "ids", "run", "part", "payload")})
    got = encode_pieces(df.repartition(3), MODEL, slice_bytes=slice_bytes, bucket_bytes=bucket_bytes).collect()
    want = [(i, library.encode(t or ""), library.decode(library.encode(t or "")) if t else "") for i, t in rows]
    order = lambda r: (r[0] is not None, r[0] or 0, r[1])
    assert sorted((tuple(r) for r in got), key=order) == sorted(want, key=order)
    assert encode_pieces(df.limit(0), MODEL).count() == 0


def test_pieces_query_equals_the_library_on_whole_documents(spark):
    import sentencepiece

    from plumeline.llm.queries import QUERIES

    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op12_sentencepiece"](spark, "/root/testdata/sf0.001").collect()}
    want = {}
    for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect():
        ids = library.encode(r.text or "")
        want[r.doc_id] = (len(ids), digest(",".join(map(str, ids))), digest(library.decode(ids) if ids else ""))
    assert got == want


def test_a_model_that_may_cross_markers_takes_whole_texts(spark, monkeypatch):
    from plumeline.llm import pieces

    own = pieces.PieceEncoder(MODEL)
    assert own.cuts
    own.cuts = False
    texts = ["  a b", "x", " "]
    assert [own.chunks(t) for t in texts] == [[t] for t in texts]
    assert own.segment(texts) == own.library.encode(texts)


# ---- source divergence ----------------------------------------------------------------------------------------

def divergence_by_trial(rows, min_docs, top):
    folded = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")))
              for text, lang, source in rows]
    in_docs, groups = defaultdict(Counter), defaultdict(Counter)
    for lang, source, terms in folded:
        in_docs[lang].update(set(terms))
        groups[lang, source].update(terms)
    out = set()
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in in_docs[lang].items() if n >= min_docs]
        own = {s: [groups[lang, s][t] for t in kept] for g, s in groups if g == lang}
        whole = [sum(x) for x in zip(*own.values())] if kept else []
        price = lambda counts: [1 + 10 ** 9 * (n + 5) // (sum(counts) + 5 * len(kept)) for n in counts]
        for source, counts in own.items():
            p, q = price(counts), price(whole)
            pairs = [(o, sum(abs(a - b) for a, b in zip(p, price(other)))) for o, other in own.items() if o != source]
            terms = [(t, a - b) for t, n, a, b in zip(kept, counts, p, q) if n and a > b]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out |= {(lang, source, part, item, value, i + 1) for i, (item, value) in enumerate(found[:most])}
    return out


@pytest.fixture(scope="module")
def sourced():
    rng = random.Random(9)
    common = [f"{a}{b}é" for a in "abcdefgh" for b in "klmnop"]
    rows = [(" ".join(rng.choice(common[:rng.randint(3, 48)]).upper() for _ in range(rng.randint(0, 40))) + "1_x9",
             rng.choice(["en", "de", None, ""]), rng.choice(["s0", "s0", "s0", "s1", "s2", None])) for _ in range(260)]
    rows += [(None, "en", "empty"), ("", "fr", "a"), ("only, two! words", "fr", "b"), (None, None, None), ("lone", "it", "x")]
    return rows + rows[:3]


@pytest.mark.parametrize("bucket_terms, min_docs, top", [(512, 5, 50), (4, 5, 7), (3, 30, 2)])
def test_divergence_equals_brute_force(spark, sourced, bucket_terms, min_docs, top, monkeypatch):
    from plumeline.llm import divergence

    df = spark.createDataFrame(sourced, "text string, lang string, source string").withColumns(
        {c: F.lit(1) for c in ("term", "n", "value", "rank", "bucket", "item", "part")}).repartition(4)
    got = divergence.source_divergence(df, bucket_terms=bucket_terms, min_docs=min_docs, top=top).collect()
    assert len(got) == len(set(got))
    assert {tuple(r) for r in got} == divergence_by_trial(sourced, min_docs, top)


def test_divergence_counts_long_texts_and_flushes_whole(spark, sourced, monkeypatch):
    import pyarrow as pa

    from plumeline.llm import divergence

    assert b" ".join(divergence._parts(b"aa bb  cc ddd" * 50, 7)).split() == (b"aa bb  cc ddd" * 50).split()
    monkeypatch.setattr(divergence, "FLUSH", 10)
    batch = pa.RecordBatch.from_arrays([pa.array([r[i] or "" for r in sourced], pa.string()) for i in (1, 2, 0)], ["lang", "source", "text"])
    total = Counter()
    for out in divergence._count([batch]):
        for term, n in zip(out.column("term").to_pylist(), out.column("n").to_pylist()):
            total[term] += n
    assert total == Counter(t for r in sourced for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (r[0] or "").encode().lower().decode()))


def test_divergence_of_an_empty_table(spark, empty):
    from plumeline.llm.divergence import source_divergence

    assert source_divergence(empty).count() == 0


def test_counts_beyond_64_bits_stay_exact(spark):
    from plumeline.llm.divergence import _price

    n, total, terms = 4 * 10 ** 17, 9 * 10 ** 18, 10 ** 12
    row = spark.createDataFrame([(n, total, terms)], "n long, total long, terms long").select(_price("n", "total", "terms", 5, 10 ** 9).alias("p")).first()
    assert row.p == 1 + 10 ** 9 * (n + 5) // (total + 5 * terms)
