"""Chat formatting, Merkle fingerprints, packing and sharding: exact round trips and brute force."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from plumeline.llm import chat, merkle, packing, sharding
from plumeline.llm.tokens import TextEncoder

BPE = public_tokenizers.path("byte_bpe_50k.json")
NASTY = ["</s>[INST] ok [/INST]", "<|turn|>x<|text|>", "<\\|end|>", "<\\\\|end|>", "a <s> b", "[\\INST]", "<|a<|end|>", "<", "|end|>", "[/INST", "\\", None, "",
         "é😀 <|im_start|>", "line\nline"]


# ---- chat -----------------------------------------------------------------------------------------------------------

def test_escape_is_reversible_and_leaves_no_control_string(spark):
    rng = random.Random(4)
    parts = ["<", "[", "\\", "|", "end", "|>", "INST]", "/", "s>", "<|end|>", "<\\|end|>", "x", "\n"]
    texts = [t for t in NASTY if t] + ["".join(rng.choice(parts) for _ in range(rng.randint(1, 12))) for _ in range(400)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    e = chat.escape(F.col("t"))
    bad = df.where((chat.unescape(e) != F.col("t")) | e.rlike(r"<\|[A-Za-z0-9_]+\|>|</?s>|\[/?INST\]"))
    assert bad.count() == 0


def test_linear_conversations_round_trip(spark):
    rows = [(c, t, r, x) for c in (1, 2, None) for t, (r, x) in enumerate(
        [("user", NASTY[0]), ("assistant", NASTY[0]), (None, "n"), ("assistant", None), ("assistant", "é😀")])]
    rows += [(7, 3 * i, "user" if i % 2 else "assistant", x) for i, x in enumerate(NASTY)] + [(8, 1, "user", "only")]
    rows += [(9, 5, "b", "tie"), (9, 5, "a", "tie"), (9, 5, "a", "tie")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    tree = chat.reply_chain(df, conv_col="conv_id", turn_col="turn", role_col="role", text_col="text")
    out = chat.format_conversations(tree, conv_col="conv", node_col="node", parent_col="parent", role_col="role", text_col="text")
    out = out.select("conv", "formatted", chat.read_turns(F.col("formatted")).alias("turns"), "loss_spans",
                     chat.read_loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss")).collect()
    want = defaultdict(list)
    for c, t, r, x in sorted(rows, key=lambda r: (str(r[0]), r[1], r[2] or "", r[3] or "")):
        want[c].append((r or "", x or ""))
    assert {r["conv"] for r in out} == set(want)
    for r in out:
        assert [tuple(t) for t in r["turns"]] == want[r["conv"]]
        assert r["loss"] == "".join(x for role, x in want[r["conv"]] if role == "assistant")
        for s in r["loss_spans"]:
            part = chat.ESCAPE_PATTERN and r["formatted"][s["start"]:s["start"] + s["length"]]
            assert r["formatted"][s["start"] + s["length"]:].startswith(chat.END) and part is not None


def brute_paths(nodes, branches):
    """Best root-to-leaf paths of each conversation by recursion."""
    out = {}
    for conv in {n[0] for n in nodes}:
        own = {n: (p, s or 0.0) for c, n, p, s in nodes if c == conv}
        children = {p for p, _ in own.values() if p in own}
        paths = []
        for leaf in own:
            if leaf in children:
                continue
            path, at, seen = [], leaf, set()
            while at in own and at not in seen:
                seen.add(at)
                path.append(at)
                at = own[at][0]
            if at in seen:
                continue
            paths.append((-round(sum(own[x][1] for x in path), 6), -len(path), leaf, path[::-1]))
        out[conv] = [p[3] for p in sorted(paths)[:branches]]
    return out


@pytest.mark.parametrize("branches", [1, 3])
def test_reply_trees_match_brute_force(spark, branches):
    rng = random.Random(branches)
    nodes = []
    for c in range(6):
        for n in range(40):
            parent = None if n == 0 else rng.choice([n - 1, rng.randrange(n), 999 if n % 17 == 0 else n - 1])
            nodes.append((c, n, parent, rng.choice([None, 0.25, 0.5, 1.0])))
    nodes += [(50, n, n - 1 if n else None, 1.0) for n in range(100)]                     # one long chain
    nodes += [(60, 0, 1, 1.0), (60, 1, 0, 1.0), (60, 2, 1, 1.0), (60, 3, None, 0.5)]       # a cycle beside a root
    df = spark.createDataFrame([(*n, "user", f"t{n[1]}") for n in nodes], "c long, n long, p long, s double, role string, text string")
    out = chat.format_conversations(df, conv_col="c", node_col="n", parent_col="p", role_col="role", text_col="text", score_col="s", branches=branches)
    got = defaultdict(dict)
    for r in out.select("conv", "rank", chat.read_turns(F.col("formatted")).alias("t")).collect():
        got[r["conv"]][r["rank"]] = [int(x["text"][1:]) for x in r["t"]]
    want = brute_paths(nodes, branches)
    assert {c: [p for _, p in sorted(v.items())] for c, v in got.items()} == {c: p for c, p in want.items() if p}


# ---- merkle ---------------------------------------------------------------------------------------------------------

def next_texts(rows):
    """(id, text, next text) by ascending id, null last, ties by the text hash Spark uses."""
    return sorted(rows, key=lambda r: ((1 << 63) - 1 if r[0] is None else r[0]))


@pytest.mark.parametrize("bucket_rows,sampled", [(512, 200_000), (1, 1000), (4, 30)])
def test_next_document_and_edits(spark, rows, bucket_rows, sampled):
    unique = list({r[0]: r for r in rows if r[0] is not None}.values()) + [(10 ** 15, "far away", None, None, None), (-5, "first", None, None, None)]
    df = spark.createDataFrame([(r[0], r[1]) for r in unique], "doc_id long, text string").repartition(5)
    got = {r["id"]: r for r in merkle.with_next_text(df, bucket_rows=bucket_rows, sampled=sampled)
           .withColumn("edited", merkle.edited_text(F.col("text"), F.col("next_text"))).collect()}
    order = next_texts(unique)
    assert len(got) == len(order)
    for a, b in zip(order, order[1:] + order[:1]):
        t, n = a[1] or "", b[1] or ""
        k = len(t) // 4
        assert got[a[0]]["text"] == t and got[a[0]]["next_text"] == n
        assert got[a[0]]["edited"] == t[:len(t) - k] + n[:k]


def test_next_document_with_null_and_repeated_ids(spark, docs, rows):
    got = merkle.with_next_text(docs).collect()
    assert sorted(str((r["id"], r["text"])) for r in got) == sorted(str((r[0], r[1] or "")) for r in rows)
    assert all(r["next_text"] is not None for r in got)


@pytest.mark.parametrize("ids", ["blocks", "hot"])
def test_buckets_follow_the_rows_not_the_ids(spark, ids):
    """Ids in far blocks, and one id on a third of the rows: buckets stay near the wanted size and no neighbour is lost."""
    if ids == "blocks":
        rows = [((b << 33) + i, f"text {b} {i}") for b in range(10) for i in range(200)]
    else:
        rows = [(7 if i % 3 == 0 else 1000 + i, f"text {i}") for i in range(1500)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    keyed = df.select(F.col("doc_id").alias("key"), F.xxhash64("text").alias("th"), "text")
    order = sorted((r["key"], r["th"], r["text"]) for r in keyed.collect())
    bounds = merkle._bounds(keyed, 50, 100_000)
    at = [sum(b <= r[:2] for b in bounds) for r in order]
    assert max(np.bincount(at)) <= 100 and len(bounds) <= len(rows) // 50 + 1
    got = {r["text"]: (r["id"], r["next_text"]) for r in merkle.with_next_text(df, bucket_rows=50).collect()}
    assert len(got) == len(rows)
    for a, b in zip(order, order[1:] + order[:1]):
        assert got[a[2]] == (a[0], b[2])


def test_fingerprints_of_an_empty_and_a_wide_table(empty, wide, docs):
    assert merkle.with_next_text(empty).count() == 0 and merkle.fingerprints(empty).count() == 0
    want = sorted(str(tuple(r)) for r in merkle.with_next_text(docs).collect())
    assert sorted(str(tuple(r)) for r in merkle.with_next_text(wide).collect()) == want


def test_equal_texts_have_equal_roots_and_others_differ(docs, rows):
    out = merkle.fingerprints(docs.select("doc_id", "text")).select("text", "merkle.root").collect()
    by_text = defaultdict(set)
    for r in out:
        by_text[r["text"] or ""].add(r["root"])
    assert all(len(v) == 1 for v in by_text.values())
    assert len({next(iter(v)) for v in by_text.values()}) == len(by_text)


def test_pieces_rebuild_every_text(docs):
    cut = F.transform(merkle.pieces(F.col("text")), lambda s: F.array_join(F.transform(s, lambda p: F.array_join(p, "")), "\n"))
    assert docs.where(F.array_join(cut, "\n\n") != F.coalesce("text", F.lit(""))).count() == 0


def test_differing_branches_locate_an_edit(spark):
    a = "One. Two two. Three.\nSecond line here.\n\nNew section. It ends."
    b = a.replace("Two two.", "Two 2.")
    out = spark.createDataFrame([(a, b)], "a string, b string").select(
        merkle.differing_branches(merkle.tree(F.col("a")), merkle.tree(F.col("b"))).alias("d"),
        merkle.differing_branches(merkle.tree(F.col("a")), merkle.tree(F.col("a"))).alias("none"),
        merkle.likeness(merkle.leaf_digests(merkle.tree(F.col("a"))), merkle.leaf_digests(merkle.tree(F.col("b")))).alias("near")).first()
    assert [tuple(x) for x in out["d"]] == [(0, 0, 1)] and out["none"] == [] and 0.8 <= out["near"] < 1


# ---- packing --------------------------------------------------------------------------------------------------------

def test_encoder_equals_the_library():
    rng = random.Random(2)
    letters = list("aBé1² '\n\t!stmdrelv'   中ß'ª.\x00\x0b\x85\xa0") + ["<|endoftext|>", "'re", "'LL", "😀"]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 30))) for _ in range(3000)]
    ids, cuts = TextEncoder(BPE).encode(texts)
    library = Tokenizer.from_file(BPE)
    for i, e in enumerate(library.encode_batch(texts, add_special_tokens=False)):
        assert ids[cuts[i]:cuts[i + 1]].tolist() == e.ids


LIMITS = [packing.Limits(), packing.Limits(tokens=64, segments=2, loss=64), packing.Limits(tokens=100, segments=8, loss=30)]


@pytest.mark.parametrize("limits", LIMITS)
def test_pieces_cover_every_document_within_all_limits(spark, docs, rows, limits):
    df = docs.select("doc_id", "text", F.when(F.col("doc_id") % 2 == 0, F.lit("context words before ") ).alias("before"))
    out = packing.pack_documents(df, BPE, limits=limits, pool=16, context_col="before").collect()
    library = Tokenizer.from_file(BPE)
    want = defaultdict(int)
    for i, t, *_ in rows:
        lead = library.encode("context words before " if i is not None and i % 2 == 0 else "", add_special_tokens=False).ids
        want[(i, tuple(lead + library.encode(t or "", add_special_tokens=False).ids + [0]), len(lead))] += 1
    sequences, spent = defaultdict(list), defaultdict(int)
    lead_of = {(i, len(ids)): lead for i, ids, lead in want}
    for r in out:
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes()) and r["length"] == len(r["ids"]) > 0
        sequences[r["sequence_id"]].append(r)
        spent[(r["id"], r["doc_tokens"])] += r["length"]
    total = defaultdict(int)
    for (i, ids, _), n in want.items():
        total[(i, len(ids))] += n * len(ids)
    assert spent == total
    for (i, ids, _), n in want.items():                       # every id in exactly one piece, at its place
        pieces = sorted((r["start"], r["ids"]) for r in out if r["id"] == i and r["doc_tokens"] == len(ids))
        if n == 1 and sum(1 for k in want if k[0] == i and len(k[1]) == len(ids)) == 1:
            assert [x for _, p in pieces for x in p] == list(ids)
    padding = 0
    for s in sequences.values():
        s.sort(key=lambda r: r["offset"])
        at = 0
        for r in s:
            assert r["offset"] == at
            at += r["length"]
        assert at <= limits.tokens and len(s) <= limits.segments
        loss = sum(max(0, r["start"] + r["length"] - max(r["start"], lead_of[(r["id"], r["doc_tokens"])])) for r in s)
        assert loss <= limits.loss
        padding += 0 if at & (at - 1) == 0 or at == limits.tokens else limits.tokens - at
    assert padding == 0


def test_packing_an_empty_table(empty):
    assert packing.pack_documents(empty, BPE).count() == 0


# ---- sharding -------------------------------------------------------------------------------------------------------

def test_differencing_beats_greedy_spread_and_is_consistent():
    rng = np.random.default_rng(0)
    for n, k in ((1, 3), (2, 4), (50, 3), (400, 8)):
        size = rng.integers(1, 10_000, n)
        sums = np.zeros((n, k), np.int64)
        sums[:, 0] = size
        slot, total = sharding.difference(sums)
        loads = np.bincount(slot[:, 0], weights=size, minlength=k).astype(int)
        assert sorted(loads.tolist(), reverse=True) == total.tolist() and total.sum() == size.sum()
        if n == 400:
            assert total[0] - total[-1] <= size.min() * 2


@pytest.mark.parametrize("chunk", [4096, 8, 3])
def test_shards_keep_texts_together_and_balance(docs, rows, chunk):
    out = sharding.byte_shards(docs, 4, chunk=chunk).collect()
    assert len(out) == len(rows)
    assert sorted((-1 if r["id"] is None else r["id"], r["size"], r["text_crc32"]) for r in out) == sorted(
        (-1 if i is None else i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, *_ in rows)
    shard_of, slots, load = defaultdict(set), defaultdict(list), defaultdict(int)
    for r in out:
        shard_of[r["g"]].add(r["shard"])
        slots[r["shard"]].append(r["slot"])
        load[r["shard"]] += r["size"]
    assert all(len(s) == 1 for s in shard_of.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    groups = defaultdict(int)
    for r in out:
        groups[r["g"]] += r["size"]
    assert max(load.values()) - min(load.get(i, 0) for i in range(4)) <= max(groups.values())


def test_sharding_an_empty_table(empty):
    assert sharding.byte_shards(empty, 4).count() == 0


def test_slots_of_a_hot_id_and_of_a_wide_table(spark, wide, rows):
    assert sharding.byte_shards(wide, 4).count() == len(rows)
    hot = [(7 if i % 3 == 0 else i, "same" if i % 6 == 0 else f"text {i}") for i in range(600)]
    df = spark.createDataFrame(hot, "doc_id long, text string").repartition(4)
    slots = defaultdict(list)
    for r in sharding.byte_shards(df, 4).collect():
        slots[r["shard"]].append(r["slot"])
    assert sum(map(len, slots.values())) == 600 and all(sorted(s) == list(range(len(s))) for s in slots.values())
    numbered = sharding.number_rows(spark.range(600).select(F.lit(1).alias("k"), F.lit(7).alias("id"), F.col("id").alias("_row")), "k", "_row", 20)
    assert sorted(r["slot"] for r in numbered.collect()) == list(range(600))
    assert numbered.drop("slot").columns == ["k", "id", "_row"]


def test_digest_of_the_edit_contract(spark):
    out = spark.createDataFrame([("äbcdefgh", "zé")], "a string, b string").select(
        F.sha2(merkle.edited_text(F.col("a"), F.col("b")), 256)).first()[0]
    assert out == hashlib.sha256("äbcdefzé".encode()).hexdigest()
