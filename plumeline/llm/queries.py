"""Registered queries of the corpus operators: thin result digests over each operator's outputs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumeline.llm.oracle import ORACLE  # noqa: F401 - read by the entry point
from plumeline.llm.runtime import table


def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    from plumeline.llm import chat

    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = "</s>[INST] ok [/INST]"
    added = spark.range(2).select(F.lit(-7).cast(rows.schema["conv_id"].dataType).alias("conv_id"),
                                  F.col("id").cast(rows.schema["turn"].dataType).alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(probe).alias("text"))
    tree = chat.reply_chain(rows.unionByName(added), conv_col="conv_id", turn_col="turn", role_col="role", text_col="text")
    done = chat.format_conversations(tree, conv_col="conv", node_col="node", parent_col="parent", role_col="role", text_col="text")
    turns = F.array_join(F.transform(chat.read_turns(F.col("formatted")), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = chat.read_loss_text(F.col("formatted"), F.col("loss_spans"))
    return done.select(F.col("conv").alias("conv_id"), F.size(chat.read_turns(F.col("formatted"))).cast("long").alias("n_turns"),
                       F.sha2(turns, 256).alias("turns_sha256"), F.char_length(loss).cast("long").alias("loss_chars"),
                       F.sha2(loss, 256).alias("loss_sha256"), F.char_length("formatted").cast("long").alias("formatted_chars"))


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from plumeline.llm.simhash import NO_ID, near_duplicates

    groups = near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), shingle=3, max_bits=3)
    return groups.select(F.nullif("id", F.lit(NO_ID)).alias("doc_id"),
                         F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                         F.nullif("first_id", F.lit(NO_ID)).alias("component_id"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from plumeline.llm.langid import fit, predict

    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    model = fit(docs.where(~held_out), id_col="doc_id", text_col="text", label_col="lang")
    scored = predict(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", held_out.alias("held_out"), F.col("language.lang_pred").alias("lang_pred"),
                         F.col("language.score").alias("score"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from plumeline.llm.substring import remove_repeats

    done = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"), window=13)
    kept = F.trim(F.regexp_replace(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+", " "))
    return done.select("doc_id", F.col("repeats.n_words").alias("n_words"), F.col("repeats.n_removed").alias("n_removed"),
                       F.sha2(kept, 256).alias("kept_sha256"))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from plumeline.llm.quality import fit, score

    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    scored = score(docs, fit(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", F.round(1 - F.col("quality_scores.low"), 6).alias("quality_score"),
                         F.round("quality_scores.toxic", 6).alias("toxic_score"), F.col("quality_scores.keep").alias("keep"))


def op6_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from plumeline.llm import merkle as m

    rows = m.with_next_text(table(spark, sf_dir, "documents").select("doc_id", "text"))
    rows = rows.withColumn("edited", m.edited_text(F.col("text"), F.col("next_text")))
    trees = rows.select("id", F.char_length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
                        *[m.tree(F.col(c)).alias(f"{c}_tree") for c in ("text", "edited", "next_text")])
    leaves = {c: m.leaf_digests(F.col(f"{c}_tree")) for c in ("text", "edited", "next_text")}
    return trees.select(
        F.col("id").alias("doc_id"), "n_chars", "edited_sha256", m.root(F.col("text_tree")).alias("fingerprint"),
        m.root(F.col("edited_tree")).alias("edited_fingerprint"), m.likeness(leaves["text"], leaves["edited"]).alias("near_edited"),
        m.likeness(leaves["text"], leaves["next_text"]).alias("near_next"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from plumeline.llm.packing import pack_documents

    pieces = pack_documents(table(spark, sf_dir, "documents").select("doc_id", "text"),
                            public_tokenizers.path("byte_bpe_50k.json"), with_ids=False)
    return pieces.withColumnRenamed("id", "doc_id")


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from plumeline.llm.decontam import benchmark_hits, contamination

    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    hits = benchmark_hits(docs.select("doc_id", "text"), items, window=13)
    rule = contamination("benchmark_hits")
    return hits.select(
        "doc_id", F.col("benchmark_hits.n_words").alias("n_words"), rule["n_hit"].alias("n_hit"),
        F.size("benchmark_hits.items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("benchmark_hits.items"), ","), 256).alias("items_sha256"),
        rule["contaminated"].alias("contaminated"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from plumeline.llm.sharding import byte_shards

    rows = byte_shards(table(spark, sf_dir, "documents").select("doc_id", "text"), shards=8)
    return rows.select(F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                       F.lit(None).cast("int").alias("grown_shard"))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from plumeline.llm.licenses import scan_licenses

    found = scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.withColumnRenamed("id", "doc_id")


def damaged_conversations(rows: DataFrame) -> DataFrame:
    """Conversation rows with faults put in by a checksum of their place; nulls read as one space."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20
    text = F.when(F.col("fault") == 1, F.lit("")).when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.explode(F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    kept = rows.select("conv_id", "turn", space("role").alias("role"), space("text").alias("text"), fault.alias("fault")).where("fault <> 0")
    return kept.select("conv_id", "turn", F.when(F.col("fault") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
                       text.alias("text"), copies.alias("copy")).drop("copy")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    from plumeline.llm.repair import repair_conversations, repaired_digests

    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    done = repaired_digests(repair_conversations(damaged_conversations(rows)))
    every = rows.select(F.col("conv_id").alias("conv")).distinct()
    joined = every.join(done, F.col("conv").eqNullSafe(F.col("conv_id")), "left")
    longs = [F.coalesce(f"report.{c}", F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return joined.select(F.col("conv").alias("conv_id"), *longs, F.coalesce("report.audit", F.lit("")).alias("audit"),
                         F.coalesce("digest", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def op12_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from plumeline.llm.pieces import encode_pieces

    done = encode_pieces(table(spark, sf_dir, "documents").select("doc_id", "text"), public_tokenizers.path("piece_bpe_32k.model"))
    return done.select(F.col("id").alias("doc_id"), F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    from plumeline.llm.divergence import source_divergence

    return source_divergence(table(spark, sf_dir, "documents").select("text", "lang", "source"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_chat_formatting": op1_chat_formatting,
    "op2_simhash_near_dedup": op2_simhash_near_dedup,
    "op3_language_id": op3_language_id,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_quality_classifier": op5_quality_classifier,
    "op6_document_fingerprints": op6_document_fingerprints,
    "op7_packing": op7_packing,
    "op8_benchmark_decontamination": op8_benchmark_decontamination,
    "op9_sharding": op9_sharding,
    "op10_license_scan": op10_license_scan,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_sentencepiece": op12_sentencepiece,
    "op13_source_divergence": op13_source_divergence,
}
