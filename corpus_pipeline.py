"""Corpus pipeline: documents in, packed training sequences out, one operator per stage.

Stages, in order: the quality classifier drops documents judged low or toxic; SimHash near-dedup keeps one
document of each group; substring dedup cuts passages that an earlier document has; benchmark
decontamination drops contaminated documents; packing turns what is left into token sequences.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all but the last return the columns of
``documents``. Null texts count as empty, extra columns pass through to the packing stage, and empty
tables give empty tables; each operator's docstring has its own cases.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from plumeline.llm.runtime import table
from plumeline.session import ensure_checkpoint_dir


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the classifier rejects (low quality or toxic)."""
    from plumeline.llm.quality import drop_rejected

    return drop_rejected(docs, table(spark, sf_dir, "labels"))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document, the one with the smallest id, of each group of near duplicates."""
    from plumeline.llm.simhash import drop_near_duplicates

    return drop_near_duplicates(docs, shingle=3, max_bits=3)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut every passage of 13 words or more that a document with a smaller id has; no document is dropped."""
    from plumeline.llm.substring import cut_repeats

    return cut_repeats(docs, window=13)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the benchmark rule calls contaminated."""
    from plumeline.llm.decontam import drop_contaminated

    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"), window=13)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of 1024: one row per piece, with its ids."""
    import public_tokenizers

    from plumeline.llm.packing import pack_documents

    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json")).withColumnRenamed("id", "doc_id")


STAGES = [
    ("quality classifier", quality_classifier),
    ("SimHash near-dedup", simhash_near_dedup),
    ("substring dedup", substring_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("packing", packing),
]

#: Model fitting, fingerprints and tokenizers have no SQL form; the tests compare with brute force.
ORACLE_SQL = None


def write_stage(docs: DataFrame, folder: str) -> DataFrame:
    """Write a stage's rows as Parquet and return them as read back; row groups of 32 MB bound a task's write buffer."""
    docs.write.option("parquet.block.size", 32 << 20).parquet(folder)
    return docs.sparkSession.read.schema(docs.schema).parquet(folder)


def remove_stage(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; each stage's rows are written as Parquet and read again as the next one's docs.

    The files lie in a folder of this call under ``spark.checkpoint.dir``; a stage's files go when the next stage's are
    written. Those of the last but one stay, as the returned rows are read from them.
    """
    base = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs, before = table(spark, sf_dir, "documents"), None
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            folder = f"{base}/stage-{number + 1}"
            docs = write_stage(docs, folder)
            if before:
                remove_stage(spark, before)
            before = folder
    return docs
