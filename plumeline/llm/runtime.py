"""Small session helpers shared by the operators of this package."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumeline.session import cut_lineage

PACKAGE_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def with_package(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package when it runs from a source folder.

    On a cluster the package is shipped as usual (``--py-files`` or an installed wheel); the entry
    added here is then simply a folder that does not exist.
    """
    env = spark.sparkContext.environment
    have = env.get("PYTHONPATH", "")
    if PACKAGE_ROOT not in have.split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (have, PACKAGE_ROOT) if x)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return with_package(spark).read.parquet(f"{str(sf_dir).rstrip('/')}/{name}.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and go on from the written rows.

    Cuts the lineage and survives lost executors.
    """
    return cut_lineage(df)


def text_bytes(df: DataFrame, text: str) -> int:
    """Total UTF-8 bytes of a text column (one aggregate), used to size buckets."""
    row = df.agg(F.sum(F.octet_length(F.col(text)).cast("long")).alias("n")).first()
    return int(row["n"] or 0)
