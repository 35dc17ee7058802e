"""Byte-balanced sharding of indivisible groups by Karmarkar-Karp differencing.

Rows with equal texts form a group that stays in one shard. The k-way differencing method starts with
one partial partition per group (its size in one slot, k - 1 empty slots) and repeatedly combines the
two partial partitions with the largest spread, the largest slots of the one onto the smallest of the
other, until one is left.

Differencing runs as a tree of Spark jobs. Groups fall into chunks of about ``chunk`` by the hash of
their text; one task differences a chunk to a single partial partition (k sums) and remembers which slot
each group got. The partial partitions of all chunks are the input of the next level, and so on,
until one chunk is left: the number of rows falls by the factor ``chunk`` per level, and no task
holds more than a chunk. Slots are then translated back down the levels by joins on chunk numbers.

Defined results: a null text has size 1 and is grouped with empty texts. Size is the UTF-8 length plus
one. Rows keep null ids and repeats; every row has its own slot number. Ties between equal spreads
are broken by group hash, so the shards do not depend on task order. Slots follow no order of the ids: rows
are numbered in buckets by a row number, so an id that many rows share is spread like any other. Extra columns are ignored.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from plumeline.llm.runtime import materialize, with_package


def difference(sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """k-way differencing of partial partitions (rows of ``sums``, slots of one row in any order).

    Returns (slot, total): ``slot[i, j]`` is the final slot of slot j of row i, ``total`` the final sums in
    descending order.
    """
    n, k = sums.shape
    order = np.argsort(-sums, axis=1, kind="stable")
    sorted_sums = np.take_along_axis(sums, order, axis=1)
    heap = [(int(s[-1] - s[0]), i, tuple(s.tolist())) for i, s in enumerate(sorted_sums)]
    heapq.heapify(heap)
    merges: list[tuple[int, int, list[int]]] = []             # children and the new place of each merged slot
    number = n
    while len(heap) > 1:
        _, a, left = heapq.heappop(heap)
        _, b, right = heapq.heappop(heap)
        both = [x + y for x, y in zip(left, reversed(right))]
        rank = sorted(range(k), key=lambda j: (-both[j], j))
        place = [0] * k
        for new, old in enumerate(rank):
            place[old] = new
        merges.append((a, b, place))
        heapq.heappush(heap, (both[rank[-1]] - both[rank[0]], number, tuple(both[j] for j in rank)))
        number += 1
    final = np.empty((number, k), np.int32)                   # sorted slot of a node -> final slot
    final[number - 1] = np.arange(k)
    for node in range(number - 1, n - 1, -1):
        a, b, place = merges[node - n]
        final[a] = final[node][place]
        final[b] = final[node][place[::-1]]
    slot = np.empty((n, k), np.int32)
    np.put_along_axis(slot, order, final[:n], axis=1)
    return slot, np.array(heap[0][2], np.int64)


def _difference_groups(pdf: pd.DataFrame, k: int) -> pd.DataFrame:
    """One chunk of groups (chunk, g, size): the slot of each group; the sums on the first row."""
    pdf = pdf.sort_values(["size", "g"], ascending=[False, True], kind="stable")
    sums = np.zeros((len(pdf), k), np.int64)
    sums[:, 0] = pdf["size"]
    slot, total = difference(sums)
    return pd.DataFrame({"chunk": pdf["chunk"].to_numpy(), "g": pdf["g"].to_numpy(), "slot": slot[:, 0],
                         "sums": [total.tolist()] + [None] * (len(pdf) - 1)})


def _difference_chunks(pdf: pd.DataFrame, k: int) -> pd.DataFrame:
    """One chunk of partial partitions (up, chunk, sums): where each of their slots goes."""
    pdf = pdf.sort_values("chunk", kind="stable")
    slot, total = difference(np.array(pdf["sums"].tolist(), np.int64).reshape(-1, k))
    return pd.DataFrame({"up": pdf["up"].to_numpy(), "chunk": pdf["chunk"].to_numpy(), "slots": slot.tolist(),
                         "sums": [total.tolist()] + [None] * (len(pdf) - 1)})


def group_slots(groups: DataFrame, k: int, chunk: int = 4096) -> DataFrame:
    """(g, shard) for each group (g, size)."""
    with_package(groups.sparkSession)
    groups = materialize(groups)
    n = max(-(-groups.count() // chunk), 1)
    parts = groups.withColumn("chunk", F.pmod(F.xxhash64("g"), F.lit(n)))
    placed = materialize(parts.groupBy("chunk").applyInPandas(lambda p: _difference_groups(p, k), "chunk long, g long, slot int, sums array<long>"))
    level = placed.where("sums is not null").select("chunk", "sums")
    maps: DataFrame | None = None                              # chunk of the first level -> slots at the level reached
    while n > 1:
        n = -(-n // chunk)
        up = materialize(level.withColumn("up", F.pmod(F.xxhash64("chunk"), F.lit(n))).groupBy("up").applyInPandas(
            lambda p: _difference_chunks(p, k), "up long, chunk long, slots array<int>, sums array<long>"))
        step = up.select(F.col("chunk").alias("from"), F.col("up").alias("at"), F.col("slots").alias("next"))
        if maps is None:
            maps = step.select(F.col("from").alias("chunk"), "at", F.col("next").alias("slots"))
        else:
            maps = maps.join(step, maps["at"] == step["from"]).select(
                "chunk", step["at"], F.transform("slots", lambda s: F.col("next")[s]).alias("slots"))
        level = up.where("sums is not null").select(F.col("up").alias("chunk"), "sums")
    if maps is None:
        return placed.select("g", F.col("slot").alias("shard"))
    return placed.join(maps, "chunk").select("g", F.col("slots")[F.col("slot")].alias("shard"))


def number_rows(rows: DataFrame, key: str, unique: str, bucket_rows: int = 50_000) -> DataFrame:
    """``rows`` with ``slot``: gapless from 0 inside each ``key``, without gathering a key in one task.

    Rows are numbered inside (key, bucket) and shifted by the counts of the buckets before; the only
    ordered pass over a whole key sees one row per bucket. Buckets go by ``unique``, which no two rows share.
    """
    n = max(-(-rows.count() // bucket_rows), 1)
    rows = rows.withColumn("_bucket", F.pmod(F.xxhash64(unique), F.lit(n)))
    counts = rows.groupBy(key, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(key).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    shift = counts.select(key, "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(key, "_bucket").orderBy(unique)
    return (rows.withColumn("slot", F.row_number().over(inside).cast("long") - 1)
            .join(F.broadcast(shift) if n <= 10_000 else shift, [key, "_bucket"])
            .withColumn("slot", F.col("slot") + F.col("_before")).drop("_bucket", "_before"))


def byte_shards(docs: DataFrame, shards: int = 8, *, id_col: str = "doc_id", text_col: str = "text",
                chunk: int = 4096) -> DataFrame:
    """(id, size, text_crc32, g, shard, slot) per row; rows of one text ``g`` share a shard."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = materialize(docs.select(F.col(id_col).alias("id"), (F.octet_length(text).cast("long") + 1).alias("size"),
                                   F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"), F.xxhash64(text).alias("g"),
                                   F.monotonically_increasing_id().alias("_row")))          # fixed once written
    groups = group_slots(rows.groupBy("g").agg(F.sum("size").alias("size")), shards, chunk)
    return number_rows(rows.join(groups, "g"), "shard", "_row").drop("_row")
