"""Dense 1..n row numbers in a total order, optionally restarting per group.

``row_number()`` over a window without ``partitionBy`` moves every row into one task, and a window
per group does the same for a hot group. Here the order columns are used as a hierarchy: all but
the last are coarse keys (file, scanline; or a block of ids) that cut a group into runs. Rows are numbered
inside their run, and each level of the hierarchy adds the row counts of the siblings before it. The tables
of counts hold one row per run, one per parent, and so on, so no window sees more than one level's
children. Everything is one lazy plan of group-bys, windows and null-safe joins: no job runs
while the query is built, nothing is materialized, and lost tasks are simply recomputed.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def id_block(col: str, size: int = 65_536) -> Column:
    """Order-preserving coarse key of an integer column: its block of ``size`` values."""
    return F.floor(F.col(col) / F.lit(size))


def sequence_ids(df: DataFrame, order_cols: list, group_cols: list | None = None, out: str = "row_id",
                 start: int | Column = 0) -> DataFrame:
    """Add ``out`` = start + 1..n in ``order_cols`` order (per ``group_cols`` when given).

    ``order_cols`` are names or columns; all but the last are coarse keys, so put ``id_block(x)`` before
    ``x`` when one column orders a large group. They (with ``group_cols``) should be a unique key; ties
    get an arbitrary order. NULL groups and keys are groups and keys like others (NULL first).
    ``start`` may be a literal or a scalar-subquery Column.
    """
    groups = list(group_cols or [])
    order = [F.col(c) if isinstance(c, str) else c for c in order_cols]
    keys = [f"_g{i}" for i in range(len(groups))] + [f"_k{i}" for i in range(len(order) - 1)]
    made = dict(zip(keys, [*[F.col(g) for g in groups], *order[:-1]]))
    rows = df.withColumns(made) if made else df
    inside = Window.partitionBy(*keys).orderBy(order[-1])
    numbered = rows.withColumn("_n", F.row_number().over(inside).cast("long"))

    # One count per run; the levels above are sums of it, so the rows are read once to be counted and once to be numbered.
    runs = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_c")) if keys else None
    first_coarse = len(groups)
    offsets = None
    for level in range(first_coarse, len(keys)):
        own, parent = keys[:level + 1], keys[:level]
        before = Window.partitionBy(*parent).orderBy(own[-1]).rowsBetween(Window.unboundedPreceding, -1)
        counts = runs if own == keys else runs.groupBy(*own).agg(F.sum("_c").alias("_c"))
        here = counts.select(*own, F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_o"))
        if offsets is None:
            offsets = here
        else:
            up = offsets.select(*[F.col(k).alias("_u" + k) for k in parent], F.col("_o").alias("_uo"))
            offsets = here.join(up, _same([(here[k], up["_u" + k]) for k in parent])).select(*own, (F.col("_o") + F.col("_uo")).alias("_o"))
    if offsets is not None:
        up = offsets.select(*[F.col(k).alias("_u" + k) for k in keys], F.col("_o").alias("_uo"))
        numbered = numbered.join(up, _same([(numbered[k], up["_u" + k]) for k in keys]))
    offset = F.col("_uo") if offsets is not None else F.lit(0)
    start_col = start if isinstance(start, Column) else F.lit(int(start))
    return numbered.select(*[F.col(c) for c in df.columns if c != out], (start_col + offset + F.col("_n")).cast("long").alias(out))


def _same(pairs: list[tuple[Column, Column]]) -> Column:
    return reduce(lambda a, b: a & b, [x.eqNullSafe(y) for x, y in pairs])
