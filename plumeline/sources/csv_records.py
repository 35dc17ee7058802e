"""CSV records from the lines of split files: a quoted field may hold line breaks, wherever a split ends.

Whether a line starts inside a quoted field depends on all lines before it in its file. Each line is read as a step
from (outside, inside) to (outside, inside): a field that starts with a quote is open until an odd number of quotes
has been seen, in the other fields quotes are plain characters. Steps compose: a step is constant (it ends outside, or
inside, whatever was before), flips the state, or keeps it. So the state before any line is the last constant step's value,
flipped by the flips since: running sums within a split, and the same over one row per split of a file. No file is
read in one task; a split is streamed in order.

Only files with a line that leaves a field open go this way. In all others each line is a record, without a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FILE, SPLIT, PLACE = "_path", "_line_block", "_line_pos"


def _after(line: Column, inside: int) -> Column:
    """State (0 outside, 1 inside) after a line that starts in the given state."""
    def step(state: Column, field: Column) -> Column:
        odd = (F.char_length(field) - F.char_length(F.replace(field, F.lit('"'), F.lit("")))) % 2 == 1
        reads = (state == 1) | field.startswith('"')
        return F.when(reads & odd, 1 - state).otherwise(state)

    walked = F.aggregate(F.split(line, ","), F.lit(inside), step)
    return F.when(F.contains(line, F.lit('"')), walked).otherwise(F.lit(inside))


def _state_before(rows: DataFrame, part: list[str], order: str, start: Column) -> DataFrame:
    """``rows`` (with ``_out``, ``_in``: the state after the row from outside, from inside) and ``_state`` before each."""
    constant, flips = F.col("_out") == F.col("_in"), (F.col("_out") == 1) & (F.col("_in") == 0)
    upto = Window.partitionBy(*part).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = Window.partitionBy(*part).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    run = rows.withColumn("_flips", F.sum(flips.cast("long")).over(upto))
    run = run.withColumn("_fixed", F.when(constant, (F.col("_out") + F.col("_flips")) % 2))
    last = F.coalesce(F.last("_fixed", ignorenulls=True).over(before), start)
    count = F.coalesce(F.max("_flips").over(before), F.lit(0))
    return run.withColumn("_state", ((last + count) % 2).cast("int")).drop("_flips", "_fixed")


def _through(rows: DataFrame, part: list[str], order: str, start: int) -> DataFrame:
    """State after all rows of each ``part``, and the last row that starts outside, for a given state before them."""
    walked = _state_before(rows, part, order, F.lit(start))
    end = F.when(F.col("_state") == 1, F.col("_in")).otherwise(F.col("_out"))
    return walked.groupBy(*part).agg(F.max_by(end, order).alias("_end"), F.max(F.when(F.col("_state") == 0, F.col(order))).alias("_last"))


def csv_records(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(records, unclosed) of lines (``value``, ``_path``, ``_line_block``, ``_line_pos`` and further columns).

    A record stands at its first line's place, its lines joined by a line feed. ``unclosed`` has the first line of
    each file's last record if the file ends inside a quoted field; its lines are no record (a stray quote cannot pull the
    rest of a file into one row).
    """
    steps = lines.withColumns({"_out": _after(F.col("value"), 0), "_in": _after(F.col("value"), 1)})
    open_files = steps.where(F.col("_out") == 1).select(F.col(FILE).alias("_open")).distinct()
    plain = lines.join(open_files, lines[FILE] == F.col("_open"), "left_anti")
    steps = steps.join(open_files, steps[FILE] == F.col("_open"), "left_semi")

    # One row per split: where it leads from either state, and its last line that starts a record in either case.
    key = [FILE, SPLIT]
    ways = [_through(steps, key, PLACE, s).select(*key, F.col("_end").alias(e), F.col("_last").alias(f"_last{e}")) for s, e in ((0, "_out"), (1, "_in"))]
    splits = _state_before(ways[0].join(ways[1], key), [FILE], SPLIT, F.lit(0))
    own_last = F.when(F.col("_state") == 1, F.col("_last_in")).otherwise(F.col("_last_out"))
    splits = splits.withColumn("_start", F.when(own_last.isNotNull(), F.struct(F.col(SPLIT).alias("block"), own_last.alias("pos"))))
    earlier = Window.partitionBy(FILE).orderBy(SPLIT).rowsBetween(Window.unboundedPreceding, -1)
    ends = F.when(F.col("_state") == 1, F.col("_in")).otherwise(F.col("_out"))
    splits = splits.select(*[F.col(k).alias("_s" + k) for k in key], F.col("_state").alias("_enter"),
                           F.last("_start", ignorenulls=True).over(earlier).alias("_carried"), ends.alias("_leave"), "_start")
    tails = splits.groupBy("_s" + FILE).agg(F.max_by("_leave", "_s" + SPLIT).alias("_open_end"),
                                            F.max_by("_start", F.when(F.col("_start").isNotNull(), F.col("_s" + SPLIT))).alias("_tail"))
    tails = tails.where("_open_end = 1").select(F.col("_s" + FILE).alias("_t"), "_tail")

    placed = steps.join(splits.select("_s" + FILE, "_s" + SPLIT, "_enter", "_carried"),
                        (steps[FILE] == F.col("_s" + FILE)) & (steps[SPLIT] == F.col("_s" + SPLIT)))
    walked = _state_before(placed, key, PLACE, F.col("_enter"))
    upto = Window.partitionBy(*key).orderBy(PLACE).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    own = F.when(F.col("_state") == 0, F.struct(F.col(SPLIT).alias("block"), F.col(PLACE).alias("pos")))
    walked = walked.withColumn("_record", F.coalesce(F.last(own, ignorenulls=True).over(upto), F.col("_carried")))
    kept = walked.join(tails, (walked[FILE] == F.col("_t")) & (F.col("_record") == F.col("_tail")), "left")
    unclosed = kept.where(F.col("_t").isNotNull() & (F.col(PLACE) == F.col("_record.pos")) & (F.col(SPLIT) == F.col("_record.block")))
    rest = [c for c in lines.columns if c not in ("value", FILE, SPLIT, PLACE)]
    first = F.struct(SPLIT, PLACE)
    joined = kept.where(F.col("_t").isNull()).groupBy(FILE, "_record").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(SPLIT, PLACE, "value"))), lambda x: x["value"]), "\n").alias("value"),
        *[F.min_by(c, first).alias(c) for c in rest])
    joined = joined.select("value", FILE, F.col("_record.block").alias(SPLIT), F.col("_record.pos").alias(PLACE), *rest)
    return plain.unionByName(joined.select(*plain.columns)), unclosed.select(*lines.columns)
