"""Chat formatting of reply trees, in DataFrame functions only.

Root-to-leaf paths are enumerated by self-joins with doubling pointers: round k joins each message to the
message 2^k replies above it, so a tree of depth d takes about log2(d) rounds. The same rounds add up the
scores on the way to the root. The best ``branches`` leaves of each conversation are kept (largest path
score, then longest path, then smallest message) and the messages above them are found by the pointers
again. Each chosen path becomes one conversation in one string:

    <|turn|>role<|text|>text<|end|><|turn|>...

Control strings inside roles and texts (``<|name|>``, ``<s>``, ``</s>``, ``[INST]``, ``[/INST]``) get a backslash after
their first character, and backslashes already there are kept in addition, so unescaping gives
back the exact text. The loss mask lists the character spans of the texts of ``loss_roles``.

Only keys, pointers and scores go through the rounds; texts join once at the end. A conversation is one
row of the result, so the messages of one path meet in one task.

Defined results: null roles and texts are empty. A reply to a missing message starts a path of its own; messages
on or under a cycle of replies have no root and are left out. Message ids are unique in a conversation: of
rows that share one, the highest score, then the smallest role and text is used. Null scores count
zero. A null conversation id is a conversation. Other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from plumeline.llm.runtime import materialize

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
_CONTROL = r"(\|[A-Za-z0-9_]+\|>|/?INST\]|/?s>)"
ESCAPE_PATTERN = r"([<\[])(\\*)" + _CONTROL
UNESCAPE_PATTERN = r"([<\[])\\(\\*)" + _CONTROL


def escape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPE_PATTERN, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, UNESCAPE_PATTERN, "$1$2$3")


def _pointers(messages: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """Messages with a root: (conv, node, score, depth); and the jump tables (conv, node, up) of 1, 2, 4 ... replies."""
    known = messages.select("conv", "node")
    state = messages.alias("m").join(
        known.alias("p"), F.col("m.conv").eqNullSafe(F.col("p.conv")) & (F.col("m.parent") == F.col("p.node")), "left")
    state = materialize(state.select("m.conv", "m.node", F.col("p.node").alias("up"), "m.score", F.lit(1).cast("long").alias("depth")))
    # Only messages that have not reached a root are joined again; the finished ones stay as they were written.
    done, still = [state.where("up is null")], state.where("up is not null")
    jumps, open_rows = [], still.count()
    while open_rows:
        jumps.append(still.select("conv", "node", "up"))
        a, b = still.alias("a"), reduce(DataFrame.unionByName, [*done, still]).alias("b")
        state = materialize(a.join(b, F.col("a.conv").eqNullSafe(F.col("b.conv")) & (F.col("a.up") == F.col("b.node")), "left").select(
            "a.conv", "a.node", "b.up", (F.col("a.score") + F.coalesce("b.score", F.lit(0.0))).alias("score"),
            (F.col("a.depth") + F.coalesce("b.depth", F.lit(0))).alias("depth")))
        done.append(state.where("up is null"))
        still, before = state.where("up is not null"), open_rows
        open_rows = still.count()
        if open_rows == before:                               # only cycles are left
            break
    return reduce(DataFrame.unionByName, done).drop("up"), jumps


def best_paths(messages: DataFrame, branches: int = 1) -> DataFrame:
    """(conv, leaf, path_score, rank, node, above) for the messages (conv, node, parent, score) of the best paths.

    ``above`` counts the replies from the message down to the leaf.
    """
    rooted, jumps = _pointers(messages)
    parents = messages.where("parent is not null").select(F.col("conv").alias("pc"), F.col("parent").alias("pn")).distinct()
    leaves = rooted.join(parents, F.col("conv").eqNullSafe(F.col("pc")) & (F.col("node") == F.col("pn")), "left_anti")
    order = Window.partitionBy("conv").orderBy(F.desc("score"), F.desc("depth"), "node")
    chosen = leaves.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= branches)
    path = chosen.select("conv", F.col("node").alias("leaf"), F.col("score").alias("path_score"), "rank", "node", F.lit(0).cast("long").alias("above"))
    path = materialize(path)
    for k, jump in enumerate(jumps):                          # written each round: the plan would double otherwise
        j = jump.select(F.col("conv").alias("jc"), F.col("node").alias("jn"), "up")
        higher = path.join(j, F.col("conv").eqNullSafe(F.col("jc")) & (F.col("node") == F.col("jn"))).select(
            "conv", "leaf", "path_score", "rank", F.col("up").alias("node"), (F.col("above") + 2 ** k).alias("above"))
        path = materialize(path.unionByName(higher))
    return path


def format_conversations(messages: DataFrame, *, conv_col: str, node_col: str, parent_col: str, role_col: str, text_col: str,
                         score_col: str | None = None, branches: int = 1, loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """One row per chosen path: conv, leaf, path_score, rank, n_turns, formatted, loss_spans.

    ``loss_spans`` has, per text under the loss, its turn number, its start in the whole string and in the
    turn, and its length (characters, counted from 0).
    """
    score = F.coalesce(F.col(score_col).cast("double"), F.lit(0.0)) if score_col else F.lit(0.0)
    rows = messages.select(
        F.col(conv_col).alias("conv"), F.col(node_col).alias("node"), F.col(parent_col).alias("parent"), score.alias("score"),
        F.coalesce(role_col, F.lit("")).alias("role"), F.coalesce(text_col, F.lit("")).alias("text"))
    rows = materialize(rows.groupBy("conv", "node").agg(F.min(F.struct((-F.col("score")).alias("worst"), "role", "text", "parent")).alias("m")).select(
        "conv", "node", (-F.col("m.worst")).alias("score"), "m.role", "m.text", "m.parent"))
    path = best_paths(rows.select("conv", "node", "parent", "score"), branches)
    texts = rows.select(F.col("conv").alias("tc"), F.col("node").alias("tn"), "role", "text")
    turns = path.join(texts, F.col("conv").eqNullSafe(F.col("tc")) & (F.col("node") == F.col("tn")))
    head, body = F.concat(F.lit(TURN), escape(F.col("role")), F.lit(TEXT)), escape(F.col("text"))
    turns = turns.select("conv", "leaf", "path_score", "rank", F.col("above"), F.col("role").isin(*loss_roles).alias("loss"),
                         F.char_length(head).alias("start"), F.char_length(body).alias("length"), F.concat(head, body, F.lit(END)).alias("segment"))
    before = Window.partitionBy("conv", "leaf").orderBy(F.desc("above")).rowsBetween(Window.unboundedPreceding, -1)
    turns = turns.withColumn("offset", F.coalesce(F.sum(F.char_length("segment").cast("long")).over(before), F.lit(0).cast("long")))
    one = turns.groupBy("conv", "leaf").agg(
        F.first("path_score").alias("path_score"), F.first("rank").alias("rank"), F.count(F.lit(1)).alias("n_turns"),
        F.sort_array(F.collect_list(F.struct((-F.col("above")).alias("at"), "segment", "loss", "offset", "start", "length"))).alias("turns"))
    spans = F.filter(F.transform("turns", lambda t, i: F.when(t["loss"], F.struct(
        i.alias("turn"), (t["offset"] + t["start"]).alias("start"), t["start"].alias("start_in_turn"), t["length"].alias("length")))),
        lambda s: s.isNotNull())
    return one.select("conv", "leaf", "path_score", "rank", "n_turns",
                      F.array_join(F.transform("turns", lambda t: t["segment"]), "").alias("formatted"), spans.alias("loss_spans"))


def segments(formatted: Column) -> Column:
    """The turns of a formatted conversation, as written."""
    return F.split(formatted, r"(?=<\|turn\|>)", -1)


def read_turns(formatted: Column) -> Column:
    """array of struct(role, text), unescaped: the inverse of the template."""
    role = lambda s: F.substring_index(F.substring_index(s, TEXT, 1), TURN, -1)
    text = lambda s: F.substring_index(F.substring_index(s, TEXT, -1), END, 1)
    return F.transform(segments(formatted), lambda s: F.struct(unescape(role(s)).alias("role"), unescape(text(s)).alias("text")))


def read_loss_text(formatted: Column, loss_spans: Column) -> Column:
    """All text under the loss mask, unescaped, in order."""
    cut = segments(formatted)
    return F.array_join(F.transform(loss_spans, lambda s: unescape(
        F.substring(F.get(cut, s["turn"]), s["start_in_turn"] + 1, s["length"]))), "")


def reply_chain(turns: DataFrame, *, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """Linear conversations as reply trees: rows by turn, each replying to the row before (ties by role and text)."""
    order = Window.partitionBy(conv_col).orderBy(turn_col, role_col, text_col)
    rows = turns.select(F.col(conv_col).alias("conv"), F.row_number().over(order).cast("long").alias("node"),
                        F.col(role_col).alias("role"), F.col(text_col).alias("text"))
    return rows.withColumn("parent", F.when(F.col("node") > 1, F.col("node") - 1))
