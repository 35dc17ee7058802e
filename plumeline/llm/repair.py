"""Conversation structure repair by a generalised LR parse with weighted edits.

The turns of a conversation, by their order, must read ``(s?(ua)+)?`` in role initials. Edits: Keep (free), Rerole to user
or assistant, Delete, and Insert of an empty user or assistant turn at any place. A blank or duplicate turn must be
deleted; a truncated turn costs one more unless deleted. The cheapest edits win, among equally cheap ones the
ASCII-least audit (the initials K, R, D, I in order).

The parse runs an LR automaton of the grammar with a graph-structured stack: every action that the table allows is
tried on every stack top, and stacks whose tops are equal merge by the minimum of (cost, audit). Merging is exact:
what a stack still accepts depends on its top alone, and of two equally cheap audits of the same turns none is a
prefix of the other.

One row per piece of a conversation comes back. A conversation of up to ``piece_turns`` turns is one piece, parsed
in one run over rows sorted by conversation; sorted partitions are streamed. Longer ones, which may hold any share
of all rows, are numbered and cut into pieces; each piece is parsed once from every stack top that can enter it, the
pieces' tables of (entry, exit, cost, audit) are chained per conversation, and the pieces are then edited apart.
Only the audit strings of a long conversation meet in one task; its texts never do.

Defined results: a null role or text is one space; null turns come first; turns of equal number are ordered by role,
then text, in UTF-8 order, and equal rows stay adjacent. A null conversation id is a conversation. A role whose first
character is not s, u or a, or an empty one, cannot be kept. Columns other than the four named are ignored. An empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumeline.llm.runtime import materialize, with_package
from plumeline.operators.sequence import sequence_ids

BLANKS = " \t\n\x0b\x0c\r"
REROLE, DELETE, INSERT, CUT_SHORT = 2, 3, 2, 1
ROLES = {"u": "user", "a": "assistant"}

# LR(0) automaton of C -> empty | T | s T;  T -> P | T P;  P -> u a.
_SHIFT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (5, "u"): 2, (2, "a"): 6}
_REDUCE = {4: ("T", 1), 6: ("P", 2), 7: ("T", 2)}
_GOTO = {(0, "P"): 4, (0, "T"): 3, (1, "P"): 4, (1, "T"): 5, (3, "P"): 7, (5, "P"): 7}
_ACCEPT = (0, 3, 5)
#: A stack for each top that can stand between two turns.
ENTRIES = {0: (0,), 1: (0, 1), 2: (0, 2), 3: (0, 3), 5: (0, 1, 5)}
# Classes of turns: the initial of a turn that can be kept, upper case if truncated; x / X other roles; d to be deleted.


class _Top:
    """A stack top: LR state, the top below, and the cheapest edits that lead here."""

    __slots__ = ("state", "below", "cost", "audit")

    def __init__(self, state: int, below: _Top | None, cost: int, audit: str):
        self.state, self.below, self.cost, self.audit = state, below, cost, audit


def _shifted(top: _Top, symbol: str, cost: int, action: str) -> _Top | None:
    """The stack after the symbol and all reductions it completes, or None if the table has no shift."""
    state = _SHIFT.get((top.state, symbol))
    if state is None:
        return None
    cost, audit = top.cost + cost, top.audit + action
    new = _Top(state, top, cost, audit)
    while new.state in _REDUCE:
        head, size = _REDUCE[new.state]
        below = new
        for _ in range(size):
            below = below.below
        new = _Top(_GOTO[below.state, head], below, cost, audit)
    return new


def _merge(tops: dict[int, _Top], new: _Top | None) -> bool:
    if new is None:
        return False
    old = tops.get(new.state)
    if old is None or (new.cost, new.audit) < (old.cost, old.audit):
        tops[new.state] = new
        return True
    return False


def _insertions(tops: dict[int, _Top]) -> None:
    """Close the tops under inserted turns."""
    todo = list(tops.values())
    while todo:
        top = todo.pop()
        if tops[top.state] is top:
            for symbol in ROLES:
                new = _shifted(top, symbol, INSERT, "I")
                if _merge(tops, new):
                    todo.append(new)


def parse(classes: str, entry: int = 0) -> dict[int, tuple[int, str]]:
    """(cost, audit) of the cheapest edits for each stack top after the turns ``classes``, insertions at the end included."""
    top = None
    for state in ENTRIES[entry]:
        top = _Top(state, top, 0, "")
    tops = {top.state: top}
    _insertions(tops)
    for kind in classes:
        after: dict[int, _Top] = {}
        more = CUT_SHORT if kind.isupper() else 0
        for top in tops.values():
            _merge(after, _Top(top.state, top.below, top.cost + DELETE, top.audit + "D"))
            if kind != "d":
                _merge(after, _shifted(top, kind.lower(), more, "K"))
                for symbol in ROLES:
                    _merge(after, _shifted(top, symbol, REROLE + more, "R"))
        _insertions(after)
        tops = after
    return {t.state: (t.cost, t.audit) for t in tops.values()}


def cheapest(ends: dict[int, tuple[int, str]]) -> tuple[int, str]:
    return min(ends[s] for s in _ACCEPT if s in ends)


_MEMORY: dict[str, tuple[int, str]] = {}


def repair(classes: str) -> tuple[int, str]:
    """(cost, audit) of a whole conversation; short ones are remembered by their classes."""
    if len(classes) > 64:
        return cheapest(parse(classes))
    if classes not in _MEMORY:
        if len(_MEMORY) > 200_000:
            _MEMORY.clear()
        _MEMORY[classes] = cheapest(parse(classes))
    return _MEMORY[classes]


def edited(turns: list[tuple[str, str]], audit: str, position: int = 0, system: bool = False) -> tuple[list[dict], int, bool]:
    """The turns after the edits, and the position and system flag to go on with."""
    out, at = [], iter(turns)
    for action in audit:
        role, text = ("", "") if action == "I" else next(at)
        if action == "D":
            continue
        if action == "K":
            if position == 0 and role[:1] == "s":
                system = True
        else:
            role = ROLES["ua"[(position - system) % 2]]
        out.append({"edit": action, "role": role, "text": text})
        position += 1
    return out, position, system


_TURN = pa.struct([("edit", pa.string()), ("role", pa.string()), ("text", pa.string())])
_REPORT = pa.struct([(c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")] + [("audit", pa.string())])
PIECES = T.StructType([
    T.StructField("conv", T.StringType()), T.StructField("piece", T.LongType()), T.StructField("n_pieces", T.LongType()),
    T.StructField("turns", T.ArrayType(T.StructType([T.StructField(c, T.StringType()) for c in ("edit", "role", "text")]))),
    T.StructField("report", T.StructType([T.StructField(c, T.LongType()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
                                         + [T.StructField("audit", T.StringType())]))])
_LEGAL = {"su", "ua", "au"}


def _class(role: str, ends: str, again: bool) -> str:
    """Class of a turn from its role, the last visible character of its text and whether it was seen before."""
    if not ends or again:
        return "d"
    kind = role[:1] if role[:1] in ("s", "u", "a") else "x"
    return kind if ends in ".!?" else kind.upper()


def _summary(turns: list[int | None], roles: list[str], ends: list[str], again: list[bool]) -> dict:
    """Counts over the turns of one piece, with what is needed to go on over its borders."""
    known = [t for t in turns if t is not None]
    kinds = [_class(r, e, g) for r, e, g in zip(roles, ends, again)]
    pairs = (a[:1] + b[:1] for a, b in zip(roles, roles[1:]))
    return {"low": min(known, default=None), "high": max(known, default=None), "distinct": len(set(known)),
            "blank": sum(not e for e in ends), "duplicate": sum(bool(e) and g for e, g in zip(ends, again)),
            "truncated": sum(k.isupper() for k in kinds), "illegal": sum(p not in _LEGAL for p in pairs), "classes": "".join(kinds)}


def _report(s: dict, cost: int, audit: str) -> dict:
    gaps = 0 if s["low"] is None else s["high"] - s["low"] + 1 - s["distinct"]
    return {"gaps": gaps, "cost": cost, "audit": audit, **{c: s[c] for c in ("blank", "duplicate", "truncated", "illegal")}}


def _short(batches) -> Iterator[pa.RecordBatch]:
    """Rows (conv, turn, role, text, ends) sorted by conversation -> one piece per conversation."""
    held: list[tuple] = []
    done: list[tuple] = []
    size = 0

    def close() -> None:
        seen, again = set(), []
        for _, _, role, text, _ in held:
            again.append((role, text) in seen)
            seen.add((role, text))
        s = _summary([r[1] for r in held], [r[2] for r in held], [r[4] for r in held], again)
        cost, audit = repair(s["classes"])
        done.append((held[0][0], 0, 1, edited([(r[2], r[3]) for r in held], audit)[0], _report(s, cost, audit)))

    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if held and row[0] != held[0][0]:
                close()
                held = []
            held.append(row)
            size += len(row[3])
            if size > 1 << 22 and done:
                yield _rows(done)
                done, size = [], 0
    if held:
        close()
    if done:
        yield _rows(done)


def _rows(found: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.list_(_TURN), _REPORT]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in found], k) for i, k in enumerate(kinds)], PIECES.names)


# ---- conversations of more than one piece ---------------------------------------------------------------------

_COUNTS = ("low", "high", "distinct", "blank", "duplicate", "truncated", "illegal", "first_turn", "last_turn")
_MOVES = pa.list_(pa.struct([("entry", pa.int32()), ("exit", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))
PARSED = (f"conv string, piece long, {', '.join(c + ' long' for c in _COUNTS)}, first_role string, last_role string, classes string, "
          "moves array<struct<entry:int,exit:int,cost:long,audit:string>>")
CHAINED = T.StructType([PIECES["conv"], PIECES["piece"], PIECES["n_pieces"], T.StructField("audit", T.StringType()),
                        T.StructField("position", T.LongType()), T.StructField("system", T.BooleanType()), PIECES["report"]])


def _parsed(found: pa.Table) -> pa.Table:
    """One piece (conv, piece, place, turn, role, ends, again): its counts, classes and edits from every entry."""
    rows = sorted(zip(*(found.column(c).to_pylist() for c in ("place", "turn", "role", "ends", "again"))), key=lambda r: r[0])
    turns, roles = [r[1] for r in rows], [r[2] for r in rows]
    s = _summary(turns, roles, [r[3] for r in rows], [r[4] for r in rows])
    s |= {"first_turn": turns[0], "last_turn": turns[-1]}
    moves = [{"entry": e, "exit": x, "cost": c, "audit": a} for e in ENTRIES for x, (c, a) in parse(s["classes"], e).items()]
    return pa.table({"conv": found.column("conv").slice(0, 1), "piece": found.column("piece").slice(0, 1),
                     **{c: pa.array([s[c]], pa.int64()) for c in _COUNTS},
                     "first_role": [roles[0][:1]], "last_role": [roles[-1][:1]], "classes": [s["classes"]], "moves": pa.array([moves], _MOVES)})


def _whole(pieces: list[dict]) -> dict:
    """Counts of a conversation from those of its pieces, in order."""
    out = {c: sum(p[c] for p in pieces) for c in ("distinct", "blank", "duplicate", "truncated", "illegal")}
    for p, q in zip(pieces, pieces[1:]):
        out["illegal"] += p["last_role"] + q["first_role"] not in _LEGAL
        out["distinct"] -= p["last_turn"] is not None and p["last_turn"] == q["first_turn"]
    known = [p for p in pieces if p["low"] is not None]
    return out | {"low": min((p["low"] for p in known), default=None), "high": max((p["high"] for p in known), default=None)}


def _chained(found: pa.Table) -> pa.Table:
    """One long conversation: the cheapest way through its pieces, and what each piece needs to be edited apart."""
    pieces = sorted(found.to_pylist(), key=lambda p: p["piece"])
    best: dict[int, tuple[int, str, tuple]] = {0: (0, "", ())}
    for p in pieces:
        after: dict[int, tuple[int, str, tuple]] = {}
        for m in p["moves"]:
            if m["entry"] in best:
                cost, audit, way = best[m["entry"]]
                new = (cost + m["cost"], audit + m["audit"], (way, m["audit"]))
                if m["exit"] not in after or new[:2] < after[m["exit"]][:2]:
                    after[m["exit"]] = new
        best = after
    cost, audit, way = min((best[s] for s in _ACCEPT if s in best), key=lambda x: x[:2])
    audits: list[str] = []
    while way:
        way, own = way
        audits.append(own)
    audits.reverse()
    rows, position, system = [], 0, False
    report = _report(_whole(pieces), cost, audit)
    for i, (p, own) in enumerate(zip(pieces, audits)):
        rows.append({"conv": p["conv"], "piece": i, "n_pieces": len(pieces), "audit": own, "position": position, "system": system,
                     "report": None if i else report})
        classes = iter(p["classes"])
        for action in own:
            kind = "" if action == "I" else next(classes)
            if action != "D":
                system |= position == 0 and action == "K" and kind.lower() == "s"
                position += 1
    kinds = pa.schema([("conv", pa.string()), ("piece", pa.int64()), ("n_pieces", pa.int64()), ("audit", pa.string()),
                       ("position", pa.int64()), ("system", pa.bool_()), ("report", _REPORT)])
    return pa.Table.from_pylist(rows, kinds)


def _edited(found: pa.Table, plan: pa.Table) -> pa.Table:
    """Turns (conv, piece, place, role, text) of one piece after the edits of its plan."""
    rows = sorted(zip(*(found.column(c).to_pylist() for c in ("place", "role", "text"))), key=lambda r: r[0])
    p = plan.to_pylist()[0]
    turns = edited([r[1:] for r in rows], p["audit"], p["position"], p["system"])[0]
    return pa.Table.from_batches([_rows([(p["conv"], p["piece"], p["n_pieces"], turns, p["report"])])])


def _long(rows: DataFrame, piece_turns: int) -> DataFrame:
    numbered = materialize(sequence_ids(rows, ["turn", "role", "text"], group_cols=["conv"], out="place")
                           .withColumn("piece", F.floor((F.col("place") - 1) / piece_turns)))
    seen = numbered.withColumn("same", F.sha2(F.concat_ws("\0", "role", "text"), 256))
    first = seen.groupBy("conv", "role", "same").agg(F.min("place").alias("first"))
    marked = seen.drop("text").join(first, ["conv", "role", "same"]).withColumn("again", F.col("place") > F.col("first"))
    parsed = marked.select("conv", "piece", "place", "turn", "role", "ends", "again").groupBy("conv", "piece").applyInArrow(_parsed, PARSED)
    plan = materialize(parsed.groupBy("conv").applyInArrow(_chained, CHAINED))
    texts = numbered.select("conv", "piece", "place", "role", "text").groupBy("conv", "piece")
    return texts.cogroup(plan.groupBy("conv", "piece")).applyInArrow(_edited, PIECES)


def repair_conversations(rows: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                         text_col: str = "text", piece_turns: int = 4096) -> DataFrame:
    """One row per piece: the conversation id (under its own name), piece, n_pieces, turns (edit, role, text) and, on
    piece 0, a report (gaps, blank, duplicate, truncated, illegal, cost, audit). Conversations of up to
    ``piece_turns`` turns are one piece."""
    with_package(rows.sparkSession)
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    key = F.coalesce(F.concat(F.lit("="), F.col(conv_col).cast("string")), F.lit(""))
    plain = rows.select(key.alias("conv"), F.col(turn_col).cast("long").alias("turn"), space(role_col).alias("role"), space(text_col).alias("text"))
    plain = plain.withColumn("ends", F.substring(F.rtrim("text", F.lit(BLANKS)), -1, 1))
    long = materialize(plain.groupBy("conv").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > piece_turns).select("conv"))
    split = not long.isEmpty()
    short = plain.join(long, "conv", "left_anti") if split else plain
    pieces = short.repartition("conv").sortWithinPartitions("conv", "turn", "role", "text").mapInArrow(_short, PIECES)
    pieces = pieces.withColumn("n_pieces", F.lit(1).cast("long"))             # known to the optimizer: filters on it prune this part
    if split:
        pieces = pieces.unionByName(materialize(_long(plain.join(long, "conv", "left_semi"), piece_turns)))
    conv = F.when(F.col("conv") != "", F.substr("conv", F.lit(2))).cast(rows.schema[conv_col].dataType)
    return pieces.select(conv.alias(conv_col), "piece", "n_pieces", "turns", "report")


def _hashed(batches) -> Iterator[pa.RecordBatch]:
    """Rows (conv, piece, lines) sorted by conversation and piece -> SHA-256 of all lines, streamed."""
    last, state, lines, out = None, None, 0, []
    for batch in batches:
        for conv, text, n in zip(*(batch.column(c).to_pylist() for c in (0, 2, 3))):
            if state is None or conv != last:
                if state is not None:
                    out.append((last, state.hexdigest()))
                last, state, lines = conv, hashlib.sha256(), 0
            if n:
                state.update((("\n" if lines else "") + text).encode())
                lines += n
    if state is not None:
        out.append((last, state.hexdigest()))
    yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], pa.string()), pa.array([r[1] for r in out], pa.string())], ["conv", "digest"])


def repaired_digests(pieces: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """(conversation id, report, digest): SHA-256 of the repaired ``role:text`` lines of each conversation."""
    text = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit(":"), t["text"])), "\n")
    one = pieces.where(F.col("n_pieces") == 1).select(conv_col, "report", F.sha2(text, 256).alias("digest"))
    key = F.coalesce(F.concat(F.lit("="), F.col(conv_col).cast("string")), F.lit("")).alias("conv")
    several = pieces.where(F.col("n_pieces") > 1)
    streamed = (several.select(key, "piece", text.alias("lines"), F.size("turns").alias("n")).repartition("conv")
                .sortWithinPartitions("conv", "piece").mapInArrow(_hashed, "conv string, digest string"))
    heads = several.where(F.col("piece") == 0).select(key, conv_col, "report")
    return one.unionByName(heads.join(streamed, "conv").select(conv_col, "report", "digest"))
