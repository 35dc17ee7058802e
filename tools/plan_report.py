"""Print the executed (final adaptive) physical plan of every catalogue query as an operator
outline: one line per operator, expressions dropped. Usage: python tools/plan_report.py [sf_dir]"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

KEEP = re.compile(r"^(?P<indent>[\s:+\-|]*)(?P<cg>\*\(\d+\) )?(?P<op>[A-Z][A-Za-z]+)")


def outline(plan: str) -> list[str]:
    out = []
    for line in plan.splitlines():
        m = KEEP.match(line)
        if not m:
            continue
        op = m.group("op")
        cg = "*" if m.group("cg") else ""
        extra = ""
        if op.startswith("BroadcastHashJoin") or op.startswith("SortMergeJoin") or op.startswith("ShuffledHashJoin"):
            jt = re.search(r"\b(Inner|LeftOuter|LeftSemi|LeftAnti|RightOuter|FullOuter)\b", line)
            extra = f" [{jt.group(1)}]" if jt else ""
        elif op == "Exchange":
            kind = re.search(r"Exchange (\w+)", line)
            extra = f" [{kind.group(1)}]" if kind else ""
        elif op == "FileScan":
            cols = re.search(r"ReadSchema: struct<([^>]*)>", line)
            extra = f" [{', '.join(c.split(':')[0] for c in cols.group(1).split(','))}]" if cols else ""
        out.append(m.group("indent") + cg + op + extra)
    return out


def final_only(plan: str) -> str:
    """Drop every ``== Initial Plan ==`` block (the outer one and those of nested subqueries) and
    the ``== Final Plan ==`` marker lines, keeping the plans that actually ran."""
    keep, skip_deeper_than = [], None
    for line in plan.splitlines():
        indent = line.find("+-") if "+-" in line else len(line) - len(line.lstrip(" :|"))
        if skip_deeper_than is not None:
            body_at = len(line) - len(line.lstrip(" :|+-"))
            if body_at > skip_deeper_than + 2 and "== Final Plan ==" not in line:
                continue
            skip_deeper_than = None
        if "== Initial Plan ==" in line:
            skip_deeper_than = indent
            continue
        if "== Final Plan ==" in line:
            continue
        keep.append(line)
    return "\n".join(keep)


def _depth(line: str) -> int:
    return len(line) - len(line.lstrip(" :|+-*"))


def collapse_repeated_subqueries(lines: list[str]) -> list[str]:
    """A subquery referenced in several expressions is printed once per reference but runs once;
    keep its first printing and mark the others."""
    out, seen, i = [], set(), 0
    while i < len(lines):
        line = lines[i]
        if line.strip(" :|+-*") == "Subquery":
            d = _depth(line)
            j = i + 1
            while j < len(lines) and _depth(lines[j]) > d:
                j += 1
            key = "\n".join(ln[d:] for ln in lines[i + 1:j])
            if key in seen:
                out.append(line.replace("Subquery", "Subquery (printed above, runs once)"))
                i = j
                continue
            seen.add(key)
        out.append(line)
        i += 1
    return out


def main() -> None:
    from plumeline.session import build_session
    from plumeline.plans.catalog import QUERIES
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", shuffle_partitions=8)
    outlines, runs = {}, {}
    sc = spark.sparkContext
    tracker = sc.statusTracker()
    for name, q in QUERIES.items():
        df = q(spark, sf)
        sc.setJobGroup(name, name)
        df.collect()
        sc.setJobGroup(None, None)
        stages = set()
        jobs = tracker.getJobIdsForGroup(name)
        for j in jobs:
            info = tracker.getJobInfo(j)
            stages |= set(info.stageIds if info else [])
        ran = [st for st in stages if (tracker.getStageInfo(st) and tracker.getStageInfo(st).numCompletedTasks > 0)]
        runs[name] = (len(jobs), len(ran))
        plan = df._jdf.queryExecution().executedPlan().toString()
        outlines[name] = collapse_repeated_subqueries(outline(final_only(plan)))

    print("# Executed plans (final adaptive plans, operators only)\n")
    print(f"Generated by `python tools/plan_report.py {sf}`; local[8], 8 shuffle partitions.")
    print("`*` marks operators inside whole-stage code generation; `[...]` after a scan lists the columns read.\n")
    print("Jobs and stages are counted by Spark's status tracker for one run (stages that ran tasks).\n")
    print("| query | jobs | stages run | join strategies | reused exchanges |")
    print("| --- | --- | --- | --- | --- |")
    for name, lines in outlines.items():
        ops = [ln.strip(" :+-|*") for ln in lines]
        joins = sorted({o for o in ops if "Join" in o})
        reused = sum(1 for o in ops if o.startswith("ReusedExchange"))
        jobs, stages = runs[name]
        print(f"| {name} | {jobs} | {stages} | {', '.join(joins) or '-'} | {reused} |")
    print()
    for name, lines in outlines.items():
        print(f"## {name}\n\n```")
        print("\n".join(lines))
        print("```\n")


if __name__ == "__main__":
    main()
