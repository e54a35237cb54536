"""Summarise the physical plan of every registered query (markdown table).

Usage: python scripts/explain_all.py [sf_dir] > PLANS.md
Counts shuffles, join strategies, aggregates and window limits in the plan
Spark chooses before execution (AQE may still switch a sort-merge join to a
broadcast join at run time from measured sizes), and lists pushed filters.
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("simple")
    return buf.getvalue()


def summarise(plan: str) -> dict[str, str]:
    def count(pattern: str) -> int:
        return len(re.findall(pattern, plan))

    joins = []
    for kind in ("BroadcastHashJoin", "SortMergeJoin", "ShuffledHashJoin", "BroadcastNestedLoopJoin", "CartesianProduct"):
        n = count(rf"\b{kind}\b")
        if n:
            joins.append(f"{kind} x{n}")
    pushed = sorted(set(re.findall(r"PushedFilters: \[([^\]]+)\]", plan)))
    pushed = [p for p in pushed if p.strip()]
    return {
        "exchanges": str(count(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)")),
        "joins": ", ".join(joins) or "-",
        "partial aggregates": str(count(r"HashAggregate\(keys=.*functions=\[partial_")),
        "window limit partial": "yes" if re.search(r"WindowGroupLimit .*Partial", plan) else "-",
        "python": "yes" if re.search(r"EvalPython", plan) else "no",
        "pushed filters": "; ".join(p[:90] for p in pushed) or "-",
    }


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    from ledgerflow.plans.keys import QUERIES
    from ledgerflow.session import build_session

    spark = build_session("local[8]", shuffle_partitions=8, extra={"spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    cols = ["exchanges", "joins", "partial aggregates", "window limit partial", "python", "pushed filters"]
    print(f"# Physical plans of the registered queries ({os.path.basename(sf_dir)})\n")
    print("Generated by `scripts/explain_all.py`. Plans are the ones chosen before execution; AQE")
    print("re-plans joins and partition counts at run time from measured sizes. Jobs that write")
    print("tables (stream_load, incremental_load, backfill_intervals) show only their final read.\n")
    print("| query | " + " | ".join(cols) + " |")
    print("|---" * (len(cols) + 1) + "|")
    for name, fn in QUERIES.items():
        s = summarise(plan_text(fn(spark, sf_dir)))
        print(f"| {name} | " + " | ".join(s[c].replace("|", "/") for c in cols) + " |")
    spark.stop()


if __name__ == "__main__":
    main()
