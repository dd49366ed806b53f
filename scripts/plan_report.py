"""Executed-plan summary of every registered query (after adaptive re-planning).

    python scripts/plan_report.py [sf_dir] > PLANS.md

Per query: file scans, shuffles by kind (hash / range / single-partition
merges of partial results), join strategies, reused exchanges, and the
aggregate implementations.
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from faultline.session import build_session  # noqa: E402


def final_plan(df) -> str:
    # Run the frame's own plan (a write would run a separate one), so that
    # ``explain`` shows the final adaptive plan. Results here are small.
    df.collect()
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    text = buf.getvalue()
    # after an action the adaptive plan prints its final form first
    return text.split("+- == Initial Plan ==")[0]


def summarize(plan: str) -> dict[str, str]:
    hash_keys = re.findall(r"Exchange hashpartitioning\(([^)]*?), \d+\)", plan)
    keys = sorted({re.sub(r"#\d+L?", "", k).split(",")[0].strip() for k in hash_keys})
    return {
        "scans": str(plan.count("FileScan")),
        "hash shuffles": f"{len(hash_keys)} ({', '.join(keys)})" if hash_keys else "0",
        "range shuffles": str(plan.count("Exchange rangepartitioning")),
        "single-partition merges": str(plan.count("Exchange SinglePartition")),
        "reused": str(plan.count("ReusedExchange")),
        "joins": ", ".join(
            f"{n}×{j}"
            for j in ("BroadcastHashJoin", "SortMergeJoin", "ShuffledHashJoin")
            if (n := plan.count(j + " ") + plan.count(j + "\n"))
        )
        or "—",
        "aggregates": ", ".join(
            f"{a}" for a in ("HashAggregate", "ObjectHashAggregate", "SortAggregate") if re.search(rf"\b{a}\b", plan)
        )
        or "—",
        "top-k / limit": "yes" if ("TakeOrderedAndProject" in plan or "WindowGroupLimit" in plan) else "",
    }


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from faultline.plans.queries import queries

    spark = build_session(extra_conf={"spark.ui.showConsoleProgress": "false"})
    cols = None
    print(f"# Executed plans ({os.path.basename(sf_dir)}, every query built from the raw driver tables)\n")
    for name, fn in queries().items():
        s = summarize(final_plan(fn(spark, sf_dir)))
        if cols is None:
            cols = list(s)
            print("| query | " + " | ".join(cols) + " |")
            print("|---" * (len(cols) + 1) + "|")
        print(f"| `{name}` | " + " | ".join(s[c] for c in cols) + " |", flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
