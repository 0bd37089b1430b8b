"""Print the physical plan of catalogue queries and a one-line summary of it.

usage: python tools/show_plans.py [--full] sf_dir name [name ...]
The summary counts shuffles, join strategies, window-group limits and shows each
scan's ReadSchema / PushedFilters (column pruning and filter pushdown).
Queries that cut lineage run those jobs while the plan is built.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def summary(plan: str) -> str:
    tree = plan.split("\n\n\n")[0]                      # the operator tree, not the details
    count = lambda pat: len(re.findall(pat, tree))
    scans = sorted(set(re.findall(r"ReadSchema: (struct<[^>]*>)", plan)))
    pushed = sorted(set(p for p in re.findall(r"PushedFilters: (\[[^\]]*\])", plan) if p != "[]"))
    return (f"shuffles={count(r'[+-] Exchange')} broadcasts={count(r'BroadcastExchange')} "
            f"smj={count(r'SortMergeJoin')} bhj={count(r'BroadcastHashJoin')} "
            f"windowGroupLimit={count(r'WindowGroupLimit')} hashAgg={count(r'HashAggregate')} "
            f"rddScans(checkpointed)={count(r'Scan ExistingRDD')}\n  scans: {scans}\n  pushed: {pushed}")


def main() -> None:
    args = sys.argv[1:]
    full = "--full" in args
    args = [a for a in args if a != "--full"]
    sf_dir, names = args[0], args[1:]
    from recolib.plans.catalog import QUERIES
    from recolib.session import build_session

    spark = build_session()
    for name in names:
        df = QUERIES[name](spark, sf_dir)
        plan = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted") \
            if hasattr(df._sc._jvm, "PythonSQLUtils") else ""
        if not plan:
            import io
            from contextlib import redirect_stdout
            buf = io.StringIO()
            with redirect_stdout(buf):
                df.explain("formatted")
            plan = buf.getvalue()
        print(f"== {name}\n{summary(plan)}")
        if full:
            print(plan)


if __name__ == "__main__":
    main()
