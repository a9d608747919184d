"""Summarise the physical plan of every registered batch query.

    python tools/plan_report.py [DATA_DIR]

For each query: shuffles (Exchange), broadcasts, join strategies,
aggregate operators, WindowGroupLimit (top-k before the shuffle), Python
nodes and whether the scans push filters.  Read from ``explain("formatted")``.
Stream queries are skipped (their plans run inside the streaming engine).
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from loglens import build_session  # noqa: E402
from loglens.plans import QUERIES  # noqa: E402

PATTERNS = {
    "shuffles": r"^\(\d+\) Exchange$",
    "broadcasts": r"^\(\d+\) BroadcastExchange$",
    "bhj": r"^\(\d+\) BroadcastHashJoin",
    "smj": r"^\(\d+\) SortMergeJoin",
    "hash_agg": r"^\(\d+\) HashAggregate",
    "sort_agg": r"^\(\d+\) SortAggregate",
    "obj_agg": r"^\(\d+\) ObjectHashAggregate",
    "group_limit": r"^\(\d+\) WindowGroupLimit",
    "python": r"^\(\d+\) (ArrowEvalPython|MapInPandas|MapInArrow|FlatMapGroupsInPandas|BatchEvalPython)",
    "pushed_filters": r"^PushedFilters: \[.+\]",
}


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def summarize(text: str) -> dict[str, int]:
    lines = [ln.strip() for ln in text.splitlines()]
    return {k: sum(1 for ln in lines if re.match(p, ln)) for k, p in PATTERNS.items()}


def main() -> None:
    data_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    spark = build_session("local[4]", extra={"spark.ui.showConsoleProgress": "false"})
    keys = list(PATTERNS)
    print("| query | " + " | ".join(keys) + " |")
    print("| --- |" + " --- |" * len(keys))
    for name, fn in sorted(QUERIES.items()):
        if name.startswith(("stream_", "late_")):
            continue
        s = summarize(plan_text(fn(spark, data_dir)))
        print(f"| `{name}` | " + " | ".join(str(s[k]) for k in keys) + " |")


if __name__ == "__main__":
    main()
