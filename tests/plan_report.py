"""Count exchanges in the physical plans of registered queries.

Usage: ``python tests/plan_report.py [sf_dir] [name ...]``.  For each query
prints shuffle exchanges, broadcast exchanges, scalar subqueries and whether
the parquet scans carry pushed filters (initial plan, before AQE).
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def plan_text(df) -> str:
    """The physical plan as ``df.explain()`` prints it."""
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def summarize(df) -> dict:
    text = plan_text(df)
    return {
        "shuffles": len(re.findall(r"\bExchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)", text)),
        "broadcasts": text.count("BroadcastExchange"),
        "subqueries": len(set(re.findall(r"subquery#(\d+)", text))),
        "windows": len(re.findall(r"\+- Window \[", text)) + len(re.findall(r"^Window \[", text, re.M)),
        "pushed_filters": "PushedFilters: [" in text and "PushedFilters: []" not in text,
    }


if __name__ == "__main__":
    from cardwatch.session import build_session
    import __spark_entry__ as E
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    names = sys.argv[2:] or list(E.queries())
    spark = build_session("local[8]", 8)
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # show the static plan
    for n in names:
        print(f"{n:32s} {summarize(E.queries()[n](spark, sf))}")
