"""Write PLANS.md: the executed physical plan of every registered query (after adaptive
re-planning) and the plan of one PageRank iteration.

Usage: python tools/show_plans.py [--sf-dir DIR] [--out PLANS.md]
"""

from __future__ import annotations

import argparse
import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from quarry.operators import graph as G  # noqa: E402
from quarry.plans import derived  # noqa: E402
from quarry.plans.queries import REGISTRY  # noqa: E402
from quarry.session import checkpoint_dir, get_session  # noqa: E402


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    text = buf.getvalue().strip()
    return re.sub(r"#\d+L?", "", text)  # attribute ids only add noise


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf-dir", default="/root/testdata/sf0.01")
    ap.add_argument("--out", default=os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                                                  "PLANS.md"))
    a = ap.parse_args()
    spark = get_session("local[8]", 8)
    checkpoint_dir(spark)
    parts = [f"# Executed plans (generated by tools/show_plans.py at {os.path.basename(a.sf_dir)})\n",
             "Each plan is the final adaptive plan after running the query. Queries that read a "
             "checkpoint (PageRank) show the scan only; the iteration plan is at the end.\n"]
    for name, q in REGISTRY.items():
        df = q(spark, a.sf_dir)
        df.collect()
        parts.append(f"## {name}\n\n```\n{plan_text(df)}\n```\n")

    captured = []
    orig = G._checkpointed

    def capture(df, n, *keys):
        captured.append((df, n, keys))
        return orig(df, n, *keys)

    G._checkpointed = capture
    try:
        G.pagerank(derived.edges(spark, a.sf_dir), iterations=2)
    finally:
        G._checkpointed = orig
    df, n, keys = captured[-1]
    parts.append("## PageRank iteration (set variant, as checkpointed)\n\n"
                 f"```\n{plan_text(df.repartition(n, *keys))}\n```\n")
    with open(a.out, "w") as f:
        f.write("\n".join(parts))
    print("wrote", a.out)


if __name__ == "__main__":
    main()
