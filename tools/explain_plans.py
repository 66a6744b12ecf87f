"""Write the physical plan of every registered query to docs/PLANS.md.

    python tools/explain_plans.py [sf_dir]

For each query: the operator tree of ``explain("formatted")`` plus the scan's pushed filters
and read schema -- the things to check for shuffles, broadcasts and pruning.
"""

from __future__ import annotations

import contextlib
import io
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from eventide.plans import REGISTRY  # noqa: E402
from eventide.session import get_session  # noqa: E402


def main(argv):
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark = get_session("local[8]", 8)
    spark.sparkContext.setLogLevel("OFF")
    out = ["# Physical plans", "",
           f"`explain(\"formatted\")` of every registered query on `{sf_dir}` (local[8], AQE on;",
           "AQE may still switch a join to broadcast at run time when a side turns out small).",
           "Generated by `tools/explain_plans.py`.", ""]
    for name, q in REGISTRY.items():
        df = q.fn(spark, sf_dir)
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain("formatted")
        text = buf.getvalue()
        tree = text.split("\n\n\n")[0].replace("== Physical Plan ==\n", "").rstrip()
        scans = [ln for ln in text.splitlines()
                 if ln.startswith("PushedFilters") or ln.startswith("ReadSchema")]
        out += [f"## `{name}`", "", "```", tree, *sorted(set(scans)), "```", ""]
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                        "docs", "PLANS.md")
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write("\n".join(out) + "\n")
    print(path)


if __name__ == "__main__":
    main(sys.argv[1:])
