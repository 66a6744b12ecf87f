"""Write docs/QUERIES.md: every registered query with its description and oracle SQL."""

from __future__ import annotations

import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from eventide.plans import REGISTRY  # noqa: E402


def main() -> None:
    out = ["# Registered queries", "",
           f"{len(REGISTRY)} queries over the test tables (`__spark_entry__.queries()`); "
           f"{sum(1 for q in REGISTRY.values() if q.sql)} carry an oracle SQL text "
           "(`oracle_sql()`). Generated by `tools/list_queries.py`.", ""]
    for name, q in REGISTRY.items():
        doc = " ".join(q.doc.split())
        out += [f"## `{name}`", "", doc or "-", ""]
        if q.sql:
            out += ["```sql", q.sql, "```", ""]
        else:
            out += ["No oracle SQL (see the docstring); checked by tests instead.", ""]
    path = os.path.join(ROOT, "docs", "QUERIES.md")
    with open(path, "w") as f:
        f.write("\n".join(out) + "\n")
    print(path)


if __name__ == "__main__":
    main()
