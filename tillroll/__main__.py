"""Run a registered query and show its result.

``python -m tillroll`` lists the queries; ``python -m tillroll <key>
[tables_dir] [rows]`` runs one over the Parquet tables in ``tables_dir``
(default /root/testdata/sf0.01) and prints up to ``rows`` rows.
"""

from __future__ import annotations

import sys


def main(argv: list[str]) -> int:
    from .plans.registry import OPERATORS, QUERIES, load_all
    load_all()
    if len(argv) < 2:
        for key in sorted(QUERIES, key=lambda k: (OPERATORS[k].__module__, k)):
            fn = OPERATORS[key]
            doc = (fn.__doc__ or "").strip().splitlines()
            print(f"{fn.__module__.rsplit('.', 1)[-1]:14s} {key:32s} {doc[0] if doc else ''}")
        return 0
    key = argv[1]
    root = argv[2] if len(argv) > 2 else "/root/testdata/sf0.01"
    rows = int(argv[3]) if len(argv) > 3 else 20
    if key not in QUERIES:
        print(f"unknown query {key!r}; run without arguments for the list", file=sys.stderr)
        return 2
    from .session import build_session
    spark = build_session("local[*]")
    QUERIES[key](spark, root).show(rows, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
