"""Run or explain one catalogue query.

usage: python -m ordertide.plans [--explain] NAME [SF_DIR]
       python -m ordertide.plans --list
"""

from __future__ import annotations

import sys

from ordertide.params import PipelineParams
from ordertide.plans.catalogue import QUERIES
from ordertide.session import build_session


def main(argv: list[str] | None = None) -> int:
    args = list(sys.argv[1:] if argv is None else argv)
    if not args or args[0] == "--list":
        print("\n".join(sorted(QUERIES)))
        return 0
    explain = args[0] == "--explain"
    if explain:
        args = args[1:]
    name = args[0]
    sf_dir = args[1] if len(args) > 1 else "/root/testdata/sf0.01"
    if name not in QUERIES:
        print(f"unknown query {name!r}; --list shows the names", file=sys.stderr)
        return 2
    spark = build_session(PipelineParams(shuffle_partitions=8),
                          conf={"spark.ui.showConsoleProgress": "false"})
    df = QUERIES[name](spark, sf_dir)
    if explain:
        df.explain("formatted")
    else:
        df.show(20, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
