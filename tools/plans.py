"""Writes PLANS.md: the final (adaptive) physical plans of the headline batch
plans after running them at the given scale.

usage: python tools/plans.py [sf_dir]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ordertide.params import PipelineParams  # noqa: E402
from ordertide.plans.catalogue import QUERIES  # noqa: E402
from ordertide.session import build_session  # noqa: E402

PLANS = ["store_metrics_5m", "store_metrics_5m_salted", "curate_orders", "salting_parity",
         "skew_profile", "order_total_check", "item_lines", "bronze_latest", "dashboard_silver"]
WIDTH = 200


def final_plan(df) -> str:
    qe = df._jdf.queryExecution()
    qe.toRdd().count()                       # run this plan itself, so AQE finalizes it
    text = qe.executedPlan().toString()
    text = text.split("== Initial Plan ==")[0]
    text = re.sub(r"#\d+L?", "", text)                       # expression ids
    return "\n".join(line if len(line) <= WIDTH else line[:WIDTH] + " …" for line in text.splitlines())


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session(PipelineParams(shuffle_partitions=8), master="local[8]",
                          conf={"spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    out = ["# Final physical plans", "",
           f"Generated by `tools/plans.py` at `{sf_dir}` (local[8], 8 shuffle partitions, AQE on), after",
           "each plan ran. Expression ids are stripped; long lines are cut.", ""]
    for name in PLANS:
        out += [f"## {name}", "", "```", final_plan(QUERIES[name](spark, sf_dir)), "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"),
              "w", encoding="utf-8") as fh:
        fh.write("\n".join(out))


if __name__ == "__main__":
    main()
