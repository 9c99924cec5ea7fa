"""Write PLANS.md: formatted physical plans of the two row-moving steps (``python -m pulseward.plans.explain``)."""

from __future__ import annotations

import os
import re
import sys

from ..operators import lateness, scan
from ..session import get_spark
from . import live
from .catalog import QUERIES


def fmt(df) -> str:
    """The plan tree plus, per exchange / scan / window / join / aggregate node, its key lines."""
    text = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    tree, _, details = text.partition("\n\n\n")
    keep = []
    for block in re.split(r"\n(?=\(\d+\) )", details):
        lines = block.strip().splitlines()
        if not lines:
            continue
        head = lines[0]
        if not re.match(r"\(\d+\) (Exchange|Scan|Window|SortMergeJoin|BroadcastHashJoin|HashAggregate)", head):
            continue
        picked = [l for l in lines[1:] if l.startswith(("Arguments:", "ReadSchema:", "PushedFilters:", "Keys"))]
        keep.append(head + "".join("\n    " + (l if len(l) < 180 else l[:177] + "...") for l in picked))
    return tree.strip() + "\n\n" + "\n".join(keep)

def main(sf: str = "/root/testdata/sf0.01") -> str:
    scan.ROWS_PER_RANGE = 1000   # several ranges on this small input
    spark = get_spark(master="local[8]", shuffle_partitions=8)
    parts = [    "# Physical plans of the two row-moving steps\n",
             "Generated with `explain(\"formatted\")` on sf0.01 (the initial plan; with AQE the small sort-merge joins "
             "become broadcasts at run time). Read them for: one `Exchange` of the rows (the one whose input carries "
             "record columns such as `bmi`), the scans' pruned `ReadSchema` / `PushedFilters`, and windows "
             "partitioned by range keys only.\n",
             "## Watermark over the parsed feed (`lateness.with_watermark`)\n",
             "Rows: one `Exchange hashpartitioning(_range)`, ranges of the arrival order of about equal row counts. "
             "The summary has one row per range.\n", "```", fmt(lateness.with_watermark(live.checked_feed(spark, sf))), "```\n",
             "## Running per-patient state (`patient_risk_running`)\n",
             "Rows: one `Exchange hashpartitioning(patient_id, _range)`. The carry has one row per (patient, range), is "
             "scanned by a window per patient and joined back on (patient, range).\n",
             "```", fmt(QUERIES["patient_risk_running"](spark, sf)), "```\n"]
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "PLANS.md")
    with open(path, "w") as f:
        f.write("\n".join(parts))
    return path


if __name__ == "__main__":
    print(main(*sys.argv[1:]))
