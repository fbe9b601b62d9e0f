"""Write the physical plan outline of the core operators to docs/PLANS.md.

Usage: python scripts/explain_plans.py [sf_dir]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from faultscore.functions.scorers import torque_wear_score  # noqa: E402
from faultscore.operators.audit import audit_stats, duplicate_keys  # noqa: E402
from faultscore.operators.importance import permuted_copies  # noqa: E402
from faultscore.operators.metrics import ranking_metrics  # noqa: E402
from faultscore.operators.split import stratified_split  # noqa: E402
from faultscore.operators.threshold import threshold_sweep  # noqa: E402
from faultscore.schema import MACHINE_TASK as S  # noqa: E402
from faultscore.session import ensure_checkpoint_dir, get_session  # noqa: E402
from faultscore.sources.adapters import load_machine  # noqa: E402

KEEP = re.compile(r"(Exchange|Window|Join|Aggregate|Scan|Sort|Expand|Generate|InMemory)")


def outline(df) -> str:
    plan = df._jdf.queryExecution().executedPlan().toString()
    lines = []
    for line in plan.splitlines():
        if KEEP.search(line):
            lines.append(re.sub(r"#\d+L?", "", line)[:160])
    return "\n".join(lines)


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session("local[8]")
    ensure_checkpoint_dir(spark)
    m = load_machine(spark, sf)
    split = stratified_split(m, S, 42)
    scored = split.select("udi", "split", F.col(S.target).alias("label"),
                          torque_wear_score(F.col("torque"), F.col("tool_wear")).alias("score"))
    sections = {
        "audit: one aggregate pass": audit_stats(m, S),
        "audit: key uniqueness": duplicate_keys(m, ["udi"]),
        "split assignment (boundaries are literals: no exchange)": split.select("udi", "split"),
        "ranking metrics by split": ranking_metrics(scored, "label", "score", ["split"]),
        "threshold sweep by split": threshold_sweep(scored, "label", "score", ["split"]),
        "permutation copies (one shuffle of the repeats; features expand row by row)": permuted_copies(
            split.where("split = 'validation'").select("udi", *S.features, S.target), S, 42, 10),
    }
    out = ["# Physical plans of the core operators", "",
           f"Generated by `scripts/explain_plans.py` on `{sf}` (outline: exchanges, joins, windows, aggregates, scans).", ""]
    for title, df in sections.items():
        out += [f"## {title}", "", "```", outline(df), "```", ""]
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "docs", "PLANS.md")
    with open(path, "w", encoding="utf-8") as f:
        f.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
