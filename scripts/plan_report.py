"""Write PLANS.md: physical plans of the main queries, their writes and rewrites
included, as Spark's event log has them.

Usage: python scripts/plan_report.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
from pathlib import Path

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from strata.plans.catalog import QUERIES  # noqa: E402
from strata.session import get_session  # noqa: E402

SHOWN = ["q01_json_ingest", "q14_global_sort", "q15_split_export", "q23_update", "q24_delete", "q26_pruned_read", "q11_distinct", "q13_first_20"]


def tree(description: str) -> str:
    """The plan's tree, without the details of each node."""
    body = description.split("== Physical Plan ==")[-1].strip()
    return body.split("\n\n")[0]


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    events = tempfile.mkdtemp(prefix="strata-plans-")
    spark = get_session(
        master="local[8]",
        conf={
            "spark.sql.shuffle.partitions": "8",
            "spark.eventLog.enabled": "true",
            "spark.eventLog.dir": f"file://{events}",
            "spark.eventLog.rolling.enabled": "false",
            "spark.eventLog.compress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    for name in SHOWN:
        spark.sparkContext.setLocalProperty("spark.job.description", name)
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    spark.stop()
    plans: dict[int, tuple[str, str]] = {}
    for file in Path(events).iterdir():
        for line in file.open():
            event = json.loads(line)
            if "physicalPlanDescription" in event:
                number = event["executionId"]
                name = event.get("description") or plans.get(number, ("", ""))[0]
                plans[number] = (name, tree(event["physicalPlanDescription"]))
    print(f"# Physical plans ({os.path.basename(sf_dir)}, generated by scripts/plan_report.py)")
    for name in SHOWN:
        print(f"\n## {name}")
        for step, (_, text) in enumerate((p for p in plans.values() if p[0] == name), 1):
            print(f"\n### step {step}\n\n```\n{text}\n```")


if __name__ == "__main__":
    main()
