"""Per-stage task statistics from Spark's event log; prints markdown.

Usage: python scripts/stage_report.py [sf_dir] [query ...] > STAGES.md
Runs each query (eager writes + a noop evaluation of the result) in a session
whose event log goes to a fresh scratch folder, then summarises every stage:
tasks, median / max task time, rows and bytes read, written and shuffled.
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import tempfile
from collections import defaultdict

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from strata.plans.catalog import QUERIES  # noqa: E402
from strata.session import get_session  # noqa: E402

DEFAULT = ["q01_json_ingest", "q15_split_export", "q23_update", "q25_update_delete", "q26_pruned_read"]


def run(sf_dir: str, names: list[str]) -> str:
    log_dir = tempfile.mkdtemp(prefix="strata-eventlog-")
    spark = get_session(
        "strata-stages",
        master="local[8]",
        conf={
            "spark.sql.shuffle.partitions": "16",
            "spark.eventLog.enabled": "true",
            "spark.eventLog.dir": f"file://{log_dir}",
            "spark.eventLog.compress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    for name in names:
        spark.sparkContext.setJobGroup(name, name)
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    spark.stop()
    return log_dir


def _lines(path: str):
    if path.endswith(".zstd"):
        import io

        import zstandard

        with open(path, "rb") as raw:
            reader = zstandard.ZstdDecompressor().stream_reader(raw)
            yield from io.TextIOWrapper(reader, encoding="utf-8")
        return
    with open(path, encoding="utf-8") as fh:
        yield from fh


def summarise(log_dir: str) -> str:
    job_group: dict[int, str] = {}
    stage_job: dict[int, int] = {}
    tasks: dict[int, list[dict]] = defaultdict(list)
    names: dict[int, str] = {}
    for path in glob.glob(os.path.join(log_dir, "**", "events_*"), recursive=True) + glob.glob(
        os.path.join(log_dir, "local-*")
    ):
        for line in _lines(path):
            ev = json.loads(line)
            kind = ev.get("Event")
            if kind == "SparkListenerJobStart":
                group = (ev.get("Properties") or {}).get("spark.jobGroup.id", "")
                job_group[ev["Job ID"]] = group
                for sid in ev.get("Stage IDs", []):
                    stage_job[sid] = ev["Job ID"]
            elif kind == "SparkListenerStageCompleted":
                info = ev["Stage Info"]
                names[info["Stage ID"]] = info.get("Stage Name", "")
            elif kind == "SparkListenerTaskEnd":
                m = ev.get("Task Metrics") or {}
                info = ev["Task Info"]
                shuffle_read = m.get("Shuffle Read Metrics") or {}
                tasks[ev["Stage ID"]].append(
                    {
                        "ms": info["Finish Time"] - info["Launch Time"],
                        "in_rows": (m.get("Input Metrics") or {}).get("Records Read", 0),
                        "in_bytes": (m.get("Input Metrics") or {}).get("Bytes Read", 0),
                        "out_bytes": (m.get("Output Metrics") or {}).get("Bytes Written", 0),
                        "sh_read": shuffle_read.get("Remote Bytes Read", 0) + shuffle_read.get("Local Bytes Read", 0),
                        "sh_write": (m.get("Shuffle Write Metrics") or {}).get("Shuffle Bytes Written", 0),
                    }
                )
    lines = [
        "| query | stage | name | tasks | median ms | max ms | rows in | MB in | MB shuffled (w/r) | MB out |",
        "|---|---|---|---|---|---|---|---|---|---|",
    ]
    mb = lambda b: f"{b / 1e6:.1f}"
    for sid in sorted(tasks):
        ts = tasks[sid]
        durations = [t["ms"] for t in ts]
        group = job_group.get(stage_job.get(sid, -1), "")
        lines.append(
            f"| {group} | {sid} | {names.get(sid, '')[:40]} | {len(ts)} | "
            f"{statistics.median(durations):.0f} | {max(durations)} | {sum(t['in_rows'] for t in ts)} | "
            f"{mb(sum(t['in_bytes'] for t in ts))} | {mb(sum(t['sh_write'] for t in ts))}/"
            f"{mb(sum(t['sh_read'] for t in ts))} | {mb(sum(t['out_bytes'] for t in ts))} |"
        )
    return "\n".join(lines)


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    names = sys.argv[2:] or DEFAULT
    log_dir = run(sf_dir, names)
    print(f"# Stage report ({os.path.basename(sf_dir)}, local[8], generated by scripts/stage_report.py)\n")
    print(summarise(log_dir))


if __name__ == "__main__":
    main()
