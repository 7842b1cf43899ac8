"""Summarise a Spark event log: job count, total job and stage time, slowest stages.

Usage:
    D=$(mktemp -d /tmp/run-XXXXXX)
    BENCH_EVENT_LOG=$D python bench.py
    python scripts/stage_times.py $D [top_n]
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys


def _lines(path: str):
    with open(path, "rb") as fh:
        if path.endswith(".zstd"):
            import zstandard

            yield from io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(fh), encoding="utf-8")
        else:
            yield from io.TextIOWrapper(fh, encoding="utf-8")


def main() -> None:
    root = sys.argv[1]
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 10
    files = sorted(glob.glob(os.path.join(root, "**", "events_*"), recursive=True)) or \
        sorted(p for p in glob.glob(os.path.join(root, "*")) if os.path.isfile(p))
    jobs: dict[int, dict] = {}
    stages: dict[int, tuple[int, str, int]] = {}
    for f in files:
        for line in _lines(f):
            e = json.loads(line)
            ev = e.get("Event")
            if ev == "SparkListenerJobStart":
                jobs[e["Job ID"]] = {"start": e["Submission Time"]}
            elif ev == "SparkListenerJobEnd" and e["Job ID"] in jobs:
                jobs[e["Job ID"]]["end"] = e["Completion Time"]
            elif ev == "SparkListenerStageCompleted":
                si = e["Stage Info"]
                if "Completion Time" in si and "Submission Time" in si:
                    stages[si["Stage ID"]] = (si["Completion Time"] - si["Submission Time"],
                                              si["Stage Name"][:80], si["Number of Tasks"])
    job_ms = sum(j.get("end", j["start"]) - j["start"] for j in jobs.values())
    print(f"jobs {len(jobs)}  job time {job_ms} ms  stages {len(stages)}  "
          f"stage time {sum(v[0] for v in stages.values())} ms")
    for sid, (ms, name, tasks) in sorted(stages.items(), key=lambda kv: -kv[1][0])[:top]:
        print(f"stage {sid:5d} {ms:7d} ms {tasks:6d} tasks  {name}")


if __name__ == "__main__":
    main()
