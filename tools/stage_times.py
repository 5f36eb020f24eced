"""Summarise a Spark event log: per job, its stages with wall time, tasks and shuffle bytes.

Usage: python tools/stage_times.py <event log file or v2 folder> [top_n]
"""

from __future__ import annotations

import json
import os
import sys


def _lines(path: str):
    """Lines of a single event log file, or of every rolled file of a v2 log folder."""
    files = [path]
    if os.path.isdir(path):
        names = [n for n in os.listdir(path) if n.startswith("events_")]
        names.sort(key=lambda n: int(n.split("_")[1]) if n.split("_")[1].isdigit() else 0)
        files = [os.path.join(path, n) for n in names]
    for fp in files:
        if fp.endswith(".zstd"):
            import io

            import zstandard
            with open(fp, "rb") as raw:
                reader = zstandard.ZstdDecompressor().stream_reader(raw)
                yield from io.TextIOWrapper(reader, encoding="utf-8")
        else:
            with open(fp) as f:
                yield from f


def main(path: str, top: int = 15) -> None:
    stages, jobs = {}, {}
    for line in _lines(path):
        if line.strip():
            e = json.loads(line)
            kind = e.get("Event")
            if kind == "SparkListenerStageCompleted":
                info = e["Stage Info"]
                t0, t1 = info.get("Submission Time"), info.get("Completion Time")
                acc = {a.get("Name"): a.get("Value") for a in info.get("Accumulables", [])}
                stages[info["Stage ID"]] = dict(
                    name=info.get("Stage Name", "")[:60], tasks=info.get("Number of Tasks"),
                    ms=(t1 - t0) if t0 and t1 else None,
                    shuffle_write=acc.get("internal.metrics.shuffle.write.bytesWritten"),
                    shuffle_read=acc.get("internal.metrics.shuffle.read.remoteBytesRead"))
            elif kind == "SparkListenerJobStart":
                jobs[e["Job ID"]] = dict(stages=e.get("Stage IDs", []), start=e.get("Submission Time"))
            elif kind == "SparkListenerJobEnd" and e["Job ID"] in jobs:
                jobs[e["Job ID"]]["end"] = e.get("Completion Time")
    ranked = sorted(stages.items(), key=lambda kv: -(kv[1]["ms"] or 0))[:top]
    print(f"{len(jobs)} jobs, {len(stages)} stages; slowest stages:")
    for sid, s in ranked:
        print(f"  stage {sid:5d} {s['ms'] or 0:7d} ms  tasks={s['tasks']:5d}  "
              f"shuffle_write={s['shuffle_write'] or 0:>10}  {s['name']}")
    total = sum((j.get("end", 0) or 0) - (j.get("start", 0) or 0) for j in jobs.values())
    print(f"sum of job wall times: {total} ms")


if __name__ == "__main__":
    main(sys.argv[1], int(sys.argv[2]) if len(sys.argv) > 2 else 15)
