"""Stage times from a Spark event log (no web UI needed).

usage: python tools/stage_times.py <event-log-file-or-folder> [top]

Prints the slowest stages: id, duration, task count, summed task time,
shuffle read/write, and the stage name (call site).
"""

from __future__ import annotations

import glob
import json
import os
import sys


def _lines(path: str):
    if path.endswith(".zstd"):
        import io

        import zstandard

        with open(path, "rb") as raw:
            reader = zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True)
            yield from io.TextIOWrapper(reader, encoding="utf-8")
    else:
        with open(path, encoding="utf-8") as f:
            yield from f


def main() -> None:
    path = sys.argv[1]
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 20
    # rolling event logs (Spark 4 default) are folders of events_* files
    files = sorted(glob.glob(os.path.join(path, "events_*"))) if os.path.isdir(path) else [path]
    stages, task_ms = {}, {}
    for line in (line for f in files for line in _lines(f)):
        if True:
            ev = json.loads(line)
            kind = ev.get("Event")
            if kind == "SparkListenerTaskEnd":
                sid = ev["Stage ID"]
                info = ev.get("Task Info", {})
                task_ms[sid] = task_ms.get(sid, 0) + info.get("Finish Time", 0) - info.get("Launch Time", 0)
            elif kind == "SparkListenerStageCompleted":
                st = ev["Stage Info"]
                acc = {a.get("Name"): a.get("Value") for a in st.get("Accumulables", [])}
                stages[st["Stage ID"]] = {
                    "ms": st.get("Completion Time", 0) - st.get("Submission Time", 0),
                    "tasks": st.get("Number of Tasks"),
                    "name": st.get("Stage Name", "")[:60],
                    "read": acc.get("internal.metrics.shuffle.read.recordsRead", 0),
                    "write": acc.get("internal.metrics.shuffle.write.recordsWritten", 0),
                }
    rows = sorted(stages.items(), key=lambda kv: -kv[1]["ms"])[:top]
    print(f"{'stage':>6} {'ms':>7} {'tasks':>6} {'task ms':>8} {'shuf rd':>9} {'shuf wr':>9}  name")
    for sid, s in rows:
        print(f"{sid:>6} {s['ms']:>7} {s['tasks']:>6} {task_ms.get(sid, 0):>8} {s['read']:>9} {s['write']:>9}  {s['name']}")
    print(f"stages: {len(stages)}, total stage ms: {sum(s['ms'] for s in stages.values())}")


if __name__ == "__main__":
    main()
