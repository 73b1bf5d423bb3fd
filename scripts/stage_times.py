"""Slowest stages from a Spark event log (JSON lines).

Usage: python scripts/stage_times.py <event-log-file-or-dir> [top_n]
"""

from __future__ import annotations

import json
import os
import sys


def open_log(fp: str):
    """Event-log file, zstd-compressed or plain."""
    if fp.endswith(".zstd") or fp.endswith(".zst"):
        import io

        import zstandard

        return io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(open(fp, "rb")), encoding="utf-8")
    return open(fp, encoding="utf-8")


def stage_rows(path: str):
    if os.path.isdir(path):
        files = sorted(os.path.join(d, f) for d, _, fs in os.walk(path) for f in fs
                       if f.startswith("events") or f.startswith("local-") or f.startswith("app-"))
    else:
        files = [path]
    for fp in files:
        label = {}
        with open_log(fp) as fh:
            for line in fh:
                ev = json.loads(line)
                if ev.get("Event") == "SparkListenerJobStart":
                    desc = (ev.get("Properties") or {}).get("spark.job.description")
                    for sid in ev.get("Stage IDs", []):
                        if desc:
                            label[sid] = desc
                    continue
                if ev.get("Event") != "SparkListenerStageCompleted":
                    continue
                info = ev["Stage Info"]
                sub, done = info.get("Submission Time"), info.get("Completion Time")
                if sub is None or done is None:
                    continue
                sid = info["Stage ID"]
                yield (done - sub) / 1000.0, sid, info.get("Number of Tasks"), label.get(sid, info.get("Stage Name", ""))[:90]


def main() -> None:
    path = sys.argv[1].replace("file:", "")
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 15
    rows = sorted(stage_rows(path), reverse=True)
    print(f"{len(rows)} stages, {sum(r[0] for r in rows):.1f} s total stage time")
    by_label: dict[str, float] = {}
    for sec, _, _, name in rows:
        by_label[name] = by_label.get(name, 0.0) + sec
    for name, sec in sorted(by_label.items(), key=lambda kv: -kv[1])[:top]:
        print(f"{sec:8.2f}s  total  {name}")
    print("slowest stages:")
    for sec, sid, tasks, name in rows[:top]:
        print(f"{sec:8.2f}s  stage {sid:5d}  tasks {tasks:5d}  {name}")


if __name__ == "__main__":
    main()
