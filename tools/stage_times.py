"""Summarise stage durations from a Spark event log (no UI needed).

usage: python tools/stage_times.py <event-log-file-or-dir> [top_n]
Prints the slowest stages with their task count, shuffle read/write bytes
and the name Spark gave them (call site).
"""

from __future__ import annotations

import json
import os
import sys


def _files(path: str):
    if os.path.isfile(path):
        yield path
        return
    for root, _dirs, names in os.walk(path):
        for name in sorted(names):
            if name.startswith(("events", "app-", "local-")) or name.endswith(".inprogress"):
                yield os.path.join(root, name)


def _lines(f: str):
    if f.endswith(".zstd"):
        import zstandard
        with open(f, "rb") as fh:
            text = zstandard.ZstdDecompressor().stream_reader(fh).read().decode("utf-8")
        yield from text.splitlines()
    else:
        with open(f, encoding="utf-8") as fh:
            yield from fh


def _events(path: str):
    for f in _files(path):
        for line in _lines(f):
            if line.strip():
                yield json.loads(line)


def main() -> None:
    path = sys.argv[1]
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 15
    stages = []
    for ev in _events(path):
        if ev.get("Event") != "SparkListenerStageCompleted":
            continue
        info = ev["Stage Info"]
        start, end = info.get("Submission Time"), info.get("Completion Time")
        if start is None or end is None:
            continue
        acc = {a.get("Name"): a.get("Value") for a in info.get("Accumulables", [])}
        stages.append((end - start, info["Stage ID"], info.get("Number of Tasks"),
                       acc.get("internal.metrics.shuffle.read.remoteBytesRead", 0) or 0,
                       acc.get("internal.metrics.shuffle.read.localBytesRead", 0) or 0,
                       acc.get("internal.metrics.shuffle.write.bytesWritten", 0) or 0,
                       info.get("Stage Name", "")))
    stages.sort(reverse=True)
    print(f"{'ms':>8} {'stage':>6} {'tasks':>6} {'shuf_read':>11} {'shuf_write':>11}  name")
    for ms, sid, tasks, rr, lr, w, name in stages[:top]:
        print(f"{ms:>8} {sid:>6} {tasks:>6} {int(rr) + int(lr):>11} {int(w):>11}  {name[:70]}")
    print(f"{len(stages)} stages, {sum(s[0] for s in stages)} ms in total")


if __name__ == "__main__":
    main()
