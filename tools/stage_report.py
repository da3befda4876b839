"""Summarise stage times from a Spark event log (no UI needed).

Usage:
    BENCH_EVENT_LOG=$(mktemp -d /tmp/run-XXXXXX) python bench.py
    python tools/stage_report.py <that folder> [top_n]

Prints the slowest stages and any single-task stage that read more than 1 MB
(a sign of work that does not spread over the cluster).
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys


def _lines(path: str):
    if path.endswith(".zstd"):
        import zstandard
        with open(path, "rb") as f:
            yield from io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(f), encoding="utf-8")
    else:
        with open(path, encoding="utf-8") as f:
            yield from f


def stages(folder: str) -> list[tuple]:
    files = [p for p in glob.glob(os.path.join(folder, "**", "*"), recursive=True) if os.path.isfile(p)]
    out = []
    for path in files:
        for line in _lines(path):
            e = json.loads(line)
            if e.get("Event") != "SparkListenerStageCompleted":
                continue
            si = e["Stage Info"]
            acc = {a["Name"]: a.get("Value") for a in si.get("Accumulables", [])}

            def g(k):
                return int(acc.get(k) or 0)

            dur = (si.get("Completion Time", 0) - si.get("Submission Time", 0)) / 1000
            out.append((round(dur, 3), si["Stage ID"], si["Number of Tasks"], si["Stage Name"][:50],
                        g("internal.metrics.input.bytesRead"),
                        g("internal.metrics.shuffle.read.localBytesRead")
                        + g("internal.metrics.shuffle.read.remoteBytesRead"),
                        g("internal.metrics.shuffle.write.bytesWritten")))
    return out


def main() -> None:
    folder = sys.argv[1]
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 15
    st = stages(folder)
    print(f"{len(st)} stages, {sum(s[0] for s in st):.2f} s in total")
    print("sec, stage, tasks, name, input bytes, shuffle read, shuffle write")
    for s in sorted(st, reverse=True)[:top]:
        print(s)
    single = [s for s in st if s[2] == 1 and max(s[4], s[5]) > 1 << 20]
    print(f"single-task stages reading > 1 MB: {len(single)}")
    for s in single:
        print(s)


if __name__ == "__main__":
    main()
