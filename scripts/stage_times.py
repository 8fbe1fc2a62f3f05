"""Summarise stage durations from a Spark event log folder (no UI needed).

Usage: python scripts/stage_times.py <event-log-dir>
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
        with open(path, "rb") as fh:
            reader = zstandard.ZstdDecompressor().stream_reader(fh)
            yield from io.TextIOWrapper(reader, encoding="utf-8")
    else:
        with open(path, encoding="utf-8") as fh:
            yield from fh


def main(path: str) -> None:
    files = [p for p in glob.glob(f"{path}/**/events_*", recursive=True) if os.path.isfile(p)]
    for f in sorted(files):
        stages = {}
        for line in _lines(f):
            ev = json.loads(line)
            if ev.get("Event") == "SparkListenerStageCompleted":
                info = ev["Stage Info"]
                dur = (info.get("Completion Time", 0) - info.get("Submission Time", 0)) / 1000
                stages[info["Stage ID"]] = (dur, info["Number of Tasks"], info["Stage Name"][:70])
        total = 0.0
        for sid, (dur, n, name) in sorted(stages.items()):
            total += dur
            print(f"stage {sid:4d} {dur:7.2f}s tasks {n:4d} {name}")
        print(f"{f}: {len(stages)} stages, {total:.1f}s summed")


if __name__ == "__main__":
    main(sys.argv[1])
