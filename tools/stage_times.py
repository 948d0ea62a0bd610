"""Job and stage durations from a Spark event log folder.

usage: BENCH_EVENT_LOG_DIR=$(mktemp -d /tmp/run-XXXXXX) python bench.py
       python tools/stage_times.py <that folder>
Jobs are grouped by their job description (bench.py sets it per query).
"""

from __future__ import annotations

import collections
import glob
import io
import json
import os
import sys


def _lines(path: str):
    raw = open(path, "rb").read()
    if path.endswith(".zstd"):
        import zstandard
        raw = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw)).read()
    for line in raw.decode().splitlines():
        if line.strip():
            yield json.loads(line)


def main(folder: str) -> None:
    files = [f for f in glob.glob(os.path.join(folder, "**", "*"), recursive=True)
             if os.path.isfile(f) and os.path.basename(f).startswith(("events", "local-", "app-"))]
    jobs, stages, stage_of = {}, {}, {}
    for f in sorted(files):
        for e in _lines(f):
            kind = e.get("Event")
            if kind == "SparkListenerJobStart":
                desc = e.get("Properties", {}).get("spark.job.description", "")
                jobs[e["Job ID"]] = {"desc": desc, "start": e["Submission Time"], "end": None}
                for s in e.get("Stage IDs", []):
                    stage_of[s] = e["Job ID"]
            elif kind == "SparkListenerJobEnd":
                jobs[e["Job ID"]]["end"] = e["Completion Time"]
            elif kind == "SparkListenerStageCompleted":
                si = e["Stage Info"]
                stages[si["Stage ID"]] = (si.get("Completion Time", 0) - si.get("Submission Time", 0), si["Number of Tasks"])
    per_desc = collections.defaultdict(lambda: [0, 0, 0])
    for jid, j in jobs.items():
        d = per_desc[j["desc"]]
        d[0] += 1
        d[1] += (j["end"] or j["start"]) - j["start"]
    for sid, (ms, _) in stages.items():
        per_desc[jobs[stage_of[sid]]["desc"]][2] += ms if sid in stage_of else 0
    print(f"{'job description':40s} {'jobs':>5s} {'job ms':>8s} {'stage ms':>9s}")
    for desc, (n, job_ms, stage_ms) in sorted(per_desc.items()):
        print(f"{desc[:40]:40s} {n:5d} {job_ms:8d} {stage_ms:9d}")


if __name__ == "__main__":
    main(sys.argv[1])
