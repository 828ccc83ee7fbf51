"""Job and stage durations from a Spark event log (no UI needed).

Run a session with ``spark.eventLog.enabled=true`` and ``spark.eventLog.dir`` set to a
scratch folder, tag work with ``sc.setJobGroup(name, name)``, then:

    python tools/stage_times.py <event log file or folder> [job group ...]
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys


def _lines(path: str):
    files = sorted(glob.glob(os.path.join(path, "events_*"))) if os.path.isdir(path) else [path]
    for f in files:
        with open(f, "rb") as fh:
            if f.endswith(".zstd"):
                import zstandard

                stream = zstandard.ZstdDecompressor().stream_reader(fh)
                yield from io.TextIOWrapper(stream, encoding="utf-8")
            else:
                yield from io.TextIOWrapper(fh, encoding="utf-8")


def summarize(path: str, groups=None) -> dict:
    jobs, stages, job_group, stage_job = {}, {}, {}, {}
    for line in _lines(path):
        e = json.loads(line)
        ev = e["Event"]
        if ev == "SparkListenerJobStart":
            job_group[e["Job ID"]] = (e.get("Properties") or {}).get("spark.jobGroup.id")
            jobs[e["Job ID"]] = [e["Submission Time"], None]
            for s in e["Stage IDs"]:
                stage_job[s] = e["Job ID"]
        elif ev == "SparkListenerJobEnd":
            jobs[e["Job ID"]][1] = e["Completion Time"]
        elif ev == "SparkListenerStageCompleted":
            si = e["Stage Info"]
            stages[si["Stage ID"]] = {
                "name": si["Stage Name"][:60],
                "tasks": si["Number of Tasks"],
                "ms": si.get("Completion Time", 0) - si.get("Submission Time", 0),
            }
    out = {}
    for j, (start, end) in sorted(jobs.items()):
        g = job_group.get(j)
        if groups and g not in groups:
            continue
        entry = out.setdefault(g, {"jobs": 0, "first_start": start, "last_end": end, "stages": []})
        entry["jobs"] += 1
        entry["last_end"] = max(entry["last_end"] or 0, end or 0)
        entry["stages"] += [stages[s] for s in sorted(stages) if stage_job.get(s) == j]
    for g, entry in out.items():
        entry["span_ms"] = (entry.pop("last_end") or 0) - entry.pop("first_start")
    return out


if __name__ == "__main__":
    print(json.dumps(summarize(sys.argv[1], sys.argv[2:] or None), indent=1))
