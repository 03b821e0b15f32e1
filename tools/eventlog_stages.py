"""Summarize job, stage and longest-task times from a Spark event log folder (zstd or plain).

Usage: python tools/eventlog_stages.py <eventlog dir> [job description] [min ms]
"""

from __future__ import annotations

import glob
import io
import json
import sys

import zstandard


def events(folder: str):
    for f in sorted(glob.glob(f"{folder}/**/*", recursive=True)):
        name = f.rsplit("/", 1)[-1]
        if not (name.startswith("events_") or name.startswith("local-") or name.startswith("app-")):
            continue
        try:
            raw = open(f, "rb").read()
        except IsADirectoryError:
            continue
        if f.endswith(".zstd"):
            raw = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw)).read()
        for line in raw.decode().splitlines():
            if line.strip():
                yield json.loads(line)


def main() -> None:
    folder = sys.argv[1]
    want = sys.argv[2] if len(sys.argv) > 2 else None
    min_ms = int(sys.argv[3]) if len(sys.argv) > 3 else 100
    jobs, stages, stage_job, longest = {}, {}, {}, {}
    for e in events(folder):
        ev = e["Event"]
        if ev == "SparkListenerJobStart":
            desc = e.get("Properties", {}).get("spark.job.description")
            jobs[e["Job ID"]] = [desc, e["Submission Time"], None]
            for s in e.get("Stage IDs", []):
                stage_job[s] = e["Job ID"]
        elif ev == "SparkListenerJobEnd":
            jobs[e["Job ID"]][2] = e["Completion Time"]
        elif ev == "SparkListenerTaskEnd":
            info = e["Task Info"]
            ms = info["Finish Time"] - info["Launch Time"]
            longest[e["Stage ID"]] = max(longest.get(e["Stage ID"], 0), ms)
        elif ev == "SparkListenerStageCompleted":
            si = e["Stage Info"]
            if "Submission Time" in si:
                stages[si["Stage ID"]] = (si["Completion Time"] - si["Submission Time"], si["Number of Tasks"], si["Stage Name"][:60])
    for jid, (desc, t0, t1) in sorted(jobs.items()):
        if want and desc != want:
            continue
        print(f"job {jid} {desc} {(t1 or t0) - t0} ms")
    for sid, (ms, n, name) in sorted(stages.items()):
        jd = jobs.get(stage_job.get(sid), [None])[0]
        if ms >= min_ms and (not want or jd == want):
            print(f"  stage {sid} job {stage_job.get(sid)} {ms} ms tasks={n} longest_task={longest.get(sid, 0)} ms {name}")


if __name__ == "__main__":
    main()
