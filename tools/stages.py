"""Summarise a Spark event log: per job, its stages with task count and wall time.

Usage: python tools/stages.py <event-log-dir-or-file> [min_seconds]
"""

import glob
import json
import os
import sys


def main():
    path = sys.argv[1]
    min_s = float(sys.argv[2]) if len(sys.argv) > 2 else 0.2
    files = [path] if os.path.isfile(path) else sorted(
        p for p in glob.glob(os.path.join(path, "**", "*"), recursive=True) if os.path.isfile(p))
    for f in files:
        jobs = {}
        for line in open(f):
            e = json.loads(line)
            ev = e.get("Event")
            if ev == "SparkListenerJobStart":
                jobs[e["Job ID"]] = {"start": e["Submission Time"], "stages": e["Stage IDs"],
                                     "desc": (e.get("Properties") or {}).get("spark.job.description", "")}
            elif ev == "SparkListenerJobEnd":
                jobs[e["Job ID"]]["end"] = e["Completion Time"]
            elif ev == "SparkListenerStageCompleted":
                info = e["Stage Info"]
                for j in jobs.values():
                    if info["Stage ID"] in j["stages"]:
                        j.setdefault("done", []).append(
                            (info["Stage ID"], info["Stage Name"][:60], info["Number of Tasks"],
                             (info.get("Completion Time", 0) - info.get("Submission Time", 0)) / 1000))
        for jid, j in sorted(jobs.items()):
            dur = (j.get("end", j["start"]) - j["start"]) / 1000
            if dur < min_s:
                continue
            print(f"job {jid}: {dur:.2f}s {j['desc'][:60]}")
            for sid, name, n, s in j.get("done", []):
                print(f"    stage {sid}: {s:.2f}s tasks={n} {name}")


if __name__ == "__main__":
    main()
