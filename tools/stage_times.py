"""Job/stage timings of registered queries from Spark's event log.

Usage: python tools/stage_times.py [sf_dir] name [name ...]
Each query runs once to warm up, then once more under a job group; the
event log goes to a fresh scratch folder (no UI, no server).
"""

import glob
import json
import os
import sys
import tempfile
import time

import zstandard

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from airshed.plans.registry import QUERIES  # noqa: E402
from airshed.session import build_session  # noqa: E402


def read_events(folder):
    for f in sorted(glob.glob(f"{folder}/*/events_*") + glob.glob(f"{folder}/events_*")):
        with open(f, "rb") as fh:
            raw = fh.read()
        if f.endswith(".zstd"):
            raw = zstandard.ZstdDecompressor().stream_reader(raw).read()
        for line in raw.decode().splitlines():
            yield json.loads(line)


def main():
    args = sys.argv[1:]
    root = args.pop(0) if args and os.path.isdir(args[0]) else "/root/testdata/sf0.1"
    log_dir = tempfile.mkdtemp(prefix="airshed-eventlog-")
    spark = build_session("local[8]", 8, extra={"spark.eventLog.enabled": "true",
                                                "spark.eventLog.dir": log_dir})
    wall = {}
    for name in args:
        spark.sparkContext.setJobGroup("warm-up", "warm-up")
        QUERIES[name](spark, root).write.format("noop").mode("overwrite").save()
        spark.sparkContext.setJobGroup(name, name)
        t0 = time.time()
        QUERIES[name](spark, root).write.format("noop").mode("overwrite").save()
        wall[name] = time.time() - t0
    spark.stop()
    jobs, stages = {}, {}
    for e in read_events(log_dir):
        t = e["Event"]
        if t == "SparkListenerJobStart":
            jobs[e["Job ID"]] = {"start": e["Submission Time"], "stages": e["Stage IDs"],
                                 "group": e.get("Properties", {}).get("spark.jobGroup.id")}
        elif t == "SparkListenerJobEnd":
            jobs[e["Job ID"]]["end"] = e["Completion Time"]
        elif t == "SparkListenerStageCompleted":
            si = e["Stage Info"]
            stages[si["Stage ID"]] = (si.get("Completion Time", 0) - si.get("Submission Time", 0),
                                      si["Number of Tasks"])
    for name in args:
        mine = [v for _, v in sorted(jobs.items()) if v["group"] == name]
        busy = sum(v["end"] - v["start"] for v in mine)
        print(f"== {name}: wall {wall[name]:.2f}s, {len(mine)} jobs, {busy / 1000:.2f}s inside jobs")
        for v in mine:
            st = [f"stage {s}: {stages[s][0]} ms x{stages[s][1]} tasks" for s in v["stages"] if s in stages]
            print(f"   +{v['start'] - mine[0]['start']:>5} ms  {v['end'] - v['start']:>5} ms  " + "; ".join(st))
    print(f"(event log: {log_dir})")


if __name__ == "__main__":
    main()
