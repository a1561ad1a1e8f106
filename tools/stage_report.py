"""Slowest stages of one registered query, from Spark's event log written to a scratch folder.

usage: python tools/stage_report.py <query-name> [sf_dir] [top]

Runs a warm-up job, then the query (DataFrame build timed separately from the run), with
``spark.eventLog.enabled`` pointing at a fresh ``mktemp`` folder, and prints the slowest stages
with their operator scopes and the busiest task's metrics. No UI or REST endpoint is used.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def _lines(path: str) -> list[str]:
    with open(path, "rb") as fh:
        data = fh.read()
    if path.endswith(".zstd"):
        import zstandard

        data = zstandard.ZstdDecompressor().stream_reader(__import__("io").BytesIO(data)).read()
    return data.decode().splitlines()


def main() -> None:
    name = sys.argv[1]
    sf_dir = sys.argv[2] if len(sys.argv) > 2 else "/root/testdata/sf0.1"
    top = int(sys.argv[3]) if len(sys.argv) > 3 else 8
    log_dir = tempfile.mkdtemp(prefix="cohortflow-evlog-")
    from cohortflow.registry import queries
    from cohortflow.session import local_session

    spark = local_session(8, extra={"spark.ui.showConsoleProgress": "false", "spark.eventLog.enabled": "true",
                                    "spark.eventLog.dir": log_dir})
    qs = queries()
    qs["job_lapsed_base"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    app = spark.sparkContext.applicationId
    t0 = time.time()
    df = qs[name](spark, sf_dir)
    t1 = time.time()
    df.write.format("noop").mode("overwrite").save()
    t2 = time.time()
    spark.stop()
    print(f"{name}: build {t1 - t0:.2f}s run {t2 - t1:.2f}s")
    events = [json.loads(x) for f in sorted(glob.glob(f"{log_dir}/*{app}*/events_*") + glob.glob(f"{log_dir}/*{app}*"))
              if os.path.isfile(f) for x in _lines(f)]
    stages, tasks = [], {}
    for e in events:
        if e["Event"] == "SparkListenerTaskEnd":
            m = e.get("Task Metrics") or {}
            tasks.setdefault(e["Stage ID"], []).append(m)
        if e["Event"] == "SparkListenerStageCompleted":
            s = e["Stage Info"]
            if s.get("Submission Time") and s.get("Completion Time") and s["Submission Time"] / 1000 >= t0 - 0.5:
                scopes = sorted({json.loads(r["Scope"])["name"] for r in s.get("RDD Info", []) if r.get("Scope")})
                stages.append((s["Completion Time"] - s["Submission Time"], s["Stage ID"], s["Number of Tasks"], scopes))
    print(f"stages: {len(stages)}, summed stage time {sum(x[0] for x in stages)} ms")
    for ms, sid, ntasks, scopes in sorted(stages, reverse=True)[:top]:
        busiest = max(tasks.get(sid, [{}]), key=lambda m: m.get("Executor Run Time", 0))
        print(f"{ms:6d} ms  stage {sid:4d}  tasks {ntasks:3d}  run {busiest.get('Executor Run Time', 0)} ms  "
              f"cpu {busiest.get('Executor CPU Time', 0) // 1_000_000} ms  | {', '.join(scopes)[:120]}")


if __name__ == "__main__":
    main()
