"""Benchmark the composed jobs (P1-P19) on one scale factor.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_QUERIES
(comma-separated names, default: all jobs). Each query is executed fully with the ``noop`` sink
(no rows brought to the driver). Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


#: Other forms of the same jobs (many anchors, stored tables) would not compare with earlier rounds; BENCH_QUERIES names them.
OTHER_FORMS = {"job_reactivation_features_many", "job_reactivation_features_stored", "job_cohorts_many"}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from cohortflow.registry import queries
    from cohortflow.session import local_session

    spark = local_session(cpus, app="cohortflow-bench", shuffle_partitions=int(os.environ.get("BENCH_PARTITIONS", int(cpus) * 2)),
                          extra={"spark.ui.showConsoleProgress": "false"})
    qs = queries()
    names = os.environ.get("BENCH_QUERIES")
    selected = names.split(",") if names else sorted(n for n in qs if n.startswith("job_") and n not in OTHER_FORMS)

    # warm-up: JVM, code generation, file listing
    qs["job_lapsed_base"](spark, sf_dir).write.format("noop").mode("overwrite").save()

    timings: dict[str, float] = {}
    errors: dict[str, str] = {}
    for name in selected:
        t0 = time.perf_counter()
        try:
            qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        except Exception as e:  # noqa: BLE001  (report and continue; one line of JSON is always printed)
            errors[name] = f"{type(e).__name__}: {str(e)[:200]}"
            continue
        timings[name] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "total_job_seconds",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": int(cpus),
    }
    if errors:
        out["errors"] = errors
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
