"""Per-job plan statistics from the AQE final plan: shuffles, broadcasts, scans, reuse, joins.

usage: python tools/plan_report.py [sf_dir]   (prints a markdown table)
"""

from __future__ import annotations

import contextlib
import io
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    from cohortflow.registry import queries
    from cohortflow.session import local_session

    spark = local_session(8, extra={"spark.ui.showConsoleProgress": "false"})
    qs = queries()
    print("| job | shuffle exchanges | broadcast exchanges | reused exchanges | parquet scans | sort-merge joins | "
          "broadcast joins | windows | python nodes |")
    print("|---|---|---|---|---|---|---|---|---|")
    for name in sorted(n for n in qs if n.startswith("job_")):
        df = qs[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        df.collect()
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain()
        p = buf.getvalue().split("== Initial Plan ==")[0]  # AQE prints the final plan, then the initial one
        stats = [p.count("Exchange hashpartitioning") + p.count("Exchange rangepartitioning"),
                 p.count("BroadcastExchange"), p.count("ReusedExchange"), p.count("FileScan parquet"),
                 p.count("SortMergeJoin"), p.count("BroadcastHashJoin"), p.count(" Window "),
                 p.count("EvalPython") + p.count("ArrowEvalPython")]
        print(f"| `{name}` | " + " | ".join(str(s) for s in stats) + " |")


if __name__ == "__main__":
    main()
