"""Audit the physical plans of the registered queries.

Prints, per query, shuffles, window operators, Python operators, and anything that
would not hold at scale: nested-loop or Cartesian joins, and unbounded single-partition
exchanges (those under a global aggregate or a limit carry bounded rows).
"""

from __future__ import annotations

import pathlib
import re
import sys

ROOT = pathlib.Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))


def main() -> int:
    from seriesforge import session
    from seriesforge.plans.catalog import load_all

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    spark = session.build(master="local[2]", spark__ui__enabled="false", spark__sql__autoBroadcastJoinThreshold="-1")
    spark.sparkContext.setLogLevel("ERROR")
    bad = 0
    for name, reg in load_all().items():
        plan = reg.plan(spark, sf)._jdf.queryExecution().executedPlan().toString()
        count = lambda p: len(re.findall(p, plan))
        loops = count(r"BroadcastNestedLoopJoin|CartesianProduct")
        single_window = count(r"Window .*\n.*Sort.*\n.*Exchange SinglePartition")
        print(
            f"{name:34s} shuffles {count(r'Exchange hashpartitioning|Exchange rangepartitioning|Exchange RoundRobin'):3d} "
            f"windows {count(r'- Window |Window '):3d} python {count('EvalPython'):2d} single {count('Exchange SinglePartition'):2d}"
            + (f"  LOOPS {loops}" if loops else "") + (f"  GLOBAL WINDOW {single_window}" if single_window else "")
        )
        bad += loops + single_window
    print(f"{bad} findings")
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main())
