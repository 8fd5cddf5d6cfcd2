"""Print the physical plan tree (node names and key arguments) of queries.

Usage: python scripts/show_plans.py [sf_dir] name ...
Runs each query once into the noop sink so the adaptive plan is final.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    sf_dir = sys.argv[1]
    from seismiq.plans.queries import REGISTRY
    from seismiq.session import build_session
    spark = build_session("local[8]", shuffle_partitions=8,
                          extra={"spark.ui.showConsoleProgress": "false"})
    for name in sys.argv[2:]:
        df = REGISTRY[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        plan = df._jdf.queryExecution().executedPlan().toString()
        print(f"### {name}\n```")
        for line in plan.splitlines():
            line = re.sub(r"#\d+L?", "", line)
            line = re.sub(r"\[plan_id=\d+\]", "", line)
            print(line[:160])
        print("```\n")


if __name__ == "__main__":
    main()
