"""Print the final adaptive physical plan of registered queries.

Usage: python tools/show_plans.py [sf_dir] name [name ...]
The query is executed once so the plan shown is AQE's final plan.
"""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from airshed.plans.registry import QUERIES  # noqa: E402
from airshed.session import build_session  # noqa: E402


def main():
    args = sys.argv[1:]
    root = args.pop(0) if args and os.path.isdir(args[0]) else "/root/testdata/sf0.1"
    spark = build_session("local[8]", 8)
    for name in args:
        df = QUERIES[name](spark, root)
        df.collect()
        print(f"===== {name}")
        df.explain("formatted")
    spark.stop()


if __name__ == "__main__":
    main()
