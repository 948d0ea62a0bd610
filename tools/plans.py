"""Print the formatted physical plan of registered queries.

usage: python tools/plans.py [sf_dir] name [name ...]
Shows PushedFilters / ReadSchema of the scans, the exchanges, the join
strategies and the aggregate kinds Spark picked.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from quarry.queries import QUERIES  # noqa: E402
from quarry.session import build_session  # noqa: E402


def main() -> None:
    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    spark = build_session("local[8]", shuffle_partitions=8)
    for name in args or list(QUERIES):
        print(f"===== {name}")
        QUERIES[name](spark, sf_dir).explain("formatted")
    spark.stop()


if __name__ == "__main__":
    main()
