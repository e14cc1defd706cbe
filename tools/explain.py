"""Print the formatted physical plan of registered queries.

Usage: python tools/explain.py [sf_dir] name [name ...]
Multi-pass operators (kernel density, samples) run their earlier passes while
the DataFrame is built; the plan shown is the final one.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from qualmark.plans.queries import QUERIES  # noqa: E402
from qualmark.session import local_session  # noqa: E402


def main() -> None:
    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and os.path.isdir(args[0]) else "/root/testdata/sf0.01"
    spark = local_session(8)
    for name in args or list(QUERIES):
        print(f"===== {name}")
        QUERIES[name](spark, sf_dir).explain("formatted")


if __name__ == "__main__":
    main()
