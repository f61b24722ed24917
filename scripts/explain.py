"""Print the formatted physical plan of registered queries.

Usage: python scripts/explain.py [sf_dir] [name ...]
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from omoplate.plans.registry import QUERIES  # noqa: E402
from omoplate.session import get_session  # noqa: E402


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or ["observation_period", "visit_lookup", "measurement"]
    spark = get_session("local[8]", 8)
    for name in names:
        print(f"===== {name} =====")
        QUERIES[name](spark, sf).explain("formatted")


if __name__ == "__main__":
    main()
