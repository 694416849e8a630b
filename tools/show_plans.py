"""Print the formatted physical plan of registered queries (default: the bench headline).

Usage: python tools/show_plans.py [sf_dir] [name ...]
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from bench import HEADLINE  # noqa: E402
from surveyspark.plans.catalog import QUERIES  # noqa: E402
from surveyspark.session import get_spark  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or HEADLINE
    spark = get_spark("local[8]", 16)
    for name in names:
        print(f"===================== {name}")
        QUERIES[name](spark, sf_dir).explain("formatted")
    spark.stop()


if __name__ == "__main__":
    main()
