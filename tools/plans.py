"""Print the physical plans of the gold datasets over a silver transactions table.

usage: python tools/plans.py [sf_dir] [dataset ...]
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from laminar.plans.layers import gold_frames  # noqa: E402
from laminar.session import build_session, fresh_dir  # noqa: E402
from laminar.sources import testdata  # noqa: E402


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", shuffle_partitions=16,
                          extra_conf={"spark.ui.showConsoleProgress": "false"})
    path = f"{fresh_dir(spark, 'plans')}/silver_transactions"
    testdata.transactions(spark, sf_dir).write.parquet(path)
    tx = spark.read.parquet(path)
    frames = gold_frames(tx, testdata.customers(spark, sf_dir), testdata.products(spark, sf_dir),
                         as_of="2001-08-02")
    for name in argv[2:] or frames:
        print(f"\n######## {name}")
        frames[name].explain("formatted")


if __name__ == "__main__":
    main(sys.argv)
