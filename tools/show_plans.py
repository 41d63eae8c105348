"""Print the formatted physical plans of the headline feed queries.

    python tools/show_plans.py [--sf-dir /root/testdata/sf0.01]

What to look for: one text scan with ``ReadSchema: struct<value:string>``,
the MapInArrow continuation step, broadcast joins only on the hit side (no
Exchange between the scan and the output), and lookup build sides reading
their own ``entry=`` partition (``PartitionFilters``).
"""

from __future__ import annotations

import argparse
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from hitloom import datafeed, synth  # noqa: E402
from hitloom.session import local_session  # noqa: E402


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf-dir", default="/root/testdata/sf0.01")
    args = ap.parse_args()
    spark = local_session(8)
    root = synth.ensure_feeds(spark, args.sf_dir)
    web = datafeed(spark).load(f"{root}/web")
    plans = {
        "hits per os (flagship)": web.groupBy("os").agg(F.count(F.lit(1)).alias("n_hits")),
        "one column, no lookup": web.select("hit_id"),
        "full width, all lookups": web,
    }
    for title, df in plans.items():
        print(f"\n===== {title} =====")
        df.explain("formatted")


if __name__ == "__main__":
    main()
