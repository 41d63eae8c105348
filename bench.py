"""Benchmark: feeds written from the driver tables at $BENCH_SF_DIR, read back.

Prints one JSON line.  Each query is timed as the median of 3 runs after one
warm-up; results go to Spark's ``noop`` sink (the whole plan runs, nothing is
collected).  Planning a ``load()`` (manifest table, archive index, headers,
file table) is reported on its own: ``load_plan_cold_sec`` for a first load,
``load_plan_sec`` for a repeated load of the unchanged feed (planning results
are reused after two listing fingerprints); ``value`` sums the query scenarios.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from hitloom import datafeed, fs, read_manifests, synth  # noqa: E402
from hitloom.plans.reader import clear_plan_cache  # noqa: E402
from hitloom.session import local_session  # noqa: E402
from hitloom.sources.manifest import manifest_entries  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def _sf(path: str) -> float | str:
    tag = path.rstrip("/").rsplit("/", 1)[-1]
    try:
        return float(tag.replace("sf", ""))
    except ValueError:
        return tag


def _run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def _median(fn) -> float:
    fn()  # warm-up
    times = []
    for _ in range(RUNS):
        t0 = time.perf_counter()
        fn()
        times.append(time.perf_counter() - t0)
    return statistics.median(times)


def _wide_feed(spark, root: str) -> str:
    """A feed of 300 columns, a hit for each event."""
    folder = f"{root}/bench-wide"
    if not fs.exists(spark, f"{folder}/_READY"):
        headers = ["hit_id", *[f"c{i}" for i in range(1, 300)]]
        events = spark.read.parquet(f"{SF_DIR}/events.parquet").select("event_id", "user_id")
        cells = [((F.col("user_id") + i) % 97).cast("string") for i in range(1, 300)]
        synth._write_archive(spark, f"{folder}/wide_2024-07-01-lookup_data.tar.gz", {"column_headers.tsv": [headers]})
        lines = events.select(F.concat_ws("\t", F.col("event_id").cast("string"), *cells).alias("value"))
        lines.repartition(8).write.mode("overwrite").text(f"{folder}/hits", compression="gzip")
        synth._write_feed_manifest(spark, folder, "wide_2024-07-01", "hits", None)
        fs.write_bytes(spark, f"{folder}/_READY", b"ok")
    return folder


def _many_files(spark, root: str) -> str:
    """One manifest that names 20,000 hit files."""
    folder = f"{root}/bench-many"
    blocks = ["Lookup-File: m_2024-07-01-lookup_data.tar.gz\nMD5-Digest: 0\nFile-Size: 1"]
    blocks += [f"Data-File: hits/{i:05d}-m_2024-07-01.tsv.gz\nMD5-Digest: 0\nFile-Size: 1\nRecord-Count: 1" for i in range(20_000)]
    fs.write_bytes(spark, f"{folder}/m_2024-07-01.txt", "\n\n".join(blocks).encode())
    return folder


def main() -> None:
    spark = local_session(CPUS, shuffle_partitions=int(CPUS) if CPUS.isdigit() else 8)
    t0 = time.perf_counter()
    root = synth.ensure_feeds(spark, SF_DIR)
    synth_sec = time.perf_counter() - t0
    web, orders, docs = f"{root}/web", f"{root}/orders", f"{root}/docs"

    q: dict[str, float] = {}

    def cold_load():
        clear_plan_cache()
        datafeed(spark).load(web)

    load_plan_cold = _median(cold_load)
    load_plan = _median(lambda: datafeed(spark).load(web))

    raw = datafeed(spark).option("enableLookups", "false").load(web)
    raw_off = datafeed(spark).option("enableLookups", "false").option("joinContinuationLines", "false").load(web)
    full = datafeed(spark).load(web)
    n_hits = full.count()
    q["scan_raw"] = _median(lambda: _run(raw))
    q["scan_raw_join_off"] = _median(lambda: _run(raw_off))
    q["all_lookups_all_columns"] = _median(lambda: _run(full))
    q["one_lookup_pruned"] = _median(lambda: _run(full.groupBy("os").agg(F.count(F.lit(1)).alias("n"))))

    events = full.select(F.explode("event_list").alias("e")).groupBy(F.col("e.event").alias("event")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("e.value").try_cast("double")).alias("value")
    )
    q["events_exploded_agg"] = _median(lambda: _run(events))

    products_df = datafeed(spark).load(orders)
    products = products_df.select(F.explode("product_list").alias("p")).groupBy(F.col("p.category").alias("category")).agg(
        F.sum(F.col("p.quantity").try_cast("double")).alias("qty"), F.sum(F.col("p.price").try_cast("double")).alias("revenue")
    )
    q["products_exploded_agg"] = _median(lambda: _run(products))

    docs_on = datafeed(spark).load(docs)
    docs_off = datafeed(spark).option("joinContinuationLines", "false").load(docs)
    q["docs_continuation_on"] = _median(lambda: _run(docs_on))
    q["docs_continuation_off"] = _median(lambda: _run(docs_off))

    wide = _wide_feed(spark, root)
    wide_df = datafeed(spark).load(wide)
    q["wide_one_early_column"] = _median(lambda: _run(wide_df.groupBy("c3").count()))
    q["wide_one_late_column"] = _median(lambda: _run(wide_df.groupBy("c290").count()))
    q["wide_all_columns"] = _median(lambda: _run(wide_df))
    many = _many_files(spark, root)
    q["manifest_20000_files"] = _median(lambda: manifest_entries(read_manifests(spark, [many])).agg(F.max("path")).collect())

    # The sum of the scenarios of all rounds, so that rounds compare.
    total = sum(v for k, v in q.items() if not k.startswith(("wide_", "manifest_")))
    print(
        json.dumps(
            {
                "metric": "feed_queries_total",
                "value": round(total, 3),
                "unit": "sec",
                "queries": {k: round(v, 3) for k, v in q.items()},
                "sf": _sf(SF_DIR),
                "load_plan_sec": round(load_plan, 3),
                "load_plan_cold_sec": round(load_plan_cold, 3),
                "cpus": CPUS,
                "web_hits": n_hits,
                "scan_raw_hits_per_sec": round(n_hits / q["scan_raw"], 1),
                "synth_sec": round(synth_sec, 1),
            }
        )
    )


if __name__ == "__main__":
    main()
