"""Queries build the feeds they read, parse a list once, and load without sorting rows by partition."""

import datetime
import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from hitloom import fs, synth
from hitloom.functions import nested
from hitloom.streaming import table

DAY = datetime.date(2024, 1, 2)


@pytest.fixture
def tables(spark, tmp_path):
    """Three orders (one without items) and their lines, four events; the other tables are there for their names."""
    rows = {
        "orders": ([(1, 7, "O"), (2, 8, "F"), (3, 9, "P")], "o_orderkey bigint, o_custkey bigint, o_orderstatus string"),
        "lineitem": (
            [(1, 2, 11, 5, 3.0, 10.5, 0.1, 0.02, "N", DAY), (1, 1, 10, 5, 2.0, 7.25, 0.0, 0.01, "R", DAY), (2, 1, 11, 5, 1.0, 1.0, 0.0, 0.0, "A", DAY)],
            "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_suppkey bigint, l_quantity double, l_extendedprice double, "
            "l_discount double, l_tax double, l_returnflag string, l_shipdate date",
        ),
        "part": ([(10, "red pin", "A^B"), (11, "big nut", None)], "p_partkey bigint, p_name string, p_type string"),
        "events": ([(i, i * 3, "view") for i in range(4)], "event_id bigint, user_id bigint, event_type string"),
    }
    for name in synth.TABLES:
        data, schema = rows.get(name, ([(1,)], "k int"))
        spark.createDataFrame(data, schema).coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def test_a_query_writes_only_the_feeds_that_it_reads(spark, tables):
    kept = entry.feed_comments_kept(spark, tables).collect()
    root = synth.feed_root(spark, tables)
    assert len(kept) == 4 and [f for f in synth.FEEDS if fs.exists(spark, f"{root}/{f}")] == ["rules"]


def test_product_lists_of_the_orders(spark, tables):
    got = {(r.hit_id, r.pos): (r.category, r.name, r.quantity, r.price) for r in entry.feed_product_list(spark, tables).collect()}
    assert got == {
        (1, 0): ("A^B", "red,pin", "2", "7.25"), (1, 1): ("big;nut", "3", "10.50", None), (2, 0): ("big;nut", "1", "1.00", None),
    }
    pairs = {tuple(r) for r in entry.feed_product_events_evars(spark, tables).filter("hit_id = 1 AND pos = 1").collect()}
    assert pairs == {
        (1, 1, "event", 0, "event1", "0.10"), (1, 1, "event", 1, "event2", "0.02"),
        (1, 1, "evar", 0, "eVar1", "N"), (1, 1, "evar", 1, "eVar2", "2024-01-02"),
    }


def test_a_list_is_parsed_once(spark):
    df = spark.createDataFrame([(1, "c;n;1;2.00;a=1|b;e=2,;x"), (2, ""), (3, None)], "hit_id int, l string")
    hits = df.select("hit_id", nested.parse_products(F.col("l")).alias("product_list"))
    for got, rows in ((entry._exploded_products(hits, "product_list"), 3), (entry._exploded_pairs(hits, "product_list"), 3)):
        assert got.count() == rows
        plan = got._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("split(") == hits._jdf.queryExecution().optimizedPlan().toString().count("split(")


def test_a_load_does_not_sort_by_partition(spark, tmp_path):
    with table._open_partitions(spark):
        assert int(spark.conf.get(table._OPEN_CONF)) == table.OPEN_PARTITIONS
    assert spark.conf.get(table._OPEN_CONF, None) in (None, "0")
    n = 3 * table.OPEN_PARTITIONS  # more than stay open: the rest is sorted
    rows = spark.range(4 * n).select("id", (F.col("id") % n).cast("string").alias("part")).coalesce(1)
    written = table.write_version(rows, str(tmp_path), "part")
    assert len(written) == n and spark.read.parquet(f"{tmp_path}/data").agg(F.count("id"), F.sum("id")).first() == (4 * n, 2 * n * (4 * n - 1))
    assert all(os.path.isdir(f"{tmp_path}/data/{f}") for f in written.values())
