"""The feed named in SQL: equal to the batch read."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import hitloom
from hitloom import datafeed
from hitloom.functions import names, nested
from hitloom.sources import named
from tests.conftest import make_feed
from tests.test_stream_reader import HEADERS, HITS, LOOKUPS, _rows


def test_view_equals_batch(spark, tmp_path):
    root = str(tmp_path)
    make_feed(root, "s_2024-01-01", HEADERS, HITS, LOOKUPS, n_files=3, extra_text=["b1\t1\t7\t\t;a|b^|;;;e1=1|e^=2=3|;v=1\t\tx\n", ""])
    later = ["note", "extra", "os", "hit_id", "browser", "event_list"]
    make_feed(root, "s_2024-01-02", later, "n1\te1\t2\tz1\t7\t1\n", {"operating_systems.tsv": "2\tNew two\n", "event.tsv": "1\tOther\n"})
    hitloom.install(spark)
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW hits USING datafeed OPTIONS (path '{root}')")
    batch = datafeed(spark).load(root)
    view = spark.table("hits")
    assert [(f.name, f.dataType.simpleString()) for f in view.schema] == [(f.name, f.dataType.simpleString()) for f in batch.schema]
    assert _rows(view) == _rows(batch)
    got = spark.sql("SELECT os, count(*) AS n FROM hits GROUP BY os").collect()
    assert {r.os: r.n for r in got} == {r.os: r.n for r in batch.groupBy("os").agg(F.count("*").alias("n")).collect()}
    # Columns of the view, options, one manifest.
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW few (os STRING, hit_id STRING) USING datafeed OPTIONS (path '{root}', pathGlobFilter '*-0{{2,3}}.txt')")
    assert _rows(spark.table("few")) == [{"os": "New two", "hit_id": "z1"}]
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW one USING datafeed OPTIONS (path '{root}/s_2024-01-01.txt', enableLookups 'false')")
    assert _rows(spark.table("one")) == _rows(datafeed(spark).option("enableLookups", False).load(f"{root}/s_2024-01-01.txt"))
    with pytest.raises(Exception, match="cast it in the query"):
        spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW bad (os INT) USING datafeed OPTIONS (path '{root}')")
        spark.table("bad").collect()
    with pytest.raises(Exception, match="no manifest"):
        spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW none USING datafeed OPTIONS (path '{root}', pathGlobFilter 'x*')")
        spark.table("none").collect()


def test_python_rules_equal_the_column_rules(spark):
    lists = ["", ",", ",,a", "a,,", ";n", "c;n;1;2;e=1|f=|g|;v=1", "^^,x;^;y;z", "a^,b;n^=;;;k^=v=w^|x|", ";;;;;", ";a;;;|;|", "a;b;c;d;e;f;g=h|i", "^"]
    pairs = [("file:/a/b", n) for n in ("x.tsv", "/x//y", "../x", "./x", "file:///q/x", "file:/q", "s3://b/k", "d/")] + [("s3://b/d", n) for n in ("x", "/k", "s3://c/../k")]
    rows = spark.createDataFrame([(t,) for t in lists], "t string").select("t", nested.parse_products(F.col("t")).alias("p")).collect()
    assert [named.products(r.t) for r in rows] == [[x.asDict(recursive=True) for x in r.p] for r in rows]
    rows = spark.createDataFrame(pairs, "d string, n string").select("d", "n", names.resolve(F.col("d"), F.col("n")).alias("r")).collect()
    assert [(r.n, named.resolve(r.d, r.n)) for r in rows] == [(r.n, r.r) for r in rows]
