"""The streaming DataFrame of hits: equal to the batch read, restartable, drift, lookups of each manifest."""

from __future__ import annotations

import os

import pytest

import hitloom
from hitloom import datafeed, datafeed_stream
from hitloom.operators.lookups import MOBILE_FIELDS
from tests.conftest import make_feed

HEADERS = ["hit_id", "os", "browser", "event_list", "product_list", "mobile_id", "note"]
LOOKUPS = {
    "operating_systems.tsv": "1\tOS one\n2\tOS two\n1\tOS one again\n",
    "browser.tsv": "7\tBro\\\\wser\\t7\n8\n",
    "event.tsv": "1\tPurchase\n20\tView\n",
    "mobile_attributes.tsv": "\t".join(["5", *[f"m{i}" for i in range(len(MOBILE_FIELDS))]]) + "\n6\tshort\n",
}
HITS = (
    "a1\t1\t7\t1=2.50,20,99\tc;n;1;2;event1=3|event2=4;eVar1=x\t5\tplain\n"
    "#comment\n\n"
    "a2\t2\t8\t20=a=b\t;n^;2;;\t6\ttwo\\\nlines\\\\\n"
    "a3\t9\t\t\t\t\ttab\\there \n"
    "a4\t 1\t7\t1^,2,\t\t77\t\n"
    "a5\n"
)


def _rows(df):
    return sorted((r.asDict(recursive=True) for r in df.collect()), key=str)


def _run(df, target, checkpoint):
    q = df.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()


def test_stream_equals_batch(spark, tmp_path):
    root, out, ck = (str(tmp_path / x) for x in ("feed", "out", "ck"))
    make_feed(root, "s_2024-01-01", HEADERS, HITS, LOOKUPS, n_files=3, extra_text=["b1\t1\t7\t\t\t\tx\n", ""])
    df = datafeed_stream(spark).load(root)
    assert df.isStreaming and df.schema.simpleString() == datafeed(spark).load(root).schema.simpleString()
    _run(df, out, ck)
    assert _rows(spark.read.parquet(out)) == _rows(datafeed(spark).load(root))


def test_restart_reads_only_new_manifests_with_their_own_lookups(spark, tmp_path):
    root, out, ck = (str(tmp_path / x) for x in ("feed", "out", "ck"))
    make_feed(root, "s_2024-01-01", HEADERS, HITS, LOOKUPS)
    _run(datafeed_stream(spark).load(root), out, ck)
    first = spark.read.parquet(out).count()
    # Another order, a column less and one more, another os file, no browser file.
    later = ["note", "extra", "os", "hit_id", "browser", "event_list"]
    make_feed(root, "s_2024-01-02", later, "n1\te1\t2\tz1\t7\t1\nn2\te2\t3\tz2\t8\t20=4\n", {"operating_systems.tsv": "2\tNew two\n", "event.tsv": "1\tOther\n"})
    stream = datafeed_stream(spark).load(root)
    _run(stream, out, ck)
    _run(stream, out, ck)
    rows = {r.hit_id: r for r in spark.read.parquet(out).collect()}
    assert spark.read.parquet(out).count() == first + 2
    assert (rows["a1"].os, rows["a1"]._tech_fileset) == ("OS one again", "s_2024-01-01")
    z1, z2 = rows["z1"], rows["z2"]
    assert (z1.os, z1.browser, z1.note, z1.mobile_id, z1._tech_fileset) == ("New two", "7", "n1", None, "s_2024-01-02")
    assert z2.os is None and [tuple(e) for e in z2.event_list] == [(None, "4")] and z1.event_list[0].event == "Other"


def test_aggregation_in_the_stream(spark, tmp_path):
    root = str(tmp_path / "feed")
    for day in ("01", "02", "03"):
        make_feed(root, f"s_2024-01-{day}", ["hit_id", "os"], f"x{day}\t1\ny{day}\t2\nz{day}\t1\n", {"operating_systems.tsv": "1\tOne\n"})
    hitloom.install()
    counts = spark.readStream.format("datafeed").option("maxManifestsPerTrigger", 1).load(root).groupBy("os").count()
    q = counts.writeStream.outputMode("complete").format("memory").queryName("os_counts").trigger(availableNow=True).start()
    q.awaitTermination()
    assert {r.os: r["count"] for r in spark.table("os_counts").collect()} == {"One": 6, None: 3}
    assert len([p for p in q.recentProgress if p.numInputRows]) == 3


def test_user_schema_before_any_manifest_and_filters(spark, tmp_path):
    root, out, ck = (str(tmp_path / x) for x in ("feed", "out", "ck"))
    os.makedirs(root)
    with pytest.raises(hitloom.NoManifestError):
        datafeed_stream(spark).load(root)
    reader = datafeed_stream(spark).schema("hit_id string, os string, note string, absent int").option("pathGlobFilter", "s_*")
    _run(reader.load(root), out, ck)
    make_feed(root, "s_2024-01-01", HEADERS, HITS, LOOKUPS)
    make_feed(root, "t_2024-01-01", HEADERS, HITS, LOOKUPS)
    os.utime(f"{root}/s_2024-01-01.txt", (1_700_000_000, 1_700_000_000))
    _run(reader.load(root), out, ck)
    got = _rows(spark.read.parquet(out))
    assert len(got) == 5 and got == _rows(datafeed(spark).schema("hit_id string, os string, note string, absent int").option("pathGlobFilter", "s_*").load(root))
    early = datafeed_stream(spark).option("modifiedBefore", "2023-12-01T00:00:00").option("timeZone", "UTC").load(root).select("_tech_fileset")
    _run(early, str(tmp_path / "early"), str(tmp_path / "ck2"))
    assert {r[0] for r in spark.read.parquet(str(tmp_path / "early")).collect()} == {"s_2024-01-01"}


def test_no_hit_is_shuffled(spark, tmp_path):
    root = str(tmp_path / "feed")
    make_feed(root, "s_2024-01-01", HEADERS, HITS, LOOKUPS)
    plan = datafeed_stream(spark).load(root).select("os")._jdf.queryExecution().logical().toString()
    assert plan.index("MapInArrow") < plan.index("Repartition")  # only file names lie below the exchange
