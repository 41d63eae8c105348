"""End-to-end reads of hand-made feeds (lookups, drift, options, metadata)."""

import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

import hitloom
from hitloom import datafeed
from hitloom.operators import lookups
from hitloom.operators.lookups import MOBILE_FIELDS
from hitloom.streaming.reader import Delivery
from tests.conftest import make_feed, write_archive, write_gz, write_manifest

HEADERS = ["hit_id", "browser", "os", "mobile_id", "event_list", "post_product_list", "last_hit_time_gmt", "post_pagename"]
LOOKUPS = {
    # duplicate key 1 (last wins), key 3 missing, a row without value
    "browser.tsv": "1\tFirefox\n2\tSafari\n1\tFirefox 2\n4\n",
    "browser_type.tsv": "1\tMozilla\n2\tApple\n",
    "operating_systems.tsv": "10\tLinux\n11\tOS X 10.9.5\n",
    "event.tsv": "1\tPurchase\n200\tInstance of eVar1\n",
    "mobile_attributes.tsv": "m1\t" + "\t".join(f"{f}1" for f in MOBILE_FIELDS) + "\nm2\tAcme\tPhone\n",
}
HITS = (
    "1\t1\t10\tm1\t1=2.5,200\t;Shoe;1;9.99\t300\tHome\n"
    "2\t2\t11\tm2\t200,999\t\t100\tCart\n"
    "3\t3\t12\tm3\t\tCat;Hat\t200\tCheckout\n"
    "4\t\t\t\t\t\t400\t\n"
)


@pytest.fixture(scope="module")
def feed(tmp_path_factory):
    root = str(tmp_path_factory.mktemp("feed"))
    make_feed(root, "suite_2024-01-01", HEADERS, HITS, LOOKUPS)
    return root


def test_schema_order(spark, feed):
    df = datafeed(spark).load(feed)
    assert df.columns[:6] == ["_tech_last_modified", "_tech_fileset", "mobile_attributes", "event_list", "post_product_list", "browser"]
    assert df.columns[6:] == ["browser_type", "os", "hit_id", "mobile_id", "last_hit_time_gmt", "post_pagename"]
    assert df.schema["_tech_last_modified"].dataType == T.TimestampType()


def test_simple_lookups(spark, feed):
    rows = {r.hit_id: r for r in datafeed(spark).load(feed).collect()}
    assert rows["1"].browser == "Firefox 2"  # last row wins
    assert rows["2"].browser == "Safari" and rows["2"].browser_type == "Apple"
    assert rows["3"].browser is None  # key missing from the lookup
    assert rows["4"].browser is None and rows["4"].os is None
    assert rows["2"].os == "OS X 10.9.5"
    assert rows["3"].os is None


def test_golden_first_os_by_time(spark, feed):
    """First os ordered by last_hit_time_gmt, with and without lookups."""
    df = datafeed(spark).load(feed).select("os").orderBy(F.col("last_hit_time_gmt"))
    assert df.take(1)[0][0] == "OS X 10.9.5"
    raw = datafeed(spark).option("enableLookups", "false").load(feed).select("os").orderBy("last_hit_time_gmt")
    assert raw.take(1)[0][0] == "11"


def test_lookups_off_has_raw_columns_only(spark, feed):
    df = datafeed(spark).option("enableLookups", False).load(feed)
    assert df.columns == HEADERS
    assert df.filter(F.col("hit_id") == "1").first().event_list == "1=2.5,200"


def test_events_products_mobile(spark, feed):
    rows = {r.hit_id: r for r in datafeed(spark).load(feed).collect()}
    assert [(e.event, e.value) for e in rows["1"].event_list] == [("Purchase", "2.5"), ("Instance of eVar1", None)]
    assert [(e.event, e.value) for e in rows["2"].event_list] == [("Instance of eVar1", None), (None, None)]
    assert rows["3"].event_list is None
    assert rows["1"].post_product_list[0].name == "Shoe" and rows["1"].post_product_list[0].price == "9.99"
    assert rows["3"].post_product_list[0].category == "Cat"
    assert rows["1"].mobile_attributes.Manufacturer == "Manufacturer1"
    assert rows["2"].mobile_attributes.Manufacturer == "Acme"
    assert rows["2"].mobile_attributes.Device == "Phone"
    assert rows["2"].mobile_attributes.Device_Type is None  # short row
    assert rows["3"].mobile_attributes is None  # unknown key


def test_nested_select(spark, feed):
    df = datafeed(spark).load(feed).select(F.col("post_product_list.name").alias("names"), "hit_id")
    got = {r.hit_id: r.names for r in df.collect()}
    assert got["1"] == ["Shoe"] and got["3"] == ["Hat"]


def test_metadata_columns(spark, feed):
    r = datafeed(spark).load(feed).select("_tech_fileset", "_tech_last_modified").first()
    assert r._tech_fileset == "suite_2024-01-01"
    mtime = os.path.getmtime(os.path.join(feed, "suite_2024-01-01.txt"))
    assert abs(r._tech_last_modified.timestamp() - mtime) < 1.0


def test_metadata_prefix(spark, feed):
    df = datafeed(spark).option("metadataPrefix", "meta_").load(feed)
    assert df.columns[:2] == ["meta_last_modified", "meta_fileset"]


def test_unused_lookups_are_pruned(spark, feed):
    df = datafeed(spark).load(feed)

    def lookup_joins(d):  # joins of hits with a lookup table (keyed by a lookup version)
        return d._jdf.queryExecution().executedPlan().toString().count("BroadcastHashJoin [__v_")

    assert lookup_joins(df.select("hit_id")) == 0
    assert lookup_joins(df.select("os")) == 1
    assert lookup_joins(df.select("hit_id", "browser", "browser_type")) == 2
    assert lookup_joins(df) == 4  # 3 simple lookups, mobile attributes (event names are plan constants)
    assert df.select("hit_id")._jdf.queryExecution().executedPlan().toString().count("BroadcastHashJoin") == 2


def test_small_lookups_share_one_build_side(spark, feed):
    df = datafeed(spark).load(feed).select("hit_id", "browser", "browser_type", "os")
    rows = sorted(df.collect())
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = df.select("*")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    assert plan.count("BroadcastHashJoin [__v_") == 3
    assert plan.count("FileScan parquet") == 1 and plan.count("ReusedExchange") == 2  # read and broadcast once
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr("hitloom.operators.lookups.PACKED_ENTRY_BYTES", -1)  # a build side for each
        assert sorted(datafeed(spark).load(feed).select(*df.columns).collect()) == rows


def test_packed_entries_stay_within_their_limits():
    sizes = {"browser.tsv": 1000, "country.tsv": 400, "carrier.tsv": lookups.PACKED_ENTRY_BYTES + 1, "event.tsv": 5}
    assert lookups.packed_entries(sizes, 1 << 28) == ["browser.tsv", "country.tsv"]
    assert lookups.packed_entries(sizes, 900) == ["country.tsv"]
    assert lookups.packed_entries(sizes, -1) == []


def test_user_schema(spark, feed):
    schema = T.StructType([T.StructField("accept_language", T.StringType()), T.StructField("hit_id", T.LongType())])
    df = datafeed(spark).schema(schema).load(feed)
    assert df.schema == schema
    with pytest.raises(AnalysisException):
        df.select("browser").collect()
    assert sorted(r.hit_id for r in df.collect()) == [1, 2, 3, 4]


def test_user_schema_without_manifests(spark, tmp_path):
    df = datafeed(spark).schema("a string").load(str(tmp_path))
    assert df.count() == 0


def test_no_manifest_is_an_error(spark, tmp_path):
    with pytest.raises(hitloom.NoManifestError):
        datafeed(spark).load(str(tmp_path))


def test_glob_filter_selects_manifest_with_no_data(spark, tmp_path):
    root = str(tmp_path)
    make_feed(root, "site_2015-07-13", HEADERS, HITS, LOOKUPS)
    # a later manifest that names the same archive and no hit files
    write_manifest(f"{root}/site_2023-11-09.txt", ["site_2015-07-13-lookup_data.tar.gz"], [], comment="free text")
    assert datafeed(spark).option("pathGlobFilter", "site_2023-*").load(root).count() == 0
    assert datafeed(spark).load(root).count() == 4


def test_single_manifest_path_and_install(spark, feed):
    hitloom.install()
    df = spark.read.datafeed(os.path.join(feed, "suite_2024-01-01.txt"))
    assert df.count() == 4


def test_schema_drift_by_name(spark, tmp_path):
    root = str(tmp_path)
    make_feed(root, "a_2024-01-01", ["hit_id", "os", "only_a"], "1\t10\tx\n", {"operating_systems.tsv": "10\tLinux\n"})
    make_feed(root, "b_2024-01-02", ["only_b", "os", "hit_id"], "y\t10\t2\n", {})
    df = datafeed(spark).load(root)
    assert "only_b" not in df.columns
    rows = {r.hit_id: r for r in df.collect()}
    assert rows["1"].os == "Linux" and rows["1"].only_a == "x"
    # the second delivery has no operating_systems.tsv: its raw code passes through
    assert rows["2"].os == "10" and rows["2"].only_a is None
    assert rows["2"]._tech_fileset == "b_2024-01-02"


def test_later_archive_wins_whole_entry(spark, tmp_path):
    root = str(tmp_path)
    write_archive(f"{root}/x_2024-01-01-lookup_data.tar.gz", {"column_headers.tsv": "hit_id\tos\n", "operating_systems.tsv": "1\tOld\n2\tTwo\n"})
    write_archive(f"{root}/extra-lookup_data.tar.gz", {"operating_systems.tsv": "1\tNew\n"})
    write_gz(f"{root}/01-x_2024-01-01.tsv.gz", "a\t1\nb\t2\n")
    write_manifest(f"{root}/x_2024-01-01.txt", ["x_2024-01-01-lookup_data.tar.gz", "extra-lookup_data.tar.gz"], ["01-x_2024-01-01.tsv.gz"])
    rows = {r.hit_id: r.os for r in datafeed(spark).load(root).collect()}
    assert rows == {"a": "New", "b": None}


def test_max_chars_per_column(spark, feed):
    df = datafeed(spark).option("maxCharsPerColumn", 3).load(feed)
    with pytest.raises(Exception):
        df.collect()


def test_lookup_limits(spark, tmp_path):
    """Lookup files beyond the limits fail the load; headers and hits have no part in them."""
    root = str(tmp_path)
    make_feed(root, "s_2024-01-01", ["os", "a_long_column_name"], "1\t" + "x" * 50 + "\n", {"operating_systems.tsv": "1\tabc\\td\tq\n"})
    want = [("abc\td", "x" * 50)]
    for chars, columns in ((5, 3), (-1, 3), (5, -1), (0, 0)):
        df = datafeed(spark).option("lookupMaxCharsPerColumn", chars).option("lookupMaxColumns", columns).load(root)
        assert [(r.os, r.a_long_column_name) for r in df.collect()] == want
    for chars, columns in ((4, 3), (5, 2)):
        with pytest.raises(Exception, match="lookupMax"):
            datafeed(spark).option("lookupMaxCharsPerColumn", chars).option("lookupMaxColumns", columns).load(root).collect()
        with pytest.raises(ValueError, match="lookupMax"):
            Delivery([f"{root}/s_2024-01-01-lookup_data.tar.gz"], {"operating_systems.tsv"}, "UTF-8", "UTF-8", "#", (chars, columns))


def test_bad_option_values(spark, feed):
    with pytest.raises(ValueError):
        datafeed(spark).option("enableLookups", "yes").load(feed)
    with pytest.raises(ValueError):
        datafeed(spark).option("maxCharsPerColumn", "ten").load(feed)


def test_file_named_twice_yields_rows_twice(spark, tmp_path):
    root = str(tmp_path)
    make_feed(root, "d_2024-01-01", ["hit_id"], "1\n2\n")
    write_manifest(f"{root}/e_2024-01-02.txt", ["d_2024-01-01-lookup_data.tar.gz"], ["01-d_2024-01-01.tsv.gz"])
    assert datafeed(spark).load(root).count() == 4


def test_spark_read_format_datafeed(spark, feed):
    hitloom.install()
    df = spark.read.format("datafeed").option("enableLookups", "false").load(feed)
    assert df.columns == HEADERS
    df2 = spark.read.format("datafeed").schema("hit_id long").load(feed)
    assert sorted(r.hit_id for r in df2.collect()) == [1, 2, 3, 4]
    # other formats are untouched
    assert spark.read.format("text").load(os.path.join(feed, "suite_2024-01-01.txt")).count() > 0


def test_over_broadcast_limit_same_result(spark, tmp_path):
    """Tiny broadcast limit: lookups are joined without a broadcast hint and the
    hit files are scanned in several path-hash chunks; rows are unchanged."""
    root = str(tmp_path)
    more = [HITS.replace("\t", "\t", 1)] + ["".join(f"{i}{j}\t{j % 3}\t1{j % 2}\tm1\t1\t;P{j}\t{j}\tx\n" for j in range(50)) for i in range(5, 10)]
    make_feed(root, "big_2024-01-01", HEADERS, more[0], LOOKUPS, n_files=6, extra_text=more[1:])
    base = datafeed(spark).load(root)
    small = datafeed(spark).option("broadcastLimitBytes", 1).option("maxFilesPerScan", 2).load(root)
    cols = ["hit_id", "browser", "os", "browser_type"]
    assert sorted(base.select(*cols).collect()) == sorted(small.select(*cols).collect())
    plan = small.select(*cols)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Union") >= 1


def test_data_encoding_latin1(spark, tmp_path):
    root = str(tmp_path)
    os.makedirs(root, exist_ok=True)
    write_archive(f"{root}/l_2024-01-01-lookup_data.tar.gz", {
        "column_headers.tsv": "hit_id\tcountry\tcity\n".encode("latin-1"),
        "country.tsv": "1\tEspaña\n".encode("latin-1"),
    })
    import gzip
    with gzip.open(f"{root}/01-l_2024-01-01.tsv.gz", "wb") as f:
        f.write("a\t1\tMálaga\n".encode("latin-1"))
    write_manifest(f"{root}/l_2024-01-01.txt", ["l_2024-01-01-lookup_data.tar.gz"], ["01-l_2024-01-01.tsv.gz"])
    r = datafeed(spark).option("dataEncoding", "ISO-8859-1").load(root).first()
    assert (r.city, r.country) == ("Málaga", "España")


def test_manifest_without_headers_is_an_error(spark, tmp_path):
    root = str(tmp_path)
    make_feed(root, "a_2024-01-01", ["hit_id"], "1\n")
    write_archive(f"{root}/b_2024-01-02-lookup_data.tar.gz", {"browser.tsv": "1\tx\n"})
    write_gz(f"{root}/01-b_2024-01-02.tsv.gz", "2\n")
    write_manifest(f"{root}/b_2024-01-02.txt", ["b_2024-01-02-lookup_data.tar.gz"], ["01-b_2024-01-02.tsv.gz"])
    with pytest.raises(ValueError):
        datafeed(spark).load(root)


def _ancestors_of(plan: str, needle: str) -> list[str]:
    lines = plan.splitlines()
    idx = next(i for i, l in enumerate(lines) if needle in l)
    depth = len(lines[idx]) - len(lines[idx].lstrip(" :+-"))
    out = []
    for l in reversed(lines[:idx]):
        d = len(l) - len(l.lstrip(" :+-"))
        if d < depth:
            out.append(l.strip(" :+-"))
            depth = d
    return out


def test_hits_are_never_shuffled(spark, feed):
    df = datafeed(spark).load(feed)
    plan = df._jdf.queryExecution().executedPlan().toString()
    ancestors = _ancestors_of(plan, "FileScan text")
    assert ancestors, plan
    assert not any("Exchange" in a and "BroadcastExchange" not in a for a in ancestors), ancestors


def test_awkward_file_names_match_their_manifest(spark, tmp_path):
    root = str(tmp_path / "dir with space+plus")
    os.makedirs(root)
    fileset = "odd_2024-01-01"
    write_archive(f"{root}/{fileset}-lookup_data.tar.gz", {"column_headers.tsv": "hit_id\n"})
    names = ["01-a b+c%20d[1]é.tsv.gz", "02-{x},y?.tsv.gz"]
    for i, n in enumerate(names):
        write_gz(f"{root}/{n}", f"{i}a\n{i}b\n")
    write_manifest(f"{root}/{fileset}.txt", [f"{fileset}-lookup_data.tar.gz"], names)
    assert sorted(r.hit_id for r in datafeed(spark).load(root).collect()) == ["0a", "0b", "1a", "1b"]
    # without the continuation step the path is decoded by url_decode in the JVM
    off = datafeed(spark).option("joinContinuationLines", "false").load(root)
    assert sorted(r.hit_id for r in off.collect()) == ["0a", "0b", "1a", "1b"]


def test_full_width_show(spark, feed, capsys):
    datafeed(spark).load(feed).show(10, False)
    assert "suite_2024-01-01" in capsys.readouterr().out


def test_conform_and_stream_ingest(spark, tmp_path):
    from hitloom.streaming import ingest

    root = str(tmp_path / "feed")
    make_feed(root, "c_2024-01-01", ["hit_id", "os"], "1\t10\n2\t11\n", {"operating_systems.tsv": "10\tLinux\n"})
    make_feed(root, "c_2024-01-02", ["hit_id", "os"], "3\t10\n", {"operating_systems.tsv": "10\tLinux\n"})
    target = str(tmp_path / "table")
    ingest.conform(spark, [root], target)
    ingest.conform(spark, [root], target)  # a reload replaces, never duplicates
    got = ingest.read_conformed(spark, target).groupBy("_tech_fileset").count().collect()
    assert sorted((r[0], r[1]) for r in got) == [("c_2024-01-01", 2), ("c_2024-01-02", 1)]

    streamed = str(tmp_path / "streamed")
    q = ingest.stream_ingest(spark, root, streamed, str(tmp_path / "ckpt"), max_manifests_per_batch=1)
    q.awaitTermination()
    rows = ingest.read_conformed(spark, streamed).select("hit_id", "os").collect()
    assert sorted((r.hit_id, r.os) for r in rows) == [("1", "Linux"), ("2", None), ("3", "Linux")]


def test_chunked_by_manifest_keeps_duplicates(spark, tmp_path):
    root = str(tmp_path)
    for k in range(3):
        make_feed(root, f"m{k}_2024-01-0{k + 1}", ["hit_id", "os"], f"{k}a\t10\n{k}b\t11\n", {"operating_systems.tsv": "10\tLinux\n"})
    write_manifest(f"{root}/m9_2024-01-09.txt", ["m0_2024-01-01-lookup_data.tar.gz"], ["01-m0_2024-01-01.tsv.gz"])
    base = datafeed(spark).load(root).select("_tech_fileset", "hit_id", "os")
    tiny = datafeed(spark).option("broadcastLimitBytes", 1).load(root).select("_tech_fileset", "hit_id", "os")
    a, b = sorted(base.collect()), sorted(tiny.collect())
    assert a == b and len(a) == 8
    assert sum(1 for r in a if r.hit_id == "0a") == 2  # named by two manifests


def test_failfast_and_comment_options(spark, tmp_path):
    root = str(tmp_path)
    make_feed(root, "f_2024-01-01", ["hit_id", "os"], "1\t10\n#2\t11\n3\t12\textra\textra2\n")
    permissive = datafeed(spark).load(root)
    assert sorted(r.hit_id for r in permissive.collect()) == ["1", "3"]  # '#' record skipped, extra fields ignored
    kept = datafeed(spark).option("comment", "").load(root)
    assert sorted(r.hit_id for r in kept.collect()) == ["#2", "1", "3"]
    with pytest.raises(Exception):
        datafeed(spark).option("mode", "FAILFAST").load(root).collect()
    with pytest.raises(ValueError):
        datafeed(spark).option("mode", "SOMETIMES").load(root)


def test_plan_cache_sees_new_manifests_and_changed_archives(spark, tmp_path):
    import time as _time

    root = str(tmp_path)
    make_feed(root, "k_2024-01-01", ["hit_id", "os"], "1\t10\n", {"operating_systems.tsv": "10\tLinux\n"})
    assert [r.os for r in datafeed(spark).load(root).collect()] == ["Linux"]
    assert [r.os for r in datafeed(spark).load(root).collect()] == ["Linux"]  # cached plan
    # a changed archive (same manifest) is noticed
    _time.sleep(1.1)
    write_archive(f"{root}/k_2024-01-01-lookup_data.tar.gz", {"column_headers.tsv": "hit_id\tos\n", "operating_systems.tsv": "10\tBSD\n"})
    assert [r.os for r in datafeed(spark).load(root).collect()] == ["BSD"]
    # a new delivery is noticed
    make_feed(root, "k_2024-01-02", ["hit_id", "os"], "2\t10\n", {"operating_systems.tsv": "10\tLinux\n"})
    assert sorted((r.hit_id, r.os) for r in datafeed(spark).load(root).collect()) == [("1", "BSD"), ("2", "Linux")]


def test_duplicate_member_in_archive_later_wins(spark, tmp_path):
    import io
    import tarfile

    root = str(tmp_path)
    with tarfile.open(f"{root}/d_2024-01-01-lookup_data.tar.gz", "w:gz") as tf:
        for name, data in [("column_headers.tsv", b"hit_id\tos\n"), ("operating_systems.tsv", b"1\tFirst\n"),
                           ("operating_systems.tsv", b"1\tSecond\n")]:
            info = tarfile.TarInfo(name)
            info.size = len(data)
            tf.addfile(info, io.BytesIO(data))
    write_gz(f"{root}/01-d_2024-01-01.tsv.gz", "a\t1\n")
    write_manifest(f"{root}/d_2024-01-01.txt", ["d_2024-01-01-lookup_data.tar.gz"], ["01-d_2024-01-01.tsv.gz"])
    assert datafeed(spark).load(root).first().os == "Second"


def test_event_names_by_constants_dictionary_and_join_agree(spark, feed, monkeypatch):
    import hitloom.plans.reader as reader

    rows = lambda df: {r.hit_id: r.event_list for r in df.select("hit_id", "event_list").collect()}
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    const = rows(datafeed(spark).load(feed))
    monkeypatch.setattr(reader, "EVENT_CONSTANT_LIMIT", 0)
    reader.clear_plan_cache()
    shipped = datafeed(spark).load(feed)
    assert "ArrowEvalPython" in plan(shipped) and "[__v_event" not in plan(shipped)  # no join, no array in a row
    assert "ArrowEvalPython" not in plan(shipped.select("hit_id"))  # and nothing where no event column is used
    joined = datafeed(spark).option("broadcastLimitBytes", 1).load(feed)
    assert "Join [__v_event" in plan(joined)  # beyond the broadcast limit, joined per version
    found = rows(shipped), rows(joined)
    reader.clear_plan_cache()
    assert found == (const, const) and const["1"][0].event == "Purchase"


def test_event_dictionary_of_a_million_ids(spark, tmp_path):
    import hitloom.plans.reader as reader

    root, n = str(tmp_path), 1_000_000
    names = "".join(f"{i}\tEvent {i}\n" for i in range(n)) + "007\tPadded\nx^\tLetter\n5\tLast wins\n"
    hits = "".join(f"{i}\t{i * 997 % n}=1,{i},{n + i},007,5\n" for i in range(2000)) + "e1\tx^^,=2,3^,4,,\ne2\t\n"
    make_feed(root, "m_2024-01-01", ["hit_id", "event_list"], hits, {"event.tsv": names})
    make_feed(root, "m_2024-01-02", ["hit_id", "event_list"], "o\t5,6\n", {"event.tsv": "5\tOther five\n"})
    make_feed(root, "m_2024-01-03", ["hit_id", "event_list"], "p\t5,6\n")  # no dictionary at all
    got = {r.hit_id: [tuple(e) for e in r.event_list or []] for r in datafeed(spark).load(root).collect()}
    reader.clear_plan_cache()
    for i in range(2000):
        k = i * 997 % n
        name = lambda j: "Last wins" if j == 5 else f"Event {j}"
        assert got[str(i)] == [(name(k), "1"), (name(i), None), (None, None), ("Padded", None), ("Last wins", None)]
    assert got["o"] == [("Other five", None), (None, None)] and got["p"] == [(None, None)] * 2 and got["e2"] == []


def test_event_names_follow_each_deliverys_own_version(spark, tmp_path):
    root = str(tmp_path)
    make_feed(root, "v_2024-01-01", ["hit_id", "event_list"], "a\t1,2\n", {"event.tsv": "1\tOld one\n2\tOld two\n"})
    make_feed(root, "v_2024-01-02", ["hit_id", "event_list"], "b\t1,2,70000,x\n",
              {"event.tsv": "1\tNew one\n70000\tBig id\nx\tLetter\n"})
    got = {r.hit_id: [e.event for e in r.event_list] for r in datafeed(spark).load(root).collect()}
    assert got == {"a": ["Old one", "Old two"], "b": ["New one", None, "Big id", "Letter"]}


def test_stream_ingest_is_incremental(spark, tmp_path):
    from hitloom.streaming import ingest

    root, target, ckpt = str(tmp_path / "feed"), str(tmp_path / "table"), str(tmp_path / "ckpt")
    make_feed(root, "s_2024-01-01", ["hit_id"], "1\n2\n")
    ingest.stream_ingest(spark, root, target, ckpt).awaitTermination()
    # the first delivery's hit file changes after it was ingested; a new delivery arrives
    write_gz(f"{root}/01-s_2024-01-01.tsv.gz", "changed\n")
    make_feed(root, "s_2024-01-02", ["hit_id"], "3\n")
    ingest.stream_ingest(spark, root, target, ckpt).awaitTermination()
    got = sorted((r._tech_fileset, r.hit_id) for r in ingest.read_conformed(spark, target).collect())
    assert got == [("s_2024-01-01", "1"), ("s_2024-01-01", "2"), ("s_2024-01-02", "3")]


def test_scan_pruning_and_lookup_partition_filters(spark, feed):
    plan = datafeed(spark).load(feed).select("hit_id", "os")._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    text = [line for line in scans if "FileScan text" in line]
    assert len(text) == 1 and "ReadSchema: struct<value:string>" in text[0]  # only the record text is read
    # the operating_systems build side reads only its own partition of the lookup lines
    lookup = [line for line in scans if "FileScan parquet" in line]
    assert lookup and all("PartitionFilters: [" in line and "operating_systems.tsv" in line for line in lookup)


def test_manifest_paths_in_any_form(spark, tmp_path):
    root = str(tmp_path / "feed")
    make_feed(root, "p_2024-01-01", ["hit_id"], "0\n")
    for i in range(1, 5):
        write_gz(f"{root}/0{i}-a.tsv.gz", f"{i}\n")
    forms = ["01-a.tsv.gz", "./02-a.tsv.gz", f"file://{root}/03-a.tsv.gz", f"{root}//x/..//04-a.tsv.gz"]
    write_manifest(f"{root}/p_2024-01-01.txt", ["./p_2024-01-01-lookup_data.tar.gz"], forms)
    assert sorted(r.hit_id for r in datafeed(spark).load(root).collect()) == ["1", "2", "3", "4"]


def test_listed_file_that_the_scan_skips_is_an_error(spark, tmp_path):
    root = str(tmp_path / "feed")
    make_feed(root, "p_2024-01-01", ["hit_id"], "0\n")
    os.makedirs(f"{root}/folder.tsv.gz")
    write_gz(f"{root}/folder.tsv.gz/01-a.tsv.gz", "1\n")
    write_manifest(f"{root}/p_2024-01-01.txt", ["p_2024-01-01-lookup_data.tar.gz"], ["folder.tsv.gz"])
    with pytest.raises(ValueError, match="listed path"):
        datafeed(spark).load(root)


def test_filesets_option_limits_the_scan(spark, tmp_path):
    root = str(tmp_path / "feed")
    for day in (1, 2, 3):
        make_feed(root, f"f_2024-01-0{day}", ["hit_id"], f"{day}\n")
    df = datafeed(spark).option("filesets", "f_2024-01-01,f_2024-01-03").load(root)
    assert sorted(r.hit_id for r in df.collect()) == ["1", "3"] and len(df.inputFiles()) == 2


def test_user_schema_sees_columns_of_later_manifests(spark, tmp_path):
    root = str(tmp_path / "feed")
    make_feed(root, "a_2024-01-01", ["hit_id", "os"], "1\t10\n")
    make_feed(root, "b_2024-01-02", ["hit_id", "os", "only_b"], "2\t10\ty\n", {"operating_systems.tsv": "10\tLinux\n"})
    got = datafeed(spark).schema("hit_id string, only_b string, os string").load(root).collect()
    assert sorted(tuple(r) for r in got) == [("1", None, "10"), ("2", "y", "Linux")]
    plain = datafeed(spark).load(root)  # the first manifest decides the columns, each manifest its own lookups
    assert "only_b" not in plain.columns and sorted((r.hit_id, r.os) for r in plain.collect()) == [("1", "10"), ("2", "Linux")]


def test_bad_bytes_beside_a_continued_line(spark, tmp_path):
    import gzip

    root = str(tmp_path / "feed")
    make_feed(root, "u_2024-01-01", ["hit_id", "page"], "")
    with gzip.open(f"{root}/01-u_2024-01-01.tsv.gz", "wb") as f:
        f.write(b"1\ta\xffb\n2\tc\\\nd\n")
    assert sorted((r.hit_id, r.page) for r in datafeed(spark).load(root).collect()) == [("1", "a\ufffdb"), ("2", "c\nd")]


def test_failfast_short_record_only_where_the_column_is_used(spark, tmp_path):
    root = str(tmp_path / "feed")
    make_feed(root, "s_2024-01-01", ["hit_id", "a", "b"], "1\tx\n")
    assert datafeed(spark).load(root).collect()[0].b is None
    df = datafeed(spark).option("mode", "FAILFAST").load(root)
    assert df.select("hit_id", "a").collect()[0].a == "x"
    with pytest.raises(Exception, match="shorter"):
        df.collect()


def test_max_chars_counts_decoded_text(spark, tmp_path):
    root = str(tmp_path / "feed")
    make_feed(root, "m_2024-01-01", ["hit_id", "a"], "1\ta\\tb\n")
    assert datafeed(spark).option("maxCharsPerColumn", 3).load(root).collect()[0].a == "a\tb"
    with pytest.raises(Exception, match="maxCharsPerColumn"):
        datafeed(spark).option("maxCharsPerColumn", 2).load(root).collect()


def test_metadata_columns_are_never_null(spark, feed):
    schema = datafeed(spark).load(feed).schema
    assert not schema["_tech_last_modified"].nullable and not schema["_tech_fileset"].nullable


@pytest.mark.parametrize("per_batch", [1, 1000])
def test_stream_result_does_not_depend_on_the_batches(spark, tmp_path, per_batch):
    from hitloom.streaming import ingest

    root, target = str(tmp_path / "feed"), str(tmp_path / "table")
    make_feed(root, "s_2024-01-01", ["hit_id", "event_list"], "1\t1=2\n")
    write_gz(f"{root}/02-s_2024-01-01.tsv.gz", "2\t1\n")
    write_manifest(f"{root}/s_more.txt", ["s_2024-01-01-lookup_data.tar.gz"], ["02-s_2024-01-01.tsv.gz"])  # same fileset
    make_feed(root, "t_2024-01-02", ["hit_id", "event_list", "only_t"], "3\t1\ty\n", {"event.tsv": "1\tBuy\n"})
    make_feed(root, "x_2024-01-02", ["hit_id", "event_list"], "4\t1\n")
    q = ingest.stream_ingest(
        spark, root, target, str(tmp_path / "ckpt"), max_manifests_per_batch=per_batch, pathGlobFilter="[st]_*"
    )
    q.awaitTermination()
    ingest.conform(spark, [root], target, pathGlobFilter="s_more*")  # a reload replaces its own rows only
    rows = ingest.read_conformed(spark, target).collect()
    assert sorted((r.hit_id, r.only_t, r.event_list[0].event, r._tech_fileset) for r in rows) == [
        ("1", None, None, "s_2024-01-01"), ("2", None, None, "s_2024-01-01"), ("3", "y", "Buy", "t_2024-01-02")
    ]


def test_plan_size_does_not_grow_with_header_signatures(spark, tmp_path):
    import random

    columns = ["hit_id", *[f"c{i}" for i in range(60)], "os"]

    def feed_of(n):
        root, rng = str(tmp_path / f"drift{n}"), random.Random(n)
        want = {}
        for m in range(n):
            headers = ["hit_id", *rng.sample(columns[1:], rng.randrange(20, len(columns)))] if m else list(columns)
            rng.shuffle(headers)
            hits = []
            for i in range(3):
                row = {h: f"{m}-{i}-{h}" for h in headers} | {"hit_id": f"{m}-{i}"} | ({"os": str(i)} if "os" in headers else {})
                want[f"{m}-{i}"] = row
                hits.append("\t".join(row[h] for h in headers))
            make_feed(root, f"d_2024-{m:04d}", headers, "\n".join(hits) + "\n", {"operating_systems.tsv": "0\tZero\n1\tOne\n"})
        return root, want

    few, many = feed_of(4), feed_of(60)
    size = {}
    for n, (root, want) in ((4, few), (60, many)):
        df = datafeed(spark).load(root)
        size[n] = len(df._jdf.queryExecution().optimizedPlan().toString())
        for r in df.collect():
            row = want[r.hit_id]
            assert {c: r[c] for c in columns[:-1]} == {c: row.get(c) for c in columns[:-1]}
            assert r.os == ({"0": "Zero", "1": "One"}.get(row["os"]) if "os" in row else None)
    assert size[60] < 1.3 * size[4]


def test_runs_of_fields(spark, tmp_path):
    """Columns on both sides of every cut, records that end early, and only the runs that a query reads."""
    root, headers = str(tmp_path), [f"c{i}" for i in range(300)]
    lines = ["\t".join(f"{r}.{i}" if (r + i) % 7 else "" for i in range(n)) for r, n in enumerate([300, 301, 1, 15, 16, 17, 63, 64, 65, 255, 256, 257, 299])]
    make_feed(root, "w_2024-01-01", headers, "\n".join(lines) + "\n")
    df = datafeed(spark).option("enableLookups", "false").load(root)
    for got, line in zip(sorted(df.collect(), key=lambda r: int((r.c0 or r.c1 or "0.").split(".")[0])), lines):
        want = [x or None for x in line.split("\t")][:300]
        assert list(got) == want + [None] * (300 - len(want))
    plan = lambda c: df.select(c)._jdf.queryExecution().optimizedPlan().toString()
    limits = lambda c: [n for n in ("17", "49", "193") if f", {n})" in plan(c)]
    assert [limits(c) for c in ("c3", "c20", "c70")] == [["17"], ["17", "49"], ["17", "49", "193"]]
