"""Manifest discovery, parsing, writing and reconstruction."""

import os
import time

import pytest
from pyspark.sql import functions as F

from hitloom import datafeed
from hitloom.functions import names
from hitloom.sources import manifest, manifest_writer
from tests.conftest import make_feed, write_archive, write_gz


def test_fileset_names(spark):
    row = spark.range(1).select(
        names.hit_fileset(F.lit("/x/01-blogfeed_2015-07-13.tsv.gz")).alias("d"),
        names.lookup_fileset(F.lit("/x/blogfeed_2015-07-13-lookup_data.tar.gz")).alias("l"),
        names.reconstruct_key(F.lit("/x/02-site_2015-01-13.tsv.gz")).alias("r"),
    ).first()
    assert (row.d, row.l, row.r) == ("blogfeed_2015-07-13", "blogfeed_2015-07-13", "site_2015-01-13")


def test_parse_ignores_other_lines_and_crlf(spark, tmp_path):
    root = str(tmp_path)
    text = (
        "a free-text first line\r\nDatafeed-Manifest-Version: 1.0\r\nLookup-Files: 1\r\n\r\n"
        "Lookup-File: f_2024-01-01-lookup_data.tar.gz\r\nMD5-Digest: abc\r\nFile-Size: 10\r\n\r\n"
        "Data-File: 01-f_2024-01-01.tsv.gz\r\nMD5-Digest: def\r\nFile-Size: 20\r\nRecord-Count: 592\r\n\r\n"
        "Data-File: /abs/02-f_2024-01-01.tsv.gz\nMD5-Digest: \nFile-Size: \n"
    )
    with open(f"{root}/f_2024-01-01.txt", "w") as f:
        f.write(text)
    m = manifest.read_manifests(spark, [root]).first()
    assert m.fileset == "f_2024-01-01"
    assert [x.path.rsplit("/", 1)[-1] for x in m.lookup_files] == ["f_2024-01-01-lookup_data.tar.gz"]
    assert m.lookup_files[0].md5 == "abc" and m.lookup_files[0].size == "10"
    assert m.data_files[0].path == "file:" + root + "/01-f_2024-01-01.tsv.gz"
    assert m.data_files[0].record_count == 592
    assert m.data_files[1].path == "file:/abs/02-f_2024-01-01.tsv.gz"
    assert m.data_files[1].record_count is None


def test_listing_is_not_recursive_and_needs_txt(spark, tmp_path):
    root = str(tmp_path)
    make_feed(root, "g_2024-01-01", ["hit_id"], "1\n")
    os.makedirs(f"{root}/sub")
    make_feed(f"{root}/sub", "h_2024-01-01", ["hit_id"], "1\n")
    with open(f"{root}/notes.md", "w") as f:
        f.write("Lookup-File: x\nMD5-Digest: y\nFile-Size: z\n")
    assert [r.fileset for r in manifest.read_manifests(spark, [root]).collect()] == ["g_2024-01-01"]


def test_write_then_parse_roundtrip(spark, tmp_path):
    src = str(tmp_path / "src")
    make_feed(src, "blogfeed_2015-07-13", ["hit_id", "os"], "1\t2\n3\t4\n")
    out = str(tmp_path / "out")
    written = manifest_writer.write_manifests(manifest.read_manifests(spark, [src]), "file:" + out).collect()
    assert [os.path.basename(r.manifest_path) for r in written] == ["blogfeed_2015-07-13.txt"]
    m = manifest.read_manifests(spark, [out]).first()
    assert m.lookup_files[0].path.endswith("blogfeed_2015-07-13-lookup_data.tar.gz")
    assert m.data_files[0].path.endswith("01-blogfeed_2015-07-13.tsv.gz")
    with open(f"{out}/blogfeed_2015-07-13.txt") as f:
        text = f.read()
    assert text.startswith("Datafeed-Manifest-Version: 1.0\nLookup-Files: 1\nData-Files: 1\nTotal-Records: 1")
    assert datafeed(spark).load(out).count() == 2


def test_reconstruct_pairs_by_fileset(spark, tmp_path):
    hits_dir = tmp_path / "hits" / "nested"
    lk_dir = tmp_path / "lookups"
    os.makedirs(hits_dir)
    os.makedirs(lk_dir)
    write_gz(str(hits_dir / "01-site_2015-07-13.tsv.gz"), "1\n")
    write_gz(str(hits_dir / "01-site_2015-01-13.tsv.gz"), "1\n2\n")
    write_gz(str(hits_dir / "01-orphan_2015-07-13.tsv.gz"), "1\n")
    for fs_name in ("site_2015-07-13", "site_2015-01-13"):
        write_archive(str(lk_dir / f"{fs_name}-lookup_data.tar.gz"), {"column_headers.tsv": "hit_id\n"})
    rebuilt = manifest_writer.reconstruct_manifests(spark, str(tmp_path / "hits"), str(lk_dir))
    rows = sorted(rebuilt.select("fileset", "data_files", "lookup_files").collect())
    assert [r.fileset for r in rows] == ["site_2015-01-13", "site_2015-07-13"]
    assert all(len(r.data_files) == 1 and len(r.lookup_files) == 1 for r in rows)
    out = str(tmp_path / "manifests")
    manifest_writer.write_manifests(rebuilt, "file:" + out).collect()
    got = datafeed(spark).load(out).groupBy("_tech_fileset").count().collect()
    assert sorted((r[0], r[1]) for r in got) == [("site_2015-01-13", 2), ("site_2015-07-13", 1)]


def test_reconstruct_keeps_all_parts_and_duplicate_targets_fail(spark, tmp_path):
    (tmp_path / "hits").mkdir()
    for part in ("01", "02"):
        write_gz(str(tmp_path / "hits" / f"{part}-s.tsv.gz"), part + "\n")
    (tmp_path / "lk").mkdir()
    write_archive(str(tmp_path / "lk" / "s-lookup_data.tar.gz"), {"column_headers.tsv": "hit_id\n"})
    rebuilt = manifest_writer.reconstruct_manifests(spark, str(tmp_path / "hits"), str(tmp_path / "lk"))
    rows = rebuilt.collect()
    assert [[d.path.rsplit("/", 1)[1] for d in r.data_files] for r in rows] == [["01-s.tsv.gz", "02-s.tsv.gz"]]
    out = "file:" + str(tmp_path / "out")
    assert len(manifest_writer.write_manifests(rebuilt, out).collect()) == 1
    assert sorted(r.hit_id for r in datafeed(spark).load(out).collect()) == ["01", "02"]
    with pytest.raises(Exception, match="several manifests"):
        manifest_writer.write_manifests(rebuilt.unionByName(rebuilt), out).collect()


def test_parse_is_linear_in_the_files_of_a_manifest(spark, tmp_path):
    n = 40_000  # a quadratic parse of as many takes hours
    blocks = ["Lookup-File: f_2024-01-01-lookup_data.tar.gz\nMD5-Digest: a\nFile-Size: 1"]
    blocks += [f"Data-File: hits/{i:05d}-f_2024-01-01.tsv.gz\nMD5-Digest: m{i}\nFile-Size: {i}" + (f"\nRecord-Count: {i}" if i % 2 else "") for i in range(n)]
    (tmp_path / "f_2024-01-01.txt").write_text("\n\n".join(blocks))
    start = time.time()
    files = manifest.manifest_entries(manifest.read_manifests(spark, [str(tmp_path)])).filter("kind = 'data'").orderBy("pos").collect()
    assert time.time() - start < 120
    assert [(r.path, r.md5, r.size, r.record_count) for r in files] == [
        (f"file:{tmp_path}/hits/{i:05d}-f_2024-01-01.tsv.gz", f"m{i}", str(i), i if i % 2 else None) for i in range(n)
    ]
