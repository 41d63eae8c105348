"""Conformed tables: published at once, restartable after a crash, compaction, vacuum."""

from __future__ import annotations

import os

import pytest

import hitloom
from hitloom import fs
from hitloom.streaming import ingest, table
from tests.conftest import make_feed, write_gz

KEYS = ("_tech_fileset", "_tech_manifest")


def _ids(df):
    return sorted(r.hit_id for r in df.select("hit_id").collect())


def test_reader_sees_the_old_or_the_new_rows(spark, tmp_path, monkeypatch):
    root, target = str(tmp_path / "feed"), str(tmp_path / "table")
    make_feed(root, "s_2024-01-01", ["hit_id"], "1\n2\n")
    make_feed(root, "s_2024-01-02", ["hit_id"], "3\n")
    ingest.conform(spark, [root], target)
    before = ingest.read_conformed(spark, target)
    write_gz(f"{root}/01-s_2024-01-01.tsv.gz", "10\n11\n12\n")
    during = []
    publish = table.publish

    def look(*args, **kwargs):
        during.append(_ids(ingest.read_conformed(spark, target)))  # all new files are written, none is published
        return publish(*args, **kwargs)

    monkeypatch.setattr(table, "publish", look)
    ingest.conform(spark, [root], target)
    assert during == [["1", "2", "3"]]
    assert _ids(ingest.read_conformed(spark, target)) == ["10", "11", "12", "3"]
    assert _ids(before) == ["1", "2", "3"]  # a plan made before goes on with its snapshot
    assert _ids(table.read(spark, target, 1)) == ["1", "2", "3"]


def test_crash_before_publishing_changes_nothing(spark, tmp_path, monkeypatch):
    root, target = str(tmp_path / "feed"), str(tmp_path / "table")
    make_feed(root, "s_2024-01-01", ["hit_id"], "1\n")
    ingest.conform(spark, [root], target)
    write_gz(f"{root}/01-s_2024-01-01.tsv.gz", "2\n")
    with monkeypatch.context() as m:
        m.setattr(fs, "rename_new", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            ingest.conform(spark, [root], target)
    assert _ids(ingest.read_conformed(spark, target)) == ["1"]
    ingest.conform(spark, [root], target)
    assert _ids(ingest.read_conformed(spark, target)) == ["2"]
    assert table.vacuum(spark, target, older_than_hours=24) == 0
    assert table.vacuum(spark, target, older_than_hours=-1) == 2  # the replaced version and the one that died
    assert _ids(ingest.read_conformed(spark, target)) == ["2"]


def test_two_loads_at_a_time_both_count(spark, tmp_path, monkeypatch):
    root, target = str(tmp_path / "feed"), str(tmp_path / "table")
    make_feed(root, "a_2024-01-01", ["hit_id"], "1\n")
    make_feed(root, "b_2024-01-01", ["hit_id"], "2\n")
    partitions, raced = table.partitions, []

    def late(*args):
        found = partitions(*args)
        if not raced:  # the other load publishes after this one has read the log
            raced.append(1)
            ingest.conform(spark, [root], target, pathGlobFilter="b_*")
        return found

    monkeypatch.setattr(table, "partitions", late)
    ingest.conform(spark, [root], target, pathGlobFilter="a_*")
    assert _ids(ingest.read_conformed(spark, target)) == ["1", "2"]
    assert partitions(spark, target)[0] == 2 and not [f for f in os.listdir(f"{target}/_log") if "draft" in f and not f.endswith(".crc")]


def test_manifest_without_hits_empties_its_partition(spark, tmp_path):
    root, target = str(tmp_path / "feed"), str(tmp_path / "table")
    make_feed(root, "a_2024-01-01", ["hit_id"], "1\n")
    make_feed(root, "b_2024-01-01", ["hit_id"], "2\n")
    ingest.conform(spark, [root], target)
    write_gz(f"{root}/01-a_2024-01-01.tsv.gz", "")
    ingest.conform(spark, [root], target)
    assert _ids(ingest.read_conformed(spark, target)) == ["2"]
    with pytest.raises(hitloom.NoManifestError):
        ingest.conform(spark, [root], target, pathGlobFilter="none*")


def test_compaction_keeps_rows_and_yields_to_loads(spark, tmp_path, monkeypatch):
    root, target = str(tmp_path / "feed"), str(tmp_path / "table")
    for name in ("a", "b"):
        make_feed(root, f"{name}_2024-01-01", ["hit_id", "os"], f"{name}1\t1\n", n_files=4, extra_text=[f"{name}{i}\t1\n" for i in (2, 3, 4)])
    with monkeypatch.context():
        spark.conf.set("spark.sql.files.openCostInBytes", str(1 << 30))
        try:
            ingest.conform(spark, [root], target)
        finally:
            spark.conf.unset("spark.sql.files.openCostInBytes")
    rows = _ids(ingest.read_conformed(spark, target))
    files = lambda: len(ingest.read_conformed(spark, target).inputFiles())
    assert files() == 8
    write = table.write_version

    def load_meanwhile(df, *args):
        out = write(df, *args)
        monkeypatch.setattr(table, "write_version", write)
        write_gz(f"{root}/01-b_2024-01-01.tsv.gz", "new\t1\n")
        ingest.conform(spark, [root], target, pathGlobFilter="b_*")
        return out

    monkeypatch.setattr(table, "write_version", load_meanwhile)
    assert table.compact(spark, target, *KEYS, least_files=4) == 2
    assert _ids(ingest.read_conformed(spark, target)) == sorted([*(r for r in rows if r != "b1"), "new"])
    assert files() < 8
    pruned = ingest.read_conformed(spark, target).filter("_tech_fileset = 'a_2024-01-01'")
    assert "PartitionFilters: [isnotnull(_tech_fileset" in pruned._jdf.queryExecution().executedPlan().toString()
