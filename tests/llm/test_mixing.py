"""Mixing with null and repeated ids, through the tree, into real partitions."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from hitloom.llm import mixing, queries


def _rows(rng, ids):
    return [(ids(i), " ".join(f"w{rng.randrange(5000)}" for _ in range(rng.randrange(1, 30))), "abbc"[i % 4]) for i in range(600)]


@pytest.mark.parametrize("ids", [lambda i: None if i % 2 else i, lambda i: None, lambda i: i % 5], ids=["half null", "all null", "repeated"])
def test_each_source_comes_within_a_document_of_its_target(spark, monkeypatch, ids):
    monkeypatch.setattr(mixing, "BLOCK_DOCS", 16)
    docs = spark.createDataFrame(_rows(random.Random(1), ids), "doc_id bigint, text string, source string")
    found = mixing.allot(docs, mixing.plan_mix(docs)).collect()
    assert len(found) == 600
    taken, target = {}, {}
    for r in found:
        assert len(r.copies) <= 3
        taken[r.source] = taken.get(r.source, 0) + len(r.text.split()) * len(r.copies)
        target[r.source] = r.target
    assert all(abs(taken[s] - target[s]) <= 30 for s in target), (taken, target)
    assert {c.shard for r in found for c in r.copies} == set(range(8))  # the tree has three levels on any table


def test_shards_are_partitions(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_DOCS", 16)
    docs = spark.createDataFrame(_rows(random.Random(2), lambda i: i), "doc_id bigint, text string, source string")
    mixed = mixing.mix(docs, mixing.plan_mix(docs))
    pairs = mixed.select("shard", F.spark_partition_id().alias("p")).distinct().collect()
    assert sorted((r.shard, r.p) for r in pairs) == [(i, i) for i in range(8)]


def test_wordless_rows_are_never_taken_more_than_three_times(spark):
    rows = [(i, None if i % 3 else "", "empty") for i in range(50)] + [(i, " \t" if i % 2 else "one two three", "small") for i in range(50, 90)]
    docs = spark.createDataFrame([*rows, *[(i, "word " * 40, "large") for i in range(90, 190)]], "doc_id bigint, text string, source string")
    assert max(len(r.copies) for r in mixing.allot(docs, mixing.plan_mix(docs)).collect()) <= 3


def test_spread_levels_keep_the_quotas(spark, monkeypatch):
    quotas = spark.createDataFrame([(0, 900), (1, 77), (2, 5)], "k int, quota long")
    whole = {tuple(r) for r in mixing.split_quotas(quotas, 5, 3).collect()}
    monkeypatch.setattr(mixing, "TOP_LEVELS", 2)
    assert {tuple(r) for r in mixing.split_quotas(quotas, 5, 3).collect()} == whole
    assert len(whole) == 96 and sum(q for _, k, q in whole if k == 0) == 900


def test_query_returns_its_columns(spark):
    df = queries.op4_mixing(spark, "/root/testdata/sf0.001")
    assert [f"{f.name} {f.dataType.simpleString()}" for f in df.schema] == [
        "doc_id bigint", "size bigint", "source_size bigint", "target double", "taken bigint", "shards string",
    ]
    for r in df.collect():
        shards = [x for x in r.shards.split(",") if x]
        assert r.taken == r.size * len(shards)
