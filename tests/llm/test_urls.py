"""Token boundaries of the URL filter are ASCII, in the operator as in its SQL."""

from __future__ import annotations

import duckdb

from hitloom.llm import queries, urls


def test_boundaries_agree_with_the_sql(spark):
    hosts = ["casino.net", "écasino.net", "xcasino.net", "casinoß.net", "casino9.net", "_casino_.net", "CASINO.net", "a.com/win-bet", "a.com/winé-bet", "a.com/win", "ſex.com/win", "例casino例", "a.com/casino"]
    rows = [(i, f"http://{h}") for i, h in enumerate(hosts)] + [(50, None), (51, ""), (52, "casino"), (53, "http://casino"), (53, "http://casino")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string")
    got = urls.filter_urls(pages, rules=queries.URL_RULES).select("page_id", "host", "path", "rule", "verdict")
    con = duckdb.connect()
    con.register("pages", pages.toPandas())
    key = lambda r: tuple(str(x) for x in r)
    want = con.sql(queries.ORACLES["op7_url_filter"]).fetchall()
    assert sorted((tuple(r) for r in got.collect()), key=key) == sorted(want, key=key)
    verdict = {r.page_id: r.verdict for r in got.collect()}
    assert [verdict[i] for i in (0, 1, 2, 3, 4)] == ["block", "block", "allow", "block", "allow"]


def test_soft_terms_reject_by_number_and_weight(spark):
    cases = {
        "http://poker.example.net/": "allow",  # one soft term, however heavy
        "http://poker.example.net/poker/poker-poker": "allow",  # the same one again
        "http://cheap.example.net/free": "allow",  # two light ones
        "http://cheap.example.net/free/deals": "block",  # three light ones
        "http://cheap-pills.example.net/": "block",  # a heavy and a light one
        "http://bets.example.net/pills": "block",
        "http://alphabets.example.net/freedom/pillsbury": "allow",  # parts of words
        "http://example.net/" + "a/" * 100_000 + "porn": "block",  # far into a long URL
    }
    pages = spark.createDataFrame([(u, 1) for u in cases] * 2, "url string, soft_weight int")
    rows = urls.filter_urls(pages).collect()
    assert len(rows) == 2 * len(cases) and {r.url: r.verdict for r in rows} == cases
    assert {r.url: (r.soft_hits, r._soft_weight) for r in rows}["http://cheap-pills.example.net/"] == (["cheap", "pills"], 3)
    strict_only = urls.filter_urls(pages, strict=["poker"], soft={}).collect()
    assert {r.url for r in strict_only if r.verdict == "block"} == {u for u in cases if "poker" in u}


def test_query_equals_its_sql(spark):
    sf = "/root/testdata/sf0.001"
    got = queries.op7_url_filter(spark, sf)
    assert got.dtypes == [("page_id", "bigint"), ("host", "string"), ("path", "string"), ("rule", "string"), ("verdict", "string")]
    con = duckdb.connect()
    con.sql(f"CREATE VIEW pages AS SELECT * FROM '{sf}/pages.parquet'")
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(con.sql(queries.ORACLES["op7_url_filter"]).fetchall(), key=key)
