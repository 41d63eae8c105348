"""

Every query reads a hit feed that Spark writes from the driver's tables
(``hitloom.synth``: events -> web hits, orders/lineitem/part -> product lists,
documents -> escaped long texts, customer/nation -> hit files without
manifests) and reads it back through the feed reader.  The matching oracle
SQL computes the same answer straight from the tables in DuckDB, sharing no
parsing code with the Spark side.  Nested results are compared flat
(exploded); timestamps as epoch seconds.
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import hitloom
from hitloom import datafeed, datafeed_stream, synth
from hitloom.operators.lookups import MOBILE_FIELDS
from hitloom.session import work_dir
from hitloom.sources import manifest as manifest_source
from hitloom.sources import manifest_writer
from hitloom.streaming import ingest

try:  # the corpus operators, and the packages that only they need, are optional
    import corpus_pipeline
    import hitloom.llm.queries as corpus_queries
except ImportError as missing:
    print(f"corpus queries are not registered: {missing}", file=sys.stderr)
    corpus_pipeline = corpus_queries = None

SMOKE_DIR = "/root/testdata/sf0.001"


def _web(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    root = synth.ensure_feeds(spark, sf_dir, "web")
    return datafeed(spark).options(**options).load(f"{root}/web")


def _hit_id() -> F.Column:
    return F.col("hit_id").cast("bigint").alias("hit_id")


def _scratch(spark: SparkSession, kind: str) -> str:
    return work_dir(spark, kind, uuid.uuid4().hex)


# --------------------------------------------------------------------------- queries


def feed_hits_by_os(spark, sf_dir):
    return _web(spark, sf_dir).groupBy("os").agg(F.count(F.lit(1)).alias("n_hits"))


def feed_scan_raw(spark, sf_dir):
    df = _web(spark, sf_dir, enableLookups="false")
    return df.select(_hit_id(), "os", "browser", "country", "date_time", "post_pagename", "user_agent")


SIMPLE_OUTPUTS = [
    "browser", "browser_type", "carrier", "color", "connection_type", "country", "javascript",
    "language", "os", "os_type", "plugin", "resolution", "ref_type", "search_engine",
]


def feed_simple_lookups(spark, sf_dir):
    return _web(spark, sf_dir).select(_hit_id(), *SIMPLE_OUTPUTS)


def feed_lookup_last_wins(spark, sf_dir):
    return _web(spark, sf_dir).groupBy("browser").agg(F.count(F.lit(1)).alias("n_hits"))


def feed_mobile_attributes(spark, sf_dir):
    m = F.col("mobile_attributes")
    return _web(spark, sf_dir).select(
        _hit_id(),
        m["Manufacturer"].alias("manufacturer"),
        m["Device_Type"].alias("device_type"),
        m["Stream_HTTP_Live_Streaming_Video_Support"].alias("hls"),
    )


def _items(df: DataFrame, items: str, alias: str, *keep: str | F.Column, pos: str = "pos") -> DataFrame:
    """A row for each item of an array.

    An inner ``posexplode`` of a computed array gets filters on its size and on null that compute the array
    again, twice; the outer form computes it once, and its one row for an empty array goes here."""
    return df.select(*keep, F.posexplode_outer(items).alias(pos, alias)).filter(F.col(pos).isNotNull())


def _exploded_events(df: DataFrame, column: str) -> DataFrame:
    return _items(df, column, "ev", _hit_id()).select(
        "hit_id", "pos", F.col("ev.event").alias("event"), F.col("ev.value").alias("value")
    )


def feed_event_list(spark, sf_dir):
    return _exploded_events(_web(spark, sf_dir), "event_list")


def feed_post_event_list(spark, sf_dir):
    return _exploded_events(_web(spark, sf_dir), "post_event_list")


def _orders(spark, sf_dir) -> DataFrame:
    root = synth.ensure_feeds(spark, sf_dir, "orders")
    return datafeed(spark).load(f"{root}/orders")


def _exploded_products(df: DataFrame, column: str) -> DataFrame:
    return _items(df, column, "p", _hit_id()).select(
        "hit_id", "pos", F.col("p.category").alias("category"), F.col("p.name").alias("name"),
        F.col("p.quantity").alias("quantity"), F.col("p.price").alias("price"),
    )


def feed_product_list(spark, sf_dir):
    return _exploded_products(_orders(spark, sf_dir), "product_list")


def feed_post_product_list(spark, sf_dir):
    return _exploded_products(_orders(spark, sf_dir), "post_product_list")


def _exploded_pairs(df: DataFrame, column: str) -> DataFrame:
    """The events and the eVars of every product, from one read of the hits."""
    p = _items(df, column, "p", _hit_id())
    lists = F.array(*[F.struct(F.lit(kind).alias("kind"), F.col(f"p.{kind}s").alias("pairs")) for kind in ("event", "evar")])
    of_kind = p.select("hit_id", "pos", F.explode(lists).alias("list"))
    return _items(of_kind, "list.pairs", "kv", "hit_id", "pos", "list.kind", pos="i").select(
        "hit_id", "pos", "kind", "i", F.col("kv.key").alias("key"), F.col("kv.value").alias("value")
    )


def feed_product_events_evars(spark, sf_dir):
    return _exploded_pairs(_orders(spark, sf_dir), "post_product_list")


def feed_tsv_escapes(spark, sf_dir):
    root = synth.ensure_feeds(spark, sf_dir, "docs")
    df = datafeed(spark).load(f"{root}/docs")
    return df.select(_hit_id(), F.col("post_pagename").alias("text"))


def feed_metadata_fileset(spark, sf_dir):
    df = _web(spark, sf_dir)
    return df.groupBy(
        F.col("_tech_fileset").alias("fileset"), F.unix_seconds("_tech_last_modified").alias("modified_epoch")
    ).agg(F.count(F.lit(1)).alias("n_hits"))


_EPOCH = "timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', to_timestamp_ntz(date_time))"


def feed_schema_drift(spark, sf_dir):
    df = _web(spark, sf_dir)
    return df.select(
        _hit_id(), "visid", "user_agent", "post_pagename", F.col("last_hit_time_gmt").cast("bigint").alias("last_hit"),
        F.expr(_EPOCH).alias("date_epoch"),
    )


def feed_user_schema(spark, sf_dir):
    root = synth.ensure_feeds(spark, sf_dir, "web")
    schema = "hit_id bigint, os string, not_in_feed string, last_hit_time_gmt bigint, browser_type string"
    return datafeed(spark).schema(schema).load(f"{root}/web")


def feed_glob_filter(spark, sf_dir):
    df = _web(spark, sf_dir, pathGlobFilter="shop_2024-01-02*")
    return df.select(_hit_id(), "browser", "_tech_fileset")


def feed_modified_after(spark, sf_dir):
    df = _web(spark, sf_dir, modifiedAfter="2024-01-02T12:00:00", timeZone="UTC")
    return df.groupBy(F.col("_tech_fileset").alias("fileset")).agg(F.count(F.lit(1)).alias("n_hits"))


def feed_multi_path(spark, sf_dir):
    root = synth.ensure_feeds(spark, sf_dir, "docs", "orders", "web")
    df = datafeed(spark).load(f"{root}/web", f"{root}/orders", f"{root}/docs")
    return df.groupBy(F.col("_tech_fileset").alias("fileset")).agg(F.count(F.lit(1)).alias("n_hits"))


def feed_manifest_parse(spark, sf_dir):
    root = synth.ensure_feeds(spark, sf_dir, "web")
    m = manifest_source.read_manifests(spark, [f"{root}/web"])
    return m.select(
        "fileset",
        F.size("lookup_files").alias("n_lookup"),
        F.size("data_files").alias("n_data"),
        F.aggregate("data_files", F.lit(0).cast("bigint"), lambda a, d: a + d["record_count"]).alias("total_records"),
    )


def feed_manifest_roundtrip(spark, sf_dir):
    root = synth.ensure_feeds(spark, sf_dir, "web")
    folder = _scratch(spark, "roundtrip")
    manifest_writer.write_manifests(manifest_source.read_manifests(spark, [f"{root}/web"]), folder).collect()
    df = datafeed(spark).load(folder)
    return df.groupBy(F.col("_tech_fileset").alias("fileset"), "os").agg(F.count(F.lit(1)).alias("n_hits"))


def feed_manifest_reconstruct(spark, sf_dir):
    root = synth.ensure_feeds(spark, sf_dir, "lost")
    folder = _scratch(spark, "reconstructed")
    rebuilt = manifest_writer.reconstruct_manifests(spark, f"{root}/lost/hits", f"{root}/lost/lookups")
    manifest_writer.write_manifests(rebuilt, folder).collect()
    df = datafeed(spark).load(folder)
    return df.groupBy(F.col("_tech_fileset").alias("fileset"), "os").agg(F.count(F.lit(1)).alias("n_hits"))


def feed_conform_incremental(spark, sf_dir):
    root = synth.ensure_feeds(spark, sf_dir, "web")
    target = _scratch(spark, "conformed")
    ingest.conform(spark, [f"{root}/web"], target, modifiedBefore="2024-01-02T12:00:00", timeZone="UTC")
    ingest.conform(spark, [f"{root}/web"], target, modifiedAfter="2024-01-02T12:00:00", timeZone="UTC")
    df = ingest.read_conformed(spark, target)
    return df.groupBy(F.col("_tech_fileset").alias("fileset"), "os").agg(F.count(F.lit(1)).alias("n_hits"))


def feed_stream_ingest(spark, sf_dir):
    root = synth.ensure_feeds(spark, sf_dir, "web")
    target = _scratch(spark, "streamed")
    q = ingest.stream_ingest(spark, f"{root}/web", target, _scratch(spark, "stream-checkpoint"), max_manifests_per_batch=1)
    q.awaitTermination()
    return _by_fileset_os(ingest.read_conformed(spark, target))


def _by_fileset_os(df: DataFrame) -> DataFrame:
    return df.groupBy(F.col("_tech_fileset").alias("fileset"), "os").agg(F.count(F.lit(1)).alias("n_hits"))


def feed_stream_ingest_filtered(spark, sf_dir):
    """The filters choose the same manifests in a stream as in a batch read, at any batch size."""
    root = synth.ensure_feeds(spark, sf_dir, "web")
    target = _scratch(spark, "streamed")
    q = ingest.stream_ingest(
        spark, f"{root}/web", target, _scratch(spark, "stream-checkpoint"), max_manifests_per_batch=1000, pathGlobFilter="shop_2024-01-02*"
    )
    q.awaitTermination()
    return _by_fileset_os(ingest.read_conformed(spark, target))


def feed_conform_drift(spark, sf_dir):
    """Deliveries with other columns, conformed one by one: the table has the columns of both."""
    root = synth.ensure_feeds(spark, sf_dir, "late")
    target = _scratch(spark, "conformed")
    ingest.conform(spark, [f"{root}/late"], target, modifiedBefore="2024-01-02T12:00:00", timeZone="UTC")
    ingest.conform(spark, [f"{root}/late"], target, modifiedAfter="2024-01-02T12:00:00", timeZone="UTC")
    return ingest.read_conformed(spark, target).select(_hit_id(), "os", "extra_b")


def feed_path_forms(spark, sf_dir):
    """Manifests that name the same files relatively, with ``.``, ``..`` and spare slashes, and absolutely."""
    root = synth.ensure_feeds(spark, sf_dir, "forms")
    return _by_fileset_os(datafeed(spark).load(f"{root}/forms"))


def feed_lookup_late_file(spark, sf_dir):
    """A lookup file that only a later delivery has: earlier hits keep their code."""
    root = synth.ensure_feeds(spark, sf_dir, "late")
    return datafeed(spark).load(f"{root}/late").select(_hit_id(), "os")


def feed_user_schema_drift(spark, sf_dir):
    """A column that only a later delivery has, asked for by a user schema."""
    root = synth.ensure_feeds(spark, sf_dir, "late")
    return datafeed(spark).schema("hit_id bigint, extra_b string, os string").load(f"{root}/late")


def feed_plain_and_bzip2(spark, sf_dir):
    """Hit files that Spark splits; records may go over the cuts."""
    root = synth.ensure_feeds(spark, sf_dir, "codecs")
    df = datafeed(spark).load(f"{root}/codecs")
    return df.select(_hit_id(), F.col("post_pagename").alias("text"))


def feed_mobile_all_fields(spark, sf_dir):
    return _web(spark, sf_dir).select(_hit_id(), "mobile_attributes.*")


def feed_product_pairs(spark, sf_dir):
    """Pairs whose keys and values hold escaped list syntax."""
    root = synth.ensure_feeds(spark, sf_dir, "parts")
    return _exploded_pairs(datafeed(spark).load(f"{root}/parts"), "product_list")


def feed_filesets_option(spark, sf_dir):
    """``filesets`` chooses deliveries before any hit file is listed."""
    return _web(spark, sf_dir, filesets=synth.WEB_B).select(_hit_id(), "browser", "_tech_fileset")


def feed_metadata_prefix(spark, sf_dir):
    df = _web(spark, sf_dir, metadataPrefix="m_")
    return df.groupBy(F.col("m_fileset").alias("fileset"), "os").agg(F.count(F.lit(1)).alias("n_hits"))


def _streamed(spark, df: DataFrame) -> DataFrame:
    """What a streaming DataFrame of hits writes until its manifests are read."""
    target = _scratch(spark, "streamed")
    writer = df.writeStream.format("parquet").option("path", target).option("checkpointLocation", _scratch(spark, "stream-checkpoint"))
    writer.trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(df.schema).parquet(target)


def feed_stream_dataframe(spark, sf_dir):
    """The feed as a streaming DataFrame: looked-up columns and metadata, a manifest in each micro-batch."""
    root = synth.ensure_feeds(spark, sf_dir, "web")
    hits = datafeed_stream(spark).option("maxManifestsPerTrigger", 1).load(f"{root}/web")
    return _by_fileset_os(_streamed(spark, hits.select("_tech_fileset", "os")))


def feed_stream_simple_lookups(spark, sf_dir):
    root = synth.ensure_feeds(spark, sf_dir, "web")
    return _streamed(spark, datafeed_stream(spark).load(f"{root}/web").select(_hit_id(), *SIMPLE_OUTPUTS))


def feed_stream_events(spark, sf_dir):
    root = synth.ensure_feeds(spark, sf_dir, "web")
    hits = datafeed_stream(spark).schema("hit_id string, event_list array<struct<event:string,value:string>>").load(f"{root}/web")
    return _exploded_events(_streamed(spark, hits), "event_list")


def feed_stream_texts(spark, sf_dir):
    """Long texts with continued lines in gzip, plain and bzip2 files."""
    root = synth.ensure_feeds(spark, sf_dir, "codecs")
    hits = datafeed_stream(spark).load(f"{root}/codecs").select(_hit_id(), F.col("post_pagename").alias("text"))
    return _streamed(spark, hits)


MANY_FILES = 5000


def feed_manifest_many_files(spark, sf_dir):
    """Manifests that name thousands of files each (one for each event), written and parsed again."""
    folder = _scratch(spark, "many-files")
    name = F.concat(F.lit("hits/"), F.col("event_id").cast("string"), F.lit("-many.tsv.gz"))
    file = F.struct(name.alias("path"), F.md5(F.coalesce("props", F.lit(""))).alias("md5"), F.col("user_id").cast("string").alias("size"), F.col("event_id").alias("record_count"))
    archive = F.struct(F.concat(F.lit("many_"), F.floor(F.col("event_id") / MANY_FILES).cast("string"), F.lit("-lookup_data.tar.gz")).alias("path"), F.lit("").alias("md5"), F.lit("").alias("size"))
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    manifests = events.groupBy(F.array(archive).alias("lookup_files")).agg(F.sort_array(F.collect_list(file)).alias("data_files"))
    manifest_writer.write_manifests(manifests, folder).collect()
    parsed = manifest_source.read_manifests(spark, [folder])
    files = parsed.select("fileset", F.explode("data_files").alias("f"))
    return files.select("fileset", F.regexp_extract("f.path", r"hits/(.*)$", 1).alias("file"), "f.md5", "f.size", "f.record_count")


def feed_record_rules(spark, sf_dir):
    """Comments and blank lines go, fields beyond the header are ignored, missing ones are null."""
    root = synth.ensure_feeds(spark, sf_dir, "rules")
    return datafeed(spark).load(f"{root}/rules").select("hit_id", "user", "kind")


def feed_comments_kept(spark, sf_dir):
    """Without a comment character the lines that begin with ``#`` are records."""
    root = synth.ensure_feeds(spark, sf_dir, "rules")
    return datafeed(spark).option("comment", "").load(f"{root}/rules").select("hit_id", "user", "kind")


def feed_encodings(spark, sf_dir):
    """Column names and hits in ISO-8859-1."""
    root = synth.ensure_feeds(spark, sf_dir, "latin")
    df = datafeed(spark).option("fileEncoding", "ISO-8859-1").option("dataEncoding", "ISO-8859-1").load(f"{root}/latin")
    return df.select(_hit_id(), F.col("größe").cast("bigint").alias("n_chars"), F.col("post_pagename").alias("text"))


def feed_max_chars(spark, sf_dir):
    """The length limit lets texts of exactly that length through."""
    root = synth.ensure_feeds(spark, sf_dir, "docs")
    longest = datafeed(spark).load(f"{root}/docs").agg(F.max(F.length("post_pagename"))).first()[0]
    df = datafeed(spark).option("maxCharsPerColumn", longest).load(f"{root}/docs")
    return df.select(_hit_id(), F.col("post_pagename").alias("text"))


def feed_reader_extension(spark, sf_dir):
    """``spark.read.datafeed`` and ``spark.read.format("datafeed")``, one delivery each."""
    hitloom.install()
    root = synth.ensure_feeds(spark, sf_dir, "web")
    a = spark.read.option("pathGlobFilter", "shop_2024-01-01*").datafeed(f"{root}/web")
    b = spark.read.format("datafeed").option("pathGlobFilter", "shop_2024-01-02*").load(f"{root}/web")
    return _by_fileset_os(a.select("_tech_fileset", "os").unionByName(b.select("_tech_fileset", "os")))


def feed_sql_view(spark, sf_dir):
    """The feed named in SQL, lookups and metadata included."""
    hitloom.install(spark)
    root = synth.ensure_feeds(spark, sf_dir, "web")
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW feed_hits USING datafeed OPTIONS (path '{root}/web')")
    return _by_fileset_os(spark.table("feed_hits"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in [
        feed_hits_by_os, feed_scan_raw, feed_simple_lookups, feed_lookup_last_wins, feed_mobile_attributes,
        feed_event_list, feed_post_event_list, feed_product_list, feed_post_product_list,
        feed_product_events_evars, feed_tsv_escapes, feed_metadata_fileset, feed_schema_drift,
        feed_user_schema, feed_glob_filter, feed_modified_after, feed_multi_path, feed_manifest_parse,
        feed_manifest_roundtrip, feed_manifest_reconstruct, feed_conform_incremental, feed_stream_ingest,
        feed_stream_ingest_filtered, feed_conform_drift, feed_path_forms, feed_lookup_late_file, feed_user_schema_drift,
        feed_plain_and_bzip2, feed_mobile_all_fields, feed_product_pairs, feed_filesets_option, feed_metadata_prefix,
        feed_stream_dataframe, feed_stream_simple_lookups, feed_stream_events, feed_stream_texts, feed_manifest_many_files,
        feed_record_rules, feed_comments_kept, feed_encodings, feed_max_chars, feed_reader_extension, feed_sql_view,
    ]
}

# --------------------------------------------------------------------------- oracles

_OS = "CASE WHEN user_id % 5 = 4 THEN NULL ELSE concat('OS ', user_id % 5) END"
_BROWSER = (
    "CASE WHEN user_id % 7 = 6 THEN NULL WHEN user_id % 7 = 0 THEN 'Browser 0 (latest)' "
    "ELSE concat('Browser ', user_id % 7) END"
)
_BROWSER_TYPE = "concat('Vendor ', (user_id % 7) % 3)"
_FILESET = "CASE WHEN event_id % 2 = 0 THEN 'shop_2024-01-01' ELSE 'shop_2024-01-02' END"
_TYPE_ID = (
    "CASE event_type WHEN 'click' THEN 1 WHEN 'view' THEN 2 WHEN 'purchase' THEN 3 "
    "WHEN 'signup' THEN 4 WHEN 'error' THEN 5 END"
)
_MONEY = "CAST(CAST({} AS DECIMAL(18,2)) AS VARCHAR)"
_EPOCH_SQL = "date_diff('second', TIMESTAMP '1970-01-01 00:00:00', {})"
_TRUNC_TS = "date_trunc('second', ts)"
_PRODUCT_NAME = (
    "CASE p_partkey % 5 WHEN 0 THEN replace(p_name, ' ', ',') WHEN 1 THEN replace(p_name, ' ', ';') "
    "WHEN 2 THEN replace(p_name, ' ', '=') WHEN 3 THEN replace(p_name, ' ', '|') ELSE replace(p_name, ' ', '^') END"
)
_ITEMS = (
    "SELECT l_orderkey AS hit_id, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_shipdate) - 1 AS INTEGER) AS pos, "
    "l_linenumber, p_partkey, p_type, p_name, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_shipdate "
    "FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON o_orderkey = l_orderkey"
)
_DOC_TEXT = "replace(replace(replace(text, '. ', '.' || chr(9)), 'é', '\\'), 'è', chr(13))"
_COUNT_BY_FILESET_OS = (
    "SELECT {fs} AS fileset, " + _OS + " AS os, COUNT(*) AS n_hits FROM events GROUP BY 1, 2"
).format(fs=_FILESET)

_LATE = (
    f"SELECT event_id AS hit_id, CASE WHEN event_id % 2 = 0 THEN CAST(user_id % 5 AS VARCHAR) ELSE {_OS} END AS os, "
    "CASE WHEN event_id % 2 = 1 THEN concat('b', event_id) END AS extra_b FROM events"
)

ORACLES: dict[str, str] = {
    "feed_hits_by_os": f"SELECT {_OS} AS os, COUNT(*) AS n_hits FROM events GROUP BY 1",
    "feed_scan_raw": (
        "SELECT event_id AS hit_id, CAST(user_id % 5 AS VARCHAR) AS os, CAST(user_id % 7 AS VARCHAR) AS browser, "
        "CAST(user_id % 25 AS VARCHAR) AS country, strftime(ts, '%Y-%m-%d %H:%M:%S') AS date_time, "
        "props AS post_pagename, CASE WHEN event_id % 2 = 0 THEN concat('Agent/', user_id) END AS user_agent FROM events"
    ),
    "feed_simple_lookups": (
        f"SELECT event_id AS hit_id, {_BROWSER} AS browser, {_BROWSER_TYPE} AS browser_type, "
        "concat('Carrier ', user_id % 4) AS carrier, concat('Depth ', user_id % 3) AS color, "
        "CASE WHEN event_id % 3 = 2 THEN NULL ELSE concat('Conn ', event_id % 3) END AS connection_type, "
        "n_name AS country, concat('JS 1.', user_id % 6) AS javascript, concat('Language ', user_id % 11) AS language, "
        f"{_OS} AS os, concat('Type ', (user_id % 5) % 2) AS os_type, concat('Plugin ', user_id % 2) AS plugin, "
        "concat('Res ', user_id % 9) AS resolution, concat('Ref ', event_id % 6) AS ref_type, "
        "CASE WHEN event_id % 8 = 7 THEN NULL ELSE concat('Engine ', event_id % 8) END AS search_engine "
        "FROM events LEFT JOIN nation ON n_nationkey = user_id % 25"
    ),
    "feed_lookup_last_wins": f"SELECT {_BROWSER} AS browser, COUNT(*) AS n_hits FROM events GROUP BY 1",
    "feed_mobile_attributes": (
        "SELECT event_id AS hit_id, "
        "CASE WHEN user_id % 13 = 12 THEN NULL ELSE concat('Manufacturer ', user_id % 13) END AS manufacturer, "
        "CASE WHEN user_id % 13 >= 11 THEN NULL ELSE concat('Device_Type ', user_id % 13) END AS device_type, "
        "CASE WHEN user_id % 13 >= 11 THEN NULL ELSE concat('Stream_HTTP_Live_Streaming_Video_Support ', user_id % 13) END AS hls "
        "FROM events"
    ),
    "feed_event_list": (
        f"SELECT event_id AS hit_id, 0 AS pos, concat('Custom Event ', {_TYPE_ID}) AS event, "
        f"{_MONEY.format('value')} AS value FROM events UNION ALL "
        "SELECT event_id, 1, CASE WHEN user_id % 10 = 9 THEN NULL ELSE concat('Instance of eVar', user_id % 10 + 1) END, "
        "NULL FROM events"
    ),
    "feed_post_event_list": (
        f"SELECT event_id AS hit_id, 0 AS pos, concat('Custom Event ', {_TYPE_ID}) AS event, CAST(NULL AS VARCHAR) AS value "
        "FROM events UNION ALL SELECT event_id, 1, 'Page Views', NULL FROM events UNION ALL "
        "SELECT event_id, 2, CASE WHEN event_id % 10 = 9 THEN NULL ELSE concat('Instance of eVar', event_id % 10 + 1) END, "
        "'x' FROM events"
    ),
    "feed_product_list": (
        f"SELECT hit_id, pos, p_type AS category, {_PRODUCT_NAME} AS name, "
        "CAST(CAST(trunc(l_quantity) AS INTEGER) AS VARCHAR) AS quantity, "
        f"{_MONEY.format('l_extendedprice')} AS price FROM ({_ITEMS})"
    ),
    "feed_post_product_list": (
        "SELECT hit_id, pos, CAST(NULL AS VARCHAR) AS category, p_name AS name, "
        "CAST(CAST(trunc(l_quantity) AS INTEGER) AS VARCHAR) AS quantity, "
        f"{_MONEY.format('l_extendedprice')} AS price FROM ({_ITEMS})"
    ),
    "feed_product_events_evars": (
        f"SELECT hit_id, pos, 'event' AS kind, 0 AS i, 'event1' AS key, {_MONEY.format('l_discount')} AS value FROM ({_ITEMS}) "
        f"UNION ALL SELECT hit_id, pos, 'event', 1, 'event2', {_MONEY.format('l_tax')} FROM ({_ITEMS}) "
        f"UNION ALL SELECT hit_id, pos, 'evar', 0, 'eVar1', l_returnflag FROM ({_ITEMS}) "
        f"UNION ALL SELECT hit_id, pos, 'evar', 1, 'eVar2', strftime(l_shipdate, '%Y-%m-%d') FROM ({_ITEMS})"
    ),
    "feed_tsv_escapes": (
        "SELECT doc_id AS hit_id, NULLIF(regexp_replace(regexp_replace("
        f"{_DOC_TEXT}, '^[\\x01-\\x08\\x0b\\x0c\\x0e-\\x20]+', ''), '[\\x01-\\x20]+$', ''), '') AS text FROM documents"
    ),
    "feed_metadata_fileset": (
        f"SELECT {_FILESET} AS fileset, CAST(CASE WHEN event_id % 2 = 0 THEN 1704153600 ELSE 1704240000 END AS BIGINT) AS modified_epoch, "
        "COUNT(*) AS n_hits FROM events GROUP BY 1, 2"
    ),
    "feed_schema_drift": (
        "SELECT event_id AS hit_id, CAST(user_id AS VARCHAR) AS visid, "
        "CASE WHEN event_id % 2 = 0 THEN concat('Agent/', user_id) END AS user_agent, props AS post_pagename, "
        f"{_EPOCH_SQL.format('ts')} AS last_hit, "
        f"{_EPOCH_SQL.format(_TRUNC_TS)} AS date_epoch FROM events"
    ),
    "feed_user_schema": (
        f"SELECT event_id AS hit_id, {_OS} AS os, CAST(NULL AS VARCHAR) AS not_in_feed, "
        f"{_EPOCH_SQL.format('ts')} AS last_hit_time_gmt, {_BROWSER_TYPE} AS browser_type FROM events"
    ),
    "feed_glob_filter": (
        f"SELECT event_id AS hit_id, {_BROWSER} AS browser, 'shop_2024-01-02' AS _tech_fileset "
        "FROM events WHERE event_id % 2 = 1"
    ),
    "feed_modified_after": (
        "SELECT 'shop_2024-01-02' AS fileset, COUNT(*) AS n_hits FROM events WHERE event_id % 2 = 1"
    ),
    "feed_multi_path": (
        f"SELECT {_FILESET} AS fileset, COUNT(*) AS n_hits FROM events GROUP BY 1 "
        "UNION ALL SELECT 'shop_2024-02-01', COUNT(*) FROM orders "
        "UNION ALL SELECT 'shop_2024-03-01', COUNT(*) FROM documents"
    ),
    "feed_manifest_parse": (
        f"SELECT {_FILESET} AS fileset, 1 AS n_lookup, "
        f"CAST(greatest({synth.FILES_PER_FILESET}, ceil(COUNT(*) / {synth.ROWS_PER_FILE}.0)) AS INTEGER) AS n_data, "
        "COUNT(*) AS total_records FROM events GROUP BY 1"
    ),
    "feed_manifest_roundtrip": _COUNT_BY_FILESET_OS,
    "feed_manifest_reconstruct": (
        "SELECT concat(lower(regexp_replace(n_name, '[^A-Za-z0-9]+', '_', 'g')), '_2024-04-01') AS fileset, "
        "CASE WHEN c_custkey % 5 = 4 THEN NULL ELSE concat('OS ', c_custkey % 5) END AS os, COUNT(*) AS n_hits "
        "FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_nationkey % 2 = 0 GROUP BY 1, 2"
    ),
    "feed_conform_incremental": _COUNT_BY_FILESET_OS,
    "feed_stream_ingest": _COUNT_BY_FILESET_OS,
    "feed_stream_ingest_filtered": f"SELECT * FROM ({_COUNT_BY_FILESET_OS}) WHERE fileset = '{synth.WEB_B}'",
    "feed_conform_drift": _LATE,
    "feed_path_forms": _COUNT_BY_FILESET_OS,
    "feed_lookup_late_file": f"SELECT hit_id, os FROM ({_LATE})",
    "feed_user_schema_drift": _LATE,
    "feed_mobile_all_fields": (
        "SELECT event_id AS hit_id, "
        + ", ".join(
            f"CASE WHEN user_id % 13 < {12 if i < 2 else 11} THEN concat('{f} ', user_id % 13) END AS \"{f}\""
            for i, f in enumerate(MOBILE_FIELDS)
        )
        + " FROM events"
    ),
    "feed_product_pairs": " UNION ALL ".join(
        f"SELECT p_partkey AS hit_id, {pos} AS pos, '{kind}' AS kind, {i} AS i, '{key}' AS key, {value} AS value FROM part"
        for pos, kind, i, key, value in [
            (0, "event", 0, "event1", "'1'"), (0, "event", 1, "event2", _PRODUCT_NAME),
            (0, "evar", 0, "eVar1", _PRODUCT_NAME), (0, "evar", 1, "eVar=2", "replace(p_type, ' ', '|')"),
            (1, "evar", 0, "e|Var3", "concat(replace(p_type, ' ', '|'), ';')"),
        ]
    ),
    "feed_metadata_prefix": _COUNT_BY_FILESET_OS,
}
ORACLES["feed_plain_and_bzip2"] = ORACLES["feed_tsv_escapes"]
ORACLES["feed_stream_dataframe"] = _COUNT_BY_FILESET_OS
ORACLES["feed_stream_simple_lookups"] = ORACLES["feed_simple_lookups"]
ORACLES["feed_stream_events"] = ORACLES["feed_event_list"]
ORACLES["feed_stream_texts"] = ORACLES["feed_tsv_escapes"]
ORACLES["feed_manifest_many_files"] = (
    f"SELECT concat('many_', event_id // {MANY_FILES}) AS fileset, concat(event_id, '-many.tsv.gz') AS file, md5(coalesce(props, '')) AS md5, "
    "CAST(user_id AS VARCHAR) AS size, event_id AS record_count FROM events"
)
_RULE_ROWS = (
    "SELECT CASE event_id % 6 WHEN 5 THEN NULL WHEN 4 THEN concat('#', event_id) WHEN 0 THEN concat('#', event_id) ELSE CAST(event_id AS VARCHAR) END AS hit_id, "
    "CASE WHEN event_id % 6 <> 5 THEN CAST(user_id AS VARCHAR) END AS user, CASE WHEN event_id % 6 NOT IN (3, 5) THEN event_type END AS kind FROM events"
)
ORACLES["feed_record_rules"] = f"{_RULE_ROWS} WHERE event_id % 6 <> 0"
ORACLES["feed_comments_kept"] = _RULE_ROWS
ORACLES["feed_encodings"] = ORACLES["feed_tsv_escapes"].replace("AS text FROM", "AS text, n_chars FROM").replace(
    _DOC_TEXT, f"regexp_replace({_DOC_TEXT}, '[^\\x00-\\x{{FF}}]', '?', 'g')"
)
ORACLES["feed_max_chars"] = ORACLES["feed_tsv_escapes"]
ORACLES["feed_reader_extension"] = ORACLES["feed_sql_view"] = _COUNT_BY_FILESET_OS
ORACLES["feed_filesets_option"] = ORACLES["feed_glob_filter"]


def entry(spark: SparkSession) -> DataFrame:
    return feed_hits_by_os(spark, SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = dict(QUERIES)
    if corpus_queries:
        found |= corpus_queries.QUERIES | {"pipeline": corpus_pipeline.run}
    return found


def oracle_sql() -> dict[str, str]:
    found = dict(ORACLES)
    if corpus_queries:
        found |= corpus_queries.ORACLES
        if corpus_pipeline.ORACLE_SQL:
            found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found
