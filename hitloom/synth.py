"""Test feeds written from the driver's tables, with Spark.

The driver's tables hold no hit feed, so these functions write one: hit files
are ``DataFrame.write.text(compression="gzip")`` of escaped TSV lines built
from ``events``, ``orders``/``lineitem``/``part``, ``documents`` and
``customer``/``nation``; the lookup archives (a few kB, codes -> text by a
rule or from ``nation``) are assembled on the driver; manifests are written
with the manifest toolkit.  Queries then read the feed back through the
reader, while their SQL oracles compute the same answers straight from the
tables, so the two sides share no parsing code.

Every value that the oracles must reproduce is defined by a rule stated here.
"""

from __future__ import annotations

import io
import tarfile
import threading
from collections.abc import Callable, Iterator
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hitloom import fs
from hitloom.functions import names
from hitloom.operators.lookups import MOBILE_FIELDS
from hitloom.session import work_dir
from hitloom.sources import manifest_writer

SYNTH_VERSION = "v8"
# Hit files of a delivery: at least FILES_PER_FILESET, one for every ROWS_PER_FILE hits beyond.
FILES_PER_FILESET = 4
ROWS_PER_FILE = 500_000
# An order's line is several times as long as another hit's.
ORDERS_PER_FILE = 125_000

WEB_A = "shop_2024-01-01"
WEB_B = "shop_2024-01-02"
ORDERS_FS = "shop_2024-02-01"
DOCS_FS = "shop_2024-03-01"
LATE_A = "late_2024-05-01"
LATE_B = "late_2024-05-02"
PARTS_FS = "shop_2024-06-01"
RULES_FS = "rules_2024-08-01"
LATIN_FS = "latin_2024-09-01"
TABLES = ["events", "nation", "orders", "lineitem", "part", "documents", "customer"]
WEB_A_MTIME = "2024-01-02 00:00:00"
WEB_B_MTIME = "2024-01-03 00:00:00"

# Hit columns of the web feed: name -> rule over events (e) / customer.
WEB_HEADERS_A = [
    "hit_id", "date_time", "visid", "browser", "os", "carrier", "color", "connection_type", "country",
    "javascript", "language", "plugin", "resolution", "ref_type", "search_engine", "mobile_id",
    "event_list", "post_event_list", "last_hit_time_gmt", "user_agent", "post_pagename",
]
# The second delivery drifts: other column order, no user_agent, one extra column.
WEB_HEADERS_B = [
    "post_pagename", "hit_id", "visid", "date_time", "os", "browser", "carrier", "color", "connection_type",
    "country", "javascript", "language", "plugin", "resolution", "ref_type", "search_engine", "mobile_id",
    "post_event_list", "event_list", "last_hit_time_gmt", "extra_b",
]

# Lookup rules: entry -> (modulus of the code, codes left out, text rule).
# Text of code k is  prefix + k  unless stated; duplicates: browser key 0 is
# repeated at the end of the file with "Browser 0 (latest)".
LOOKUP_RULES = {
    "browser.tsv": (7, {6}, "Browser "),
    "browser_type.tsv": (7, set(), "Vendor "),  # text uses k % 3
    "operating_systems.tsv": (5, {4}, "OS "),
    "operating_system_type.tsv": (5, set(), "Type "),  # text uses k % 2
    "carrier.tsv": (4, set(), "Carrier "),
    "color_depth.tsv": (3, set(), "Depth "),
    "connection_type.tsv": (3, {2}, "Conn "),
    "javascript_version.tsv": (6, set(), "JS 1."),
    "languages.tsv": (11, set(), "Language "),
    "plugins.tsv": (2, set(), "Plugin "),
    "resolution.tsv": (9, set(), "Res "),
    "referrer_type.tsv": (6, set(), "Ref "),
    "search_engines.tsv": (8, {7}, "Engine "),
}
EVENT_TYPE_IDS = {"click": 1, "view": 2, "purchase": 3, "signup": 4, "error": 5}
MOBILE_KEYS = 12  # keys 0..11 present, mobile_id % 13 == 12 has no entry; key 11 is a short row


def _lookup_text(entry: str, k: int) -> str:
    prefix = LOOKUP_RULES[entry][2]
    if entry == "browser_type.tsv":
        return f"{prefix}{k % 3}"
    if entry == "operating_system_type.tsv":
        return f"{prefix}{k % 2}"
    return f"{prefix}{k}"


def escape_field(c: Column) -> Column:
    """Value -> escaped TSV field text (newline as backslash + LF)."""
    for src, dst in (("\\", "\\\\"), ("\t", "\\t"), ("\r", "\\r"), ("\n", "\\\n")):
        c = F.replace(c, F.lit(src), F.lit(dst))
    return F.coalesce(c, F.lit(""))


def escape_list_item(c: Column) -> Column:
    """Value -> product-list syntax (caret escapes)."""
    for src, dst in (("^", "^^"), (",", "^,"), (";", "^;"), ("|", "^|"), ("=", "^=")):
        c = F.replace(c, F.lit(src), F.lit(dst))
    return c


def _tsv_line(df: DataFrame, headers: list[str]) -> DataFrame:
    return df.select(F.concat_ws("\t", *[escape_field(F.col(h).cast("string")) for h in headers]).alias("value"))


def _tsv_bytes(rows: list[list[str | None]]) -> bytes:
    def esc(v):
        if v is None:
            return ""
        return v.replace("\\", "\\\\").replace("\t", "\\t").replace("\r", "\\r").replace("\n", "\\n")

    return ("".join("\t".join(esc(v) for v in r) + "\n" for r in rows)).encode("utf-8")


def _write_archive(spark: SparkSession, path: str, entries: dict[str, list[list[str | None]]]) -> None:
    buf = io.BytesIO()
    with tarfile.open(fileobj=buf, mode="w:gz") as tf:
        for name, rows in entries.items():
            data = _tsv_bytes(rows)
            info = tarfile.TarInfo(name)
            info.size = len(data)
            info.mtime = 1704067200
            tf.addfile(info, io.BytesIO(data))
    fs.write_bytes(spark, path, buf.getvalue())


def _web_lookups(spark: SparkSession, nation: DataFrame, headers: list[str]) -> dict[str, list[list[str | None]]]:
    entries: dict[str, list[list[str | None]]] = {"column_headers.tsv": [headers]}
    for entry, (mod, missing, _) in LOOKUP_RULES.items():
        rows = [[str(k), _lookup_text(entry, k)] for k in range(mod) if k not in missing]
        if entry == "browser.tsv":
            rows.append(["0", "Browser 0 (latest)"])
        entries[entry] = rows
    # country.tsv comes from the nation table (a bounded dimension).
    entries["country.tsv"] = [[str(r.n_nationkey), r.n_name] for r in nation.orderBy("n_nationkey").collect()]
    events = [[str(k), f"Custom Event {k}"] for k in range(1, 6)]
    events += [[str(k), f"Instance of eVar{k - 199}"] for k in range(200, 209)]
    events.append(["100", "Page Views"])
    entries["event.tsv"] = events
    mobile = []
    for k in range(MOBILE_KEYS):
        row = [str(k)] + [f"{f} {k}" for f in MOBILE_FIELDS]
        if k == 11:
            row = row[:3]
        mobile.append(row)
    entries["mobile_attributes.tsv"] = mobile
    return entries


def web_hits(events: DataFrame) -> DataFrame:
    """Hit columns from events (all as strings)."""
    e = events
    type_id = F.coalesce(*[F.when(F.col("event_type") == t, F.lit(i)) for t, i in EVENT_TYPE_IDS.items()])
    money = F.col("value").cast("decimal(18,2)").cast("string")
    return e.select(
        F.col("event_id").alias("hit_id"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("date_time"),
        F.col("user_id").alias("visid"),
        (F.col("user_id") % 7).alias("browser"),
        (F.col("user_id") % 5).alias("os"),
        (F.col("user_id") % 4).alias("carrier"),
        (F.col("user_id") % 3).alias("color"),
        (F.col("event_id") % 3).alias("connection_type"),
        (F.col("user_id") % 25).alias("country"),
        (F.col("user_id") % 6).alias("javascript"),
        (F.col("user_id") % 11).alias("language"),
        (F.col("user_id") % 2).alias("plugin"),
        (F.col("user_id") % 9).alias("resolution"),
        (F.col("event_id") % 6).alias("ref_type"),
        (F.col("event_id") % 8).alias("search_engine"),
        (F.col("user_id") % 13).alias("mobile_id"),
        F.concat(type_id.cast("string"), F.lit("="), money, F.lit(","), (F.lit(200) + F.col("user_id") % 10).cast("string")).alias("event_list"),
        F.concat(type_id.cast("string"), F.lit(",100,"), (F.lit(200) + F.col("event_id") % 10).cast("string"), F.lit("=x")).alias("post_event_list"),
        F.expr("timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)").alias("last_hit_time_gmt"),
        F.concat(F.lit("Agent/"), F.col("user_id").cast("string")).alias("user_agent"),
        F.col("props").alias("post_pagename"),
        F.concat(F.lit("b"), F.col("event_id").cast("string")).alias("extra_b"),
    )


def product_name(p_name: Column, p_partkey: Column) -> Column:
    """Part name with a list-syntax character in place of its spaces."""
    specials = [",", ";", "=", "|", "^"]
    k = p_partkey % 5
    out = p_name
    for i, ch in enumerate(specials):
        out = F.when(k == i, F.replace(p_name, F.lit(" "), F.lit(ch))).otherwise(out)
    return out


# Position of a product in its list: lineitems ordered by all their columns
# (line numbers repeat within an order).
ITEM_ORDER = [
    "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_shipdate",
]


def order_hits(orders: DataFrame, lineitem: DataFrame, part: DataFrame, n: int) -> DataFrame:
    """One hit per order; product_list / post_product_list from its lineitems.

    The lines cross as they are, once, into ``n`` partitions by order, and their texts are put together there."""
    p = part.select(
        "p_partkey", escape_list_item(F.col("p_type")).alias("type"),
        escape_list_item(product_name(F.col("p_name"), F.col("p_partkey"))).alias("name"),
        escape_list_item(F.col("p_name")).alias("post_name"),
    )
    li = lineitem.join(p, lineitem.l_partkey == p.p_partkey)
    li = li.select("l_orderkey", *ITEM_ORDER, "type", "name", "post_name").repartition(n, "l_orderkey")
    money = lambda c: F.col(c).cast("decimal(18,2)").cast("string")
    li = li.withColumns({"quantity": F.col("l_quantity").cast("int").cast("string"), "price": money("l_extendedprice")})
    # In a projection of their own: an aggregate evaluates its inputs without generated code.
    item = F.concat_ws(";", "type", "name", "quantity", "price")
    post_item = F.concat_ws(
        ";",
        F.lit(""),
        "post_name",
        "quantity",
        "price",
        F.concat(F.lit("event1="), money("l_discount"), F.lit("|event2="), money("l_tax")),
        F.concat(F.lit("eVar1="), F.col("l_returnflag"), F.lit("|eVar2="), F.date_format("l_shipdate", "yyyy-MM-dd")),
    )
    li = li.select("l_orderkey", *ITEM_ORDER, item.alias("item"), post_item.alias("post"))
    per_order = li.groupBy("l_orderkey").agg(F.sort_array(F.collect_list(F.struct(*ITEM_ORDER, "item", "post"))).alias("items"))
    orders = orders.select("o_orderkey", "o_custkey", "o_orderstatus").repartition(n, "o_orderkey")
    return orders.join(per_order, orders.o_orderkey == per_order.l_orderkey, "left").select(
        F.col("o_orderkey").alias("hit_id"),
        F.col("o_custkey").alias("visid"),
        F.array_join(F.transform("items", lambda s: s["item"]), ",").alias("product_list"),
        F.array_join(F.transform("items", lambda s: s["post"]), ",").alias("post_product_list"),
        F.col("o_orderstatus").alias("os"),
    )


ORDER_HEADERS = ["hit_id", "visid", "os", "product_list", "post_product_list"]
DOC_HEADERS = ["hit_id", "post_pagename", "visid"]


def doc_text(text: Column) -> Column:
    """Document text with a TAB, a CR and a backslash put in by rule."""
    t = F.replace(text, F.lit(". "), F.lit(".\t"))
    t = F.replace(t, F.lit("é"), F.lit("\\"))
    return F.replace(t, F.lit("è"), F.lit("\r"))


def doc_hits(documents: DataFrame) -> DataFrame:
    return documents.select(
        F.col("doc_id").alias("hit_id"), doc_text(F.col("text")).alias("post_pagename"), F.col("source").alias("visid")
    )


# A delivery without the os lookup, and a later one with it and a new column.
LATE_HEADERS_A = ["hit_id", "os"]
LATE_HEADERS_B = ["extra_b", "os", "hit_id"]
PART_HEADERS = ["hit_id", "product_list"]


def part_hits(part: DataFrame) -> DataFrame:
    """One hit per part: two products whose pairs hold list-syntax characters in keys and values."""
    name = escape_list_item(product_name(F.col("p_name"), F.col("p_partkey")))
    kind = escape_list_item(F.replace("p_type", F.lit(" "), F.lit("|")))
    first = F.concat(F.lit(";a;1;2.00;event1=1|event2="), name, F.lit(";eVar1="), name, F.lit("|eVar^=2="), kind)
    second = F.concat(F.lit("c;b;;;;e^|Var3="), kind, F.lit("^;"))
    return part.select(F.col("p_partkey").alias("hit_id"), F.concat_ws(",", first, second).alias("product_list"))


RULE_HEADERS = ["hit_id", "user", "kind"]
LATIN_HEADERS = ["hit_id", "größe", "post_pagename"]


def rule_lines(events: DataFrame) -> DataFrame:
    """One or two lines for each event, by ``event_id % 6``: a comment, a record after a blank line, one with
    fields beyond the header, a short one, one whose ``#`` is not its first character, one of empty fields."""
    e = events.select(F.col("event_id").cast("string").alias("id"), F.col("user_id").cast("string").alias("u"), F.col("event_type").alias("t"), "event_id")
    record = F.concat_ws("\t", "id", "u", "t")
    lines = (
        F.when(F.col("event_id") % 6 == 0, F.array(F.concat(F.lit("#"), record)))
        .when(F.col("event_id") % 6 == 1, F.array(F.when(F.col("event_id") % 4 == 1, "").otherwise("  "), record))
        .when(F.col("event_id") % 6 == 2, F.array(F.concat_ws("\t", record, F.lit("beyond"), F.lit("far beyond"))))
        .when(F.col("event_id") % 6 == 3, F.array(F.concat_ws("\t", "id", "u")))
        .when(F.col("event_id") % 6 == 4, F.array(F.concat(F.lit(" #"), record)))
        .otherwise(F.array(F.lit("\t\t")))
    )
    return e.select(F.posexplode(lines).alias("pos", "value"), "event_id")


def _write_rules(spark: SparkSession, sf_dir: str, folder: str) -> None:
    """Comments, blank lines, records of other lengths."""
    events = _table(spark, sf_dir, "events")
    _write_archive(spark, f"{folder}/{RULES_FS}{names.LOOKUP_SUFFIX}", {"column_headers.tsv": [RULE_HEADERS]})
    lines = rule_lines(events).repartition(_files(events), "event_id").sortWithinPartitions("event_id", "pos")
    lines.select("value").write.mode("overwrite").text(f"{folder}/hits", compression="gzip")
    _write_feed_manifest(spark, folder, RULES_FS, "hits", WEB_B_MTIME)


def latin_text(text: Column) -> Column:
    """Text that ISO-8859-1 can write."""
    return F.regexp_replace(text, r"[^\x00-\x{FF}]", "?")


def _write_latin(spark: SparkSession, sf_dir: str, folder: str) -> None:
    """Hit files and column names in ISO-8859-1."""
    documents = _table(spark, sf_dir, "documents")
    header = ("\t".join(LATIN_HEADERS) + "\n").encode("iso-8859-1")
    buf = io.BytesIO()
    with tarfile.open(fileobj=buf, mode="w:gz") as tf:
        info = tarfile.TarInfo("column_headers.tsv")
        info.size = len(header)
        tf.addfile(info, io.BytesIO(header))
    fs.write_bytes(spark, f"{folder}/{LATIN_FS}{names.LOOKUP_SUFFIX}", buf.getvalue())
    hits = documents.select(F.col("doc_id").alias("hit_id"), F.col("n_chars").alias("größe"), latin_text(doc_text(F.col("text"))).alias("post_pagename"))
    lines = _tsv_line(hits, LATIN_HEADERS).select(F.encode("value", "ISO-8859-1").cast("string").alias("value"))
    lines.repartition(_files(documents)).write.mode("overwrite").text(f"{folder}/hits", compression="gzip")
    _write_feed_manifest(spark, folder, LATIN_FS, "hits", WEB_B_MTIME)


def _files(hits: DataFrame, rows_per_file: int = ROWS_PER_FILE) -> int:
    return max(FILES_PER_FILESET, -(-hits.count() // rows_per_file))


def _write_lines(lines: DataFrame, target: str, compression: str = "gzip") -> None:
    """A hit file for each partition, its lines in order."""
    lines.sortWithinPartitions("value").write.mode("overwrite").text(target, compression=compression)


def _write_hits(df: DataFrame, target: str, headers: list[str], n_files: int, compression: str = "gzip") -> None:
    # By hash: dealing rows out in turn would first sort every map task's lines.
    _write_lines(_tsv_line(df, headers).repartition(n_files, "value"), target, compression)


def _data_files(spark: SparkSession, hits_dir: str) -> list[tuple[str, int]]:
    counts = (
        spark.read.text(hits_dir)
        .groupBy(F.col("_metadata.file_name").alias("name"))
        .agg(F.count(F.lit(1)).alias("n"))
        .collect()
    )
    return sorted((r.name, int(r.n)) for r in counts)


def _write_feed_manifest(
    spark: SparkSession, feed_dir: str, fileset: str, hits_rel: str, mtime: str | None
) -> None:
    files = [(f"{hits_rel}/{n}", c) for n, c in _data_files(spark, f"{feed_dir}/{hits_rel}")]
    _write_manifest(spark, feed_dir, fileset, f"{fileset}{names.LOOKUP_SUFFIX}", files, mtime)


def _write_manifest(
    spark: SparkSession, feed_dir: str, fileset: str, archive: str, files: list[tuple[str, int]], mtime: str | None
) -> None:
    rows = [([(archive, "", "")], [(n, "", "", c) for n, c in files])]
    df = spark.createDataFrame(
        rows, "lookup_files array<struct<path:string,md5:string,size:string>>, "
        "data_files array<struct<path:string,md5:string,size:string,record_count:bigint>>",
    )
    manifest_writer.write_manifests(df, feed_dir).collect()
    if mtime:
        ms = int(datetime.strptime(mtime, "%Y-%m-%d %H:%M:%S").replace(tzinfo=timezone.utc).timestamp() * 1000)
        fs.set_modification_time(spark, f"{feed_dir}/{fileset}.txt", ms)


def feed_root(spark: SparkSession, sf_dir: str) -> str:
    """The work folder of the feeds of these very tables: their paths, sizes and times are in its name."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load([f"{sf_dir}/{t}.parquet" for t in TABLES])
    (mark,) = files.agg(F.bit_xor(F.xxhash64("path", "length", "modificationTime"))).first()
    tag = sf_dir.rstrip("/").rsplit("/", 1)[-1]
    return work_dir(spark, "feeds", f"{tag}-{SYNTH_VERSION}-{mark & (2**64 - 1):016x}")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_LOCK = threading.Lock()


def ensure_feeds(spark: SparkSession, sf_dir: str, *feeds: str) -> str:
    """Write (once per work folder) these test feeds, all by default, for the tables in ``sf_dir``.

    Each feed has a mark of its own, so a query waits for the feeds that it reads and for no other."""
    root = feed_root(spark, sf_dir)
    for feed in feeds or FEEDS:
        for needed in (*NEEDS.get(feed, ()), feed):
            _ensure_feed(spark, sf_dir, root, needed)
    return root


def _ensure_feed(spark: SparkSession, sf_dir: str, root: str, feed: str) -> None:
    ready = f"{root}/_READY-{feed}"
    if fs.exists(spark, ready):
        return
    with _LOCK:
        if not fs.exists(spark, ready):
            FEEDS[feed](spark, sf_dir, f"{root}/{feed}")
            fs.write_bytes(spark, ready, b"ok")


def _web_deliveries(spark: SparkSession, sf_dir: str) -> Iterator[tuple[str, list[str], str, DataFrame]]:
    """(fileset, headers, time, hits) of the two deliveries of events: even ids, then odd ones with other headers."""
    hits = web_hits(_table(spark, sf_dir, "events"))
    for fileset, headers, parity, mtime in ((WEB_A, WEB_HEADERS_A, 0, WEB_A_MTIME), (WEB_B, WEB_HEADERS_B, 1, WEB_B_MTIME)):
        yield fileset, headers, mtime, hits.filter(F.col("hit_id") % 2 == parity)


def _write_web(spark: SparkSession, sf_dir: str, web: str) -> None:
    """Two deliveries of events, the second with drifted headers."""
    nation = _table(spark, sf_dir, "nation")
    for fileset, headers, mtime, mine in _web_deliveries(spark, sf_dir):
        _write_archive(spark, f"{web}/{fileset}{names.LOOKUP_SUFFIX}", _web_lookups(spark, nation, headers))
        _write_hits(mine, f"{web}/hits/{fileset}", headers, _files(mine))
        _write_feed_manifest(spark, web, fileset, f"hits/{fileset}", mtime)


def _write_forms(spark: SparkSession, sf_dir: str, forms: str) -> None:
    """Other manifests for the files of the web feed."""
    for fileset, _, mtime, _ in _web_deliveries(spark, sf_dir):
        _write_path_forms(spark, forms, forms.rsplit("/", 1)[0] + "/web", fileset, mtime)


def _write_late(spark: SparkSession, sf_dir: str, late: str) -> None:
    """The first delivery has no os lookup, the second has one and another column."""
    hits = web_hits(_table(spark, sf_dir, "events"))
    systems = {"operating_systems.tsv": _web_lookups(spark, _table(spark, sf_dir, "nation"), [])["operating_systems.tsv"]}
    for fileset, headers, parity, more in ((LATE_A, LATE_HEADERS_A, 0, {}), (LATE_B, LATE_HEADERS_B, 1, systems)):
        _write_archive(spark, f"{late}/{fileset}{names.LOOKUP_SUFFIX}", {"column_headers.tsv": [headers], **more})
        mine = hits.filter(F.col("hit_id") % 2 == parity)
        _write_hits(mine, f"{late}/hits/{fileset}", headers, _files(mine))
        _write_feed_manifest(spark, late, fileset, f"hits/{fileset}", WEB_B_MTIME if more else WEB_A_MTIME)


def _write_parts(spark: SparkSession, sf_dir: str, pp: str) -> None:
    """Pairs with escapes."""
    part = _table(spark, sf_dir, "part")
    _write_archive(spark, f"{pp}/{PARTS_FS}{names.LOOKUP_SUFFIX}", {"column_headers.tsv": [PART_HEADERS]})
    _write_hits(part_hits(part), f"{pp}/hits", PART_HEADERS, _files(part))
    _write_feed_manifest(spark, pp, PARTS_FS, "hits", WEB_B_MTIME)


def _write_orders(spark: SparkSession, sf_dir: str, od: str) -> None:
    """Product lists.  The orders and their items meet in the partitions that become the hit files."""
    orders, lineitem, part = (_table(spark, sf_dir, t) for t in ("orders", "lineitem", "part"))
    _write_archive(spark, f"{od}/{ORDERS_FS}{names.LOOKUP_SUFFIX}", {"column_headers.tsv": [ORDER_HEADERS]})
    hits = order_hits(orders, lineitem, part, _files(orders, ORDERS_PER_FILE))
    _write_lines(_tsv_line(hits, ORDER_HEADERS), f"{od}/hits")
    _write_feed_manifest(spark, od, ORDERS_FS, "hits", WEB_B_MTIME)


def _doc_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return doc_hits(_table(spark, sf_dir, "documents"))


def _write_docs(spark: SparkSession, sf_dir: str, dd: str) -> None:
    """Long texts with newlines, tabs, CRs and backslashes."""
    docs = _doc_hits(spark, sf_dir)
    _write_archive(spark, f"{dd}/{DOCS_FS}{names.LOOKUP_SUFFIX}", {"column_headers.tsv": [DOC_HEADERS]})
    _write_hits(docs, f"{dd}/hits", DOC_HEADERS, _files(docs))
    _write_feed_manifest(spark, dd, DOCS_FS, "hits", WEB_B_MTIME)


def _write_codecs(spark: SparkSession, sf_dir: str, cd: str) -> None:
    """The same texts in files that Spark splits, plain for even ids and bzip2 for odd ones."""
    docs, files = _doc_hits(spark, sf_dir), []
    _write_archive(spark, f"{cd}/{DOCS_FS}{names.LOOKUP_SUFFIX}", {"column_headers.tsv": [DOC_HEADERS]})
    for codec, parity in (("none", 0), ("bzip2", 1)):
        mine = docs.filter(F.col("hit_id") % 2 == parity)
        _write_hits(mine, f"{cd}/hits/{codec}", DOC_HEADERS, _files(mine), codec)
        files += [(f"hits/{codec}/{n}", c) for n, c in _data_files(spark, f"{cd}/hits/{codec}")]
    _write_manifest(spark, cd, DOCS_FS, f"{DOCS_FS}{names.LOOKUP_SUFFIX}", files, WEB_B_MTIME)


def _write_path_forms(spark: SparkSession, feed_dir: str, web: str, fileset: str, mtime: str) -> None:
    """A manifest in another folder that names the web feed's files relatively, with spare steps and slashes, and absolutely."""
    home = fs.qualify(spark, web)
    plain = "/" + home.removeprefix("file:").lstrip("/") if home.startswith("file:") else home
    before = ["../web/", "./../web//./", f"{home}/hits/../", f"{plain}//"]
    if home.startswith("file:"):
        before.append(f"file://{plain}/")
    files = [(f"{before[i % len(before)]}hits/{fileset}/{n}", c) for i, (n, c) in enumerate(_data_files(spark, f"{web}/hits/{fileset}"))]
    _write_manifest(spark, feed_dir, fileset, f"../web/./{fileset}{names.LOOKUP_SUFFIX}", files, mtime)


LOST_HEADERS = ["hit_id", "country", "os"]
LOST_PARTS = 3  # hit files of a nation, at least


def lost_fileset(n_name: Column) -> Column:
    return F.concat(F.lower(F.regexp_replace(n_name, r"[^A-Za-z0-9]+", "_")), F.lit("_2024-04-01"))


def _write_lost(spark: SparkSession, sf_dir: str, lost: str) -> None:
    """Hit files per nation, archives for even nation keys, no manifests."""
    customer, nation = _table(spark, sf_dir, "customer"), _table(spark, sf_dir, "nation")
    hits = customer.join(nation, customer.c_nationkey == nation.n_nationkey).select(
        F.col("c_custkey").alias("hit_id"), F.col("c_nationkey").alias("country"),
        (F.col("c_custkey") % 5).alias("os"), lost_fileset(F.col("n_name")).alias("fs"),
    )
    parts = max(LOST_PARTS, -(-customer.count() // ROWS_PER_FILE))
    line = F.concat_ws("\t", *[escape_field(F.col(h).cast("string")) for h in LOST_HEADERS])
    lines = hits.select("fs", (F.col("hit_id") % parts + 1).alias("part"), line.alias("value"))
    staging = f"{lost}/staging"
    lines.repartition("fs", "part").sortWithinPartitions("value").write.mode("overwrite").partitionBy("fs", "part").text(
        staging, compression="gzip"
    )
    for r in spark.read.format("binaryFile").load(staging).select("path", "fs", "part").collect():
        fs.rename(spark, r.path, f"{lost}/hits/{r.fs}/{int(r.part):02d}-{r.fs}{names.HIT_SUFFIX}")
    for r in nation.select("n_nationkey", lost_fileset(F.col("n_name")).alias("fs")).collect():
        if r.n_nationkey % 2 == 0:
            entries = {
                "column_headers.tsv": [LOST_HEADERS],
                "operating_systems.tsv": [[str(k), f"OS {k}"] for k in range(4)],
            }
            _write_archive(spark, f"{lost}/lookups/{r.fs}{names.LOOKUP_SUFFIX}", entries)


#: Feed -> its writer, which is given the tables' folder and the feed's own.
FEEDS: dict[str, Callable[[SparkSession, str, str], None]] = {
    "web": _write_web, "forms": _write_forms, "late": _write_late, "parts": _write_parts, "orders": _write_orders,
    "docs": _write_docs, "codecs": _write_codecs, "rules": _write_rules, "latin": _write_latin, "lost": _write_lost,
}
#: Feeds whose files another one names.
NEEDS = {"forms": ("web",)}
