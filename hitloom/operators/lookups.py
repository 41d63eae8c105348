"""Lookup enrichment: coded hit columns -> text, as left outer equi-joins.

Every lookup table is keyed by ``(version, key)``, where ``version`` is the
content digest of the lookup entry a hit's own manifest delivered (see
``sources.archive``).  Keys are de-duplicated with ``max_by(value, line_no)``
(the last row of the file wins), which makes the build side unique on the join
keys: Catalyst then drops a lookup join entirely when the query does not use
its column, so unused lookups cost nothing.

Small lookup files share one packed build side: however many of them a query
uses, it is read, aggregated and broadcast once.  A large file has a build side
of its own.  Each build side is broadcast only after its size has been measured against a
limit; above it the join is left to the planner (sort-merge, with AQE skew
handling), never broadcast blindly.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hitloom.sources.archive import EVENT, MOBILE_ATTRIBUTES


@dataclass(frozen=True)
class SimpleLookup:
    output: str  # output column
    key: str  # hit column holding the code
    entry: str  # lookup file inside the archive


# The simple lookups, in output-column order
# (output column, key column, lookup file).
SIMPLE_LOOKUPS = [
    SimpleLookup("browser", "browser", "browser.tsv"),
    SimpleLookup("browser_type", "browser", "browser_type.tsv"),
    SimpleLookup("carrier", "carrier", "carrier.tsv"),
    SimpleLookup("color", "color", "color_depth.tsv"),
    SimpleLookup("connection_type", "connection_type", "connection_type.tsv"),
    SimpleLookup("country", "country", "country.tsv"),
    SimpleLookup("javascript", "javascript", "javascript_version.tsv"),
    SimpleLookup("language", "language", "languages.tsv"),
    SimpleLookup("os", "os", "operating_systems.tsv"),
    SimpleLookup("os_type", "os", "operating_system_type.tsv"),
    SimpleLookup("plugin", "plugin", "plugins.tsv"),
    SimpleLookup("resolution", "resolution", "resolution.tsv"),
    SimpleLookup("ref_type", "ref_type", "referrer_type.tsv"),
    SimpleLookup("search_engine", "search_engine", "search_engines.tsv"),
]

# The fields of mobile_attributes.tsv after its key column
# mobile_id, in file order.
MOBILE_FIELDS = [
    "Manufacturer", "Device", "Device_Type", "Operating_System", "Diagonal_Screen_Size",
    "Screen_Height", "Screen_Width", "Cookie_Support", "Color_Depth", "MP3_Audio_Support",
    "AAC_Audio_Support", "AMR_Audio_Support", "Midi_Monophonic_Audio_Support",
    "Midi_Polyphonic_Audio_Support", "QCELP_Audio_Support", "GIF87_Image_Support",
    "GIF89a_Image_Support", "PNG_Image_Support", "JPG_Image_Support", "3GPP_Video_Support",
    "MPEG4_Video_Support", "3GPP2_Video_Support", "WMV_Video_Support",
    "MPEG4_Part_2_Video_Support", "Stream_MP4_AAC_LC_Video_Support",
    "Stream_3GP_H264_Level_10b_Video_Support", "Stream_3GP_AAC_LC_Video_Support",
    "3GP_AAC_LC_Video_Support", "Stream_MP4_H264_Level_11_Video_Support",
    "Stream_MP4_H264_Level_13_Video_Support", "Stream_3GP_H264_Level_12_Video_Support",
    "Stream_3GP_H264_Level_11_Video_Support", "Stream_3GP_H264_Level_10_Video_Support",
    "Stream_3GP_H264_Level_13_Video_Support", "3GP_AMR_NB_Video_Support",
    "3GP_AMR_WB_Video_Support", "MP4_H264_Level_11_Video_Support", "3GP_H263_Video_Support",
    "MP4_H264_Level_13_Video_Support", "Stream_3GP_H263_Video_Support",
    "Stream_3GP_AMR_WB_Video_Support", "3GP_H264_Level_10b_Video_Support",
    "MP4_ACC_LC_Video_Support", "Stream_3GP_AMR_NB_Video_Support",
    "3GP_H264_Level_10_Video_Support", "3GP_H264_Level_13_Video_Support",
    "3GP_H264_Level_11_Video_Support", "3GP_H264_Level_12_Video_Support",
    "Stream_HTTP_Live_Streaming_Video_Support",
]
MOBILE_KEY = "mobile_id"
MOBILE_TYPE = T.StructType([T.StructField(n, T.StringType()) for n in MOBILE_FIELDS])

EVENT_COLUMNS = ["event_list", "post_event_list"]
PRODUCT_COLUMNS = ["product_list", "post_product_list"]

# Event ids below this bound are looked up in a dense array (O(1) per item);
# larger or non-canonical ids go through a map.  Every key is covered.
DENSE_EVENT_ID_LIMIT = 1 << 16


# Lookup files of at most this estimated size (all versions) share one packed
# table, which in all holds at most PACKED_BYTES.
PACKED_ENTRY_BYTES = 1 << 20
PACKED_BYTES = 8 << 20


def packed_entries(entry_bytes: dict[str, int], limit: int) -> list[str]:
    """The simple lookup files that share a packed table, smallest first as
    long as the table stays within PACKED_BYTES and the broadcast ``limit``.
    Depends on the feed only, never on the columns of a query, so that every
    lookup of a query has the same build side."""
    packed, total = [], 0
    for size, entry in sorted((entry_bytes.get(r, -1), r) for r in {r.entry for r in SIMPLE_LOOKUPS}):
        if 0 <= size <= PACKED_ENTRY_BYTES and total + size <= min(PACKED_BYTES, limit):
            packed.append(entry)
            total += size
    return sorted(packed)


def packed_table(parsed: DataFrame, entries: list[str]) -> DataFrame:
    """``(version, key, value)`` of several lookup files in one table.

    A version is the digest of a file's content: files with equal content
    share their rows, and rows of different content never meet, so no column
    names the file.  All lookups of a query join this same table: Spark
    computes and broadcasts it once (exchange reuse)."""
    return _entry_rows(parsed, entries, "get(fields, 1)")


def _entry_rows(parsed: DataFrame, entries: list[str], value_sql: str) -> DataFrame:
    """``(version, key, value)`` rows of these lookup files, last row per key
    wins.  Written as SQL text: one expression per column instead of one
    py4j call per function (a load builds up to 16 of these)."""
    quoted = ", ".join("'" + e.replace("\\", "\\\\").replace("'", "\\'") + "'" for e in entries)
    return (
        parsed.where(f"entry IN ({quoted}) AND get(fields, 0) IS NOT NULL")
        .selectExpr("digest AS version", "get(fields, 0) AS key", f"{value_sql} AS value", "line_no")
        .groupBy("version", "key")
        .agg(F.expr("max_by(value, line_no)").alias("value"))
    )


def key_value_table(parsed: DataFrame, entry: str) -> DataFrame:
    """``(version, key, value)`` of one lookup file, last row per key wins."""
    return _entry_rows(parsed, [entry], "get(fields, 1)")


def mobile_table(parsed: DataFrame) -> DataFrame:
    """``(version, key, attrs struct<49 strings>)``; short rows get trailing nulls."""
    attrs = "named_struct(" + ", ".join(f"'{n}', get(fields, {i + 1})" for i, n in enumerate(MOBILE_FIELDS)) + ")"
    return _entry_rows(parsed, [MOBILE_ATTRIBUTES], attrs).withColumnRenamed("value", "attrs")


def event_names_table(parsed: DataFrame) -> DataFrame:
    """``(version, dense array<string>, sparse map<string,string>)`` per event.tsv version.

    ``dense[i]`` is the name of canonical id ``i`` (< DENSE_EVENT_ID_LIMIT);
    every other key is in ``sparse``.  Built with a join against the id range
    of each version, on the (small) lookup side only.
    """
    kv = key_value_table(parsed, EVENT)
    canonical = F.col("key").rlike(r"^(0|[1-9][0-9]{0,8})$")
    ids = kv.withColumn("id", F.when(canonical, F.col("key").try_cast("int")))
    in_dense = F.col("id").isNotNull() & (F.col("id") < DENSE_EVENT_ID_LIMIT)
    dense_rows = ids.filter(in_dense)
    ranges = dense_rows.groupBy("version").agg(F.max("id").alias("max_id"))
    slots = ranges.select("version", F.explode(F.sequence(F.lit(0), F.col("max_id"))).alias("id"))
    filled = slots.join(dense_rows.select("version", "id", "value"), ["version", "id"], "left")
    dense = filled.groupBy("version").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("id", "value"))), lambda s: s["value"]).alias("dense")
    )
    sparse = (
        ids.filter(~in_dense)
        .groupBy("version")
        .agg(F.map_from_entries(F.collect_list(F.struct("key", "value"))).alias("sparse"))
    )
    versions = kv.select("version").distinct()
    return versions.join(dense, "version", "left").join(sparse, "version", "left")


def maybe_broadcast(df: DataFrame, estimated_bytes: int, limit: int) -> DataFrame:
    return F.broadcast(df) if 0 <= estimated_bytes <= limit else df


def left_lookup(hits: DataFrame, table: DataFrame, on: dict[str, str], select: dict[str, Column]) -> DataFrame:
    """Left outer join of ``hits`` with a (version, key)-unique lookup table.

    ``on`` maps lookup-side column -> hits-side column; ``select`` names the
    lookup-side values to carry over.
    """
    right = table.select(*[F.col(k).alias(v) for k, v in on.items()], *[c.alias(n) for n, c in select.items()])
    return hits.join(right, list(on.values()), "left")
