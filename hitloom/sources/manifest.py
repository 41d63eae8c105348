"""Manifest discovery and parsing.

A feed path is either a directory of manifests (``*.txt``, not recursive) or a
single manifest file.  The listing is Spark's ``binaryFile`` source, so the
generic file options ``pathGlobFilter``, ``modifiedBefore``, ``modifiedAfter``
and ``timeZone`` filter manifests exactly as they filter any Spark file read.
Manifests are parsed with ``regexp_extract_all``, each group of the block patterns
once for the whole text: one three-line block per lookup archive and per hit file;
everything else in the text is ignored.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hitloom import fs
from hitloom.functions import names
from hitloom.options import FeedOptions

# The block layout of a manifest (multiline Java regexes).
LOOKUP_BLOCK = r"(?m)^Lookup-File: (.*?)\nMD5-Digest: (.*?)\nFile-Size: (.*?)$"
DATA_BLOCK = r"(?m)^Data-File: (.*?)\nMD5-Digest: (.*?)\nFile-Size: (.*?)(?:\nRecord-Count: (.*?))?$"

LOOKUP_FILE_TYPE = T.ArrayType(
    T.StructType([T.StructField(n, T.StringType()) for n in ("path", "md5", "size")])
)
DATA_FILE_TYPE = T.ArrayType(
    T.StructType(
        [T.StructField(n, T.StringType()) for n in ("path", "md5", "size")]
        + [T.StructField("record_count", T.LongType())]
    )
)
LISTING_SCHEMA = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("modificationTime", T.TimestampType()),
        T.StructField("length", T.LongType()),
        T.StructField("content", T.BinaryType()),
    ]
)


def _read_binary(spark: SparkSession, pattern: list[str], filters: dict[str, str]) -> DataFrame | None:
    try:
        return spark.read.format("binaryFile").options(**filters).load(pattern)
    except AnalysisException as e:  # glob matched nothing
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            return None
        raise


def list_manifests(spark: SparkSession, paths: list[str], options: FeedOptions) -> DataFrame:
    """``(path_index, path, modification_time, length, content)`` of every
    manifest; ``content`` is only read when selected."""
    parts = []
    columns = [F.col("path"), F.col("modificationTime").alias("modification_time"), F.col("length"), F.col("content")]
    files: list[tuple[int, str]] = []  # single manifests are taken as they are: no suffix test, no filters
    for index, p in enumerate(paths):
        root = fs.qualify(spark, p).rstrip("/")
        if fs.is_dir(spark, p):
            df = _read_binary(spark, [names.escape_glob(root) + "/*" + names.MANIFEST_SUFFIX], options.file_filters())
            if df is not None:
                df = df.filter(names.parent_dir(F.col("path")) == F.lit(root))
                parts.append(df.select(F.lit(index).alias("path_index"), *columns))
        else:
            files.append((index, root))
    if files:
        df = _read_binary(spark, sorted({names.escape_glob(f) for _, f in files}), {})
        if df is not None:
            order = spark.createDataFrame(files, "path_index int, path string")
            parts.append(df.select(*columns).join(F.broadcast(order), "path").select("path_index", "path", "modification_time", "length", "content"))
    if not parts:
        return spark.createDataFrame(
            [], "path_index int, path string, modification_time timestamp, length bigint, content binary"
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _blocks(text: Column, pattern: str, kind: T.ArrayType) -> Column:
    """The blocks that ``pattern`` matches, one array of each group zipped into one array of structs.

    Every group is extracted once for the whole text, so the work is linear in its length."""
    names_ = kind.elementType.names
    groups = [F.regexp_extract_all(text, F.lit(pattern), i + 1) for i in range(len(names_))]
    zipped = F.arrays_zip(*groups).cast(T.ArrayType(T.StructType([T.StructField(n, T.StringType()) for n in names_])))
    if kind.elementType == LOOKUP_FILE_TYPE.elementType:
        return zipped
    return F.transform(
        zipped, lambda x: x.withField("record_count", F.nullif(x["record_count"], F.lit("")).try_cast("bigint"))
    )


def parse_manifests(listing: DataFrame) -> DataFrame:
    """Listing -> one row per manifest with its lookup archives and hit files,
    names resolved against the manifest's directory."""
    text = F.regexp_replace(F.decode(F.col("content"), "UTF-8"), r"\r\n?", "\n")
    directory = names.parent_dir(F.col("path"))
    resolve = lambda arr: F.transform(arr, lambda s: s.withField("path", names.resolve(directory, s["path"])))
    # One step each, so that no step evaluates the text or its blocks more than once.
    texts = listing.withColumn("__text", text)
    blocks = texts.withColumns({
        "__lookups": _blocks(F.col("__text"), LOOKUP_BLOCK, LOOKUP_FILE_TYPE), "__datas": _blocks(F.col("__text"), DATA_BLOCK, DATA_FILE_TYPE),
    })
    out = blocks.select(
        F.xxhash64(F.col("path_index"), F.col("path")).alias("manifest_id"),
        F.col("path_index"),
        F.col("path").alias("manifest_path"),
        F.col("modification_time"),
        resolve(F.col("__lookups")).alias("lookup_files"),
        resolve(F.col("__datas")).alias("data_files"),
    )
    return out.withColumn(
        "fileset", names.manifest_fileset(F.get("lookup_files", 0)["path"], F.get("data_files", 0)["path"])
    )


def read_manifests(spark: SparkSession, paths: list[str], options: FeedOptions | None = None) -> DataFrame:
    """Manifest table of a feed (one row per manifest file found)."""
    return parse_manifests(list_manifests(spark, paths, options or FeedOptions()))


def manifest_entries(manifests: DataFrame) -> DataFrame:
    """One row per file named in a manifest: ``kind`` is 'lookup' or 'data'."""
    lk = manifests.select(
        "manifest_id", "manifest_path", F.lit("lookup").alias("kind"),
        F.posexplode(F.transform("lookup_files", lambda s: s.withField("record_count", F.lit(None).cast("bigint")))),
    )
    dt = manifests.select("manifest_id", "manifest_path", F.lit("data").alias("kind"), F.posexplode("data_files"))
    return lk.unionByName(dt).select(
        "manifest_id", "manifest_path", "kind", "pos",
        F.col("col.path").alias("path"), F.col("col.md5").alias("md5"), F.col("col.size").alias("size"),
        F.col("col.record_count").alias("record_count"),
    )


def listing_fingerprint(df: DataFrame, *cols: str) -> tuple[int, int]:
    """(count, xor of row hashes) of a file listing: changes when a file is
    added, removed, rewritten or touched.  Contents are not read."""
    r = df.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64(*cols)).alias("h")).first()
    return int(r.n), int(r.h or 0)
