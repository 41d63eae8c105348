"""Manifest toolkit: write manifests, rebuild lost ones from hit files.

The manifest text is built with column functions (one row per manifest) and
each file is written by the executor that holds its row, so writing many
manifests is a distributed job, not a driver loop.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hitloom import fs
from hitloom.functions import names
from hitloom.sources.manifest import DATA_FILE_TYPE, LOOKUP_FILE_TYPE

# Manifest layout.
MANIFEST_VERSION_LINE = "Datafeed-Manifest-Version: 1.0"


def manifest_text(lookup_files: Column, data_files: Column) -> Column:
    """Header lines (counts and total records) + one block per file; data
    blocks also carry ``Record-Count``."""
    total = F.aggregate(data_files, F.lit(0).cast("bigint"), lambda acc, d: acc + F.coalesce(d["record_count"], F.lit(1)))
    header = F.concat_ws(
        "\n",
        F.lit(MANIFEST_VERSION_LINE),
        F.concat(F.lit("Lookup-Files: "), F.size(lookup_files).cast("string")),
        F.concat(F.lit("Data-Files: "), F.size(data_files).cast("string")),
        F.concat(F.lit("Total-Records: "), total.cast("string")),
    )

    def block(kind: str, with_count: bool):
        def f(x: Column) -> Column:
            parts = [
                F.concat(F.lit(f"{kind}: "), x["path"]),
                F.concat(F.lit("MD5-Digest: "), F.coalesce(x["md5"], F.lit(""))),
                F.concat(F.lit("File-Size: "), F.coalesce(x["size"], F.lit(""))),
            ]
            if with_count:
                parts.append(F.concat(F.lit("Record-Count: "), F.coalesce(x["record_count"], F.lit(1)).cast("string")))
            return F.concat_ws("\n", *parts)

        return f

    blocks = F.concat(
        F.transform(lookup_files, block("Lookup-File", False)),
        F.transform(data_files, block("Data-File", True)),
    )
    return F.concat_ws("\n\n", header, F.array_join(blocks, "\n\n"))


def manifest_name(lookup_files: Column) -> Column:
    """``<fileset>.txt`` after the first lookup archive."""
    first = names.base_name(F.get(lookup_files, 0)["path"])
    return F.replace(first, F.lit(names.LOOKUP_SUFFIX), F.lit(names.MANIFEST_SUFFIX))


def _write_files(batches):
    import pyarrow.fs as pafs

    for rb in batches:
        paths = rb.column("target").to_pylist()
        texts = rb.column("text").to_pylist()
        written = []
        for path, text in zip(paths, texts):
            data = text.encode("utf-8")
            local = fs.local_or_uri(path)
            if "://" in local:
                filesystem, p = pafs.FileSystem.from_uri(local)
            else:
                filesystem, p = pafs.LocalFileSystem(), local
            filesystem.create_dir(p.rsplit("/", 1)[0], recursive=True)
            with filesystem.open_output_stream(p) as out:
                out.write(data)
            written.append(len(data))
        yield pa.RecordBatch.from_pydict(
            {"manifest_path": paths, "bytes": written},
            schema=pa.schema([("manifest_path", pa.string()), ("bytes", pa.int64())]),
        )


def write_manifests(manifests: DataFrame, folder: str) -> DataFrame:
    """Write one manifest per row (needs >= 1 lookup archive per row) into
    ``folder``; returns ``(manifest_path, bytes)`` of the files written.
    Two rows with the same target file are an error, as one would hide the other."""
    lookup_files = F.col("lookup_files").cast(LOOKUP_FILE_TYPE)
    data_files = F.col("data_files").cast(DATA_FILE_TYPE)
    rows = manifests.select(
        F.when(F.size(lookup_files) > 0, F.concat(F.lit(folder.rstrip("/") + "/"), manifest_name(lookup_files)))
        .otherwise(F.raise_error(F.lit("a manifest needs at least one lookup archive")))
        .alias("target"),
        manifest_text(lookup_files, data_files).alias("text"),
    )
    once = rows.groupBy("target").agg(F.count(F.lit(1)).alias("n"), F.min("text").alias("text")).select(
        F.when(F.col("n") == 1, F.col("target"))
        .otherwise(F.raise_error(F.concat(F.lit("several manifests would be written to "), F.col("target"))))
        .alias("target"),
        "text",
    )
    return once.mapInArrow(_write_files, "manifest_path string, bytes bigint")


def reconstruct_manifests(spark: SparkSession, hit_dir: str, lookup_dir: str) -> DataFrame:
    """Rebuild manifests for hit files whose manifest is lost.

    Both folders are listed recursively (``*.tsv.gz`` hit files,
    ``*-lookup_data.tar.gz`` archives, contents not read), paired by fileset
    with an inner join; one manifest per fileset with all its hit files in path
    order, md5 and size left empty, modification time = now.  Only a leading
    ``NN-`` part number is stripped from a hit-file name to get its fileset.
    """

    def listing(path: str, glob: str) -> DataFrame:
        return (
            spark.read.format("binaryFile")
            .option("recursiveFileLookup", "true")
            .option("pathGlobFilter", glob)
            .load(names.escape_glob(fs.qualify(spark, path)))
            .select("path")
        )

    hit_files = listing(hit_dir, "*" + names.HIT_SUFFIX).select(
        F.col("path").alias("data_path"), names.reconstruct_key(F.col("path")).alias("fileset")
    )
    archives = (
        listing(lookup_dir, "*" + names.LOOKUP_SUFFIX)
        .select(names.lookup_fileset(F.col("path")).alias("fileset"), F.col("path").alias("lookup_path"))
        .groupBy("fileset")
        .agg(F.max("lookup_path").alias("lookup_path"))
    )
    empty = F.lit("")
    parts = hit_files.groupBy("fileset").agg(F.sort_array(F.collect_list("data_path")).alias("data_paths"))
    return parts.join(archives, "fileset").select(
        "fileset",
        F.array(F.struct(F.col("lookup_path").alias("path"), empty.alias("md5"), empty.alias("size"))).alias("lookup_files"),
        F.transform(
            "data_paths",
            lambda p: F.struct(
                p.alias("path"), empty.alias("md5"), empty.alias("size"), F.lit(None).cast("bigint").alias("record_count")
            ),
        ).alias("data_files"),
        F.current_timestamp().alias("modification_time"),
    )
