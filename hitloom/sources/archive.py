"""Lookup archives (``*-lookup_data.tar.gz``) as DataFrames.

Read in two passes over ``binaryFile`` rows, each a ``mapInArrow`` that opens
the archive with ``tarfile`` inside the task:

1. ``index_archives``: ``(archive, entry, digest, size)`` per archive entry.
   Feeds deliver the same lookup file again and again (one archive per
   delivery); the content digest identifies a *version* of an entry.
2. ``archive_lines``: the lines of one representative archive per distinct
   ``(entry, digest)``, so each version is parsed once, however many
   manifests share it.  Every downstream lookup table is keyed by version,
   which keeps broadcast sizes proportional to distinct lookup content rather
   than to the number of deliveries.

Binary-file partitions are packed by ``spark.sql.files.maxPartitionBytes``,
so a task holds a bounded number of archives in memory.
"""

from __future__ import annotations

import hashlib
import io
import tarfile

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hitloom.functions import names, tsv

# Entry names inside a lookup archive.
COLUMN_HEADERS = "column_headers.tsv"
EVENT = "event.tsv"
MOBILE_ATTRIBUTES = "mobile_attributes.tsv"

NO_LIMITS = (-1, -1)
LIMIT_ERROR = "beyond lookupMaxCharsPerColumn or lookupMaxColumns: "

INDEX_SCHEMA = "archive string, member_no int, entry string, digest bigint, size bigint"
LINES_SCHEMA = "digest bigint, entry string, line_no bigint, line string"


def content_digest(data: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "big", signed=True)


def _members(content: bytes):
    with tarfile.open(fileobj=io.BytesIO(content), mode="r:*") as tf:
        for m in tf:
            if m.isfile():
                f = tf.extractfile(m)
                yield m.name, (f.read() if f is not None else b"")


def _index_batches(batches):
    schema = pa.schema(
        [("archive", pa.string()), ("member_no", pa.int32()), ("entry", pa.string()), ("digest", pa.int64()), ("size", pa.int64())]
    )
    for rb in batches:
        out = {"archive": [], "member_no": [], "entry": [], "digest": [], "size": []}
        paths = rb.column("path").to_pylist()
        contents = rb.column("content")
        for i, path in enumerate(paths):
            for member_no, (name, data) in enumerate(_members(contents[i].as_py())):
                out["archive"].append(path)
                out["member_no"].append(member_no)
                out["entry"].append(name)
                out["digest"].append(content_digest(data))
                out["size"].append(len(data))
        yield pa.RecordBatch.from_pydict(out, schema=schema)


def _lines_batches(header_encoding: str, data_encoding: str):
    schema = pa.schema([("digest", pa.int64()), ("entry", pa.string()), ("line_no", pa.int64()), ("line", pa.string())])

    def run(batches):
        for rb in batches:
            paths = rb.column("path").to_pylist()
            wanted = rb.column("wanted").to_pylist()
            contents = rb.column("content")
            for i, _ in enumerate(paths):
                want = {(w["entry"], w["digest"]) for w in (wanted[i] or [])}
                for name, data in _members(contents[i].as_py()):
                    d = content_digest(data)
                    if (name, d) not in want:
                        continue
                    want.discard((name, d))  # one copy per version
                    enc = header_encoding if name == COLUMN_HEADERS else data_encoding
                    lines = data.decode(enc, errors="replace").split("\n")
                    if lines and lines[-1] == "":
                        lines.pop()
                    n = len(lines)
                    yield pa.RecordBatch.from_pydict(
                        {"digest": [d] * n, "entry": [name] * n, "line_no": list(range(n)), "line": lines},
                        schema=schema,
                    )

    return run


def _binary(spark: SparkSession, paths: list[str]) -> DataFrame:
    return spark.read.format("binaryFile").load([names.escape_glob(p) for p in paths])


def index_archives(spark: SparkSession, archive_paths: list[str]) -> DataFrame:
    if not archive_paths:
        return spark.createDataFrame([], INDEX_SCHEMA)
    return _binary(spark, archive_paths).select("path", "content").mapInArrow(_index_batches, INDEX_SCHEMA)


def archive_lines(
    spark: SparkSession,
    index: DataFrame,
    entries: list[str] | None,
    header_encoding: str,
    data_encoding: str,
) -> DataFrame:
    """Lines of each distinct entry version (``entries`` limits which)."""
    idx = index if entries is None else index.filter(F.col("entry").isin(entries))
    reps = idx.groupBy("entry", "digest").agg(F.min("archive").alias("archive"))
    wanted = reps.groupBy("archive").agg(F.collect_set(F.struct("entry", "digest")).alias("wanted"))
    wanted_rows = wanted.collect()  # one row per archive holding a new version
    if not wanted_rows:
        return spark.createDataFrame([], LINES_SCHEMA)
    wanted_df = spark.createDataFrame(
        [(r.archive, [(w.entry, w.digest) for w in r.wanted]) for r in wanted_rows],
        "path string, wanted array<struct<entry:string,digest:bigint>>",
    )
    content = _binary(spark, [r.archive for r in wanted_rows]).select("path", "content")
    joined = content.join(F.broadcast(wanted_df), "path")
    return joined.mapInArrow(_lines_batches(header_encoding, data_encoding), LINES_SCHEMA)


def parsed_lines(lines: DataFrame, comment: str | None = tsv.COMMENT_CHAR, limits: tuple[int, int] = NO_LIMITS) -> DataFrame:
    """Lookup lines -> decoded field arrays (same TSV rules as hits, no line
    joining).  ``limits``: characters of a field and columns of a row in lookup files (not in
    the column headers) beyond which the load fails; not positive: no limit."""
    fields = F.transform(tsv.split_fields(F.col("line")), tsv.decode_field)
    max_chars, max_columns = limits
    too_big = F.lit(False)
    if max_chars > 0:
        too_big = too_big | F.exists("fields", lambda x: F.length(x) > max_chars)
    if max_columns > 0:
        too_big = too_big | (F.size("fields") > max_columns)
    found = lines.filter(tsv.is_data_record(F.col("line"), comment)).select("digest", "entry", "line_no", fields.alias("fields"))
    if limits == NO_LIMITS:
        return found
    error = F.raise_error(F.concat(F.lit(LIMIT_ERROR), F.col("entry"))).cast("array<string>")
    return found.withColumn("fields", F.when((F.col("entry") != COLUMN_HEADERS) & too_big, error).otherwise(F.col("fields")))
