"""The table that feeds are loaded into: parquet folders and a log of snapshots.

    <target>/data/<fileset>/<manifest>/__version=<id>/part-*.parquet
    <target>/_log/00000000000000000007.json      {"partitions": {manifest: folder, ..}}

A load writes every partition (one for each manifest) under a version of its own and only then
publishes one small snapshot file, which names the folder of every live partition.  The file gets
its name by one rename that fails if the name is taken, so of two loads at a time the later one
merges its partitions into the snapshot of the earlier.  A reader takes the newest snapshot: it sees
all partitions of a load or none, and never a partition that is being replaced.  A load that dies
leaves files that no snapshot names; :func:`vacuum` removes those, and versions that were replaced.

The log needs a file system whose rename is atomic and refuses an existing name (HDFS, local).
"""

from __future__ import annotations

import contextlib
import json
import time
import uuid
from collections.abc import Iterator

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hitloom import fs
from hitloom.functions import names

VERSION = "__version"
# Partitions that a task of a load keeps open at a time.  The hits of a file follow each other, so a task meets
# few partitions; Spark would sort all of its rows, every column of them, by partition, and sorts only those
# that come after this many.
OPEN_PARTITIONS = 8
_OPEN_CONF = "spark.sql.maxConcurrentOutputFileWriters"
LOG, DATA = "_log", "data"


def _snapshots(spark: SparkSession, target: str) -> list[int]:
    found = [p.rsplit("/", 1)[-1] for p in fs.glob(spark, f"{names.escape_glob(target)}/{LOG}/[0-9]*.json")]
    return sorted(int(n.removesuffix(".json")) for n in found)


def _log_file(target: str, number: int) -> str:
    return f"{target}/{LOG}/{number:020d}.json"


def partitions(spark: SparkSession, target: str, number: int | None = None) -> tuple[int, dict[str, str]]:
    """(number, folder of each live partition) of the newest snapshot, or of snapshot ``number``."""
    if number is None:
        known = _snapshots(spark, target)
        number = known[-1] if known else 0
    if not number:
        return 0, {}
    return number, json.loads(fs.read_bytes(spark, _log_file(target, number)))["partitions"]


def publish(spark: SparkSession, target: str, changes: dict[str, str | None], only_over: dict[str, str] | None = None) -> int:
    """Make ``changes`` (folder of a partition, or None: it has no rows) visible at once; the snapshot's number.

    With ``only_over``, a partition is changed only if it is still the folder named there."""
    while True:
        number, live = partitions(spark, target)
        wanted = {k: v for k, v in changes.items() if only_over is None or live.get(k) == only_over[k]}
        now = {k: v for k, v in (live | wanted).items() if v is not None}
        draft = f"{target}/{LOG}/.draft-{uuid.uuid4().hex}"
        fs.write_bytes(spark, draft, json.dumps({"partitions": now}).encode())
        try:
            fs.rename_new(spark, draft, _log_file(target, number + 1))
            return number + 1
        except Py4JJavaError as e:  # another load published meanwhile: merge into its snapshot
            fs.delete(spark, draft)
            if "FileAlreadyExists" not in str(e.java_exception.getClass().getName()):
                raise


@contextlib.contextmanager
def _open_partitions(spark: SparkSession) -> Iterator[None]:
    """Writes by partition without a sort, unless the session has a setting of its own."""
    if int(spark.conf.get(_OPEN_CONF, "0")) > 0:
        yield
        return
    spark.conf.set(_OPEN_CONF, str(OPEN_PARTITIONS))
    try:
        yield
    finally:
        spark.conf.unset(_OPEN_CONF)


def write_version(df: DataFrame, target: str, *partition_columns: str) -> dict[str, str]:
    """Write ``df`` under a new version, by partition; the last column names a partition.  Nothing is visible yet."""
    spark, version = df.sparkSession, uuid.uuid4().hex
    rows = df.withColumn(VERSION, F.lit(version))
    with _open_partitions(spark):
        rows.write.mode("append").partitionBy(*partition_columns, VERSION).parquet(f"{target}/{DATA}")
    depth = "/".join(["*"] * len(partition_columns))
    root = fs.qualify(spark, f"{target}/{DATA}")
    folders = fs.glob(spark, f"{names.escape_glob(root)}/{depth}/{VERSION}={version}")
    return {f.rsplit("/", 2)[-2].partition("=")[2]: f.removeprefix(root + "/") for f in folders}


def read(spark: SparkSession, target: str, number: int | None = None) -> DataFrame:
    """The table as its newest snapshot (or snapshot ``number``) has it."""
    _, live = partitions(spark, target, number)
    if not live:
        raise ValueError(f"nothing has been published in {target}")
    return _folders(spark, target, sorted(live.values()))


def _folders(spark: SparkSession, target: str, folders: list[str]) -> DataFrame:
    base = f"{target}/{DATA}"
    reader = spark.read.option("mergeSchema", "true").option("basePath", base)
    return reader.parquet(*[names.escape_glob(f"{base}/{f}") for f in folders]).drop(VERSION)


def compact(spark: SparkSession, target: str, *partition_columns: str, least_files: int = 8) -> int:
    """Rewrite partitions of ``least_files`` files or more with fewer, larger ones; how many were rewritten.

    Rows are rebalanced by partition (a large one stays spread); a partition that a load
    replaces meanwhile keeps what the load wrote."""
    _, live = partitions(spark, target)
    many = {k: v for k, v in live.items() if len(fs.glob(spark, f"{names.escape_glob(f'{target}/{DATA}/{v}')}/*.parquet")) >= least_files}
    if many:
        rows = _folders(spark, target, sorted(many.values()))
        written = write_version(rows.hint("rebalance", *[F.col(c) for c in partition_columns]), target, *partition_columns)
        publish(spark, target, {k: written.get(k) for k in many}, only_over=many)
    return len(many)


def vacuum(spark: SparkSession, target: str, older_than_hours: float = 24.0, levels: int = 2) -> int:
    """Delete versions that the newest snapshot does not name and that are older than the limit (readers of
    older snapshots, and loads under way, must be done by then); how many were deleted."""
    _, live = partitions(spark, target)
    root, limit = fs.qualify(spark, f"{target}/{DATA}"), (time.time() - older_than_hours * 3600) * 1000
    gone = 0
    for folder in fs.glob(spark, f"{names.escape_glob(root)}/{'/'.join(['*'] * levels)}/{VERSION}=*"):
        if folder.removeprefix(root + "/") not in live.values() and fs.modification_time(spark, folder) < limit:
            fs.delete(spark, folder)
            gone += 1
    return gone
