"""Loading feeds into a columnar table, in batches or as a stream.

``conform``: one read of a feed written to parquet, partitioned by fileset and
manifest, and published by one atomic step (see ``table``): reloading a manifest replaces
exactly its partition (idempotent; a retried or repeated batch never duplicates
rows, and manifests that share a fileset never replace each other), and a reader sees the
old rows or the new ones.  The table has the columns of all manifests, so it does not
depend on how they were batched.

``stream_ingest``: Structured Streaming over the manifest folder (a
``binaryFile`` file stream of ``*.txt`` with the file filters); each micro-batch reads exactly the
manifests that arrived, and conforms them.  The stream's checkpoint replaces a
hand-kept "modified after" timestamp.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from hitloom import fs
from hitloom.options import FILE_FILTER_OPTIONS, FeedOptions
from hitloom.plans.reader import NoManifestError, build_feed
from hitloom.sources import manifest
from hitloom.streaming import table
from hitloom.streaming.reader import stream_of_manifests


def _conform(spark: SparkSession, paths: list[str], target: str, options: FeedOptions) -> None:
    prefix = options.metadata_prefix
    listed = manifest.read_manifests(spark, paths, options)
    if options.filesets is not None:
        listed = listed.filter(F.col("fileset").isin(options.filesets))
    # The manifests of this load: what is read, and the partitions that it replaces.
    rows = listed.select("path_index", "manifest_path", F.xxhash64("manifest_path").cast("string").alias("key")).collect()
    if not rows:
        if not manifest.read_manifests(spark, paths, options).take(1):
            raise NoManifestError(f"no manifest found in {paths}")
        return
    chosen = [r.manifest_path for r in sorted(rows, key=lambda r: (r.path_index, r.manifest_path))]
    df = build_feed(spark, chosen, options, every_column=True)
    keys = [c for c in (prefix + "fileset", prefix + "manifest") if c in df.columns]
    written = table.write_version(df, target, *keys)
    table.publish(spark, target, {r.key: written.get(r.key) for r in rows})


def conform(spark: SparkSession, paths: list[str], target: str, **options) -> None:
    """Read a feed (any reader options, e.g. ``modifiedAfter``) into ``target``."""
    _conform(spark, paths, target, FeedOptions(options))


def stream_ingest(
    spark: SparkSession,
    feed_dir: str,
    target: str,
    checkpoint: str,
    available_now: bool = True,
    max_manifests_per_batch: int = 1000,
    interval: str = "1 minute",
    **options,
) -> StreamingQuery:
    """Start a stream that conforms every new manifest of ``feed_dir`` (any reader
    options; the file filters choose manifests as they do in ``conform``), until all
    are read or every ``interval``."""
    opts = FeedOptions(options)
    manifests = stream_of_manifests(spark, feed_dir, opts, max_manifests_per_batch).select("path")
    # The stream has filtered the manifests: their paths are read as they are.
    reading = FeedOptions({k: v for k, v in opts.raw.items() if k not in {o.lower() for o in FILE_FILTER_OPTIONS}})

    def handle(batch: DataFrame, batch_id: int) -> None:
        # At most max_manifests_per_batch paths: the file list of this batch.  One that is gone by now has no hits to load.
        paths = sorted(r.path for r in batch.select("path").distinct().collect())
        paths = [p for p in paths if fs.exists(spark, p)]
        if paths:
            _conform(spark, paths, target, reading)

    writer = manifests.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    return writer.start()


def read_conformed(spark: SparkSession, target: str) -> DataFrame:
    """The newest published state of the table."""
    return table.read(spark, target)


__all__ = ["conform", "stream_ingest", "read_conformed"]
