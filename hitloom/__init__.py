"""hitloom: raw web-analytics hit feeds (manifests, lookup archives, escaped-TSV
hit files) read as Spark DataFrames."""

import sys

from pyspark.sql import SparkSession

from hitloom.options import FeedOptions
from hitloom.plans.reader import FeedReader, NoManifestError, build_feed, clear_plan_cache, datafeed
from hitloom.sources.manifest import read_manifests
from hitloom.sources.manifest_writer import reconstruct_manifests, write_manifests
from hitloom.streaming.ingest import conform, read_conformed, stream_ingest
from hitloom.streaming.reader import FeedStreamReader, datafeed_stream

__all__ = [
    "FeedOptions", "FeedReader", "FeedStreamReader", "NoManifestError", "build_feed", "clear_plan_cache", "conform", "datafeed",
    "datafeed_stream", "install", "read_conformed", "read_manifests", "reconstruct_manifests", "stream_ingest", "write_manifests",
]


FORMAT_NAMES = ("datafeed", "hitloom")


def install(spark: SparkSession | None = None) -> None:
    """Make the feed readers reachable from ``spark.read`` and ``spark.readStream``.

    Adds ``spark.read.datafeed(*paths)`` and ``spark.readStream.datafeed(path)``, and routes
    ``format("datafeed")...load(..)`` of both (options and a user schema included) to
    :class:`FeedReader` and :class:`FeedStreamReader`.  Other formats are untouched.
    With a session, SQL can name the feed there too: ``CREATE TEMPORARY VIEW .. USING datafeed OPTIONS (path '..')``.
    """
    if spark is not None:
        from hitloom.sources.named import NamedFeed

        spark.dataSource.register(NamedFeed)
    from pyspark.sql.readwriter import DataFrameReader
    from pyspark.sql.streaming.readwriter import DataStreamReader

    for kind, reader in ((DataFrameReader, FeedReader), (DataStreamReader, FeedStreamReader)):
        if not getattr(kind, "_hitloom_installed", False):
            _route(kind, reader)


def _route(kind: type, feed_reader: type) -> None:
    orig_format, orig_option, orig_options = kind.format, kind.option, kind.options
    orig_schema, orig_load = kind.schema, kind.load

    def state(self):
        if "_hitloom" not in self.__dict__:
            self.__dict__["_hitloom"] = {"on": False, "options": {}, "schema": None}
        return self.__dict__["_hitloom"]

    def fmt(self, source):
        state(self)["on"] = str(source).lower() in FORMAT_NAMES
        return self if state(self)["on"] else orig_format(self, source)

    def option(self, key, value):
        state(self)["options"][key] = value
        return orig_option(self, key, value)

    def options(self, **opts):
        state(self)["options"].update(opts)
        return orig_options(self, **opts)

    def schema(self, schema):
        state(self)["schema"] = schema
        return orig_schema(self, schema)

    def feed(self, schema=None, **opts):
        reader = feed_reader(self._spark).options(**state(self)["options"]).options(**opts)
        given = schema if schema is not None else state(self)["schema"]
        return reader if given is None else reader.schema(given)

    def load(self, path=None, format=None, schema=None, **opts):
        if format is not None:
            fmt(self, format)
        if not state(self)["on"]:
            return orig_load(self, path, format, schema, **opts)
        return feed(self, schema, **opts).load(*([path] if isinstance(path, str) else list(path or [])))

    def datafeed(self, *paths):
        return feed(self).load(*paths)

    kind.format, kind.option, kind.options, kind.schema, kind.load = fmt, option, options, schema, load
    kind.datafeed = datafeed
    kind._hitloom_installed = True


def _ship_by_value() -> None:
    """Executors need not have this package installed: the few functions that
    run inside tasks (mapInArrow bodies) are pickled by value."""
    try:
        from pyspark import cloudpickle

        cloudpickle.register_pickle_by_value(sys.modules[__name__])
    except Exception:  # pragma: no cover - older cloudpickle
        pass


_ship_by_value()
