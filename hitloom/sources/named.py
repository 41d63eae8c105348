"""The feed as a data source that SQL can name.

    hitloom.install(spark)
    CREATE TEMPORARY VIEW hits USING datafeed OPTIONS (path 's3://bucket/feed', pathGlobFilter 'x_*')
    CREATE TEMPORARY VIEW few (os STRING, hit_id STRING) USING datafeed OPTIONS (path '...')

Spark asks a source of this kind for Arrow batches in the columns of its schema, without the
columns that a query needs.  So the tasks do here what a stream's tasks do (read hit files,
join continued lines, look codes up) and build the nested columns too.  The columns given in a
view's definition are the ones that are looked up and built.  ``datafeed(spark)`` plans
the same feed as Catalyst expressions with pruning and is the faster way from Python.

Results are those of ``datafeed(spark).load(path)``: the first manifest gives the columns, and
columns of a view have the reader's types (cast them in the query).  Files are read through
``pyarrow.fs``.  ``modifiedBefore`` and ``modifiedAfter`` need ``timeZone``, as a source has no session.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import datetime, timezone
from zoneinfo import ZoneInfo

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from hitloom import fs
from hitloom.functions import names, nested
from hitloom.operators import lookups as L
from hitloom.options import MODIFIED_AFTER, MODIFIED_BEFORE, PATH_GLOB_FILTER, TIME_ZONE, FeedOptions
from hitloom.plans.reader import _output_columns
from hitloom.sources import archive, manifest
from hitloom.streaming.reader import Columns, Delivery, _is_data, decode_column, open_file, record_batches

#: Bytes of hit files (by their manifests) that one task reads, at least one file.
TASK_BYTES = 128 << 20
ROWS_AT_ONCE = 10_000


# ---------------------------------------------------------------- manifests

def resolve(directory: str, name: str) -> str:
    """A manifest's entry as a path, as ``names.resolve``."""
    home, own = re.match(names._ROOT, directory), re.match(names._ROOT, name)
    root, rest = home[0], name[own.end() :]
    if own[1] and not (own[1] == home[1] and own[2] in (None, "//")):
        root = own[1] + (own[2] if own[2] not in (None, "//") else "")
    elif not own[1] and not name.startswith("/"):
        rest = f"{directory[home.end():]}/{name}"
    steps: list[str] = []
    for step in rest.split("/"):
        if step == "..":
            del steps[-1:]
        elif step not in ("", "."):
            steps.append(step)
    return f"{root}/{'/'.join(steps)}"


def glob_regex(glob: str) -> re.Pattern:
    """A file-name glob (``* ? [..] {a,b}`` and backslash) as a pattern of whole names."""
    out, depth, at = "", 0, 0
    while at < len(glob):
        ch = glob[at]
        at += 1
        if ch == "\\" and at < len(glob):
            out += re.escape(glob[at])
            at += 1
        elif ch == "[" and "]" in glob[at:]:
            end = glob.index("]", at)
            inside = glob[at:end]
            out += "[" + ("^" + inside[1:] if inside[:1] in ("!", "^") else inside).replace("\\", "\\\\") + "]"
            at = end + 1
        elif ch == "{":
            out, depth = out + "(?:", depth + 1
        elif ch == "}" and depth:
            out, depth = out + ")", depth - 1
        elif ch == "," and depth:
            out += "|"
        else:
            out += {"*": "[^/]*", "?": "[^/]"}.get(ch, re.escape(ch))
    return re.compile(out)


@dataclass
class Manifest:
    path: str
    mtime: datetime
    archives: list[str]
    files: list[tuple[str, int]]  # (path, bytes)
    fileset: str


def read_manifests(path: str, options: FeedOptions) -> list[Manifest]:
    """The manifests of a folder (or a single one), by path."""
    import pyarrow.fs as pafs

    path = path.rstrip("/")
    if not re.match(names._ROOT, path)[1]:
        path = "file:" + path
    system, plain = fs._arrow_path(path)
    found = system.get_file_info(plain)
    if found.type == pafs.FileType.Directory:
        glob = glob_regex(options.get(PATH_GLOB_FILTER, "*"))
        infos = [
            i for i in system.get_file_info(pafs.FileSelector(plain))
            if i.is_file and i.base_name.endswith(names.MANIFEST_SUFFIX) and i.base_name[:1] not in "._" and glob.fullmatch(i.base_name)
        ]
        for key, after in ((MODIFIED_AFTER, True), (MODIFIED_BEFORE, False)):
            if options.get(key) is not None:
                if options.get(TIME_ZONE) is None:
                    raise ValueError(f"{key} needs the option {TIME_ZONE} here")
                moment = datetime.fromisoformat(options.get(key)).replace(tzinfo=ZoneInfo(options.get(TIME_ZONE)))
                infos = [i for i in infos if (i.mtime > moment if after else i.mtime < moment)]
        listed = [(f"{path}/{i.base_name}", i) for i in infos]
    elif found.is_file:
        listed = [(path, found)]
    else:
        raise ValueError(f"no folder or manifest at {path}")
    out = []
    for where, info in sorted(listed, key=lambda x: x[0]):
        with open_file(where, False) as f:
            text = re.sub("\r\n?", "\n", f.read().decode("utf-8", "replace"))
        home = re.sub(r"/+[^/]*/*$", "", where)
        archives = [resolve(home, name) for name, *_ in re.findall(manifest.LOOKUP_BLOCK, text)]
        files = [(resolve(home, name), int(size) if size.isdigit() else 0) for name, _, size, *_ in re.findall(manifest.DATA_BLOCK, text)]
        fileset = ""
        if archives:
            fileset = archives[0].rsplit("/", 1)[1].replace(names.LOOKUP_SUFFIX, "")
        elif files:
            base = files[0][0].rsplit("/", 1)[1]
            fileset = base[base.find("-") + 1 :].replace(names.HIT_SUFFIX, "")
        if options.filesets is None or fileset in options.filesets:
            mtime = info.mtime.astimezone(timezone.utc)
            mtime = mtime.replace(microsecond=mtime.microsecond // 1000 * 1000)  # as Spark's listing gives it
            out.append(Manifest(where, mtime, archives, files, fileset))
    return out


# ---------------------------------------------------------------- nested values

_SEPARATORS = {",": nested.ITEM_SEPARATOR, ";": nested.FIELD_SEPARATOR, "|": nested.PIPE_SEPARATOR, "=": nested.ASSIGNMENT_SEPARATOR}


def _unescape(text: str) -> str:
    for src, dst in nested.UNESCAPE_STEPS:
        text = text.replace(src, dst)
    return text


def _cut(text: str, sep: str, most: int = 0) -> list[str]:
    return re.split(_SEPARATORS[sep], text, maxsplit=most) if "^" in text else text.split(sep, most or -1)


def split_list(text: str, sep: str) -> list[str]:
    """The items of a list, as ``nested.split_list``: without empty ones at the end."""
    parts = _cut(text, sep)
    while text and parts and not parts[-1]:
        parts.pop()
    return parts


def _pairs(text: str) -> list[dict] | None:
    if not text:
        return None
    cuts = [[_unescape(x) for x in _cut(item, "=", 1)] for item in split_list(text, "|")]
    return [{"key": c[0], "value": c[1] if len(c) > 1 else None} for c in cuts]


def product(item: str) -> dict:
    parts = _cut(item, ";", nested.PRODUCT_FIELD_LIMIT - 1)
    plain = [_unescape(x) for x in parts[:4]] + [None] * 4
    return {
        "category": plain[0] or None, "name": plain[1], "quantity": plain[2] or None, "price": plain[3] or None,
        "events": _pairs(parts[4]) if len(parts) > 4 else None, "evars": _pairs(parts[5]) if len(parts) > 5 else None,
    }


def products(text: str | None) -> list[dict] | None:
    return None if text is None else [product(item) for item in split_list(text, ",")]


def events(text: str | None, known: list[str | None] | None) -> list[dict] | None:
    if text is None:
        return None
    cuts = [_cut(item, "=", 1) for item in split_list(text, ",")]
    return [{"event": name, "value": c[1] if len(c) > 1 else None} for name, c in zip([*(known or []), *[None] * len(cuts)], cuts)]


# ---------------------------------------------------------------- the source

_STRUCTS = {
    "events": T.ArrayType(nested.EVENT_TYPE), "products": T.ArrayType(nested.PRODUCT_TYPE), "meta_mtime": T.TimestampType(),
    "mobile": T.StructType([T.StructField(n, T.StringType()) for n in L.MOBILE_FIELDS]),
}


@dataclass
class HitFiles(InputPartition):
    """Hit files of one manifest for one task."""

    paths: list[str]
    archives: list[str]
    mtime: datetime
    fileset: str


class NamedFeedReader(DataSourceReader):
    def __init__(self, path: str, options: FeedOptions, schema: T.StructType):
        self.path, self.options, self.schema = path, options, schema
        wanted = [f.name for f in schema.fields]
        known = {r.entry for r in L.SIMPLE_LOOKUPS} | {archive.EVENT, archive.MOBILE_ATTRIBUTES}
        keys = [r.key for r in L.SIMPLE_LOOKUPS if r.output in wanted] + [L.MOBILE_KEY]
        kinds = _output_columns([*wanted, *keys], known, options)
        self.kinds = {n: kinds[n] for n in wanted}
        # A raw list has no dictionary to be parsed with.
        for f in schema.fields:
            if f.dataType == T.StringType() and self.kinds[f.name] == "events":
                self.kinds[f.name] = "raw"
            if f.dataType != _STRUCTS.get(self.kinds[f.name], T.StringType()):
                raise ValueError(f"column {f.name} has the type {_STRUCTS.get(self.kinds[f.name], T.StringType()).simpleString()}: cast it in the query")

    def partitions(self) -> list[HitFiles]:
        out = []
        for m in read_manifests(self.path, self.options):
            some, size = [], 0
            for path, length in m.files:
                if some and size + length > TASK_BYTES:
                    out.append(HitFiles(some, m.archives, m.mtime, m.fileset))
                    some, size = [], 0
                some.append(path)
                size += length
            if some:
                out.append(HitFiles(some, m.archives, m.mtime, m.fileset))
        return out

    def read(self, partition: HitFiles | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # no manifest has hit files
            return
        o, of = self.options, lambda kind: [n for n, k in self.kinds.items() if k == kind]
        physical = [n for n, k in self.kinds.items() if k not in ("meta_mtime", "meta_fileset", "mobile")]
        columns = Columns(physical, of("simple"), of("events"), bool(of("mobile")))
        delivery = Delivery(partition.archives, columns.entries, o.file_encoding, o.data_encoding, o.comment, o.lookup_limits)
        for path in partition.paths:
            for records in record_batches(path, o.data_encoding, o.join_continuation_lines):
                records = records.filter(_is_data(records, o.comment))
                for at in range(0, len(records), ROWS_AT_ONCE):
                    some = records[at : at + ROWS_AT_ONCE]
                    self._check_lengths(some)
                    yield self._built(columns.batch(some, delivery, partition.mtime, partition.fileset), physical)

    def _check_lengths(self, records: pa.Array) -> None:
        limit = self.options.max_chars_per_column
        if limit > 0:
            fields = pc.split_pattern(records, "\t").flatten()
            long = decode_column(fields.filter(pc.greater(pc.utf8_length(fields), limit)))
            if pc.any(pc.greater(pc.utf8_length(long), limit)).as_py():
                raise ValueError("field longer than maxCharsPerColumn")

    def _built(self, batch: pa.RecordBatch, physical: list[str]) -> pa.RecordBatch:
        """The columns of the schema from the columns of a task."""
        from pyspark.sql.pandas.types import to_arrow_type

        values = pc.split_pattern(batch.column("value"), "\t")
        flat, lengths = values.flatten(), pc.list_value_length(values)
        starts = pc.subtract(pc.cumulative_sum(lengths), lengths)
        off = set(batch.column("off")[0].as_py())

        def raw(name: str) -> pa.Array:
            at = physical.index(name)
            return decode_column(pc.take(flat, pc.if_else(pc.greater(lengths, at), pc.add(starts, at), pa.scalar(None, pa.int32()))))

        out = []
        for f in self.schema.fields:
            kind = self.kinds[f.name]
            if kind == "meta_mtime":
                out.append(batch.column("mtime"))
            elif kind == "meta_fileset":
                out.append(batch.column("fileset"))
            elif kind == "mobile":
                out.append(batch.column("mobile"))
            elif kind == "simple" and f.name not in off:
                out.append(batch.column(f"lk_{f.name}"))
            elif kind == "events":
                known = batch.column(f"ev_{f.name}").to_pylist()
                out.append(pa.array([events(t, n) for t, n in zip(raw(f.name).to_pylist(), known)], to_arrow_type(f.dataType)))
            elif kind == "products":
                out.append(pa.array([products(t) for t in raw(f.name).to_pylist()], to_arrow_type(f.dataType)))
            else:
                out.append(raw(f.name))
        return pa.RecordBatch.from_arrays(out, names=[f.name for f in self.schema.fields])


class NamedFeed(DataSource):
    """``USING datafeed OPTIONS (path '..', ..)`` with the options of the batch reader."""

    @classmethod
    def name(cls) -> str:
        return "datafeed"

    def _feed(self) -> tuple[str, FeedOptions]:
        options = FeedOptions(dict(self.options))
        if options.get("path") is None:
            raise ValueError("the option path is missing")
        if options.failfast:
            raise ValueError("a feed named in SQL is read in PERMISSIVE mode")
        return options.get("path"), options

    def schema(self) -> T.StructType:
        path, options = self._feed()
        found = read_manifests(path, options)
        if not found:
            raise ValueError(f"no manifest found in {path}: give the view its columns")
        delivery = Delivery(found[0].archives, set(), options.file_encoding, options.data_encoding, options.comment)
        kinds = _output_columns(delivery.headers, delivery.entries, options)
        return T.StructType([T.StructField(n, _STRUCTS.get(k, T.StringType())) for n, k in kinds.items()])

    def reader(self, schema: T.StructType) -> NamedFeedReader:
        return NamedFeedReader(*self._feed(), schema)
