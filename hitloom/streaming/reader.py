"""A feed as a streaming DataFrame of hits.

    spark.readStream of the manifests (Spark's file stream source, so the query's
        checkpoint knows which manifests it has read)
      -> parsed, one row per hit file, dealt over the tasks by file
      -> mapInArrow: each task reads its hit files batch by batch, joins continued lines,
         and looks the codes up in the archives of the file's own manifest
      -> the same column expressions as in a batch read

A stream has no set of lookup versions that could be joined: each manifest brings its own.
So the task that reads a hit file also opens its manifest's archives (a worker keeps the
last few) and maps whole Arrow batches of codes; fields, events, products and
user types stay Spark expressions.  Records of a manifest with other columns are put into the column
order of the stream, so all its columns read one position.  File names are shuffled; hits never are.

The columns of a stream are fixed when it starts: by the user's schema (which may come before
any manifest), or by the first manifest there is.  Only the columns that this schema names are
looked up and leave the task.  Hit files and archives are read through ``pyarrow.fs``.
"""

from __future__ import annotations

import sys
from collections import OrderedDict
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hitloom import fs
from hitloom.functions import names, nested, tsv
from hitloom.operators import lookups as L
from hitloom.operators.dictionary import KeyIndex, event_names
from hitloom.options import MODIFIED_AFTER, MODIFIED_BEFORE, PATH_GLOB_FILTER, TIME_ZONE, FeedOptions
from hitloom.plans.reader import _EPOCH, NoManifestError, _as_type, _cached_plan, _output_columns
from hitloom.sources import archive, hits, manifest

MAX_MANIFESTS_PER_TRIGGER = "maxManifestsPerTrigger"
#: Bytes of a hit file that are split into lines at a time.
BLOCK_BYTES = 4 << 20
#: Manifests whose lookup files a worker keeps.
KEPT_MANIFESTS = 4


# ---------------------------------------------------------------- inside the tasks

def open_file(path: str, decompress: bool):
    """A stream of the bytes of ``path``; hit files are decompressed by their extension."""
    import pyarrow.fs as pafs

    local = fs.local_or_uri(path)
    system, plain = pafs.FileSystem.from_uri(local) if "://" in local else (pafs.LocalFileSystem(), local)
    return system.open_input_stream(plain, compression="detect" if decompress else None)


def _decoded_text(field: str) -> str | None:
    """Raw field text -> value, as ``tsv.decode_field``."""
    field = field.lstrip(tsv.WHITESPACE)
    if "\\" in field:
        pieces = field.split("\\\\")
        for src, dst in tsv._ESCAPES:
            pieces = [p.replace(src, dst) for p in pieces]
        field = "\\".join(pieces)
    return field.rstrip(tsv.WHITESPACE) or None


def decode_column(raw: pa.Array) -> pa.Array:
    plain = pc.utf8_trim(raw, characters=tsv.WHITESPACE)
    if pc.any(pc.match_substring(raw, "\\")).as_py():
        return pa.array([None if v is None else _decoded_text(v) for v in raw.to_pylist()], pa.string())
    return pc.if_else(pc.equal(plain, ""), pa.scalar(None, pa.string()), plain)


class Delivery:
    """The lookup files of one manifest: headers, and (keys, rows) of each file asked for."""

    def __init__(
        self, archives: list[str], wanted: set[str], header_encoding: str, data_encoding: str, comment: str | None,
        limits: tuple[int, int] = archive.NO_LIMITS,
    ):
        self.headers: list[str] = []
        self.entries: set[str] = set()  # the names of all its files
        self.tables: dict[str, tuple[pa.Array, list[list[str | None]]]] = {}
        for path in archives:  # a later archive wins a whole file
            with open_file(path, False) as f:
                members = dict(archive._members(f.read()))
            self.entries |= members.keys()
            for name in (wanted | {archive.COLUMN_HEADERS}) & members.keys():
                text = members[name].decode(header_encoding if name == archive.COLUMN_HEADERS else data_encoding, "replace")
                rows = [
                    [_decoded_text(f) for f in line.split("\t")] for line in text.split("\n")
                    if (line.strip(tsv.WHITESPACE) or "\t" in line) and not (comment and line.startswith(comment))
                ]
                if name == archive.COLUMN_HEADERS:
                    self.headers = rows[0] if rows else []
                else:
                    chars, columns = (x if x > 0 else sys.maxsize for x in limits)
                    if any(len(r) > columns or any(f and len(f) > chars for f in r) for r in rows):
                        raise ValueError(archive.LIMIT_ERROR + name)
                    last = {r[0]: r for r in rows if r[0] is not None}  # the last row of a key wins
                    self.tables[name] = (pa.array(list(last), pa.string()), list(last.values()))
        if not self.headers:
            raise ValueError(f"no column_headers.tsv in {archives}")
        self._columns: dict[tuple[str, int], pa.Array] = {}
        self._indexes: dict[str, KeyIndex] = {}

    def places(self, entry: str, codes: pa.Array) -> pa.Array:
        return self.index(entry).places(codes)

    def index(self, entry: str) -> KeyIndex:
        if entry not in self._indexes:
            self._indexes[entry] = KeyIndex(self.tables[entry][0], self.column(entry, 1))
        return self._indexes[entry]

    def column(self, entry: str, i: int) -> pa.Array:
        """Column ``i`` of a lookup file; null where a row is too short."""
        if (entry, i) not in self._columns:
            self._columns[entry, i] = pa.array([r[i] if i < len(r) else None for r in self.tables[entry][1]], pa.string())
        return self._columns[entry, i]


def record_batches(path: str, encoding: str, join_lines: bool) -> Iterator[pa.Array]:
    """The records of one hit file, in order."""

    def lines() -> Iterator[list[str]]:
        with open_file(path, True) as f:
            rest = b""
            while block := f.read(BLOCK_BYTES):
                head, newline, tail = block.rpartition(b"\n")
                if newline:
                    yield (rest + head).decode(encoding, "replace").split("\n")
                    rest = tail
                else:
                    rest += block
            if rest:
                yield rest.decode(encoding, "replace").split("\n")

    def batches() -> Iterator[pa.RecordBatch]:
        for some in lines():
            zeros = pa.array([0] * len(some), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(some, pa.string()), pa.array([""] * len(some)), zeros, zeros, zeros],
                names=["value", "file_path", "block_start", "block_length", "file_size"],
            )

    found = hits.join_continuation_lines(batches()) if join_lines else batches()
    return (b.column("value") for b in found)


class Columns:
    """What a task gives for each hit: the record in the stream's column order and what its codes mean."""

    def __init__(self, physical: list[str], simple: list[str], events: list[str], mobile: bool):
        self.physical, self.events, self.mobile = physical, events, mobile
        self.simple = [r for r in L.SIMPLE_LOOKUPS if r.output in simple]
        self.entries = {r.entry for r in self.simple} | ({archive.EVENT} if events else set()) | ({archive.MOBILE_ATTRIBUTES} if mobile else set())
        self.schema = pa.schema(
            [("value", pa.string()), ("mtime", pa.timestamp("us", "UTC")), ("fileset", pa.string()), ("off", pa.list_(pa.string()))]
            + [(f"lk_{r.output}", pa.string()) for r in self.simple] + [(f"ev_{c}", pa.list_(pa.string())) for c in events]
            + ([("mobile", pa.struct([(n, pa.string()) for n in L.MOBILE_FIELDS]))] if mobile else [])
        )

    def ddl(self) -> str:
        mobile = ", ".join(f"`{n}`:string" for n in L.MOBILE_FIELDS)
        return ", ".join(
            ["value string, mtime timestamp, fileset string, off array<string>", *[f"`lk_{r.output}` string" for r in self.simple]]
            + [f"`ev_{c}` array<string>" for c in self.events] + ([f"mobile struct<{mobile}>"] if self.mobile else [])
        )

    def batch(self, records: pa.Array, delivery: Delivery, mtime, fileset: str | None) -> pa.RecordBatch:
        n, at = len(records), {h: i for i, h in reversed(list(enumerate(delivery.headers)))}
        fields = pc.split_pattern(records, "\t")
        flat, lengths = fields.flatten(), pc.list_value_length(fields)
        starts = pc.subtract(pc.cumulative_sum(lengths), lengths)

        def raw(name: str) -> pa.Array:
            if name not in at:
                return pa.nulls(n, pa.string())
            there = pc.greater(lengths, at[name])
            return pc.take(flat, pc.if_else(there, pc.add(starts, at[name]), pa.scalar(None, pa.int32())))

        codes = {key: decode_column(raw(key)) for key in {r.key for r in self.simple} | ({L.MOBILE_KEY} if self.mobile else set())}
        off, out = [], []
        for r in self.simple:
            if r.entry in delivery.tables and r.key in at:
                out.append(delivery.index(r.entry).look_up(codes[r.key]))
            else:  # this manifest keeps its raw column of that name
                off.append(r.output)
                out.append(pa.nulls(n, pa.string()))
        known = delivery.index(archive.EVENT) if archive.EVENT in delivery.tables else None
        out += [event_names(decode_column(raw(c)), known) for c in self.events]
        if self.mobile:
            kind = self.schema.field("mobile").type
            if archive.MOBILE_ATTRIBUTES in delivery.tables and L.MOBILE_KEY in at:
                place = delivery.places(archive.MOBILE_ATTRIBUTES, codes[L.MOBILE_KEY])
                parts = [pc.take(delivery.column(archive.MOBILE_ATTRIBUTES, i + 1), place) for i in range(len(L.MOBILE_FIELDS))]
                out.append(pa.StructArray.from_arrays(parts, fields=list(kind), mask=pc.is_null(place)))
            else:
                out.append(pa.nulls(n, kind))
        if self.physical != delivery.headers:
            records = pc.binary_join_element_wise(*[raw(c) for c in self.physical], "\t", null_handling="replace", null_replacement="")
        fixed = [records, pa.array([mtime] * n, self.schema.field("mtime").type), pa.array([fileset] * n, pa.string()), pa.array([off] * n, pa.list_(pa.string()))]
        return pa.RecordBatch.from_arrays([*fixed, *out], schema=self.schema)


def _is_data(records: pa.Array, comment: str | None) -> pa.Array:
    keep = pc.or_(pc.not_equal(pc.utf8_ltrim(records, characters=tsv.WHITESPACE), ""), pc.match_substring(records, "\t"))
    return pc.and_(keep, pc.invert(pc.starts_with(records, comment))) if comment else keep


def _expand(columns: Columns, header_encoding: str, data_encoding: str, join_lines: bool, comment: str | None, limits: tuple[int, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: OrderedDict[tuple, Delivery] = OrderedDict()
        for batch in batches:
            for row in batch.to_pylist():
                key = tuple(row["archives"])
                if key not in kept:
                    kept[key] = Delivery(list(key), columns.entries, header_encoding, data_encoding, comment, limits)
                    while len(kept) > KEPT_MANIFESTS:
                        kept.popitem(last=False)
                kept.move_to_end(key)
                for records in record_batches(row["data_path"], data_encoding, join_lines):
                    records = records.filter(_is_data(records, comment))
                    for at in range(0, len(records), 10_000):
                        yield columns.batch(records[at : at + 10_000], kept[key], row["mtime"], row["fileset"])

    return run


# ---------------------------------------------------------------- the plan

def stream_of_manifests(spark: SparkSession, path: str, options: FeedOptions, per_trigger: int) -> DataFrame:
    root = fs.qualify(spark, path).rstrip("/")
    reader = spark.readStream.format("binaryFile").schema(manifest.LISTING_SCHEMA).option("maxFilesPerTrigger", str(per_trigger))
    if options.get(PATH_GLOB_FILTER) is not None:
        reader = reader.option(PATH_GLOB_FILTER, options.get(PATH_GLOB_FILTER))
    found = reader.load(names.escape_glob(root) + "/*" + names.MANIFEST_SUFFIX)
    zone = options.get(TIME_ZONE, spark.conf.get("spark.sql.session.timeZone"))

    def moment(key: str) -> Column:
        return F.convert_timezone(F.lit(zone), F.current_timezone(), F.to_timestamp_ntz(F.lit(options.get(key)))).cast("timestamp")

    # The file stream has no time filters; the manifest's own time decides, as in a batch read.
    if options.get(MODIFIED_AFTER) is not None:
        found = found.filter(F.col("modificationTime") > moment(MODIFIED_AFTER))
    if options.get(MODIFIED_BEFORE) is not None:
        found = found.filter(F.col("modificationTime") < moment(MODIFIED_BEFORE))
    return found.select(F.lit(0).alias("path_index"), "path", F.col("modificationTime").alias("modification_time"), "length", "content")


def stream_feed(spark: SparkSession, path: str, options: FeedOptions, schema: T.StructType | None = None) -> DataFrame:
    """The hits of every manifest that arrives in ``path``, as a streaming DataFrame."""
    if options.failfast:
        raise ValueError("a stream reads in PERMISSIVE mode")
    if schema is not None:
        headers = [f.name for f in schema.fields]
        known = {r.entry for r in L.SIMPLE_LOOKUPS} | {archive.EVENT, archive.MOBILE_ATTRIBUTES}
        keys = [r.key for r in L.SIMPLE_LOOKUPS if r.output in headers] + [L.MOBILE_KEY]
        kinds = _output_columns([*headers, *keys], known, options)
        wanted = headers
        physical = [h for h in headers if kinds.get(h) not in (None, "meta_mtime", "meta_fileset", "mobile")]
    else:
        plan = _cached_plan(spark, [path], options, need_lookups=options.enable_lookups)
        if plan is None:
            raise NoManifestError(f"no manifest found in {path}: give a schema to start before the first one")
        kinds = _output_columns(plan.head_headers, plan.head_entries, options)
        wanted, physical = list(kinds), plan.head_headers
    used = {n: kinds[n] for n in wanted if n in kinds}
    of = lambda kind: [n for n, k in used.items() if k == kind]
    columns = Columns(physical, of("simple"), of("events"), "mobile" in used.values())

    manifests = stream_of_manifests(spark, path, options, int(options.get(MAX_MANIFESTS_PER_TRIGGER, "1000")))
    parsed = manifest.parse_manifests(manifests)
    if options.filesets is not None:
        parsed = parsed.filter(F.col("fileset").isin(options.filesets))
    files = parsed.select(
        F.explode("data_files").alias("file"), F.transform("lookup_files", lambda x: x["path"]).alias("archives"),
        F.col("modification_time").alias("mtime"), F.coalesce("fileset", F.lit("")).alias("fileset"),
    ).select(F.col("file.path").alias("data_path"), "archives", "mtime", "fileset")
    files = files.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "data_path")
    expand = _expand(columns, options.file_encoding, options.data_encoding, options.join_continuation_lines, options.comment, options.lookup_limits)
    df = files.mapInArrow(expand, columns.ddl()).withColumn("__f", tsv.split_fields(F.col("value")))
    if options.max_chars_per_column > 0:
        df = df.filter(tsv.within_limit(F.col("__f"), options.max_chars_per_column))

    def raw(name: str) -> Column:
        return F.expr(tsv.decode_field_sql(f"get(__f, {physical.index(name)})")) if name in physical else F.lit(None).cast("string")

    exprs: dict[str, Column] = {}
    for name, kind in used.items():
        if kind == "meta_mtime":
            exprs[name] = F.coalesce("mtime", F.lit(_EPOCH))  # never null, and known to be
        elif kind == "meta_fileset":
            exprs[name] = F.coalesce("fileset", F.lit(""))
        elif kind == "mobile":
            exprs[name] = F.col("mobile")
        elif kind == "simple":
            exprs[name] = F.when(F.array_contains("off", name), raw(name)).otherwise(F.col(f"`lk_{name}`"))
        elif kind == "events":
            exprs[name] = nested.parse_named_events(raw(name), F.col(f"`ev_{name}`"))
        elif kind == "products":
            exprs[name] = nested.parse_products(raw(name))
        else:
            exprs[name] = raw(name)
    if schema is None:
        return df.select(*[exprs[n].alias(n) for n in wanted])
    return df.select(*[_as_type(exprs.get(f.name), f.dataType, False).alias(f.name) for f in schema.fields])


class FeedStreamReader:
    """Builder in the style of ``spark.readStream``: the options of the batch reader, and
    ``maxManifestsPerTrigger`` (default 1000)."""

    def __init__(self, spark: SparkSession):
        self._spark = spark
        self._options: dict[str, str] = {}
        self._schema: T.StructType | None = None

    def option(self, key: str, value) -> "FeedStreamReader":
        self._options[key] = str(value).lower() if isinstance(value, bool) else str(value)
        return self

    def options(self, **opts) -> "FeedStreamReader":
        for k, v in opts.items():
            self.option(k, v)
        return self

    def schema(self, schema: T.StructType | str) -> "FeedStreamReader":
        self._schema = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
        return self

    def load(self, path: str) -> DataFrame:
        return stream_feed(self._spark, path, FeedOptions(self._options), self._schema)


def datafeed_stream(spark: SparkSession) -> FeedStreamReader:
    return FeedStreamReader(spark)
