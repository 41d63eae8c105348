"""Feed reader: manifests + lookup archives + hit files -> one DataFrame.

``FeedReader(spark).option(..).schema(..).load(*paths)`` builds a lazy plan:

    text scan of every hit file (one task per gzip file)
      -> continuation-line join (sources.hits)
      -> broadcast joins: hash(file path) -> manifest id -> manifest
         attributes (header signature, lookup versions, mtime, fileset)
      -> split into fields; every output column picks its field by the
         manifest's position vector (schema drift is an index, not a union)
      -> left joins with the lookup tables (operators.lookups)

Small driver-side work happens at ``load()`` time: the manifest table, the
archive index, the decoded lookup lines (parquet, partitioned by entry) and
the distinct header rows are computed (they decide the schema and the join
strategy), and the list of hit files is handed to the text source, as any
file read does.  These results are reused for a repeated load of an
unchanged feed.  Nothing proportional to the number of hits reaches the
driver and hits are never shuffled.
"""

from __future__ import annotations

import bisect
import datetime
import json
import uuid
from collections import OrderedDict
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hitloom.functions import names, nested, tsv
from hitloom.operators import dictionary
from hitloom.operators import lookups as L
from hitloom.options import FeedOptions
from hitloom.sources import archive, hits, manifest
from hitloom.session import ensure_checkpoint_dir, work_dir

# Estimated bytes per row of a broadcast table, on top of its string payload.
_ROW_OVERHEAD = 64


_EPOCH = datetime.datetime(1970, 1, 1, tzinfo=datetime.timezone.utc)


class NoManifestError(ValueError):
    pass


@dataclass
class _Plan:
    """Driver-side facts about a feed that decide schema and join strategy."""

    archive_paths: list[str]
    manifests: DataFrame
    head_entries: set[str]
    all_entries: set[str]
    head_headers: list[str]
    layout: "_Layout"
    versions: DataFrame  # (manifest_id, entry, version)
    manifest_sig: DataFrame  # (manifest_id, sig)
    parsed: DataFrame | None  # parsed lookup lines (checkpointed)
    entry_bytes: dict[str, int]
    entry_versions: dict[str, int] = field(default_factory=dict)  # distinct versions per lookup file
    attrs: dict[tuple[str, ...], DataFrame] = field(default_factory=dict)  # frozen tables per lookup set
    extras: dict[str, object] = field(default_factory=dict)  # other per-plan constants


# Where a record of more than CUT_ABOVE fields is cut into runs: the first 16 fields, the next 48, and so on.
CUT_ABOVE = 64
_CUTS = (0, 16, 64, 256)


class _Layout:
    """Where each physical column stands under each header signature.

    A column that stands at one place under all signatures is read there.  The others have an
    entry in the position vector, an array that each manifest carries with its attributes, so
    the size of a plan does not depend on the number of signatures."""

    def __init__(self, signatures: list[list[str]]):
        self.signatures = signatures
        places = [{h: i for i, h in reversed(list(enumerate(headers)))} for headers in signatures]
        self.columns = list(OrderedDict.fromkeys(h for headers in signatures for h in headers))
        self.fixed = {h: places[0][h] for h in self.columns if h in places[0] and all(p.get(h) == places[0][h] for p in places)}
        drifting = [h for h in self.columns if h not in self.fixed]
        self.drifting = {h: i for i, h in enumerate(drifting)}
        self.vectors = [[p.get(h) for h in drifting] for p in places]
        # Narrow records are split once, as a whole: cutting them costs more than it saves.
        self.cut = max(map(len, signatures)) > CUT_ABOVE

    def table(self, spark: SparkSession) -> DataFrame:
        """(__sig, __vec, __width): one row for each signature."""
        rows = [(i, v, len(h)) for i, (v, h) in enumerate(zip(self.vectors, self.signatures))]
        return spark.createDataFrame(rows, "__sig int, __vec array<int>, __width int")

    def place(self, name: str) -> str | None:
        """SQL for the place of a column in a hit's record; null where its manifest lacks it."""
        if name in self.fixed:
            return str(self.fixed[name])
        return f"get(__vec, {self.drifting[name]})" if name in self.drifting else None


def _safe(entry: str) -> str:
    return "".join(ch if ch.isalnum() else "_" for ch in entry)


def _version_col(entry: str) -> str:
    return "__v_" + _safe(entry)


class FeedReader:
    """Builder in the style of ``spark.read``."""

    def __init__(self, spark: SparkSession):
        self._spark = spark
        self._options: dict[str, str] = {}
        self._schema: T.StructType | None = None

    def option(self, key: str, value) -> "FeedReader":
        # Spark passes option values as strings; booleans as "true"/"false".
        self._options[key] = str(value).lower() if isinstance(value, bool) else str(value)
        return self

    def options(self, **opts) -> "FeedReader":
        for k, v in opts.items():
            self.option(k, v)
        return self

    def schema(self, schema: T.StructType | str) -> "FeedReader":
        self._schema = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
        return self

    def load(self, *paths: str) -> DataFrame:
        flat: list[str] = []
        for p in paths:
            flat.extend([p] if isinstance(p, str) else list(p))
        if not flat:
            raise ValueError("load() needs at least one path")
        return build_feed(self._spark, flat, FeedOptions(self._options), self._schema)


def datafeed(spark: SparkSession) -> FeedReader:
    return FeedReader(spark)


def _stable(spark: SparkSession, df: DataFrame) -> DataFrame:
    """Freeze a small driver-decided table with a reliable checkpoint in the
    cluster's checkpoint folder: lineage is cut, and a lost executor never
    changes which manifests, lookup versions or files a query sees."""
    ensure_checkpoint_dir(spark)
    return df.checkpoint(eager=True)


def _stable_by_entry(spark: SparkSession, df: DataFrame) -> DataFrame:
    """Parsed lookup lines as parquet partitioned by lookup file, in the shared
    work folder: every lookup build side then reads only its own partition
    (partition pruning), instead of scanning all lookup content."""
    path = work_dir(spark, "lookup-lines", uuid.uuid4().hex)
    df.write.partitionBy("entry").parquet(path)
    return spark.read.parquet(path)


# Planning results per application, keyed by the load arguments and a
# fingerprint of the manifest listing, and checked against a fingerprint of
# the lookup archives: repeated loads of an unchanged feed skip the metadata
# jobs; a new, re-delivered or touched manifest or archive plans afresh.
_PLAN_CACHE: "OrderedDict[tuple, tuple[tuple[int, int], _Plan]]" = OrderedDict()
_PLAN_CACHE_SIZE = 16


def _archive_fingerprint(spark: SparkSession, archive_paths: list[str]) -> tuple[int, int]:
    if not archive_paths:
        return (0, 0)
    listing = spark.read.format("binaryFile").load([names.escape_glob(x) for x in archive_paths])
    return manifest.listing_fingerprint(listing, "path", "modificationTime", "length")


def _cached_plan(spark: SparkSession, paths: list[str], options: FeedOptions, need_lookups: bool) -> _Plan | None:
    listing = manifest.list_manifests(spark, paths, options)
    fp = manifest.listing_fingerprint(listing, "path_index", "path", "modification_time", "length")
    key = (spark.sparkContext.applicationId, tuple(paths), tuple(sorted(options.raw.items())), need_lookups, fp)
    hit = _PLAN_CACHE.get(key)
    if hit is not None and _archive_fingerprint(spark, hit[1].archive_paths) == hit[0]:
        _PLAN_CACHE.move_to_end(key)
        return hit[1]
    plan = _plan(spark, listing, options, need_lookups)
    if plan is not None:
        _PLAN_CACHE[key] = (_archive_fingerprint(spark, plan.archive_paths), plan)
        while len(_PLAN_CACHE) > _PLAN_CACHE_SIZE:
            _PLAN_CACHE.popitem(last=False)
    return plan


def clear_plan_cache() -> None:
    _PLAN_CACHE.clear()


def _plan(spark: SparkSession, listing: DataFrame, options: FeedOptions, need_lookups: bool) -> _Plan | None:
    manifests = _stable(spark, manifest.parse_manifests(listing))
    head = manifests.orderBy("path_index", "manifest_path").select("manifest_id").first()
    if head is None:
        return None
    entries = manifest.manifest_entries(manifests)
    lookup_refs = entries.filter(F.col("kind") == "lookup")
    archive_paths = [r.path for r in lookup_refs.select("path").distinct().collect()]
    index = _stable(spark, archive.index_archives(spark, archive_paths))

    # Several archives in one manifest: a later archive wins the whole entry
    # (and within one archive a later member of the same name).
    versions = (
        lookup_refs.join(index.withColumnRenamed("archive", "path"), "path")
        .groupBy("manifest_id", "entry")
        .agg(F.max_by("digest", F.struct("pos", "member_no")).alias("version"))
    )
    # One row per lookup file name that any manifest has.
    of_head = F.max(F.when(F.col("manifest_id") == head.manifest_id, F.col("version"))).alias("version")
    entry_heads = {r.entry: r.version for r in versions.groupBy("entry").agg(of_head).collect()}
    head_versions = {e: v for e, v in entry_heads.items() if v is not None}
    if archive.COLUMN_HEADERS not in head_versions:
        raise ValueError("the first manifest's lookup archive has no column_headers.tsv")

    wanted_entries = None if need_lookups else [archive.COLUMN_HEADERS]
    lines = archive.archive_lines(spark, index, wanted_entries, options.file_encoding, options.data_encoding)
    parsed = _stable_by_entry(spark, archive.parsed_lines(lines, options.comment, options.lookup_limits))

    # One pass over the (deduplicated) lookup lines: sizes for the broadcast
    # decision and the first record of every column_headers.tsv version.
    is_headers = F.col("entry") == archive.COLUMN_HEADERS
    stats = parsed.groupBy("entry", "digest").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.aggregate("fields", F.lit(0), lambda acc, x: acc + F.coalesce(F.length(x), F.lit(0)))).alias("chars"),
        F.min_by(F.when(is_headers, F.col("fields")), "line_no").alias("headers"),
    ).collect()
    signatures: dict[tuple, int] = {}
    digest_sig: dict[int, int] = {}
    entry_bytes: dict[str, int] = {}
    entry_versions: dict[str, int] = {}
    for r in sorted(stats, key=lambda r: (r.entry, r.digest)):
        size = int(r.n) * _ROW_OVERHEAD + 2 * int(r.chars or 0)
        if r.entry == archive.EVENT:  # plus the worst case of its dense id array
            size += 8 * L.DENSE_EVENT_ID_LIMIT
        entry_bytes[r.entry] = entry_bytes.get(r.entry, 0) + size
        entry_versions[r.entry] = entry_versions.get(r.entry, 0) + 1
        if r.entry == archive.COLUMN_HEADERS and r.headers is not None:
            digest_sig[r.digest] = signatures.setdefault(tuple(r.headers), len(signatures))
    if head_versions[archive.COLUMN_HEADERS] not in digest_sig:
        raise ValueError("the first manifest's column_headers.tsv is empty")
    sig_map = spark.createDataFrame(list(digest_sig.items()), "version bigint, sig int")
    manifest_sig = (
        versions.filter(F.col("entry") == archive.COLUMN_HEADERS)
        .join(F.broadcast(sig_map), "version")
        .select("manifest_id", "sig")
    )
    layout = _Layout([list(h) for h in signatures])
    head_headers = layout.signatures[digest_sig[head_versions[archive.COLUMN_HEADERS]]]
    return _Plan(
        sorted(archive_paths), manifests, set(head_versions), set(entry_heads), head_headers, layout, versions,
        manifest_sig, parsed, entry_bytes, entry_versions,
    )




def _with_runs(df: DataFrame) -> DataFrame:
    """``df`` with ``__f``, all fields of a record, and ``__r0``, ``__r1``, ..: its runs of fields.

    A run holds its own fields and, last, the rest of the record, which the next run splits.
    Unused columns are pruned, so a query builds the fields up to the last run that it reads:
    one early column of a wide feed costs 16 strings a hit, not one for each column."""
    df = df.withColumn("__f", tsv.split_fields(F.col("value")))
    rest = F.col("value")
    for i, (start, end) in enumerate(zip(_CUTS, [*_CUTS[1:], None])):
        df = df.withColumn(f"__r{i}", tsv.split_fields(rest, None if end is None else end - start + 1))
        if end is not None:
            rest = F.get(f"__r{i}", F.lit(end - start))
    return df


def _field(at: int) -> str:
    run = bisect.bisect_right(_CUTS, at) - 1
    return f"get(__r{run}, {at - _CUTS[run]})"


def _raw_column(name: str, layout: _Layout, failfast: bool = False) -> Column:
    """Decoded value of physical column ``name`` for whatever header signature
    a hit's manifest has; null where that manifest lacks the column, and where
    the record ends before it (an error with ``failfast``)."""
    at = layout.place(name)
    if at is None:
        return F.lit(None).cast("string")
    raw = f"get(__f, {at})"
    if name in layout.fixed and layout.cut and not failfast:
        raw = _field(layout.fixed[name])
    elif failfast:
        raw = f"CASE WHEN {at} IS NULL THEN NULL WHEN size(__f) > {at} THEN {raw} ELSE raise_error('record is shorter than its header') END"
    return F.expr(tsv.decode_field_sql(raw))


def _output_columns(headers: list[str], entries: set[str], options: FeedOptions) -> OrderedDict[str, str]:
    """Output column name -> kind, in output order (first name wins), for these
    hit columns and lookup files."""
    cols: OrderedDict[str, str] = OrderedDict()
    if options.enable_lookups:
        cols[options.metadata_prefix + "last_modified"] = "meta_mtime"
        cols[options.metadata_prefix + "fileset"] = "meta_fileset"
        if archive.MOBILE_ATTRIBUTES in entries and L.MOBILE_KEY in headers:
            cols.setdefault("mobile_attributes", "mobile")
        if archive.EVENT in entries:
            for c in L.EVENT_COLUMNS:
                if c in headers:
                    cols.setdefault(c, "events")
        for c in L.PRODUCT_COLUMNS:
            if c in headers:
                cols.setdefault(c, "products")
        for rule in L.SIMPLE_LOOKUPS:
            if rule.entry in entries and rule.key in headers:
                cols.setdefault(rule.output, "simple")
    for h in headers:
        if h is not None:
            cols.setdefault(h, "raw")
    return cols


def _file_tables(p: _Plan, entries_needed: list[str], filesets: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Two small broadcast sides, kept apart so neither repeats the other:

    * files: ``(path_key, manifest_id)``, one row per hit file a manifest (of
      these filesets) names, so that other filesets are never scanned;
    * attrs: one row per manifest: header signature, modification time,
      fileset and the version of every lookup file in use.
    """
    delivered = p.manifests if filesets is None else p.manifests.filter(F.col("fileset").isin(filesets))
    files = manifest.manifest_entries(delivered).filter(F.col("kind") == "data").select(
        F.col("path").alias("path_key"), "manifest_id"
    )
    attrs = p.manifests.select(
        "manifest_id",
        F.coalesce("modification_time", F.lit(_EPOCH)).alias("__mtime"),  # never null, and known to be
        F.coalesce("fileset", F.lit("")).alias("__fileset"),
        F.xxhash64("manifest_path").alias("__manifest"),
    ).join(p.manifest_sig.withColumnRenamed("sig", "__sig"), "manifest_id", "left")
    attrs = attrs.join(p.layout.table(attrs.sparkSession), "__sig", "left")
    if entries_needed:
        pivot = (
            p.versions.filter(F.col("entry").isin(entries_needed))
            .groupBy("manifest_id")
            .pivot("entry", entries_needed)
            .agg(F.first("version"))
        )
        for e in entries_needed:
            pivot = pivot.withColumnRenamed(e, _version_col(e))
        attrs = attrs.join(pivot, "manifest_id", "left")
        for e in entries_needed:
            if _version_col(e) not in attrs.columns:
                attrs = attrs.withColumn(_version_col(e), F.lit(None).cast("bigint"))
    return files, attrs


def _hits_with_files(
    spark: SparkSession, files: DataFrame, attrs: DataFrame, options: FeedOptions, n_drifting: int = 0
) -> DataFrame:
    """Hit records with their manifest's attributes: two broadcast joins,
    sizes checked, hits never shuffled.

    Hits find their manifest through a 64-bit hash of the file path (8-byte
    keys instead of path strings on the broadcast side); a collision among
    the listed paths is detected here and switches to exact string keys.
    When either side would exceed the broadcast limit, the work is split into
    chunks (manifests by id x files by path hash): each chunk scans its files
    with only its slice of both tables broadcast.  A file named by manifests
    in two chunks is scanned by both, which keeps one row per (manifest, hit).
    """
    pairs = files.join(attrs.select("manifest_id", "__sig"), "manifest_id", "left")
    st = pairs.agg(
        F.count(F.lit(1)).alias("n_pairs"),
        F.count_distinct("path_key").alias("n_paths"),
        F.count_distinct(F.xxhash64("path_key")).alias("n_hashes"),
        F.count_distinct("manifest_id").alias("n_manifests"),
        F.max(F.length("path_key")).alias("max_len"),
        F.sum(F.col("__sig").isNull().cast("int")).alias("no_header"),
    ).first()
    if not st.n_pairs:
        empty = spark.createDataFrame([], "value string, path_key string")
        return empty.join(files, "path_key").join(attrs, "manifest_id")
    if st.no_header:
        missing = [r.path_key for r in pairs.filter(F.col("__sig").isNull()).select("path_key").limit(5).collect()]
        raise ValueError(f"hit files whose manifest has no column_headers.tsv: {missing}")
    exact = st.n_hashes != st.n_paths  # a hash collision: join on the path itself
    file_bytes = st.n_pairs * (_ROW_OVERHEAD + 16 + (st.max_len if exact else 0))
    attr_bytes = st.n_manifests * (_ROW_OVERHEAD + 8 * len(attrs.columns) + 64 + 4 * n_drifting)
    limit = max(options.broadcast_limit, 1)
    # Chunks: manifests by id (bounds the attribute slice) x files by path hash
    # (bounds the file slice and the files per scan).
    n_m = max(1, -(-attr_bytes // limit))
    n_f = max(1, -(-file_bytes // limit), -(-st.n_paths // max(options.max_files_per_scan, 1)))
    m_part = F.pmod(F.col("manifest_id"), F.lit(n_m))
    f_part = F.pmod(F.xxhash64("path_key"), F.lit(n_f))
    by_chunk: dict[tuple[int, int], list[str]] = {}
    # The file list the text source needs anyway: distinct (path, chunk) pairs.
    for r in files.select("path_key", m_part.alias("i"), f_part.alias("j")).distinct().collect():
        by_chunk.setdefault((r.i, r.j), []).append(r.path_key)
    key = "path_key" if exact else "__h"
    parts = []
    for i, j in sorted(by_chunk):
        recs = hits.scan_records(
            spark, sorted(by_chunk[(i, j)]), options.data_encoding, options.join_continuation_lines, options.comment
        )
        f_side, a_side = files, attrs
        if n_m > 1:
            f_side, a_side = f_side.filter(m_part == i), a_side.filter(m_part == i)
        if n_f > 1:
            f_side = f_side.filter(f_part == j)
        if not exact:
            recs = recs.withColumn("__h", F.xxhash64("path_key"))
            f_side = f_side.select(F.xxhash64("path_key").alias("__h"), "manifest_id")
        joined = recs.join(F.broadcast(f_side), key).join(F.broadcast(a_side), "manifest_id")
        parts.append(joined.drop("__h"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def build_feed(
    spark: SparkSession,
    paths: list[str],
    options: FeedOptions,
    user_schema: T.StructType | None = None,
    every_column: bool = False,
) -> DataFrame:
    """The feed as one DataFrame.  The first manifest decides the column set; a
    user schema, and ``every_column``, see the columns and lookup files of all
    manifests.  ``every_column`` also gives event lists their parsed form
    whether or not there is a dictionary, and adds the column ``<prefix>manifest``
    (a hash of the manifest's path): a table that does not depend on which
    manifests are read together."""
    p = _cached_plan(spark, paths, options, need_lookups=options.enable_lookups)
    if p is None:
        if user_schema is None:
            raise NoManifestError(f"no manifest found in {paths}")
        return spark.createDataFrame([], user_schema)

    all_headers = list(OrderedDict.fromkeys([*p.head_headers, *p.layout.columns]))
    out_cols = _output_columns(all_headers, p.all_entries | ({archive.EVENT} if every_column else set()), options)
    if user_schema is not None:
        wanted = [f.name for f in user_schema.fields]
    elif every_column:
        wanted = list(out_cols)
    else:
        head_cols = _output_columns(p.head_headers, p.head_entries, options)
        wanted = list(head_cols)
        # A column that only later manifests look up is still looked up there (both kinds are strings).
        out_cols = {n: "simple" if kind == "raw" and out_cols[n] == "simple" else kind for n, kind in head_cols.items()}
    kinds = {n: out_cols[n] for n in wanted if n in out_cols}

    entries_needed: list[str] = []
    if options.enable_lookups:
        entries_needed = sorted(
            {r.entry for r in L.SIMPLE_LOOKUPS if kinds.get(r.output) == "simple"}
            | ({archive.EVENT} if "events" in kinds.values() else set())
            | ({archive.MOBILE_ATTRIBUTES} if "mobile" in kinds.values() else set())
        )
    files, attrs = _file_tables(p, entries_needed, options.filesets)
    # files is an explode of the (checkpointed) manifest table; attrs joins
    # several small tables, so it is frozen (once per set of lookups in use).
    if tuple(entries_needed) not in p.attrs:
        p.attrs[tuple(entries_needed)] = _stable(spark, attrs)
    df = _hits_with_files(spark, files, p.attrs[tuple(entries_needed)], options, len(p.layout.drifting))
    df = _with_runs(df)

    if options.max_chars_per_column > 0:
        df = df.filter(tsv.within_limit(F.col("__f"), options.max_chars_per_column))
    if options.failfast:
        df = df.filter(
            F.when(F.size("__f") > F.col("__width") + 1, F.raise_error(F.lit("record has more fields than the header")))
            .otherwise(F.lit(True))
        )

    raw_cache: dict[str, Column] = {}

    def raw(name: str) -> Column:
        if name not in raw_cache:
            raw_cache[name] = _raw_column(name, p.layout, options.failfast)
        return raw_cache[name]

    limit = options.broadcast_limit
    packed = L.packed_entries(p.entry_bytes, limit)
    exprs: dict[str, Column] = {}

    # Keys of the lookups in use, decoded once.
    key_cols = {r.key for r in L.SIMPLE_LOOKUPS if kinds.get(r.output) == "simple"}
    if "mobile" in kinds.values():
        key_cols.add(L.MOBILE_KEY)
    df = df.select("*", *[raw(k).alias("__k_" + k) for k in sorted(key_cols)])

    for name, kind in kinds.items():
        if kind == "meta_mtime":
            exprs[name] = F.col("__mtime")
        elif kind == "meta_fileset":
            exprs[name] = F.col("__fileset")
        elif kind == "products":
            exprs[name] = nested.parse_products(raw(name), options.failfast)
        elif kind == "raw":
            exprs[name] = raw(name)
        elif kind == "simple":
            rule = next(r for r in L.SIMPLE_LOOKUPS if r.output == name)
            if rule.entry in packed:
                table = F.broadcast(L.packed_table(p.parsed, packed))
            else:
                table = L.maybe_broadcast(
                    L.key_value_table(p.parsed, rule.entry), p.entry_bytes.get(rule.entry, -1), limit
                )
            vcol = _version_col(rule.entry)
            df = L.left_lookup(df, table, {"version": vcol, "key": "__k_" + rule.key}, {"__lv_" + name: F.col("value")})
            # A manifest without this lookup file, or without its key, keeps the raw column of that name.
            looked_up = F.col(vcol).isNotNull()
            if rule.key not in p.layout.fixed:
                looked_up = looked_up & F.expr(f"{p.layout.place(rule.key) or 'NULL'} IS NOT NULL")
            exprs[name] = F.when(looked_up, F.col("__lv_" + name)).otherwise(raw(name))
        elif kind == "mobile":
            table = L.maybe_broadcast(
                L.mobile_table(p.parsed), p.entry_bytes.get(archive.MOBILE_ATTRIBUTES, -1), limit
            )
            df = L.left_lookup(
                df, table, {"version": _version_col(archive.MOBILE_ATTRIBUTES), "key": "__k_" + L.MOBILE_KEY},
                {"__mobile": F.col("attrs")},
            )
            exprs[name] = F.col("__mobile")

    event_consts = _event_name_constants(p) if "events" in kinds.values() else None
    if event_consts is not None:
        # Small dictionaries travel with the plan as constants (sent once per
        # stage), so no hit row ever carries a copy of a name array.
        versions, dense_all, sparse_all = event_consts
        ordinal = F.array_position(versions, F.col(_version_col(archive.EVENT))) - 1
        for name, kind in kinds.items():
            if kind == "events":
                exprs[name] = nested.parse_events(raw(name), F.get(dense_all, ordinal), F.get(sparse_all, ordinal))
    elif "events" in kinds.values() and 0 <= p.entry_bytes.get(archive.EVENT, -1) <= limit:
        # Larger dictionaries are broadcast once and indexed in the Python workers.
        if "event_dictionary" not in p.extras:
            p.extras["event_dictionary"] = dictionary.ship_dictionary(spark, L.key_value_table(p.parsed, archive.EVENT))
        for name, kind in kinds.items():
            if kind == "events":
                found = dictionary.shipped_event_names(p.extras["event_dictionary"], raw(name), F.col(_version_col(archive.EVENT)))
                df = df.withColumn("__names_" + name, found)
                exprs[name] = nested.parse_named_events(raw(name), F.col("__names_" + name))
    elif "events" in kinds.values():
        # Built once per plan; the groupBy on top keeps it provably unique per
        # version, so the join is still dropped when no event column is used.
        if ("__event_names__",) not in p.attrs:
            p.attrs[("__event_names__",)] = _stable(spark, L.event_names_table(p.parsed))
        names_table = p.attrs[("__event_names__",)].groupBy("version").agg(
            F.first("dense").alias("dense"), F.first("sparse").alias("sparse")
        )
        table = L.maybe_broadcast(names_table, p.entry_bytes.get(archive.EVENT, -1), limit)
        df = L.left_lookup(
            df, table, {"version": _version_col(archive.EVENT)},
            {"__ev_dense": F.col("dense"), "__ev_sparse": F.col("sparse")},
        )
        for name, kind in kinds.items():
            if kind == "events":
                exprs[name] = nested.parse_events(raw(name), F.col("__ev_dense"), F.col("__ev_sparse"))

    if every_column:
        wanted.append(options.metadata_prefix + "manifest")
        exprs[wanted[-1]] = F.col("__manifest")
    if user_schema is None:
        return df.select(*[exprs[n].alias(n) for n in wanted])
    return df.select(*[_as_type(exprs.get(f.name), f.dataType, options.failfast).alias(f.name) for f in user_schema.fields])


# Event dictionaries whose constants serialize to at most this many characters
# (over all versions) are embedded in the plan; larger ones are joined per row.
# The driver collects them only below the (estimated) collect limit.
EVENT_CONSTANT_LIMIT = 2 * 1024 * 1024
EVENT_COLLECT_LIMIT = 8 * 1024 * 1024
EVENT_CONSTANT_MAX_VERSIONS = 1024


def _event_name_constants(p: _Plan):
    """``(versions, dense, sparse)`` constant columns for the event lookup, or
    None when the dictionaries are too large to ship with the plan."""
    if "event_constants" in p.extras:
        return p.extras["event_constants"]
    out = None
    n_versions = p.entry_versions.get(archive.EVENT, 0)
    estimated = p.entry_bytes.get(archive.EVENT, 0)
    if 0 < estimated <= EVENT_COLLECT_LIMIT and n_versions <= EVENT_CONSTANT_MAX_VERSIONS:
        by_version: dict[int, dict[str, str | None]] = {}
        for r in L.key_value_table(p.parsed, archive.EVENT).collect():  # size checked above
            by_version.setdefault(r.version, {})[r.key] = r.value
        versions = sorted(by_version)
        dense_all, sparse_all = [], []
        for v in versions:
            dense: list[str | None] = []
            sparse: dict[str, str | None] = {}
            for k, name in by_version[v].items():
                if nested.is_canonical_id(k) and int(k) < L.DENSE_EVENT_ID_LIMIT:
                    i = int(k)
                    dense.extend([None] * (i + 1 - len(dense)))
                    dense[i] = name
                else:
                    sparse[k] = name
            dense_all.append(dense)
            sparse_all.append(sparse)
        dense_json, sparse_json = json.dumps(dense_all), json.dumps(sparse_all)
        if len(dense_json) + len(sparse_json) <= EVENT_CONSTANT_LIMIT:
            out = (
                F.array(*[F.lit(v) for v in versions]) if versions else F.array().cast("array<bigint>"),
                F.from_json(F.lit(dense_json), "array<array<string>>"),
                F.from_json(F.lit(sparse_json), "array<map<string,string>>"),
            )
    p.extras["event_constants"] = out
    return out


def _as_type(c: Column | None, data_type: T.DataType, failfast: bool) -> Column:
    """A user-schema column: missing -> typed null; atomic types are cast with
    ``try_cast`` (null on bad text) unless FAILFAST asks for errors."""
    if c is None:
        return F.lit(None).cast(data_type)
    if failfast or not isinstance(data_type, T.AtomicType):
        return c.cast(data_type)
    return c.try_cast(data_type)
