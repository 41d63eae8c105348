"""Hit-file scan: escaped-TSV records as a DataFrame of record text.

The scan is Spark's text source (LF-only line separator, codec chosen from the
file extension), with ``_metadata`` giving the file of every line.  One more
step is needed before fields can be split: a physical line that ends in an
*odd* number of backslashes continues on the next line (an escaped newline).

That join runs in a ``mapInArrow`` because it needs the previous line of the
same file, and lines of one file chunk arrive in order within one task.  Each
Arrow batch is checked vectorised; a batch with no open line and no carried
record is passed through unchanged, so the Python step costs one Arrow round
trip in the common case.

Gzip files (the normal delivery) are never split, so a task always holds whole
files.  In a plain file a record can straddle two splits: it belongs to the split
in which it begins.  That task *reads on* past the end of its split until the record
closes, and a task whose split begins inside a record drops the lines up to its
end, so the file is scanned once.  A split's bounds say nothing about the bytes of a bzip2 file,
some stores are open to Spark only, and in some encodings a backslash byte can be half of a
character: there the task emits the split's first record and its unfinished last
record as *fragments*, and a small window over fragments only stitches them back together.
"""

from __future__ import annotations

import codecs
from collections.abc import Iterator
from functools import partial
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hitloom import fs
from hitloom.functions import names, tsv

# A line is continued when it ends in an odd number of backslashes.
OPEN_LINE_REGEX = r"(?:^|[^\\])(?:\\\\)*\\$"
# Extensions whose Hadoop codec cannot be split (a task always reads whole files).
UNSPLITTABLE_SUFFIXES = (".gz", ".gzip", ".zst", ".zstd", ".snappy", ".lz4", ".deflate")

# Extensions of splittable files that are compressed.
COMPRESSED_SPLITTABLE = (".bz2",)
#: Bytes read at a time past a split's end.
READ_ON_BYTES = 64 << 10

FRAG_COMPLETE, FRAG_HEAD, FRAG_OPEN_TAIL, FRAG_HEAD_OPEN = 0, 1, 2, 3

RECORD_SCHEMA = "value string, path_key string, block_start bigint, frag int, seq int"
_ARROW_SCHEMA = pa.schema(
    [("value", pa.string()), ("path_key", pa.string()), ("block_start", pa.int64()), ("frag", pa.int32()), ("seq", pa.int32())]
)


def _decode_paths(paths: pa.Array) -> pa.Array:
    enc = pc.dictionary_encode(paths)
    decoded = pa.array([None if v is None else unquote(v) for v in enc.dictionary.to_pylist()], pa.string())
    return pc.take(decoded, enc.indices)


def _continues(line: str) -> bool:
    """Whether a line ends in an odd number of backslashes."""
    return (len(line) - len(line.rstrip("\\"))) % 2 == 1


class SplitEnds:
    """What stands around the ends of a plain file's splits.

    A split holds the lines that begin after its first byte and up to its end, that byte included
    (its first line too where the file begins).  So the line that holds the byte at a split's end is its last."""

    def __init__(self, encoding: str):
        self.encoding = encoding

    def begins_inside(self, path: str, start: int) -> bool:
        """Whether the first line of the split at ``start`` continues the line before it."""
        with fs.arrow_file(unquote(path)) as f:
            f.seek(start)
            run, only, newline = 0, True, b""  # backslashes just passed; whether there was nothing else
            while not newline:
                block = f.read(READ_ON_BYTES)
                if not block:
                    return False  # no line begins in this split
                line, newline, _ = block.partition(b"\n")
                kept = len(line) - len(line.rstrip(b"\\"))
                run, only = (run + kept, only) if kept == len(line) else (kept, False)
            while only and start > 0:  # the run may begin before the split
                begin = max(0, start - READ_ON_BYTES)
                f.seek(begin)
                block = f.read(start - begin)
                kept = len(block) - len(block.rstrip(b"\\"))
                run, only, start = run + kept, kept == len(block), begin
            return run % 2 == 1

    def lines_after(self, path: str, end: int) -> Iterator[str]:
        """The lines after the one that holds the byte at ``end``."""
        with fs.arrow_file(unquote(path)) as f:
            f.seek(end)
            parts, first = [], True
            while block := f.read(READ_ON_BYTES):
                *whole, rest = block.split(b"\n")
                for line in whole:
                    if not first:
                        yield b"".join([*parts, line]).decode(self.encoding, "replace")
                    parts, first = [], False
                parts.append(rest)
            if not first and any(parts):
                yield b"".join(parts).decode(self.encoding, "replace")


def join_continuation_lines(batches, ends: SplitEnds | None = None):
    """Per task: lines (value, file_path, block_start, block_length, file_size)
    -> records (value, path_key, block_start, frag, seq).

    With ``ends``, records that straddle splits are completed by reading on; without, they are given as fragments."""
    carry: list[str] | None = None
    carry_head = False
    skip = False  # inside a record that began in an earlier split
    chunk = None  # (file_path, block_start, block_length, file_size)
    first_in_chunk = True
    out: dict[str, list] = {k: [] for k in _ARROW_SCHEMA.names}

    def emit(text, fp, bs, frag, seq):
        out["value"].append(text)
        out["path_key"].append(fp)
        out["block_start"].append(bs)
        out["frag"].append(frag)
        out["seq"].append(seq)

    def flush_chunk():
        nonlocal carry, carry_head
        if carry is None:
            return
        fp, bs, bl, size = chunk
        at_end = bs + bl >= size
        if ends is not None and not at_end:
            for line in ends.lines_after(fp, bs + bl):
                carry.append(line)
                if not _continues(line):
                    break
            at_end = _continues(carry[-1])
            if not at_end:
                emit("\n".join(carry), fp, bs, FRAG_COMPLETE, 0)
                carry = None
                return
        text = "\n".join(carry)
        if at_end:  # end of file: the parser drops a final lone backslash
            emit(text[:-1], fp, bs, FRAG_HEAD if carry_head else FRAG_COMPLETE, 0)
        else:
            emit(text, fp, bs, FRAG_HEAD_OPEN if carry_head else FRAG_OPEN_TAIL, 1)
        carry, carry_head = None, False

    def drain():
        nonlocal out
        if not out["value"]:
            return None
        rb = pa.RecordBatch.from_pydict(out, schema=_ARROW_SCHEMA)
        out = {k: [] for k in _ARROW_SCHEMA.names}
        rb = rb.set_column(1, "path_key", _decode_paths(rb.column(1)))
        return rb

    for rb in batches:
        n = rb.num_rows
        if n == 0:
            continue
        values = rb.column("value")
        fps = rb.column("file_path")
        bss = rb.column("block_start")
        # Only a line ending in a backslash can continue; the odd-count regex
        # runs on batches that have such a line.
        if pc.any(pc.ends_with(values, pattern="\\")).as_py():
            opens = pc.fill_null(pc.match_substring_regex(values, OPEN_LINE_REGEX), False)
        else:
            opens = pa.nulls(n, pa.bool_()).fill_null(False)
        last = n - 1
        # In file order, so equal ends mean one split.
        same = ends is not None and not skip and chunk is not None and all(
            (fps[i].as_py(), bss[i].as_py()) == chunk[:2] for i in (0, last)
        )
        if carry is None and not pc.any(opens).as_py() and (same or pc.max(bss).as_py() == 0):
            start = bss[last].as_py()
            chunk = (fps[last].as_py(), start, rb.column("block_length")[last].as_py(), rb.column("file_size")[last].as_py())
            first_in_chunk, skip = False, False
            zeros = pa.array([0] * n, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [values, _decode_paths(fps), bss, zeros, zeros], schema=_ARROW_SCHEMA
            )
            continue
        vals = values.to_pylist()
        fpl = fps.to_pylist()
        bsl = bss.to_pylist()
        bll = rb.column("block_length").to_pylist()
        szl = rb.column("file_size").to_pylist()
        opl = opens.to_pylist()
        for i in range(n):
            key = (fpl[i], bsl[i])
            if chunk is None or key != chunk[:2]:
                flush_chunk()
                chunk = (fpl[i], bsl[i], bll[i], szl[i])
                first_in_chunk = True
                skip = ends is not None and bsl[i] > 0 and ends.begins_inside(fpl[i], bsl[i])
            if skip:
                skip = opl[i]
                continue
            if carry is None:
                carry = [vals[i]]
                carry_head = first_in_chunk and bsl[i] > 0 and ends is None
                first_in_chunk = False
            else:
                carry.append(vals[i])
            if not opl[i]:
                emit("\n".join(carry), fpl[i], bsl[i], FRAG_HEAD if carry_head else FRAG_COMPLETE, 0)
                carry, carry_head = None, False
        done = drain()
        if done is not None:
            yield done
    flush_chunk()
    done = drain()
    if done is not None:
        yield done


def _stitch(fragments: DataFrame) -> DataFrame:
    """Join records cut by a split boundary (few rows: two per split)."""
    w = Window.partitionBy("path_key").orderBy("block_start", "seq")
    is_open = F.col("frag").isin(FRAG_OPEN_TAIL, FRAG_HEAD_OPEN)
    is_head = F.col("frag").isin(FRAG_HEAD, FRAG_HEAD_OPEN)
    f = fragments.withColumn("is_open", is_open).withColumn(
        "joins_prev", F.coalesce(F.lag(is_open).over(w), F.lit(False)) & is_head
    )
    f = f.withColumn(
        "grp", F.sum((~F.col("joins_prev")).cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0))
    ).withColumn("is_last", F.lead("frag").over(w).isNull())
    g = f.groupBy("path_key", "grp").agg(
        F.sort_array(F.collect_list(F.struct("block_start", "seq", "value", "is_open", "is_last"))).alias("parts")
    )
    text = F.array_join(F.transform("parts", lambda p: p["value"]), "\n")
    last = F.element_at("parts", -1)
    text = F.when(last["is_open"] & last["is_last"], F.regexp_replace(text, r"\\$", "")).otherwise(text)
    return g.select(
        text.alias("value"), "path_key", F.element_at("parts", 1)["block_start"].alias("block_start"),
        F.lit(FRAG_COMPLETE).alias("frag"), F.lit(0).alias("seq"),
    )


def may_split(paths: list[str]) -> bool:
    return any(not p.lower().endswith(UNSPLITTABLE_SUFFIXES) for p in paths)


def reads_on(paths: list[str], encoding: str) -> bool:
    """Whether the tasks can read these splittable files past the ends of their splits."""
    name = codecs.lookup(encoding).name
    if not (name in ("utf-8", "ascii") or name.startswith(("iso8859", "cp125"))):
        return False  # a byte below 128 must be its ASCII character
    stores = {p.split(":", 1)[0]: p for p in paths}
    return not any(p.lower().endswith(COMPRESSED_SPLITTABLE) for p in paths) and all(map(fs.arrow_reads, stores.values()))


def _plain_file(uri: str) -> str:
    return "file:" + uri[len("file://") :] if uri.startswith("file:///") else uri


def scan_lines(spark: SparkSession, paths: list[str], encoding: str = "UTF-8") -> DataFrame:
    df = spark.read.option("lineSep", "\n").text([names.escape_glob(p) for p in paths])
    # A listed file under another path (a folder, a hidden name) would lose its hits in the join on paths.
    unread = sorted(set(paths) - {unquote(p) for p in map(_plain_file, df.inputFiles())})
    if unread:
        raise ValueError(f"hit files that the scan does not read under their listed path: {unread[:5]}")
    value = F.col("value")
    if encoding.upper().replace("_", "-") in ("UTF-8", "UTF8"):
        value = F.make_valid_utf8(value)  # a bad byte becomes U+FFFD, as in the lookup files
    else:
        value = F.decode(value.cast("binary"), encoding)
    return df.select(
        value.alias("value"),
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.col("_metadata.file_block_length").alias("block_length"),
        F.col("_metadata.file_size").alias("file_size"),
    )


def scan_records(
    spark: SparkSession,
    paths: list[str],
    encoding: str = "UTF-8",
    join_lines: bool = True,
    comment: str | None = tsv.COMMENT_CHAR,
) -> DataFrame:
    """``(value, path_key)``: one row per hit record, in file order."""
    if not join_lines:
        lines = scan_lines(spark, paths, encoding)
        recs = lines.select("value", names.scan_path_key(F.col("file_path")).alias("path_key"))
    else:
        # Only bzip2 files, and plain ones that tasks cannot open themselves, pay for the stitching pass.
        whole = [p for p in paths if not may_split([p])]
        plain = [p for p in paths if may_split([p]) and not p.lower().endswith(COMPRESSED_SPLITTABLE)]
        cut = [p for p in paths if may_split([p]) and p.lower().endswith(COMPRESSED_SPLITTABLE)]
        if plain and not reads_on(plain, encoding):
            plain, cut = [], plain + cut
        recs = None
        for some, join in (
            (whole, join_continuation_lines), (plain, partial(join_continuation_lines, ends=SplitEnds(encoding))), (cut, join_continuation_lines),
        ):
            if not some:
                continue
            joined = scan_lines(spark, some, encoding).mapInArrow(join, RECORD_SCHEMA)
            if some is cut:
                complete = joined.filter(F.col("frag") == FRAG_COMPLETE)
                joined = complete.unionByName(_stitch(joined.filter(F.col("frag") != FRAG_COMPLETE)))
            joined = joined.select("value", "path_key")
            recs = joined if recs is None else recs.unionByName(joined)
    return recs.filter(tsv.is_data_record(F.col("value"), comment))
