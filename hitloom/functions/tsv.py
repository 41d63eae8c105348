"""Escaped-TSV record rules for hit and lookup files, as Catalyst expressions.

A hit file is TSV, not CSV: quotes mean nothing, the field separator is a raw
TAB, and the escapes ``\\n`` ``\\t`` ``\\r`` ``\\\\`` and backslash+LF decode.
Any other backslash pair keeps both characters.  Leading raw whitespace
(U+0000..U+0020) is trimmed before decoding, trailing whitespace after it, and
an empty field is null.  Records that start with ``#`` are comments, and
records that are empty or hold only whitespace (no TAB) are skipped.

Everything here stays JVM-side (split / transform / replace), so it runs inside
whole-stage codegen; decoding is only evaluated for the columns a query uses.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character up to and including SPACE counts as whitespace.
WHITESPACE = "".join(chr(i) for i in range(0x21))
FIELD_SEPARATOR = "\t"
COMMENT_CHAR = "#"
ESCAPE_PAIR_REGEX = r"\\\\"  # Java regex for two literal backslashes

_ESCAPES = [("\\\n", "\n"), ("\\n", "\n"), ("\\t", "\t"), ("\\r", "\r")]


def _lit(s: str) -> Column:
    return F.lit(s)


def unescape(c: Column) -> Column:
    """Decode backslash escapes in one field.

    The field is cut at every escaped backslash (``\\\\``, scanned left to
    right); inside a piece each backslash is followed by something else, so the
    remaining escapes can be replaced independently.  The pieces are joined
    back with a single backslash.  No placeholder character is needed.
    """

    def decode_piece(p: Column) -> Column:
        for src, dst in _ESCAPES:
            p = F.replace(p, _lit(src), _lit(dst))
        return p

    pieces = F.split(c, ESCAPE_PAIR_REGEX, -1)
    return F.array_join(F.transform(pieces, decode_piece), "\\")


def decode_field(c: Column) -> Column:
    """Raw field text -> value: trim, unescape, trim, empty to null."""
    lead = F.ltrim(c, _lit(WHITESPACE))
    decoded = F.when(F.instr(lead, "\\") > 0, unescape(lead)).otherwise(lead)
    return F.nullif(F.rtrim(decoded, _lit(WHITESPACE)), _lit(""))


def within_limit(fields: Column, limit: int) -> Column:
    """True; an error if a decoded field is longer than ``limit``.

    Decoding never makes a field longer, so only fields whose raw text is over the limit are decoded."""
    too_long = F.exists(fields, lambda x: (F.length(x) > limit) & (F.length(decode_field(x)) > limit))
    return F.when(too_long, F.raise_error(F.lit("field longer than maxCharsPerColumn"))).otherwise(F.lit(True))


def split_fields(record: Column, most: int | None = None) -> Column:
    """Record text -> array of raw (undecoded) fields; trailing empties kept.
    With ``most``, that many items at most: the last one is the rest of the record."""
    return F.split(record, FIELD_SEPARATOR, -1 if most is None else most)


def is_data_record(record: Column, comment: str | None = COMMENT_CHAR) -> Column:
    """False for blank records and (by default) ``#`` comment records."""
    blank = (F.ltrim(record, _lit(WHITESPACE)) == "") & (F.instr(record, FIELD_SEPARATOR) == 0)
    keep = ~blank
    if comment:
        keep = keep & ~record.startswith(comment)
    return keep


# The same decoder as Spark SQL text.  Building a Column costs one py4j call
# per function; a feed has hundreds of columns, so the reader builds each
# column's decoder with one ``F.expr`` instead (same expression tree).
def _sql_str(s: str) -> str:
    """SQL string literal; control characters stay raw (the literal grammar
    allows any character but quote and backslash)."""
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def unescape_sql(x: str) -> str:
    p = "p"
    for src, dst in _ESCAPES:
        p = f"replace({p}, {_sql_str(src)}, {_sql_str(dst)})"
    return f"array_join(transform(split({x}, {_sql_str(ESCAPE_PAIR_REGEX)}, -1), p -> {p}), {_sql_str(chr(92))})"


def decode_field_sql(field: str) -> str:
    """SQL text of :func:`decode_field` applied to the SQL expression ``field``."""
    ws = _sql_str(WHITESPACE)
    lead = f"trim(LEADING {ws} FROM {field})"
    decoded = f"CASE WHEN instr({lead}, {_sql_str(chr(92))}) > 0 THEN {unescape_sql(lead)} ELSE {lead} END"
    return f"nullif(trim(TRAILING {ws} FROM {decoded}), '')"
