"""Event lists and product strings -> nested arrays and structs.

Pure Column functions (no I/O, no Python at run time): ``split`` with the
same Java regexes the hit-data syntax needs, ``transform`` over the pieces and
``named_struct`` for each item.

Syntax of the list columns: ``,`` separates items, ``;`` separates the fields
of one product, ``|`` separates product events or merchandising eVars, ``=``
assigns a value.  A separator right after ``^`` is data; ``^`` itself is
written ``^^``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Separators of the list syntax (Java regexes; an escaped
# separator is one preceded by a caret) and the unescape steps, applied in
# this order, each over the whole string.
ITEM_SEPARATOR = r"(?<!\^),"
FIELD_SEPARATOR = r"(?<!\^);"
PIPE_SEPARATOR = r"(?<!\^)\|"
ASSIGNMENT_SEPARATOR = r"(?<!\^)="
UNESCAPE_STEPS = [("^,", ","), ("^;", ";"), ("^|", "|"), ("^=", "="), ("^^", "^")]
PRODUCT_FIELD_LIMIT = 6

EVENT_TYPE = T.StructType([T.StructField("event", T.StringType()), T.StructField("value", T.StringType())])
KEY_VALUE_TYPE = T.StructType([T.StructField("key", T.StringType()), T.StructField("value", T.StringType())])
PRODUCT_TYPE = T.StructType(
    [
        T.StructField("category", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("quantity", T.StringType()),
        T.StructField("price", T.StringType()),
        T.StructField("events", T.ArrayType(KEY_VALUE_TYPE)),
        T.StructField("evars", T.ArrayType(KEY_VALUE_TYPE)),
    ]
)

def _empty_strings() -> Column:
    return F.array().cast(T.ArrayType(T.StringType()))


def _let(value: Column, body) -> Column:
    """Evaluate ``value`` once and hand it to ``body`` as a lambda variable
    (higher-order-function lambdas get no common-subexpression elimination)."""
    return F.element_at(F.transform(F.array(value), body), 1)


# Java's String.split needs no regex for a single plain character (or an
# escaped one); only strings that contain the escape character go through the
# look-behind regex.
_PLAIN = {",": ",", ";": ";", "|": "\\|", "=": "="}
_ESCAPE_AWARE = {",": ITEM_SEPARATOR, ";": FIELD_SEPARATOR, "|": PIPE_SEPARATOR, "=": ASSIGNMENT_SEPARATOR}


def _split(c: Column, sep: str, limit: int = -1, plain: bool = False) -> Column:
    parts = F.split(c, _PLAIN[sep], limit)
    return parts if plain else F.when(F.instr(c, "^") == 0, parts).otherwise(F.split(c, _ESCAPE_AWARE[sep], limit))


def _drop_trailing_empty(parts: Column) -> Column:
    def body(p: Column) -> Column:
        from_end = F.array_position(F.reverse(F.transform(p, lambda x: x != "")), True)
        keep = F.when(from_end == 0, F.lit(0)).otherwise(F.size(p) - from_end + 1)
        return F.slice(p, F.lit(1), keep)

    return _let(parts, body)


def unescape(c: Column) -> Column:
    for src, dst in UNESCAPE_STEPS:
        c = F.replace(c, F.lit(src), F.lit(dst))
    return c


def none_if_empty(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def split_list(c: Column, separator: str, plain: bool = False) -> Column:
    """Split like ``java.util.regex.Pattern.split(s)`` on an unescaped
    ``separator`` (one of ``, ; | =``): trailing empty items are dropped
    (Spark's ``split`` keeps them), ``""`` gives ``[""]`` and a string of
    separators gives ``[]``.  ``plain``: ``c`` holds no ``^``."""
    sep = {ITEM_SEPARATOR: ",", FIELD_SEPARATOR: ";", PIPE_SEPARATOR: "|", ASSIGNMENT_SEPARATOR: "="}.get(
        separator, separator
    )

    def body(s: Column) -> Column:
        return (
            F.when(s == "", F.array(F.lit("")))
            .when(s.endswith(sep), _drop_trailing_empty(_split(s, sep, plain=plain)))
            .otherwise(_split(s, sep, plain=plain))
        )

    return _let(c, body)


def _fail(message: str) -> Column:
    return F.raise_error(F.lit(message))


def parse_assignment(item: Column, failfast: bool = False, plain: bool = False) -> Column:
    """``key=value`` -> struct(key, value), both unescaped.  No ``=``: value
    is null (or an error in FAILFAST mode)."""
    escaped = F.instr(item, "^") > 0

    def body(parts: Column) -> Column:
        def field(i: int) -> Column:
            v = F.get(parts, i)
            return v if plain else F.when(escaped, unescape(v)).otherwise(v)

        value = field(1)
        if failfast:
            value = F.when(F.size(parts) < 2, _fail("assignment without '='")).otherwise(value)
        return F.struct(field(0).alias("key"), value.alias("value"))

    return _let(_split(item, "=", 2, plain), body)


def parse_pairs(c: Column, failfast: bool = False, plain: bool = False) -> Column:
    """``k=v|k=v`` -> array<struct<key,value>>; empty -> null."""
    pairs = F.transform(split_list(c, "|", plain), lambda x: parse_assignment(x, failfast, plain))
    return F.when(c == "", F.lit(None)).otherwise(pairs)


def parse_product(item: Column, failfast: bool = False) -> Column:
    """``category;name;quantity;price;events;evars`` -> product struct.

    An item without any ``^`` has nothing to unescape, down to its pairs: one
    check decides that for all of it."""

    def parsed(plain: bool) -> Column:
        def body(parts: Column) -> Column:
            n = F.size(parts)

            def field(i: int) -> Column:
                v = F.get(parts, i)
                return v if plain else unescape(v)

            name = field(1)
            if failfast:
                name = F.when(n < 2, _fail("product without ';'")).otherwise(name)
            return F.struct(
                none_if_empty(field(0)).alias("category"),
                name.alias("name"),
                none_if_empty(field(2)).alias("quantity"),
                none_if_empty(field(3)).alias("price"),
                F.when(n >= 5, parse_pairs(F.get(parts, 4), failfast, plain)).alias("events"),
                F.when(n >= 6, parse_pairs(F.get(parts, 5), failfast, plain)).alias("evars"),
            )

        return _let(_split(item, ";", PRODUCT_FIELD_LIMIT, plain), body)

    return F.when(F.instr(item, "^") == 0, parsed(plain=True)).otherwise(parsed(plain=False))


def parse_products(c: Column, failfast: bool = False) -> Column:
    """Product list string -> array<product>; null stays null."""
    return F.transform(split_list(c, ","), lambda x: parse_product(x, failfast))


# An event id is looked up in the dense array only when it is a canonical
# non-negative integer, so "007" or " 7" never match the key "7".
CANONICAL_ID = r"^(0|[1-9][0-9]{0,8})$"


def is_canonical_id(key: str) -> bool:
    """Python twin of CANONICAL_ID (used when dictionaries are built)."""
    return key == "0" or (key[:1] in "123456789" and key.isdigit() and key.isascii() and len(key) <= 9)


def lookup_event_name(key: Column, dense: Column | None, sparse: Column | None) -> Column:
    """Event id -> name from a per-version dense array (index = id) plus a map
    for ids that are not small canonical integers."""
    from_map = F.try_element_at(sparse, key) if sparse is not None else F.lit(None).cast("string")
    if dense is None:
        return from_map
    from_dense = F.get(dense, key.try_cast(T.IntegerType()))
    return F.when(key.rlike(CANONICAL_ID), F.coalesce(from_dense, from_map)).otherwise(from_map)


def parse_events(c: Column, dense: Column | None = None, sparse: Column | None = None) -> Column:
    """Event list -> array<struct<event,value>>.

    Each item is split on the first unescaped ``=``: the id is replaced by its
    looked-up name (null if unknown), the value is kept raw (not unescaped) and
    is null when there is no ``=``.
    """

    def one(parts: Column) -> Column:
        return F.struct(
            lookup_event_name(F.get(parts, 0), dense, sparse).alias("event"),
            F.get(parts, 1).alias("value"),
        )

    return F.transform(split_list(c, ","), lambda item: _let(_split(item, "=", 2), one))


def parse_named_events(c: Column, names: Column) -> Column:
    """Event list -> array<struct<event,value>>, the name of each item given in ``names`` by position."""

    def one(item: Column, i: Column) -> Column:
        return F.struct(F.get(names, i).alias("event"), F.get(_split(item, "=", 2), F.lit(1)).alias("value"))

    return F.transform(split_list(c, ","), one)
