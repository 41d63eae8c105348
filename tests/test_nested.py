"""Product and event list parsing (column functions, no I/O)."""

from pyspark.sql import functions as F

from hitloom.functions import nested

P = lambda name, category=None, quantity=None, price=None, events=None, evars=None: (
    category, name, quantity, price, events, evars,
)

PRODUCT_CASES = [
    ("shoes;boot", [P("boot", "shoes")]),
    ("a;b;2;3.50;event7=1|event8;eVar3=red", [P("b", "a", "2", "3.50", [("event7", "1"), ("event8", None)], [("eVar3", "red")])]),
    (";cup;;0", [P("cup", None, None, "0")]),
    (";tea^^^,pot", [P("tea^,pot")]),
    ("c^;d;e^|f;1;1;event1=2^=3;eVar1=p^|q|eVar2=r^,s", [P("e|f", "c;d", "1", "1", [("event1", "2=3")], [("eVar1", "p|q"), ("eVar2", "r,s")])]),
    (";one;1,;two;2,home;three;3", [P("one", None, "1"), P("two", None, "2"), P("three", "home", "3")]),
]


def _as_tuples(products):
    if products is None:
        return None
    out = []
    for p in products:
        ev = None if p.events is None else [(x.key, x.value) for x in p.events]
        evar = None if p.evars is None else [(x.key, x.value) for x in p.evars]
        out.append((p.category, p.name, p.quantity, p.price, ev, evar))
    return out


def test_product_cases(spark):
    df = spark.createDataFrame([(s,) for s, _ in PRODUCT_CASES], "s string")
    got = {r.s: _as_tuples(r.p) for r in df.select("s", nested.parse_products(F.col("s")).alias("p")).collect()}
    for s, expected in PRODUCT_CASES:
        assert got[s] == expected, s


def test_product_edge_cases(spark):
    df = spark.createDataFrame([(";",), (None,), ("nosemicolon",)], "s string")
    got = {r.s: _as_tuples(r.p) for r in df.select("s", nested.parse_products(F.col("s")).alias("p")).collect()}
    assert got[";"] == [P("")]  # empty name stays "", other parts null
    assert got[None] is None
    assert got["nosemicolon"] == [P(None, "nosemicolon")]  # PERMISSIVE: no name


def test_split_like_java(spark):
    cases = {"a,b,,": ["a", "b"], ",a": ["", "a"], ",": [], "a^^,b": ["a^^,b"], "": [""], "a,,b": ["a", "", "b"]}
    df = spark.createDataFrame([(k,) for k in cases], "s string")
    got = {r.s: r.x for r in df.select("s", nested.split_list(F.col("s"), nested.ITEM_SEPARATOR).alias("x")).collect()}
    assert got == cases


def test_unescape_order(spark):
    row = spark.range(1).select(nested.unescape(F.lit("^^,x^,^;^|^=^^^^")).alias("u")).first()
    # sequential: "^,"->"," runs first, so "^^," becomes "^," and then "^^"->"^"
    assert row.u == "^,x,;|=^^"


def test_events_with_dense_and_sparse_names(spark):
    df = spark.createDataFrame([("1=3.06,2,100,007,x^=y=2,,",)], "s string")
    dense = F.array(F.lit("zero"), F.lit("one"), F.lit(None).cast("string"))
    sparse = F.create_map(F.lit("100"), F.lit("hundred"), F.lit("007"), F.lit("seven"))
    got = df.select(nested.parse_events(F.col("s"), dense, sparse).alias("e")).first().e
    assert [(x.event, x.value) for x in got] == [
        ("one", "3.06"), (None, None), ("hundred", None), ("seven", None), (None, "2"),
    ]


def test_failfast_product_without_semicolon(spark):
    df = spark.createDataFrame([("nosemicolon",)], "s string")
    import pytest
    from pyspark.errors import PySparkException

    with pytest.raises(Exception) as e:
        df.select(nested.parse_products(F.col("s"), failfast=True).alias("p")).collect()
    assert isinstance(e.value, (PySparkException, Exception))
