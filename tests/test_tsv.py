"""Escaped-TSV record rules, through the real text scan and continuation join."""

import os

import pytest
from pyspark.sql import functions as F

from hitloom.functions import tsv
from hitloom.sources import hits
from tests.conftest import write_gz

# (file text, expected records as lists of decoded fields)
CASES = [
    ("a\t\tc\n", [["a", None, "c"]]),
    ("a\tb\t\n", [["a", "b", None]]),
    (" a \t b \t c \n", [["a", "b", "c"]]),
    ("a\t  \tc\n", [["a", None, "c"]]),
    ("a\\nb\tc\\td\te\\\\f\tg\\rh\n", [["a\nb", "c\td", "e\\f", "g\rh"]]),
    ("a\\\nb\tc\n", [["a\nb", "c"]]),
    ("a\\\\\nb\tc\n", [["a\\"], ["b", "c"]]),
    ("a\\\tb\tc\n", [["a\\", "b", "c"]]),
    ("a\\xb\tc\n", [["a\\xb", "c"]]),
    ("a\\n\tb\n", [["a", "b"]]),
    ("\\n a\tb\n", [["\n a", "b"]]),
    ("#a\tb\nc\td\n", [["c", "d"]]),
    (" #a\tb\n", [["#a", "b"]]),
    ("a\tb\n\nc\td\n", [["a", "b"], ["c", "d"]]),
    ("a\tb\r\nc\td\r\n", [["a", "b"], ["c", "d"]]),
    ('"a\tb"\t"c\n', [['"a', 'b"', '"c']]),
    ("\t\t\n", [[None, None, None]]),
    ("a\tb\\", [["a", "b"]]),
    ("x\\\ny\\\nz\tq\n", [["x\ny\nz", "q"]]),
]


def _records(spark, path, **kw):
    recs = hits.scan_records(spark, [path], **kw)
    return [
        list(r.f)
        for r in recs.select(F.transform(tsv.split_fields(F.col("value")), tsv.decode_field).alias("f")).collect()
    ]


@pytest.mark.parametrize("text,expected", CASES)
def test_tsv_case(spark, tmp_path, text, expected):
    path = os.path.join(str(tmp_path), "01-x.tsv.gz")
    write_gz(path, text)
    assert _records(spark, "file:" + path) == expected


def test_continuation_across_many_lines_and_files(spark, tmp_path):
    paths = []
    for i in range(3):
        p = os.path.join(str(tmp_path), f"0{i}-x.tsv.gz")
        write_gz(p, "".join(f"r{i}_{j}\\\nline2\tv{j}\n" for j in range(500)))
        paths.append("file:" + p)
    recs = hits.scan_records(spark, paths)
    rows = recs.select(F.transform(tsv.split_fields(F.col("value")), tsv.decode_field).alias("f")).collect()
    assert len(rows) == 1500
    assert all(r.f[0].endswith("\nline2") for r in rows)


def test_split_plain_file_is_stitched(spark, tmp_path):
    """A plain (splittable) file cut into many splits: records that straddle
    a split boundary are stitched back exactly."""
    p = os.path.join(str(tmp_path), "01-big.tsv")
    lines = []
    for j in range(3000):
        lines.append(f"id{j}\\\ncontinued {'x' * (j % 50)}\\\nend\t{j}\n")
    with open(p, "w") as f:
        f.write("".join(lines))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        recs = hits.scan_records(spark, ["file:" + p])
        assert recs.rdd.getNumPartitions() > 5
        rows = recs.select(F.transform(tsv.split_fields(F.col("value")), tsv.decode_field).alias("f")).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    got = sorted((r.f[0], r.f[1]) for r in rows)
    want = sorted((f"id{j}\ncontinued {'x' * (j % 50)}\nend", str(j)) for j in range(3000))
    assert got == want


def test_join_off_keeps_physical_lines(spark, tmp_path):
    path = os.path.join(str(tmp_path), "01-x.tsv.gz")
    write_gz(path, "a\\\nb\tc\n")
    assert _records(spark, "file:" + path, join_lines=False) == [["a\\"], ["b", "c"]]


def test_sql_decoder_equals_column_decoder(spark):
    fields = [f for text, _ in CASES for line in text.split("\n") for f in line.split("\t")]
    fields += ["'quoted'", "a\\\\\\nb", "  \\t  ", " x ", "\x01a\x1f", "\\", "\\\\", "\\\n"]
    df = spark.createDataFrame([(f,) for f in fields], "f string")
    rows = df.select(
        tsv.decode_field(F.col("f")).alias("a"), F.expr(tsv.decode_field_sql("f")).alias("b")
    ).collect()
    assert all(r.a == r.b for r in rows), [(r.a, r.b) for r in rows if r.a != r.b]


def test_bzip2_hits_with_continuations(spark, tmp_path):
    import bz2

    p = os.path.join(str(tmp_path), "01-b.tsv.bz2")
    text = "".join(f"id{j}\\\nmore {j}\t{j}\n" for j in range(2000))
    with open(p, "wb") as f:
        f.write(bz2.compress(text.encode()))
    recs = hits.scan_records(spark, ["file:" + p])
    rows = recs.select(F.transform(tsv.split_fields(F.col("value")), tsv.decode_field).alias("f")).collect()
    assert sorted((r.f[0], r.f[1]) for r in rows) == sorted((f"id{j}\nmore {j}", str(j)) for j in range(2000))


def _split_scan(spark, path, split_bytes):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split_bytes))
    try:
        recs = hits.scan_records(spark, ["file:" + path])
        return recs, [r.value for r in recs.collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def _in_order(text):
    """Records of a text, read from the front."""
    records, open_ = [], False
    lines = text.split("\n")
    lines = lines[:-1] if lines[-1] == "" else lines
    for line in lines:
        if open_:
            records[-1] += "\n" + line
        else:
            records.append(line)
        open_ = (len(line) - len(line.rstrip("\\"))) % 2 == 1
    if open_:
        records[-1] = records[-1][:-1]
    return [r for r in records if r.strip("".join(map(chr, range(33)))) or "\t" in r]


SPLIT_TEXTS = {
    "every cut": "".join(f"r{j}\\\nmore\\\\\\\n{'y' * (j % 7)}\t{j}\n\\\\\n" for j in range(120)),
    "one record over many splits": "a\t1\n" + "x\\\n" * 900 + "end\t2\nb\t3\n",
    "runs of backslashes": "a" + "\\" * 301 + "\nb\t1\n" + "\\" * 400 + "\nc\t2\n" + "\\" * 333 + "\nd\t3\n",
    "long lines": "k\t" + "z" * 2000 + "\\\n" + "z" * 1500 + "\nq\t1\n",
    "open at the end": "a\t1\n" * 250 + "b\\\n" * 80,
    "open at the end, no newline": "a\t1\n" * 250 + "b\\\nüñ\\",
    "no newline at the end": "a\t1\n" * 250 + "b\\\n" * 80 + "c",
}


@pytest.mark.parametrize("name", SPLIT_TEXTS)
@pytest.mark.parametrize("split_bytes", [61, 128])
def test_records_over_split_ends_are_read_on(spark, tmp_path, name, split_bytes, monkeypatch):
    monkeypatch.setattr(hits, "READ_ON_BYTES", 16)
    path = os.path.join(str(tmp_path), "01-%41 b.tsv")
    with open(path, "wb") as f:
        f.write(SPLIT_TEXTS[name].encode())
    old = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        recs, got = _split_scan(spark, path, split_bytes)
        assert recs.rdd.getNumPartitions() > 5
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", old)
    assert got == _in_order(SPLIT_TEXTS[name])


def test_plain_files_are_scanned_once(spark, tmp_path):
    path = os.path.join(str(tmp_path), "01-x.tsv")
    with open(path, "w") as f:
        f.write("a\\\nb\t1\n")
    plan = hits.scan_records(spark, ["file:" + path])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan text") == 1 and plan.count("MapInArrow") == 1 and "Exchange" not in plan
    assert not hits.reads_on(["file:/x/a.tsv"], "Shift_JIS") and not hits.reads_on(["nostore://x/a.tsv"], "UTF-8")
    assert not hits.reads_on(["file:/x/a.tsv.bz2"], "UTF-8") and hits.reads_on(["file:/x/a.tsv"], "ISO-8859-1")
