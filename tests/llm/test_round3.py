"""Secret scan, conversation trie and lexical search against brute force, and their defined results."""

from __future__ import annotations

import hashlib
import math
import random
import re
import string
from collections import Counter, defaultdict

import numpy as np
import pytest

from hitloom.llm import lexical, prefixtrie, queries, secretscan

SF = "/root/testdata/sf0.001"


# ------------------------------------------------------------------------------- secrets

_ASSIGN = re.compile(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def brute_spans(text):
    """The contract's base patterns, lengths looked at after matching."""
    found = [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [("access", m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found, key=lambda s: (s[1], ["assign", "access", "hex"].index(s[0])))


def test_base_spans_equal_the_patterns():
    rng = random.Random(3)
    pieces = [
        "password", "PassWd", "secret", "TOKEN", "api_key", "apikey", "toKen", "ſecret", '"', "'", " ", ":", "=", "AKIA", "AKIAB", "ABCDEF0123456789",
        "0123456789abcdef", "deadbeef", "x", "é", "\n", "abc123", "....", "=", "\t", "\U0001f600",
    ]
    for _ in range(3000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randrange(14)))
        assert [(k, s, e) for s, e, k in secretscan.base_spans(text)] == brute_spans(text), text


def _prose(rng, words):
    return " ".join("".join(rng.choice("etaoinshrdlu") for _ in range(rng.randrange(2, 9))) for _ in range(words))


def _planted(rng):
    alphabet = rng.choice(["0123456789ABCDEF", string.ascii_letters + string.digits, string.ascii_letters + string.digits + "+/"])
    return "".join(rng.choice(alphabet) for _ in range(rng.choice([40, 44, 64])))


def test_battery_finds_planted_tokens_and_leaves_ordinary_ones(spark):
    rng = random.Random(5)
    rows, planted = [], {}
    for i in range(300):
        text = _prose(rng, 120)
        if i % 5 == 0:
            secret = _planted(rng)
            planted[i] = secret
            text = f"{text} ({secret}) {_prose(rng, 5)}"
        if i % 7 == 0:  # long, but ordinary or regular
            text += " " + rng.choice(["a" * 40, "ab" * 20, "-" * 60, "0123456789" * 4, "theinternationalisationofthings", "4929963689861572"])
        rows.append((i, text))
    got = {r.doc_id: r for r in secretscan.scan(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    hits = {(i, rows[i][1][s.start : s.end]) for i, r in got.items() for s in r.secrets if s.kind == "random"}
    false = {h for h in hits if planted.get(h[0]) != h[1]}
    assert len(hits - false) >= 0.9 * len(planted) and len(false) <= 0.02 * len(hits) + 1, (len(planted), false)
    for i, r in got.items():
        base = brute_spans(rows[i][1])
        assert r.base_sha256 == hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in base).encode()).hexdigest()
        assert [x for x in r.spans.split(",") if x and not x.startswith("random")] == [f"{k}:{s}:{e}" for k, s, e in base]


def test_deviations_against_plain_formulas():
    rng = np.random.default_rng(1)
    size, n = 36, 50
    rows = rng.integers(0, size, (40, n))
    rows[0] = 7
    rows[1] = np.arange(n) % size
    got = secretscan.deviations(rows, size)
    for row, z in zip(rows.tolist(), got):
        cells = n // 5
        seen, share = Counter(v * cells // size for v in row), Counter(v * cells // size for v in range(size))
        chi = sum((seen[c] - n * share[c] / size) ** 2 / (n * share[c] / size) for c in range(cells))
        df = cells - 1
        tests = [((chi / df) ** (1 / 3) - (1 - 2 / (9 * df))) / math.sqrt(2 / (9 * df))]
        up = [v >= size / 2 for v in row]
        a, b = sum(up), n - sum(up)
        mu = 2 * a * b / n
        var = mu * (mu - 1) / (n - 1)
        tests.append(abs(sum(x != y for x, y in zip(up, up[1:])) - mu) / math.sqrt(var) if var > 0 else 16)
        mean = sum(row) / n
        power = sum((v - mean) ** 2 for v in row)
        lag = sum((x - mean) * (y - mean) for x, y in zip(row, row[1:]))
        tests.append(abs(lag / power + 1 / n) * math.sqrt(n) if power else 16)
        assert z == pytest.approx(max(tests)), row


def test_thresholds_keep_false_finds_below_the_rate():
    cell = lambda c, k, b: int(secretscan._cell(c, k, b))
    tokens = {cell(3, 1, 2): 50, cell(3, 6, 2): 50, cell(3, 0, 63): 100}
    plain = {cell(3, 6, 2): 500, cell(3, 4, 60): 9_499}
    best = np.array(secretscan.thresholds(tokens, plain, 0.1)).reshape(len(secretscan.CLASSES), -1)
    assert best[3, 1] >= 2 and best[3, 6] == -1  # base 62 of that score: 200 x 501 / 10,000 false finds of 50
    assert (np.array(secretscan.thresholds(tokens, {}, 0.1)) == -1).all()


def test_secrets_defined_results(spark):
    schema = "doc_id bigint, text string, base string, spans string, tokens int"
    rows = [(1, None, "b", "s", 1), (2, "", None, None, None), (None, "token=abcdef", "x", "y", 2), (3, "token=abcdef", "x", "y", 2), (3, "token=abcdef", "x", "y", 2)]
    rows.append((4, "wort " * 400_000 + "0123456789abcdef01234567", None, None, None))
    got = secretscan.scan(spark.createDataFrame(rows, schema))
    assert got.columns[:4] == ["doc_id", "base", "spans", "tokens"]
    by = defaultdict(list)
    for r in got.collect():
        by[r.doc_id].append(r)
    empty = hashlib.sha256(b"").hexdigest()
    assert [by[1][0].base_sha256, by[2][0].base_sha256] == [empty, empty] and by[1][0].base == "b"
    assert len(by[3]) == 2 and by[3][0]._spans == by[None][0]._spans == "assign:0:12"
    assert by[4][0]._spans == "hex:2000000:2000024"
    assert secretscan.scan(spark.createDataFrame([], schema)).count() == 0


def test_pieces_do_not_change_the_counts():
    rng = random.Random(9)
    texts = [_prose(rng, rng.randrange(0, 400)) for _ in range(60)]
    whole = secretscan.judge(texts)[2]
    assert (whole == sum(secretscan.judge([t])[2] for t in texts)).all()


# ---------------------------------------------------------------------------------- trie

def brute_trie(rows):
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            convs[c].append((turn is not None, turn or 0, role or "", hashlib.md5((text or "").encode()).hexdigest(), text or ""))
    own = {c: [(t[2], t[4]) for t in sorted(v)] for c, v in convs.items()}
    rebuilt = {c: own.get(c - c % 20, [])[: prefixtrie.head_length(c)] + s[prefixtrie.head_length(c) :] for c, s in own.items()}
    members = defaultdict(list)
    for c, s in rebuilt.items():
        for i in range(len(s) + 1):
            members[tuple(s[:i])].append(c)
    children = Counter(k[:-1] for k in members if k)
    leaves, saved = Counter(), Counter()
    for k, m in members.items():
        worth = (len(m) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", k[-1][1])) if k else 0
        for i in range(len(k) + 1):
            leaves[k[:i]] += children[k] == 0
            saved[k[:i]] += worth
    def ends(k, m):
        return hashlib.sha256(",".join(str(c) for c in sorted(m) if len(rebuilt[c]) == len(k)).encode()).hexdigest()
    return sorted(
        ((min(m), len(k), min(members[k[:-1]]) if k else None, len(m), children[k], leaves[k], saved[k], ends(k, m)) for k, m in members.items()), key=lambda r: r[:2]
    )


SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def _trie(spark, rows, shard_rows):
    got = prefixtrie.conversation_trie(spark.createDataFrame(rows, SCHEMA), shard_rows)
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted((tuple(r) for r in got.collect()), key=lambda r: r[:2])


@pytest.mark.parametrize("shard_rows", [200_000, 9])
def test_trie_equals_brute_force(spark, shard_rows):
    rng = random.Random(shard_rows)
    rows = []
    for c in [*range(0, 130), 400, 407, 413]:
        for t in range(rng.choice([0, 1, 2, 3, 5, 9]) if c % 20 else rng.choice([0, 1, 4])):
            rows.append((c, rng.choice([t, t, t, None]), rng.choice(["user", "assistant", None]), rng.choice(["", None, "ja nein", "a b c", "x " * 3])))
    rows += [(7, t, "user", "same " * (t % 3)) for t in range(60)]  # longer than a small shard
    rows += [(c, t, "user", f"again {t}") for c in range(500, 560, 20) for t in range(6)] + [(None, 0, "user", "nobody")] * 2
    rows += [(21, 0, "user", "twice")] * 2
    rng.shuffle(rows)
    assert _trie(spark, rows, shard_rows) == brute_trie(rows)


def test_trie_defined_results(spark):
    assert _trie(spark, [], 100) == []
    assert _trie(spark, [(None, 1, "a", "b")], 100) == []
    # Conversation 3 takes its head from conversation 0, which is absent: with h turns or fewer it has none.
    lone = next(c for c in range(1, 20) if prefixtrie.head_length(c) == 3)
    assert _trie(spark, [(lone, 0, "u", "x")], 100) == [(lone, 0, None, 1, 0, 1, 0, hashlib.sha256(str(lone).encode()).hexdigest())]
    long = "wort " * 300_000
    rows = [(20, 0, "u", long), (40, 0, "u", long), (40, 1, "u", None)]
    assert _trie(spark, rows, 100) == brute_trie(rows)


def test_slot_table_is_minimal_and_verified():
    rng = np.random.default_rng(4)
    keys = rng.integers(0, 2**63, (5000, 2)).astype(np.uint64)
    table = prefixtrie.SlotTable(np.concatenate([keys, keys[:1000]]))
    slots = table.find(keys)
    assert len(table) == 5000 and sorted(slots.tolist()) == list(range(5000))
    near = keys.copy()
    near[:, 1] ^= np.uint64(1)
    assert (table.find(near) == -1).all()


# ------------------------------------------------------------------------------- lexical

def brute_search(docs, items, top):
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    lower = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
    counted = [(d, Counter(pattern.findall((t or "").translate(lower)))) for d, t in docs]
    lengths = [sum(c.values()) for _, c in counted]
    n_docs, n_terms = sum(n > 0 for n in lengths), sum(lengths)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in items:
        scores = []
        for (d, c), n in zip(counted, lengths):
            score = 0
            for t in pattern.findall((text or "").translate(lower)):
                if c[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += w * ((1000000000 * c[t]) // (1000 * c[t] + 12 * (75 + (25 * n * n_docs) // n_terms)))
            if score > 0:
                scores.append((-score, d is None, d or 0))
        out += [(item, i + 1, None if none else d, -s) for i, (s, none, d) in enumerate(sorted(scores)[:top])]
    return sorted(out, key=str)


@pytest.mark.parametrize("bounds", [{}, {"block_terms": 6}, {"block_items": 1}])
def test_search_equals_brute_force(spark, bounds):
    rng = random.Random(11)
    words = ["the", "The", "THE", "a", "b1", "1b", "straße", "STRASSE", "ÉTÉ", "été", "x y", " ", "İ", "z_z", "q-r", "\U0001f600", "é"]
    make = lambda n: rng.choice([" ", ",", "\n", "--"]).join(rng.choice(words) for _ in range(n))
    docs = [(i, make(rng.randrange(0, 40))) for i in range(150)] + [(200, None), (201, ""), (202, " .,"), (None, "the été b1"), (7, "the été"), (7, "the été")]
    items = [(i, make(rng.randrange(0, 9))) for i in range(12)] + [(50, None), (51, "nowhere"), (None, "the a"), (3, "the a")]
    got = lexical.search(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string"), top=5, **bounds)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_search(docs, items, 5)


def test_search_defined_results(spark):
    docs, items = "doc_id bigint, text string, item int", "item_id string, text string, number int"
    none = lexical.search(spark.createDataFrame([], docs), spark.createDataFrame([("a", "b", 1)], items))
    assert none.collect() == [] and none.schema["item_id"].dataType.simpleString() == "string"
    some = spark.createDataFrame([(1, "b c", 2), (2, "c " * 500_000 + "b", 3)], docs)
    assert lexical.search(some, spark.createDataFrame([], items)).collect() == []
    assert [r.doc_id for r in lexical.search(some, spark.createDataFrame([("a", "b", 1)], items)).orderBy("rank").collect()] == [1, 2]


# ------------------------------------------------------------------------------- queries

KINDS = {
    "op11_secrets": "doc_id bigint,n_assign bigint,n_access bigint,n_hex bigint,base_sha256 string,spans string,n_random bigint",
    "op12_conversation_trie": "conv_id bigint,depth bigint,parent_conv_id bigint,n_convs bigint,n_children bigint,n_leaves bigint,saved_tokens bigint,ends_sha256 string",
    "op13_lexical_search": "item_id bigint,rank int,doc_id bigint,score bigint",
}


@pytest.mark.parametrize("name", sorted(KINDS))
def test_query_schemas(spark, name):
    df = queries.QUERIES[name](spark, SF)
    assert ",".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema) == KINDS[name]


def test_secret_query_against_brute_force(spark):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = queries.op11_secrets(spark, SF).collect()
    assert len(got) == len(texts)
    for r in got:
        base = brute_spans(texts[r.doc_id])
        kinds = Counter(k for k, *_ in base)
        assert (r.n_assign, r.n_access, r.n_hex) == (kinds["assign"], kinds["access"], kinds["hex"])
        assert r.base_sha256 == hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in base).encode()).hexdigest()


@pytest.mark.parametrize("name", ["op12_conversation_trie", "op13_lexical_search"])
def test_query_equals_its_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for table in ("documents", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF}/{table}.parquet')")
    df = queries.QUERIES[name](spark, SF)
    want = con.sql(queries.ORACLES[name])
    assert want.columns == df.columns
    assert sorted((tuple(r) for r in df.collect()), key=str) == sorted(want.fetchall(), key=str)
