"""The corpus operators against brute force, on small fixtures with nulls, ties, repeats and clashing names."""

from __future__ import annotations

import hashlib
import html
import re
import time
import zlib

import numpy as np
import public_tokenizers
import pytest
import xxhash
from tokenizers import Tokenizer

from hitloom.llm import bpe, components, exactdup, htmltext, licences, mixing, simhash, toxicity, urls, vectors
from hitloom.llm.queries import URL_RULES

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
WORDS = "one two three four five six seven eight nine ten eleven twelve".split()


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def groups_by(n, links):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def some_texts(n=60, seed=0):
    random = np.random.default_rng(seed)
    out = []
    for i in range(n):
        text = " ".join(random.choice(WORDS, int(random.integers(1, 60))))
        out.append(text)
        if i % 4 == 0:
            out += [text, text + " One"]
    return [*out, None, "", "  ", "é ß\tX"]


# ---- exact dedup


def test_exact_groups(spark):
    texts = some_texts()
    docs = spark.createDataFrame([(i, t, "clash", 1) for i, t in enumerate(texts)], "doc_id long, text string, len string, size int")
    found = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in exactdup.group_copies(docs).collect()}
    for i, t in enumerate(texts):
        same = [j for j, u in enumerate(texts) if (u or "") == (t or "")]
        assert found[i] == (max(same), len(same), i == max(same))
    left = exactdup.drop_copies(docs)
    assert left.columns == docs.columns
    assert {r.doc_id for r in left.collect()} == {i for i, f in found.items() if f[2]}


def test_exact_repeats_nulls_and_empty(spark):
    docs = spark.createDataFrame([(5, "a"), (5, "a"), (None, "a"), (None, "b"), (None, "b"), (7, None)], "doc_id long, text string")
    kept = [(r.doc_id, r.text) for r in exactdup.drop_copies(docs).collect()]
    assert sorted(kept, key=str) == [(5, "a"), (7, None), (None, "b")]
    mixed = spark.createDataFrame([(5, "a"), (5, "b"), (7, "a"), (7, "c"), (8, "d"), (3, "d"), (3, "e")], "doc_id long, text string")
    assert sorted((r.doc_id, r.text) for r in exactdup.drop_copies(mixed).collect()) == [(3, "e"), (5, "b"), (7, "a"), (7, "c"), (8, "d")]
    assert exactdup.drop_copies(docs.limit(0)).count() == 0 and exactdup.group_copies(docs.limit(0)).count() == 0


# ---- components and SimHash


def test_components(spark):
    random = np.random.default_rng(3)
    links = [(int(a), int(b)) for a, b in random.integers(0, 300, (220, 2))] + [(400 + i, 401 + i) for i in range(70)] + [(500, 500 + i) for i in range(60)]
    found = {r.node: r.root for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    root = groups_by(600, links)
    assert found == {x: root[x] for a, b in links if a != b for x in (a, b)}


def fingerprint(text, width=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    if not words:
        return 0
    width = min(width, len(words))
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + width]).encode(), 42) for i in range(len(words) - width + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_groups(spark):
    texts = some_texts(40, 1)
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, fp string")
    prints = [fingerprint(t) for t in texts]
    root = groups_by(len(texts), [(i, j) for i in range(len(texts)) for j in range(i) if bin(prints[i] ^ prints[j]).count("1") <= 2])
    found = {r.doc_id: (r.fp % 2**64, r.component_id) for r in simhash.near_groups(docs).collect()}
    assert found == {i: (prints[i], root[i]) for i in range(len(texts))}
    assert {r.doc_id for r in simhash.keep_one(docs).collect()} == set(root)
    assert simhash.keep_one(docs.limit(0)).count() == 0


@pytest.mark.parametrize("unit_rows", [1024, 4])
def test_trie_links_of_a_dense_cluster(spark, monkeypatch, unit_rows):
    monkeypatch.setattr(simhash, "UNIT_ROWS", unit_rows)
    random = np.random.default_rng(5)
    base, prints = int(random.integers(0, 2**63)), set()
    for _ in range(60):
        x = base
        for b in random.integers(0, 64, int(random.integers(0, 5))):
            x ^= 1 << int(b)
        prints.add(x)
    prints = sorted(prints | {int(x) for x in random.integers(0, 2**63, 40)})
    rows = [(x - 2**64 if x >= 2**63 else x,) for x in prints]
    links = simhash.links(spark.createDataFrame(rows, "fp long"), 2).collect()
    place = {x: i for i, x in enumerate(prints)}
    found = groups_by(len(prints), [(place[r.a % 2**64], place[r.b % 2**64]) for r in links])
    true = [(i, j) for i in range(len(prints)) for j in range(i) if bin(prints[i] ^ prints[j]).count("1") <= 2]
    assert all(bin(r.a ^ r.b & (2**64 - 1)).count("1") >= 0 for r in links) and found == groups_by(len(prints), true)


# ---- toxicity


def test_field_finds_spans():
    random = np.random.default_rng(0)
    plain = [f"word{i}" for i in range(200)]
    make = lambda bad: " ".join([*random.choice(plain, 20), *(["gruntling", "gruntly"] if bad else []), *random.choice(plain, 20)])
    texts = [make(i % 2) for i in range(400)]
    field = toxicity.train(texts, [i % 2 for i in range(400)])
    marks = toxicity.marginals([toxicity.emissions(toxicity.WORD.findall(t), field, {}) for t in [make(True), make(False), ""]], field)
    assert marks[0][20:22].min() > 0.5 and np.delete(marks[0], [20, 21]).max() < 0.5 and marks[1].max() < 0.5 and not len(marks[2])


def test_marginals_match_enumeration():
    random = np.random.default_rng(2)
    field = toxicity.Field(np.zeros(4, np.float32), random.normal(size=(2, 2)), 0.3, np.zeros(3))
    emits = [random.normal(size=n) for n in (1, 5, 0, 3)]
    for e, m in zip(emits, toxicity.marginals(emits, field)):
        total, on = 0.0, np.zeros(len(e))
        for code in range(2 ** len(e)):
            y = [code >> i & 1 for i in range(len(e))]
            w = np.exp(sum(a * b for a, b in zip(e, y)) + (field.start * y[0] if y else 0) + sum(field.pairs[a, b] for a, b in zip(y, y[1:])))
            total += w
            on += w * np.array(y)
        assert np.allclose(m, on / total if len(e) else on)


def test_score_table(spark):
    random = np.random.default_rng(0)
    texts = [" ".join([*random.choice(WORDS, 15), *(["nastyone"] if i % 2 else [])]) for i in range(200)] + [None, ""]
    docs = spark.createDataFrame([(i, t, 0.5) for i, t in enumerate(texts)], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, toxic int")
    rows = {r[0]: r for r in toxicity.score(docs, toxicity.fit(docs, labels)).collect()}
    held = [i for i in range(200) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert sum(rows[i]["predicted"] == i % 2 for i in held) >= 0.95 * len(held)
    assert rows[200]["predicted"] == rows[201]["predicted"] == 0 and rows[0]["score"] == 0.5 and 0 <= rows[0]["_score"] <= 1
    span = rows[1]["spans"][-1]
    assert texts[1][span["start"] : span["end"]] == "nastyone"
    assert toxicity.score(docs.limit(0), toxicity.train([], [])).count() == 0


# ---- mixing


def water(sizes, weights):
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {n: weights[i % len(weights)] for i, n in enumerate(names)}
    rest, free, out = sum(sizes.values()), set(names), {}
    while free:
        total = sum(weight[n] for n in free)
        over = {n for n in free if rest * weight[n] / total > 3 * sizes[n]}
        if not over:
            out |= {n: rest * weight[n] / total for n in free}
            break
        for n in over:
            out[n] = 3.0 * sizes[n]
        rest -= sum(out[n] for n in over)
        free -= over
    return out


@pytest.mark.parametrize("shard_words", [16_000_000, 300])
def test_mix(spark, monkeypatch, shard_words):
    monkeypatch.setattr(mixing, "SHARD_WORDS", shard_words)
    monkeypatch.setattr(mixing, "BLOCK_DOCS", 8)
    random = np.random.default_rng(4)
    rows = [(i, " ".join(random.choice(WORDS, int(random.integers(1, 20)))), ["a", "b", "b", "b", None, "c"][i % 6], "t") for i in range(400)]
    rows += [(400, None, "c", "t"), (401, "", "void", "t"), (402, "x", "tiny", "t")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, target string")
    plan = mixing.plan_mix(docs)
    found = mixing.allot(docs, plan).collect()
    sizes = {}
    for _, t, s, _ in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    targets, taken = water(sizes, (1, 2, 3)), {}
    for r in found:
        n = len((r.text or "").split())
        assert len(r.copies) <= 3 or n == 0
        assert r.source_size == sizes[r.source] and r._target == pytest.approx(targets[r.source])
        taken[r.source] = taken.get(r.source, 0) + n * len(r.copies)
    assert all(abs(taken[s] - targets[s]) <= 10 for s in sizes)
    mixed = mixing.mix(docs, plan)
    again = mixing.mix(docs, mixing.plan_mix(docs))
    key = lambda d: sorted((r.doc_id, r.shard) for r in d.collect())
    assert key(mixed) == key(again) == sorted((r.doc_id, c.shard) for r in found for c in r.copies)
    assert mixing.allot(docs.limit(0), mixing.plan_mix(docs.limit(0))).count() == 0


def test_quotas_are_exact(spark):
    quotas = spark.createDataFrame([(k, q) for k, q in enumerate([0, 1, 7, 1000, 40])], "k int, quota long")
    rows = mixing.split_quotas(quotas, 3, 9).collect()
    for k, q in enumerate([0, 1, 7, 1000, 40]):
        assert sum(r.quota for r in rows if r.k == k) == q
    assert {sum(r.quota for r in rows if r.shard == s) for s in range(8)} <= {130, 131, 132}


# ---- HTML


def test_pages(spark):
    text = "First &amp; second sentence, with enough words. And another one, to be sure."
    page = f'<html><head><title>T</title><script>x="<p>"</script></head><body><nav><a href=#>Menu</a></nav><div class="ad">Buy, now.</div><article><h1>Head</h1><p><b>{text}<br><p>Two\n  lines.</p></article><div id="comments"><p>Nice, really nice.</p></div><footer>&copy; x</footer>'
    pages = spark.createDataFrame([(1, page, "t"), (2, None, "t"), (3, "", "t")], "page_id long, html string, text string")
    trees = htmltext.train([page] * 20)
    found = {r.page_id: r._text for r in htmltext.extract(pages, trees).collect()}
    assert found == {1: f"Head\n{html.unescape(text)}\nTwo lines.", 2: "", 3: ""}
    assert htmltext.extract(pages.limit(0), trees).count() == 0


def test_broken_pages_take_linear_time():
    started = time.perf_counter()
    nested = "".join(f"<x{i}>" for i in range(60_000))
    for page in (
        "<a b='" * 170_000, "<a b='\"" * 140_000, "<a<a" * 250_000, "<b>" * 100_000 + "<hr>" * 100_000, nested + "</q>" * 100_000, "<b><body>" * 60_000,
        "<script" * 140_000, "<script></script " * 60_000, "<span><td>" * 50_000, "&#" + "9" * 1_000_000 + ";",
    ):
        htmltext.parse(page)
    assert time.perf_counter() - started < 40  # quadratic work takes hours


def test_tag_ends_equal_a_plain_walk():
    random = np.random.default_rng(4)
    for _ in range(3000):
        page = "".join(random.choice(list("<a '\">="), 30))
        ends = htmltext.TagEnds(page)
        for start in sorted(random.integers(0, 30, 4)):
            at, quote = int(start), ""
            while at < len(page) and (quote or page[at] != ">"):
                quote = ("" if page[at] == quote else quote) if quote else (page[at] if page[at] in "'\"" else "")
                at += 1
            assert ends.end(int(start)) == (at + 1 if at < len(page) else -1)


def test_pages_keep_formulas_drawings_and_odd_references(spark):
    words = "A sentence of the article, with enough words. And another one, to be sure."
    body = f"<p>{words}</p>" * 4
    page = f"<html><body><nav><a href=#>Menu</a></nav><article>{body}<p>{words} a <math><mi>x</mi><annotation>\\tex</annotation></math> b</p><p>&#{'7' * 6000}; &#{'0' * 6000}65; <svg><title>t</title><text>label</text></svg> 1 < 2, <a b='c</p></article>"
    pages = spark.createDataFrame([(1, page), (1, page), (2, page + "y" * 300_000)], "page_id long, html string")
    trees = htmltext.train(["<html><body><nav><a href=#>Menu</a></nav><article>" + body + "</article>"] * 20)
    found = [(r.page_id, r.text) for r in htmltext.extract(pages, trees).collect()]
    last = "\ufffd A label 1 < 2, <a b='c"
    want = "\n".join([words] * 4 + [f"{words} a x b", last])
    assert sorted(found) == [(1, want), (1, want), (2, want + "\n" + "y" * 300_000)]


def test_generated_frames_and_decoding():
    random, pieces = np.random.default_rng(8), ["Some words, in a line.", "Others stand here. They go on, and on.", "Short one."]
    trees, right = htmltext.train([]), 0
    for _ in range(80):
        page, y = htmltext.frame_labels(htmltext.frame(pieces, random))
        kept = htmltext.decode(page, trees.odds(htmltext.features(page)))
        assert all(kept[p] for i, p in enumerate(page.parents) if kept[i] and p >= 0)
        right += htmltext.main_text(page, kept) == htmltext.main_text(page, y)
    assert right >= 72


# ---- BPE


def test_bpe_matches_the_library(spark):
    library = Tokenizer.from_file(VOCABULARY)
    texts = ["Hello, world's BEST don't", "İΣΑΣ ß ﬁ é 한글", "a<|endoftext|>b <|startoftext|>", "x²½ Ⅷ ५\x1cz\x85y", "", None, "  ", "aaaa" * 5000, "the cat " * 20000, "<|endoftext|"]
    docs = spark.createDataFrame([(i, t, "c") for i, t in enumerate([*texts, *some_texts(10)])], "doc_id long, text string, ids string")
    rows = bpe.digests(bpe.decode(bpe.encode(docs, VOCABULARY), VOCABULARY, ids_col="_ids"), ids_col="_ids").collect()
    for r in rows:
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        assert (r._ids, r.decoded, r.n_tokens) == (ids, text, len(ids))
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
    odd = spark.createDataFrame([([320, None, -1, 99999, 49407],), (None,), ([],)], "ids array<int>")
    assert [r.decoded for r in bpe.decode(odd, VOCABULARY).collect()] == ["a</w> <|endoftext|>", "", ""]
    assert bpe.encode(docs.limit(0), VOCABULARY).count() == 0
    both = bpe.round_trip(docs, VOCABULARY)
    assert sorted(both.collect(), key=str) == sorted(bpe.decode(bpe.encode(docs, VOCABULARY), VOCABULARY, ids_col="_ids").collect(), key=str)
    assert bpe.round_trip(docs, VOCABULARY, keep=["doc_id"]).columns == ["doc_id", "ids", "decoded"]
    assert bpe.round_trip(docs.limit(0), VOCABULARY).count() == 0


# ---- URLs


def test_urls(spark):
    cases = {
        "http://A.Example.ORG/es/1?x": ("a.example.org", "/es/1", "example.org/es/", "block"),
        "https://example.org/en/12": ("example.org", "/en/12", "example.org/en/1", "block"),
        "https://x.org": ("x.org", "", None, "allow"), "https://x.org/": ("x.org", "/", "org/", "allow"),
        "http://notexample.org/es/": ("notexample.org", "/es/", "org/", "allow"), "http://a.com/fr/casino": ("a.com", "/fr/casino", "com/fr/", "allow"),
        "http://casino-win.net/": ("casino-win.net", "/", None, "block"), "http://casinos.net/": ("casinos.net", "/", None, "allow"),
        "http://bet.net/bet": ("bet.net", "/bet", None, "allow"), "http://bet.net/WIN#": ("bet.net", "/WIN", None, "block"),
        "no scheme casino": ("", "", None, "block"), None: ("", "", None, "allow"), "": ("", "", None, "allow"),
    }
    pages = spark.createDataFrame([(u, "x") for u in cases], "url string, host string")
    rows = urls.filter_urls(pages, rules=URL_RULES).collect()
    assert {r.url: (r._host, r.path, r.rule, r.verdict) for r in rows} == cases
    assert urls.filter_urls(pages.limit(0)).count() == 0


# ---- vectors


@pytest.mark.parametrize("cell_rows", [1024, 16])
def test_vectors(spark, monkeypatch, cell_rows):
    monkeypatch.setattr(vectors, "CELL_ROWS", cell_rows)
    monkeypatch.setattr(vectors, "BLOCK_ROWS", 8)
    random = np.random.default_rng(6)
    centres = random.normal(size=(40, 16))
    near = [c + random.normal(size=16) * 0.03 for c in centres for _ in range(4)] + [centres[0] * 2, centres[0] * 2]
    all_rows = [v.tolist() for v in np.concatenate([near, random.normal(size=(100, 16))])]
    odd = [None, [0.0] * 16, [float("nan")] * 16, [None] * 16, []]
    rows = [(i, v, "x") for i, v in enumerate([*all_rows, *odd])]
    found = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in vectors.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, size string")).collect()}
    x = np.array(all_rows)
    x /= np.linalg.norm(x, axis=1)[:, None]
    linked = x @ x.T >= 0.95
    np.fill_diagonal(linked, False)
    root = groups_by(len(x), list(zip(*np.nonzero(linked))))
    n = sum(found[i][0] for i in range(len(x)))
    assert 0.98 * linked.sum() <= n <= linked.sum() and linked.sum() > 200
    assert all(found[i][0] <= linked[i].sum() and found[i][2] == (found[i][1] == i) for i in range(len(x)))
    assert sum(found[i][1] == root[i] for i in range(len(x))) >= 0.97 * len(x)
    assert all(found[len(x) + i] == (0, len(x) + i, True) for i in range(len(odd)))


# ---- licences


def test_licences(spark):
    texts = [
        "Licensed under the Apache License, Version 2.0.", "x CC BY y cc-by 4.0 General  Public\nLicense", "Released under the MIT License. All rights reserved.",
        "This work is licensed under the GNU General Public License, version 3.", "Licensed under CC BY-NC 4.0.", "nothing here", None, "", "license " * 5000, "cc by " * 3000,
    ]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, labels string")
    rows = {r.doc_id: r for r in licences.scan(docs).collect()}
    for i, t in enumerate(texts):
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))
        places = [(p, label) for phrase, label in licences.BASE_PHRASES.items() for p in range(len(words)) if words[p : p + len(phrase.split())] == phrase.split()]
        r = rows[i]
        assert (r.n_words, r.n_base) == (len(words), len(places))
        assert (r.first_word, r.last_word) == (min((p for p, _ in places), default=None), max((p for p, _ in places), default=None))
        assert r.base_labels == ",".join(sorted({x for _, x in places})) and set(r.base_labels.split(",")) <= set(r._labels.split(",")) | {""}
    assert [rows[i]._labels for i in range(8)] == ["apache-2.0", "cc-by,gpl", "mit,reserved", "gpl", "cc-by,cc-by-nc", "", "", ""]
    assert rows[0].score == 1.0 and rows[5].score == 0.0
    assert licences.scan(docs.limit(0)).count() == 0
