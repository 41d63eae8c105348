"""The licence scan against a scan of every template at every place."""

from __future__ import annotations

import random
import re

from hitloom.llm import licences


def brute(text, templates):
    words = re.findall(licences.WORD, "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    found = set()
    for label, template, key in templates:
        t, k = template.split(), key.split()
        at = next(i for i in range(len(t)) if t[i : i + len(k)] == k)
        for s in range(-len(t), len(words)):
            if s + at >= 0 and words[s + at : s + at + len(k)] == k:
                share = sum(0 <= s + i < len(words) and words[s + i] == w for i, w in enumerate(t)) / len(t)
                if share >= licences.NEEDED:
                    found.add((label, s, round(share, 9)))
    return found


def _compare(spark, texts, templates=licences.TEMPLATES):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    for r in licences.scan(docs, templates=templates).collect():
        want = brute(texts[r.doc_id], templates)
        assert {(f.label, f.start, round(f.share, 9)) for f in r.found} == want, texts[r.doc_id]
        assert set(filter(None, r.labels.split(","))) == {x[0] for x in want} | set(filter(None, r.base_labels.split(",")))


def test_every_template_at_every_place(spark):
    rng = random.Random(2)
    whole = [t for _, t, _ in licences.TEMPLATES]
    words = sorted({w for t in whole for w in t.split()}) + ["und", "der", "x1"]
    five = [t for label, t, _ in licences.TEMPLATES if label in ("apache-2.0", "mit", "bsd", "mpl-2.0", "isc")]
    texts = ["\n\n".join(five), " ".join(whole), " ".join(reversed(whole)), None, "", "license " * 3000, "cc by nc " * 500]
    for _ in range(150):
        parts = []
        for _ in range(rng.randrange(1, 6)):
            t = rng.choice(whole).split()
            for _ in range(rng.choice([0, 0, 1, 3, 6])):
                t[rng.randrange(len(t))] = rng.choice(words)
            parts += [*t[rng.choice([0, 0, 2]) :], *rng.choices(words, k=rng.randrange(4))]
        texts.append(" ".join(parts))
    _compare(spark, texts)


def test_keys_of_one_word_and_repeated_words(spark):
    templates = [("one", "alpha beta gamma", "beta"), ("twice", "la la land la", "la la"), ("solo", "omega", "omega")]
    _compare(spark, ["alpha beta gamma", "beta beta gamma", "la la land la la la", "la", "omega omega", "la la la la", "gamma"], templates)
