"""Registered queries of the corpus operators: each applies one operator to its whole table."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hitloom.llm import bpe, exactdup, htmltext, idcodec, lexical, licences, mixing, prefixtrie, secretscan, simhash, toxicity, urls, vectors
from hitloom.session import work_dir

VOCABULARY = "word_bpe_49k.json"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of documents: 3-word shingles, 2 differing bits."""
    groups = simhash.near_groups(_table(spark, sf_dir, "documents"), words_per_shingle=3, max_distance=2)
    return groups.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    field = toxicity.fit(docs, _table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    scored = toxicity.score(docs, field)
    return scored.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


END_ID = 2


def op3_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document written as coded blocks and read back."""
    folder = work_dir(spark, "llm", f"ids-{uuid.uuid4().hex}")
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    idcodec.write_ids(docs, folder, public_tokenizers.path(VOCABULARY), END_ID)
    return idcodec.read_index(spark, folder).select("doc_id", "start", "n_tokens", "ids_crc32")


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often the mix takes every document."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    plan = mixing.plan_mix(docs)
    rows = mixing.allot(docs.withColumn("size", mixing.word_count(F.col("text"))), plan)
    taken = (F.col("size") * F.size("copies")).alias("taken")
    shards = F.array_join(F.array_sort(F.col("copies.shard")), ",").alias("shards")
    return rows.select("doc_id", "size", "source_size", "target", taken, shards)


def op5_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", "html")
    texts = htmltext.extract(pages, htmltext.fit(pages))
    return texts.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document and the text that they decode to, as digests."""
    vocabulary = public_tokenizers.path(VOCABULARY)
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.digests(bpe.round_trip(docs, vocabulary, keep=["doc_id"])).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


# The rules of the URL query (verdict, host, path).
URL_RULES = [
    ("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"), ("block", "com", "/de/"),
]


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's URL."""
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    return urls.filter_urls(pages, rules=URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op8_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of vectors: cosine 0.95 or more."""
    return vectors.near_vectors(_table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), threshold=0.95)


def op9_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases and labels of every document."""
    found = licences.scan(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal documents, with the digest of every text."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    docs = docs.withColumn("text_sha256", F.sha2(F.coalesce("text", F.lit("")), 256))
    return exactdup.group_copies(docs, carry=("text_sha256",))


def op11_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document: fixed patterns and tokens that pass for random."""
    found = secretscan.scan(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_random")


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the trie of the rebuilt conversations."""
    return prefixtrie.conversation_trie(_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best documents of each benchmark item."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return lexical.search(docs, _table(spark, sf_dir, "benchmark").select("item_id", "text"), top=20)


QUERIES = {f.__name__: f for f in [
    op1_simhash, op2_toxicity, op3_token_ids, op4_mixing, op5_main_text, op6_bpe, op7_url_filter, op8_embeddings, op9_licences, op10_exact_dedup,
    op11_secrets, op12_conversation_trie, op13_lexical_search,
]}


def _term(term: str) -> str:
    return f"CAST(regexp_matches(u, '(^|[^[:alnum:]]){term}($|[^[:alnum:]])') AS INTEGER)"


def _url_sql() -> str:
    fits = [
        f"WHEN (host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{path}') THEN {{}}"
        for _, host, path in sorted(URL_RULES, key=lambda r: -len(r[1] + r[2]))
    ]
    ordered = sorted(URL_RULES, key=lambda r: -len(r[1] + r[2]))
    rule = " ".join(f.format(f"'{h}{p}'") for f, (_, h, p) in zip(fits, ordered))
    verdict = " ".join(f.format(f"'{v}'") for f, (v, _, _) in zip(fits, ordered))
    strict, soft = " + ".join(map(_term, urls.STRICT_TERMS)), " + ".join(map(_term, urls.SOFT_TERMS))
    weight = " + ".join(f"{w} * {_term(t)}" for t, w in urls.SOFT_TERMS.items())
    lowered = f"translate(coalesce(url, ''), '{urls._UPPER}', '{urls._LOWER}')"
    return (
        f"WITH p AS (SELECT page_id, {lowered} AS u, "
        f"translate(regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)', 1), '{urls._UPPER}', '{urls._LOWER}') AS host, "
        "regexp_extract(coalesce(url, ''), '^(?s:.*?)://[^/?#]*([^?#]*)', 1) AS path FROM pages) "
        f"SELECT page_id, host, path, CASE {rule} ELSE NULL END AS rule, "
        f"CASE {verdict} WHEN ({strict}) > 0 OR (({soft}) >= {urls.SOFT_NEEDED} AND ({weight}) >= {urls.SOFT_WEIGHT}) THEN 'block' ELSE 'allow' END AS verdict FROM p"
    )


# CRC-32 of the decimal conv_id, a byte and then eight shifts at a time.
_CRC = (
    "xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), flatten(list_transform("
    "string_split(CAST(conv_id AS VARCHAR), ''), lambda ch: [CAST(ord(ch) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))), "
    "lambda acc, x: CASE WHEN x >= 0 THEN xor(acc, x) WHEN acc % 2 = 1 THEN xor(acc // 2, 3988292384) ELSE acc // 2 END))"
)

_TRIE_SQL = rf"""
WITH own AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), md5(coalesce(text, ''))) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (SELECT conv_id, {_CRC} % 4 AS h FROM (SELECT DISTINCT conv_id FROM own)),
rebuilt AS (SELECT c.conv_id, o.pos, o.role, o.text FROM convs c JOIN own o ON o.conv_id = c.conv_id - c.conv_id % 20 AND o.pos <= c.h
  UNION ALL SELECT c.conv_id, o.pos, o.role, o.text FROM convs c JOIN own o ON o.conv_id = c.conv_id AND o.pos > c.h),
turns AS (SELECT conv_id, row_number() OVER w AS depth, md5(concat(strlen(role), ':', role, text)) AS digest,
  len(regexp_extract_all(text, '[^ 	-
]+')) AS words FROM rebuilt WINDOW w AS (PARTITION BY conv_id ORDER BY pos)),
paths AS (SELECT conv_id, depth, words, string_agg(digest, '') OVER (PARTITION BY conv_id ORDER BY depth) AS path FROM turns
  UNION ALL SELECT conv_id, 0, 0, '' FROM convs),
ends AS (SELECT conv_id, max(depth) AS depth FROM paths GROUP BY 1),
nodes AS (SELECT p.depth, p.path, min(p.conv_id) AS conv_id, count(*) AS n_convs, any_value(p.words) AS words,
  sha256(coalesce(string_agg(CAST(e.conv_id AS VARCHAR), ',' ORDER BY e.conv_id), '')) AS ends_sha256
  FROM paths p LEFT JOIN ends e ON e.conv_id = p.conv_id AND e.depth = p.depth GROUP BY 1, 2),
kids AS (SELECT path[:-33] AS path, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1),
full_nodes AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM nodes n LEFT JOIN kids USING (path)),
sums AS (SELECT p.path, sum(CASE WHEN n.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((n.n_convs - 1) * n.words) AS saved_tokens
  FROM full_nodes n JOIN paths p ON p.conv_id = n.conv_id AND p.depth <= n.depth GROUP BY 1)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, up.conv_id AS parent_conv_id, CAST(n.n_convs AS BIGINT) AS n_convs,
  CAST(n.n_children AS BIGINT) AS n_children, CAST(s.n_leaves AS BIGINT) AS n_leaves, CAST(s.saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM full_nodes n JOIN sums s USING (path) LEFT JOIN nodes up ON n.depth > 0 AND up.path = n.path[:-33]
"""

_LOWERED_TERMS = (
    f"unnest(regexp_extract_all(translate(coalesce(text, ''), '{urls._UPPER}', '{urls._LOWER}'), "
    r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term"
)

_SEARCH_SQL = f"""
WITH d AS (SELECT doc_id, {_LOWERED_TERMS} FROM documents), i AS (SELECT item_id, {_LOWERED_TERMS} FROM benchmark),
q AS (SELECT item_id, term, count(*) AS reps FROM i GROUP BY ALL),
n AS (SELECT doc_id, count(*) AS n FROM d GROUP BY ALL),
g AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM n),
f AS (SELECT doc_id, term, count(*) AS tf FROM d SEMI JOIN q USING (term) GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w FROM f, g GROUP BY term, docs),
s AS (SELECT item_id, doc_id, CAST(sum(reps * w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + ((25 * n * docs) // terms))))) AS BIGINT) AS score
  FROM f JOIN q USING (term) JOIN w USING (term) JOIN n USING (doc_id), g GROUP BY ALL),
r AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 20
"""

ORACLES = {
    "op12_conversation_trie": _TRIE_SQL,
    "op13_lexical_search": _SEARCH_SQL,
    "op7_url_filter": _url_sql(),
    "op10_exact_dedup": (
        "SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, "
        "doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256 "
        "FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))"
    ),
}
