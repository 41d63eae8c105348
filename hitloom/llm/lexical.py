"""Ranked lexical search: the items' terms, found in the text of every document by one automaton.

No index of the documents is made.  The terms of a block of items form an Aho-Corasick
automaton; every term stands between guards (a space), and so does every term of a
document's text, so an automaton hit is a whole term.  Its hits give each document's term
frequencies straight from the text, and the automaton's outputs (term numbers) lead to the
items that hold them.

1. One pass over the texts counts terms (N documents, L terms) and, per block, finds
   (term, tf) of each document; documents per term are summed in the tasks first.
2. With N, L and the documents per term known, each task scores its documents against the
   block's items (64-bit integers) and keeps its best ``top`` documents for each item; Spark
   ranks the tasks' lists.

The vocabulary is cut into blocks of at most ``BLOCK_TERMS`` distinct terms or
``BLOCK_ITEMS`` items (an item with more terms is a block of its own), so what a
task receives has a fixed bound however many items there are.  Every document meets every block.

Defined results
    null and empty texts have no term and are not counted in N; items without terms have
    no result; repeated documents are ranked each for itself, equal scores by ascending
    doc_id (null last); rows of items are items, repeated ones too; empty tables give an empty
    result; whole texts are read whatever their length; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hitloom.llm.common import drop_stored, ship, store, worker_keeps

ship(__name__)

#: Bounds of one block of items: distinct terms and items.
BLOCK_TERMS = 50_000
BLOCK_ITEMS = 5_000
#: Texts are taken in parts of about this many bytes.
PART_BYTES = 4_000_000

_UPPER, _LOWER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"
_SEPARATORS = bytes(b for b in range(128) if not chr(b).isalnum())
_GUARDED = bytes.maketrans(_SEPARATORS + _UPPER, b" " * len(_SEPARATORS) + _LOWER)


def guarded(text: str) -> bytes:
    """``text`` with A-Z lower-cased and a space for each ASCII character that no term holds."""
    return b" %b " % text.encode("utf-8", "replace").translate(_GUARDED)


def terms(text: str) -> list[str]:
    return [t.decode() for t in guarded(text).split()]


class ItemBlock:
    """Items of a block: the automaton's vocabulary, and for each term the items that hold it."""

    def __init__(self, items: list[tuple[int, str]]):
        """``items``: (row number, text)."""
        self.rows = [row for row, _ in items]
        counted = [Counter(terms(text)) for _, text in items]
        self.vocabulary = sorted(set().union(*counted)) if counted else []
        number = {t: i for i, t in enumerate(self.vocabulary)}
        pairs = sorted((number[t], i, n) for i, c in enumerate(counted) for t, n in c.items())
        self.item = np.array([i for _, i, _ in pairs], np.int64)
        self.repeats = np.array([n for *_, n in pairs], np.int64)
        held = np.bincount([t for t, *_ in pairs], minlength=len(self.vocabulary)) if pairs else np.zeros(0, np.int64)
        self.first = np.concatenate([[0], np.cumsum(held)]).astype(np.int64)

    def automaton(self) -> ahocorasick.Automaton:
        found = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for i, term in enumerate(self.vocabulary):
            found.add_word(f" {term} ", i)
        if len(found):
            found.make_automaton()
        return found


def cut_blocks(items: Iterator[tuple[int, str]], most_terms: int, most_items: int) -> Iterator[list[tuple[int, str]]]:
    """Consecutive items whose distinct terms and number stay within the bounds (a larger item stands alone)."""
    block: list[tuple[int, str]] = []
    seen: set[str] = set()
    for row, text in items:
        own = set(terms(text))
        if block and (len(block) >= most_items or len(seen | own) > most_terms):
            yield block
            block, seen = [], set()
        block.append((row, text))
        seen |= own
    if block:
        yield block


_FOUND = "doc_id bigint, n bigint, terms array<int>, tfs array<int>, seen array<int>"
_FOUND_ARROW = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.int32())), ("tfs", pa.list_(pa.int32())), ("seen", pa.list_(pa.int32()))])


def _lists(rows: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
    values = np.concatenate(rows).astype(np.int32) if rows else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(offsets, values)


def _parts(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    sizes = [len(x.as_buffer()) if x.is_valid else 0 for x in batch.column(column)]
    at = size = 0
    for i, more in enumerate(sizes):
        if size and size + more > PART_BYTES:
            yield batch.slice(at, i - at)
            at, size = i, 0
        size += more
    if at < len(sizes):
        yield batch.slice(at)


def _scan(block: ItemBlock, key: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = worker_keeps("lexical", key, block.automaton)
        for batch in batches:
            for part in _parts(batch, 1):
                lengths, found, tfs = [], [], []
                seen = np.zeros(len(block.vocabulary), np.int64)
                for text in part.column(1).to_pylist():
                    plain = guarded(text or "")
                    lengths.append(len(plain.split()))
                    hits = np.fromiter((i for _, i in automaton.iter(plain.decode())), np.int64)
                    ids, counts = np.unique(hits, return_counts=True)
                    seen[ids] += 1
                    found.append(ids)
                    tfs.append(counts)
                # Documents per term, summed over the part: one pair of numbers for a term, with the part's first row.
                own = np.flatnonzero(seen)
                sums = np.stack([own, seen[own]], 1).ravel()
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(lengths, pa.int64()), _lists(found), _lists(tfs), _lists([sums, *[np.zeros(0)] * (part.num_rows - 1)])],
                    schema=_FOUND_ARROW,
                )

    return run


_BEST = "number bigint, doc_id bigint, score bigint"


def _keep_best(item: np.ndarray, score: np.ndarray, doc: np.ndarray, absent: np.ndarray, top: int) -> np.ndarray:
    """Rows that are among the ``top`` of their item: by score, then doc_id (absent ones last)."""
    order = np.lexsort((doc, absent, -score, item))
    item = item[order]
    starts = np.flatnonzero(np.concatenate([[True], item[1:] != item[:-1]])) if len(item) else np.zeros(0, np.int64)
    rank = np.arange(len(item)) - np.repeat(starts, np.diff(np.append(starts, len(item))))
    return order[rank < top]


def _score(block: ItemBlock, weights: np.ndarray, n_docs: int, n_terms: int, top: int):
    n_items = len(block.rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [np.zeros(0, np.int64)] * 3 + [np.zeros(0, bool)]
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                docs, lists = part.column(0), part.column(2)
                rows = part.num_rows
                offsets = lists.offsets.to_numpy()
                ids = lists.flatten().to_numpy().astype(np.int64)
                tf = part.column(3).flatten().to_numpy().astype(np.int64)
                of = np.repeat(np.arange(rows), np.diff(offsets))
                n = part.column(1).to_numpy().astype(np.int64)
                m = 100 - 25 + (25 * n * n_docs) // n_terms
                value = weights[ids] * ((1_000_000_000 * tf) // (1000 * tf + 12 * m[of]))
                # Each hit goes to all items that hold the term.
                held = np.diff(block.first)[ids]
                pair = np.repeat(block.first[ids] - np.concatenate([[0], np.cumsum(held)[:-1]]), held) + np.arange(held.sum()) if len(ids) else np.zeros(0, np.int64)
                score = np.zeros(rows * n_items, np.int64)
                np.add.at(score, np.repeat(of, held) * n_items + block.item[pair], np.repeat(value, held) * block.repeats[pair])
                full = np.flatnonzero(score > 0)
                absent = docs.is_null().to_numpy(zero_copy_only=False)
                ids_of = docs.fill_null(0).to_numpy()
                new = [full % n_items, score[full], ids_of[full // n_items], absent[full // n_items]]
                best = [np.concatenate([old, x]) for old, x in zip(best, new)]
                keep = _keep_best(*best, top)
                best = [x[keep] for x in best]
        if len(best[0]):
            number = np.array(block.rows, np.int64)[best[0]]
            yield pa.RecordBatch.from_arrays([pa.array(number), pa.array(best[2], mask=best[3]), pa.array(best[1])], names=["number", "doc_id", "score"])

    return run


def _weights(n_docs: int, holding: np.ndarray) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(df) + 1))) for df in holding], np.int64)


def _search_block(docs: DataFrame, block: ItemBlock, key: str, top: int) -> DataFrame | None:
    found = store(docs.mapInArrow(_scan(block, key), _FOUND), "hits")
    totals = found.agg(F.sum((F.col("n") > 0).cast("bigint")).alias("docs"), F.sum("n").alias("terms")).first()
    if not totals.terms:
        drop_stored(found)
        return None
    pairs = F.expr("transform(sequence(0, cast(size(seen) / 2 as int) - 1), i -> named_struct('term', seen[2 * i], 'n', seen[2 * i + 1]))")
    per_term = found.where("size(seen) > 0").select(F.explode(pairs).alias("x")).groupBy("x.term").agg(F.sum("x.n").alias("df"))
    holding = np.zeros(len(block.vocabulary), np.int64)
    for r in per_term.collect():  # one row for each term of the block
        holding[r.term] = r.df
    scored = found.select("doc_id", "n", "terms", "tfs").mapInArrow(
        _score(block, _weights(totals.docs, holding), totals.docs, totals.terms, top), _BEST
    )
    best = store(scored, "best")
    drop_stored(found)
    return best


def search(
    docs: DataFrame, items: DataFrame, top: int = 20, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text",
    block_terms: int = BLOCK_TERMS, block_items: int = BLOCK_ITEMS,
) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` best documents of each item, score above 0."""
    spark = docs.sparkSession
    texts = docs.select(F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    wanted = items.select(F.col(f"`{item_id}`").alias("item_id"), F.coalesce(F.col(f"`{item_text}`").cast("string"), F.lit("")).alias("text"))
    numbered = store(wanted.withColumn("number", F.monotonically_increasing_id()), "items")
    # Items come to the driver partition by partition, and leave it block by block.
    rows = ((r.number, r.text) for r in numbered.select("number", "text").toLocalIterator())
    found = None
    for i, members in enumerate(cut_blocks(rows, block_terms, block_items)):
        block = ItemBlock(members)
        best = _search_block(texts, block, f"{i}-{hash(tuple(block.vocabulary))}", top) if block.vocabulary else None
        if best is not None:
            found = best if found is None else found.union(best)
    if found is None:
        return spark.createDataFrame([], f"item_id {wanted.schema['item_id'].dataType.simpleString()}, rank int, doc_id bigint, score bigint")
    by = Window.partitionBy("number").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= top)
    return ranked.join(numbered.select("number", "item_id"), "number").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
