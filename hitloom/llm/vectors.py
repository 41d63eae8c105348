"""Embedding near-deduplication by collision-counting projections.

Equal vectors are one class.  Classes meet in cells: each of several tables cuts
space by the signs of random directions, with as many directions as keep a cell's
expected size constant while the corpus grows, and as many tables as the wanted
recall asks for.  Within a cell, many one-dimensional projections are sorted; for
every vector and projection, the vectors in the window centred on it collide with
it; a pair with enough collisions is verified by its cosine in double precision.
The window, the count and the number of tables follow from the threshold and
``RECALL`` for a pair that lies exactly on the threshold; closer pairs do better.

A pair is judged in the first table whose cell it shares, so it counts once.  A
cell with more than ``CELL_ROWS`` classes is worked on as pairs of blocks, each a
unit of its own; tasks return counts and a spanning set of links, never pairs.

Defined results
    null, zero and non-finite vectors, and rows without an id, link with nothing:
    no links, themselves as component, kept; vectors of different lengths never
    link; rows that repeat an id are one node of the graph; an empty table gives an
    empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitloom.llm.common import join_stored, ship, sorted_groups, store
from hitloom.llm.components import components
from hitloom.llm.simhash import spanning

ship(__name__)

#: Recall of the tables and of the collision count, each, for a pair on the threshold.
RECALL = 0.99
#: Expected classes in a cell; classes in a cell that are still one unit, and in a block of a larger one.
CELL_TARGET, CELL_ROWS, BLOCK_ROWS = 64, 1024, 512
#: Projections, and half the window in standard deviations of the difference of a pair on the threshold.
PROJECTIONS, WINDOW_SDS = 24, 1.9


def enough_collisions(projections: int, hit: float, recall: float) -> int:
    """The largest count that a binomial(projections, hit) reaches with probability ``recall``."""
    reached = 0.0
    for count in range(projections, -1, -1):
        reached += math.comb(projections, count) * hit**count * (1 - hit) ** (projections - count)
        if reached >= recall:
            return count
    return 0


def tables_for(rows: int, threshold: float, recall: float = RECALL) -> tuple[int, int]:
    """(directions in a table, tables) for a corpus of ``rows`` classes."""
    bits = min(60, max(2, math.ceil(math.log2(max(rows, 1) / CELL_TARGET)) if rows > CELL_TARGET else 2))
    agree = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, max(1, math.ceil(math.log(1 - recall) / math.log(1 - agree)))


def directions(length: int, count: int, seed: int) -> np.ndarray:
    return np.random.RandomState((seed * 1_000_003 + length) % 2**32).standard_normal((length, count))


def cell_keys(unit: np.ndarray, bits: int, tables: int, seed: int) -> np.ndarray:
    """One key for each vector and table: the signs on the table's directions as a number."""
    signs = (unit @ directions(unit.shape[1], bits * tables, seed) > 0).reshape(len(unit), tables, bits)
    return signs @ (1 << np.arange(bits, dtype=np.int64))


def collisions(a: np.ndarray, b: np.ndarray, half: float) -> np.ndarray:
    """For each row of ``a`` and of ``b``, in how many projections (columns) b lies in a's window."""
    counts = np.zeros((len(a), len(b)), np.uint8)
    rank = np.empty(len(b), np.int32)
    for p in range(a.shape[1]):
        order = np.argsort(b[:, p], kind="stable")
        line = b[order, p]
        rank[order] = np.arange(len(b), dtype=np.int32)
        low = np.searchsorted(line, a[:, p] - half, "left").astype(np.int32)
        high = np.searchsorted(line, a[:, p] + half, "right").astype(np.int32)
        counts += (rank >= low[:, None]) & (rank < high[:, None])
    return counts


def _vectors(column: pa.Array, length: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, length)


def _links_in_unit(ids, sizes, unit, keys, table, near, far, threshold, seed):
    """(ids, link weights) and spanning links of the index rows ``near`` against ``far`` (the same rows: with themselves)."""
    spread = math.sqrt(2 - 2 * threshold)
    half = WINDOW_SDS * spread
    needed = enough_collisions(PROJECTIONS, math.erf(WINDOW_SDS / math.sqrt(2)), RECALL)
    same = near is far
    lines = unit @ directions(unit.shape[1], PROJECTIONS, seed + 1)
    a, b = unit[near], unit[far]
    mask = collisions(lines[near], lines[far], half) >= needed
    if same:
        mask = np.triu(mask, 1)
    for earlier in range(table):
        mask &= keys[near, earlier][:, None] != keys[far, earlier][None, :]
    i, j = np.nonzero(mask)
    if not len(i):
        return np.zeros((0, 2), np.int64), np.zeros((0, 2), np.int64)
    good = np.concatenate([
        np.einsum("ij,ij->i", a[i[at : at + 65536]], b[j[at : at + 65536]]) >= threshold for at in range(0, len(i), 65536)
    ])
    i, j = near[i[good]], far[j[good]]
    weight = np.zeros(len(ids), np.int64)
    np.add.at(weight, i, sizes[j])
    np.add.at(weight, j, sizes[i])
    root = spanning(i, j, len(ids))
    linked, moved = np.flatnonzero(weight), np.flatnonzero(root != np.arange(len(ids)))
    return np.stack([ids[linked], weight[linked]], 1), np.stack([ids[moved], ids[root[moved]]], 1)


def near_vectors(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = 0.95, seed: int = 7) -> DataFrame:
    """One row per row of ``rows``: id, n_links, component_id, kept."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = []
            for value in batch.column("vec"):
                vector = np.array(value.as_py() or [], np.float64) if value.is_valid else np.zeros(0)
                norm = math.sqrt(float(vector @ vector)) if len(vector) and np.isfinite(vector).all() else 0.0
                keys.append(hashlib.sha256((vector + 0.0).tobytes()).digest() if norm > 0 and math.isfinite(norm) else None)
            known = [k if i.is_valid else None for k, i in zip(keys, batch.column("id"))]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("vec"), pa.array(known, pa.binary())], names=["id", "vec", "class"])

    given = rows.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vector_col}`").cast("array<double>").alias("vec"))
    marked = store(given.mapInArrow(digest, "id long, vec array<double>, class binary"), "marked")
    classes = marked.where("class IS NOT NULL").groupBy("class").agg(
        F.min("id").alias("id"), F.count(F.lit(1)).alias("size"), F.first("vec").alias("vec")
    )
    classes = store(classes.withColumn("length", F.size("vec")), "classes")
    bits, tables = tables_for(classes.count(), threshold)

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = batch.column("length").to_numpy()
            for length in np.unique(lengths):
                part = batch.filter(pa.array(lengths == length))
                vectors = _vectors(part.column("vec"), int(length))
                unit = vectors / np.linalg.norm(vectors, axis=1)[:, None]
                keys = cell_keys(unit, bits, tables, seed)
                found = pa.ListArray.from_arrays(np.arange(len(keys) + 1, dtype=np.int32) * tables, keys.ravel())
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in ("id", "size", "length", "vec")], found], names=["id", "size", "length", "vec", "keys"])

    celled = classes.select("id", "size", "length", "vec").mapInArrow(cells, "id long, size long, length int, vec array<double>, keys array<long>")
    celled = store(celled, "cells")
    cell = ["table", "length", "key"]
    counted = celled.select("length", F.posexplode("keys").alias("table", "key")).groupBy(*cell).count()
    hot = store(counted.where(F.col("count") > CELL_ROWS).withColumn("blocks", F.ceil(F.col("count") / BLOCK_ROWS).cast("int")).drop("count"), "hot")
    dealt = celled.select("id", "size", "length", "vec", F.posexplode("keys").alias("table", "key"))
    dealt = join_stored(dealt, hot, cell).withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    dealt = dealt.withColumn("mine", F.pmod(F.xxhash64("id"), "blocks").cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    unit_keys = ["table", "length", "key", "low", "high"]
    dealt = dealt.withColumns({"low": F.least("mine", "other"), "high": F.greatest("mine", "other")}).drop("other", "blocks")

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in sorted_groups(batches, unit_keys):
            heads = np.stack([whole.column(k).to_numpy().astype(np.int64) for k in unit_keys], 1)
            edge = np.flatnonzero(np.any(heads[1:] != heads[:-1], axis=1)) + 1
            counts, links = [np.zeros((0, 2), np.int64)], [np.zeros((0, 2), np.int64)]
            for start, end in zip([0, *edge.tolist()], [*edge.tolist(), len(heads)]):
                if end - start < 2:
                    continue
                part = whole.slice(start, end - start).combine_chunks()
                table, length, _, low, high = heads[start].tolist()
                vectors = _vectors(part.column("vec").chunk(0), length)
                unit = vectors / np.linalg.norm(vectors, axis=1)[:, None]
                block = part.column("mine").to_numpy()
                near = np.flatnonzero(block == low)
                far = near if low == high else np.flatnonzero(block == high)
                keys = cell_keys(unit, bits, tables, seed) if table else np.zeros((len(unit), 1), np.int64)
                n, e = _links_in_unit(part.column("id").to_numpy(), part.column("size").to_numpy(), unit, keys, table, near, far, threshold, seed)
                counts.append(n)
                links.append(e)
            n, e = np.concatenate(counts), np.concatenate(links)
            a, b = np.concatenate([n[:, 0], e[:, 0]]), np.concatenate([n[:, 1], e[:, 1]])
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(a)) < len(n)), pa.array(a), pa.array(b)], names=["counts", "a", "b"])

    found = dealt.repartition(*unit_keys).sortWithinPartitions(*unit_keys).mapInArrow(link, "counts boolean, a long, b long")
    found = store(found, "links")
    links = store(found.where("counts").groupBy(F.col("a").alias("node")).agg(F.sum("b").alias("links")), "counts")
    roots = store(components(found.where("NOT counts").select("a", "b")), "roots")
    named = classes.select("class", "size", F.col("id").alias("node"))
    named = join_stored(join_stored(named, links, ["node"]), roots, ["node"])
    named = store(named.select("class", (F.col("size") - 1 + F.coalesce("links", F.lit(0))).alias("n"), F.coalesce("root", "node").alias("root")), "named")
    out = join_stored(marked.select("id", "class"), named, ["class"])
    root = F.coalesce("root", "id")
    return out.select(
        F.col("id").alias(id_col), F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), root.alias("component_id"),
        F.col("id").eqNullSafe(root).alias("kept"),
    )
