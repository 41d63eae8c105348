"""SimHash near-deduplication: fingerprints of word shingles, linked by a binary-trie self-join.

Distinct fingerprints form a binary trie.  Node pairs are walked together; the
differing bits of a pair add up, and a pair beyond the error budget is pruned.

How the walk is spread: of ``budget + 1`` bit ranges, two fingerprints within the
budget agree on one whole range.  The trie is walked once per range with that
range on top, where only pairs of equal nodes survive.  Each top node is one unit
of work for a task.  A unit with more fingerprints than ``UNIT_ROWS`` is walked
further as a table: every step replaces it by the pairs of its child nodes that
the budget allows, until all units are small.  Within a task the same walk runs
over sorted arrays.  A task returns a spanning set of the links it finds, which
keeps every connection.

Defined results
    null texts count as empty; a text without words has fingerprint 0, linked like
    any other; null ids belong to groups but never name one, unless all are null;
    repeated rows share their group; an empty table gives an empty result; when a
    group's smallest id is repeated, `keep_one` returns one of its rows; `keep_one`
    never drops rows without an id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitloom.llm.common import fresh, join_stored, ship, small_batches, sorted_groups, store, text_or_empty
from hitloom.llm.components import components

ship(__name__)

SEED = 42
BITS = 64
#: Fingerprints in a unit of work, and bits that a larger unit is walked at a time.
UNIT_ROWS, STEP_BITS = 1024, 4
#: Shingles hashed at a time: memory does not grow with a text's length.
SHINGLES_AT_ONCE = 1 << 15


def fingerprint(raw: bytes, words_per_shingle: int) -> int:
    """The 64-bit fingerprint of a UTF-8 text, as a signed number."""
    words = raw.lower().split()
    if not words:
        return 0
    width = min(words_per_shingle, len(words))
    total, ones = len(words) - width + 1, np.zeros(BITS, np.int64)
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.concatenate([[0], np.cumsum(lengths[:-1] + 1)])
    begin, end = starts[:total].tolist(), (starts + lengths)[width - 1 :].tolist()
    for at in range(0, total, SHINGLES_AT_ONCE):
        part = slice(at, at + SHINGLES_AT_ONCE)
        hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(begin[part], end[part])), "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(ones * 2 > total, bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words_per_shingle: int = 3) -> DataFrame:
    """(id, fp): the fingerprint of every row's whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.large_binary())
            found = [fingerprint(t.as_py(), words_per_shingle) for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(found, pa.int64())], names=["id", "fp"])

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), text_or_empty(text_col).alias("text"))
    return small_batches(rows).mapInArrow(run, "id long, fp long")


def _ranges(budget: int) -> list[tuple[int, int]]:
    """(first bit, width) of budget + 1 ranges that cover all bits."""
    edges = [BITS * i // (budget + 1) for i in range(budget + 2)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def _rotated(fps: DataFrame, budget: int) -> DataFrame:
    """(turn, rest, key): each fingerprint once per range, rotated so that the range is on top; key is the range."""
    parts = []
    for turn, (first, width) in enumerate(_ranges(budget)):
        right = first + width  # a rotation by this moves the range to the top
        rest = F.expr(f"(fp << {(BITS - right) % BITS}) | shiftrightunsigned(fp, {right % BITS})") if right % BITS else F.col("fp")
        parts.append(F.struct(F.lit(turn).alias("turn"), rest.alias("rest"), F.shiftrightunsigned(rest, BITS - width).alias("key")))
    return fps.select(F.explode(F.array(*parts)).alias("x")).select("x.*")


def _near_steps(bits: int, budget: int) -> list[list[int]]:
    return [[m for m in range(1 << bits) if bin(m).count("1") == e] for e in range(budget + 1)]


def _split_units(units: DataFrame, budget: int) -> DataFrame:
    """Walk units with more than UNIT_ROWS fingerprints down the trie until none is left.

    Columns: turn, key, left, right (node prefixes below the key; equal for a node
    with itself), depth (bits of key and prefixes), spent, rest, side (0: left or both).
    """
    unit = ["turn", "key", "left", "right", "depth", "spent"]
    done = []
    while True:
        sizes = units.groupBy(*unit).agg(F.count(F.lit(1)).alias("n"), F.max("side").alias("far"), F.min("side").alias("near"))
        # a pair of nodes of which one holds nothing has no links
        useful = sizes.where("n > 1 AND (left = right OR (near = 0 AND far = 1))").select(*unit, (F.col("n") > UNIT_ROWS).alias("large"))
        useful = store(useful, "units")
        tagged = join_stored(units, useful, unit).where("large IS NOT NULL")
        if useful.where("large").isEmpty():
            done.append(tagged.drop("large"))
            break
        tagged = store(tagged, "tagged")
        done.append(tagged.where("NOT large").drop("large"))
        step = F.least(F.lit(BITS) - F.col("depth"), F.lit(STEP_BITS))
        child = F.expr(f"CAST(shiftrightunsigned(rest << depth, {BITS - STEP_BITS}) AS INT)")
        moves = F.array(*[
            F.struct(F.lit(m).alias("mask"), F.lit(e).alias("cost"))
            for e, masks in enumerate(_near_steps(STEP_BITS, budget)) for m in masks
        ])
        big = tagged.where("large").drop("large").withColumns({"child": child, "step": step}).where("step > 0")
        pairs = big.withColumn("move", F.explode(moves)).where(F.col("spent") + F.col("move.cost") <= budget)
        # masks only reach bits that exist below this depth
        pairs = pairs.where(F.expr(f"(move.mask & ((1 << ({STEP_BITS} - step)) - 1)) = 0"))
        other = F.col("child").bitwiseXOR(F.col("move.mask"))
        same = F.col("left") == F.col("right")
        down = lambda node, way: F.shiftleft(node, STEP_BITS) + way
        # within one node, a pair of children is kept once: smaller child on the left
        mine_left = F.when(same, F.col("child") <= other).otherwise(F.col("side") == 0)
        units = pairs.select(
            "turn", "key",
            F.when(mine_left, down(F.col("left"), F.col("child"))).otherwise(down(F.col("left"), other)).alias("left"),
            F.when(mine_left, down(F.col("right"), other)).otherwise(down(F.col("right"), F.col("child"))).alias("right"),
            (F.col("depth") + STEP_BITS).alias("depth"), (F.col("spent") + F.col("move.cost")).alias("spent"), "rest",
            F.when(mine_left, F.lit(0)).otherwise(F.lit(1)).alias("side"),
        )
        units = store(units, "walk")
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def _popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x).astype(np.int64)


def _walk(fps: np.ndarray, frontier: np.ndarray, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of links.  ``frontier``: rows (a0, a1, b0, b1, bit, spent) over sorted runs of ``fps``.

    A node is a run [x0, x1) of fingerprints that agree above ``bit``; equal runs mean a node with itself.
    """
    found: list[tuple[np.ndarray, np.ndarray]] = []
    while len(frontier):
        a0, a1, b0, b1, bit, spent = frontier.T
        single = (a1 - a0 == 1) & (b1 - b0 == 1)
        if single.any():
            i, j = a0[single], b0[single]
            near = (i != j) & (_popcount(fps[i] ^ fps[j]) <= budget)
            found.append((i[near], j[near]))
        rest = frontier[~single & (bit >= 0)]
        if not len(rest):
            break
        a0, a1, b0, b1, bit, spent = rest.T
        cut_a, cut_b = _cut(fps, a0, a1, bit), _cut(fps, b0, b1, bit)
        same = (a0 == b0) & (a1 == b1)
        grown = [
            np.stack([x0, x1, y0, y1, bit - 1, spent + cost], 1)[(x1 > x0) & (y1 > y0) & (spent + cost <= budget) & keep]
            for x0, x1, y0, y1, cost, keep in (
                (a0, cut_a, b0, cut_b, 0, True), (cut_a, a1, cut_b, b1, 0, True),
                (a0, cut_a, cut_b, b1, 1, True), (cut_a, a1, b0, cut_b, 1, ~same),
            )
        ]
        frontier = np.concatenate(grown)
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([x for x, _ in found]), np.concatenate([y for _, y in found])


def _cut(fps: np.ndarray, lo: np.ndarray, hi: np.ndarray, bit: np.ndarray) -> np.ndarray:
    """Where each sorted run changes from 0 to 1 at its bit (runs agree above it)."""
    lo, hi, shift = lo.copy(), hi.copy(), bit.astype(np.uint64)
    while True:
        open_ = lo < hi
        if not open_.any():
            return lo
        mid = (lo + hi) >> 1
        one = ((fps[np.minimum(mid, len(fps) - 1)] >> shift) & np.uint64(1)).astype(bool)
        hi = np.where(open_ & one, mid, hi)
        lo = np.where(open_ & ~one, mid + 1, lo)


def spanning(i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
    """For each of n nodes the smallest node of its component under links (i, j)."""
    root = np.arange(n)
    while len(i):
        low, high = np.minimum(root[i], root[j]), np.maximum(root[i], root[j])
        open_ = low != high
        if not open_.any():
            break
        i, j, low, high = i[open_], j[open_], low[open_], high[open_]
        np.minimum.at(root, high, low)
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up
    return root


def _unit_links(table: pa.Table, budget: int) -> pa.RecordBatch:
    """Spanning links of all units in a table sorted by unit."""
    col = lambda name: table.column(name).to_numpy()
    rest = col("rest").astype(np.int64).view(np.uint64)
    unit = np.stack([col(k).astype(np.int64) for k in ("turn", "key", "left", "right", "depth", "spent")], 1)
    edge = np.flatnonzero(np.any(unit[1:] != unit[:-1], axis=1)) + 1
    starts, ends = np.concatenate([[0], edge]), np.concatenate([edge, [len(rest)]])
    several = ends - starts > 1
    starts, ends = starts[several], ends[several]
    side = col("side").astype(np.int64)
    out_a, out_b = [], []
    weight = np.cumsum(((ends - starts) / 64.0) ** 2 + 1)
    for part in np.split(np.arange(len(starts)), np.searchsorted(weight, np.arange(4096, weight[-1] if len(weight) else 0, 4096))):
        if not len(part):
            continue
        number = np.repeat(np.arange(len(part)), ends[part] - starts[part])
        within = np.concatenate([np.arange(s, e) for s, e in zip(starts[part], ends[part])])
        order = within[np.lexsort((rest[within], side[within], number))]
        fps, first = rest[order], np.concatenate([[0], np.cumsum(ends[part] - starts[part])])
        near = np.add.reduceat((side[order] == 0).astype(np.int64), first[:-1])
        split = first[:-1] + near
        heads = unit[starts[part]]
        alike = heads[:, 2] == heads[:, 3]
        frontier = np.stack([
            first[:-1], np.where(alike, first[1:], split), np.where(alike, first[:-1], split), first[1:],
            BITS - 1 - heads[:, 4], heads[:, 5],
        ], 1)
        i, j = _walk(fps, frontier, budget)
        root = spanning(i, j, len(fps))
        moved = np.flatnonzero(root != np.arange(len(fps)))
        out_a.append(order[moved])
        out_b.append(order[root[moved]])
    a = np.concatenate(out_a) if out_a else np.zeros(0, np.int64)
    b = np.concatenate(out_b) if out_b else np.zeros(0, np.int64)
    turn = unit[:, 0]
    edges = np.array([first + width for first, width in _ranges(budget)], np.uint64)
    back = lambda at: _turn_back(rest[at], edges[turn[at]])
    arrays = [pa.array(back(x).view(np.int64)) for x in (a, b)]
    return pa.RecordBatch.from_arrays(arrays, names=["a", "b"])


def _turn_back(rest: np.ndarray, by: np.ndarray) -> np.ndarray:
    """Undo the rotation of _rotated."""
    by = by % np.uint64(BITS)
    return np.where(by == 0, rest, (rest << by) | (rest >> ((np.uint64(BITS) - by) % np.uint64(BITS))))


def links(fps: DataFrame, max_distance: int) -> DataFrame:
    """(a, b): links of the distinct values ``fp`` that connect all pairs within ``max_distance`` bits."""
    unit = ["turn", "key", "left", "right", "depth", "spent"]
    widths = F.array(*[F.lit(w) for _, w in _ranges(max_distance)])
    zero = F.lit(0).cast("long")
    units = _rotated(fps.select("fp").distinct(), max_distance).select(
        "turn", "key", zero.alias("left"), zero.alias("right"), F.get(widths, F.col("turn")).alias("depth"),
        F.lit(0).alias("spent"), "rest", F.lit(0).alias("side"),
    )
    units = _split_units(store(units, "rotated"), max_distance)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in sorted_groups(batches, unit):
            yield _unit_links(table, max_distance)

    dealt = units.repartition(*unit).sortWithinPartitions(*unit)
    return dealt.mapInArrow(run, "a long, b long")


def near_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words_per_shingle: int = 3, max_distance: int = 2
) -> DataFrame:
    """One row per row of ``docs``: id, fp, component_id (smallest id reachable by links, itself included)."""
    prints = store(fingerprints(docs, id_col, text_col, words_per_shingle), "fingerprints")
    classes = store(prints.groupBy("fp").agg(F.min("id").alias("id")), "classes")
    found = store(components(links(classes, max_distance)).toDF("fp", "root"), "roots")
    joined = classes.join(found, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    named = store(joined, "named")
    names = store(named.groupBy("root").agg(F.min("id").alias("component_id")), "names")
    by_fp = store(join_stored(named.select("fp", "root"), names, ["root"]).drop("root"), "by_fp")
    return join_stored(prints, by_fp, ["fp"]).select(F.col("id").alias(id_col), "fp", "component_id")


def keep_one(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words_per_shingle: int = 3, max_distance: int = 2
) -> DataFrame:
    """``docs`` with one row of each near-duplicate group, the one with the smallest id; columns unchanged.

    Rows without an id stay.  Of rows that repeat an id, one stays.
    """
    groups = store(near_groups(docs, id_col, text_col, words_per_shingle, max_distance), "groups")
    (key,) = fresh(docs, "key")
    gone = groups.where(F.col(id_col) != F.col("component_id")).select(F.col(id_col).alias(key)).distinct()
    name = F.col(f"`{id_col}`")
    rows = docs.join(store(gone, "gone"), name == F.col(key), "left_anti")
    if groups.where(F.col(id_col).isNotNull()).groupBy(id_col).count().where("count > 1").isEmpty():
        return rows
    return rows.where(name.isNotNull()).dropDuplicates([id_col]).unionByName(rows.where(name.isNull()))
