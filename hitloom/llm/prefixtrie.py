"""Trie of conversation prefixes, counted in minimal-perfect-hash node tables.

A node is a distinct sequence of first turns.  The steps, each spread by Spark:

1. every conversation's turns are walked once in order; a turn's node is the digest of
   its parent's digest and the turn (128 bits);
2. *enumerate*: shards (whole runs of conversations, cut at ``SHARD_ROWS`` rows) list their distinct
   prefix digests, give each a slot by a minimal perfect hash, verify the slots against
   the stored digests, and scatter members and smallest members into flat arrays; one
   row for each node and shard leaves, and Spark merges them into the node table;
3. each node's own worth (a leaf, its saved tokens) goes to one row of its smallest
   member; a subtree's total is then the sum over shards of what its members there own;
4. *accumulate*: shards hash their digests again, scatter the owned worth into slots, and add each
   depth to its parents' slots, deepest first.  Again one row for each node and shard leaves.

A shared prefix costs one row for each shard, never one for each member, so a hot first
turn, a hot conversation and the root are merged from partial sums.  A conversation longer
than a shard goes on in the next one: rows come deepest first, and what its rows own
so far is carried to the next rows up, which form a chain of their own.  The digest of a node's ending members is one
sequential hash; it streams over the sorted members and holds none of them.

Defined results
    turns of a conversation are ordered by ``turn`` (null first), then role, then the MD5 of
    the text (repeated turns stay); null roles and texts are empty; rows without a
    conversation id belong to no conversation; a conversation with no turns left after
    rebuilding is a member of the root alone; an empty table has no node; long texts enter as digests;
    other columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hitloom.llm.common import drop_stored, join_stored, ship, store

ship(__name__)

#: Rows of a shard, whatever the number of rows of a partition.
SHARD_ROWS = 200_000
#: Digest of the root.
ROOT = hashlib.blake2b(b"root", digest_size=16).digest()
WORD = r"[^\x20\x09-\x0D]+"


# ---------------------------------------------------------------- minimal perfect hash

def _mixed(keys: np.ndarray, level: int) -> np.ndarray:
    """A hash of 128-bit keys (n x 2 uint64), another one at each level."""
    with np.errstate(over="ignore"):
        x = keys[:, 0] + np.uint64(level + 1) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x ^= keys[:, 1]
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class SlotTable:
    """Slots 0..n-1 for n distinct 128-bit digests.

    At each level the keys still without a slot are hashed into a bit table of twice their
    number; a key that is alone in its bit gets the bit's rank, the others go on.  ``find``
    compares the digest stored in the slot, so a foreign digest has none.
    """

    def __init__(self, digests: np.ndarray):
        keys = np.unique(np.ascontiguousarray(digests).view("V16").ravel()).view(np.uint64).reshape(-1, 2)
        self.digests = np.empty_like(keys)
        self.levels: list[tuple[np.ndarray, int]] = []
        left, slots = keys, 0
        while len(left):
            level, size = len(self.levels), 2 * len(left)
            bit = (_mixed(left, level) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(bit, minlength=size) == 1
            rank = np.where(alone, np.cumsum(alone) - 1, -1)
            self.levels.append((rank, slots))
            own = alone[bit]
            self.digests[slots + rank[bit[own]]] = left[own]
            slots += int(own.sum())
            left = left[~own]
        assert slots == len(keys)

    def __len__(self) -> int:
        return len(self.digests)

    def find(self, digests: np.ndarray) -> np.ndarray:
        """The slot of each digest; -1 where no stored digest equals it."""
        out = np.full(len(digests), -1, np.int64)
        left = np.arange(len(digests))
        for level, (rank, first) in enumerate(self.levels):
            if not len(left):
                break
            at = rank[(_mixed(digests[left], level) % np.uint64(len(rank))).astype(np.int64)]
            hit = at >= 0
            out[left[hit]] = first + at[hit]
            left = left[~hit]
        found = out >= 0
        out[found] = np.where((self.digests[out[found]] == digests[found]).all(1), out[found], -1)
        return out


def _keys(column: pa.Array) -> np.ndarray:
    """A binary column of 16-byte digests as n x 2 uint64."""
    return np.frombuffer(b"".join(column.to_pylist()), np.uint64).reshape(-1, 2)


def _binary(digests: np.ndarray) -> pa.Array:
    raw = np.ascontiguousarray(digests).tobytes()
    return pa.array([raw[i : i + 16] for i in range(0, len(raw), 16)], pa.binary())


# ---------------------------------------------------------------- walking conversations

_PATHS = "conv_id bigint, depth bigint, node binary, parent binary, words bigint, is_end boolean"
_PATHS_ARROW = pa.schema([
    ("conv_id", pa.int64()), ("depth", pa.int64()), ("node", pa.binary()), ("parent", pa.binary()), ("words", pa.int64()), ("is_end", pa.bool_()),
])


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (conv_id, turn digest or null, words) in order -> one row for each conversation and depth.

    A conversation's first row has no digest and stands for the root.  Only the last row is held back,
    as its successor tells whether the conversation ends there.
    """
    held = None
    for batch in batches:
        out: list[tuple] = []
        for conv, turn, words in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if held is not None:
                out.append((*held, held[0] != conv))
            if turn is None:
                held = (conv, 0, ROOT, None, 0)
            else:
                node = hashlib.blake2b(held[2] + turn, digest_size=16).digest()
                held = (conv, held[1] + 1, node, held[2], words)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _PATHS_ARROW)], schema=_PATHS_ARROW)
    if held is not None:
        yield pa.RecordBatch.from_arrays([pa.array([c], f.type) for c, f in zip((*held, True), _PATHS_ARROW)], schema=_PATHS_ARROW)


def _shards(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    held, n = [], 0
    for batch in batches:
        at = 0
        while at < batch.num_rows:
            part = batch.slice(at, rows - n)
            at, n = at + part.num_rows, n + part.num_rows
            held.append(part)
            if n >= rows:
                yield pa.Table.from_batches(held)
                held, n = [], 0
    if held:
        yield pa.Table.from_batches(held)


_COUNTS = "node binary, parent binary, depth bigint, words bigint, n_convs bigint, owner bigint"


def _count(rows: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in _shards(batches, rows):
            shard = shard.combine_chunks()
            nodes = _keys(shard["node"])
            table = SlotTable(nodes)
            slot = table.find(nodes)
            n = np.bincount(slot, minlength=len(table))
            owner = np.full(len(table), np.iinfo(np.int64).max)
            np.minimum.at(owner, slot, shard["conv_id"].to_numpy())
            first = np.zeros(len(table), np.int64)
            first[slot] = np.arange(len(slot))
            one = shard.take(pa.array(first))
            columns = [one["node"], one["parent"], one["depth"], one["words"], pa.array(n.astype(np.int64)), pa.array(owner)]
            yield from pa.table(columns, names=["node", "parent", "depth", "words", "n_convs", "owner"]).to_batches(max_chunksize=10_000)

    return run


_SUMS = "node binary, n_leaves bigint, saved_tokens bigint"


def _sums(nodes: pa.ChunkedArray | pa.Array, sums: np.ndarray) -> pa.RecordBatch:
    nodes = nodes.combine_chunks() if isinstance(nodes, pa.ChunkedArray) else nodes
    return pa.RecordBatch.from_arrays(
        [nodes, pa.array(np.ascontiguousarray(sums[:, 0])), pa.array(np.ascontiguousarray(sums[:, 1]))], names=["node", "n_leaves", "saved_tokens"]
    )


def _subtrees(shard: pa.Table, own: np.ndarray, depths: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Subtree totals of the nodes of whole conversations."""
    nodes = _keys(shard["node"])
    table = SlotTable(nodes)
    slot = table.find(nodes)
    sums = np.zeros((len(table), 2), np.int64)
    np.add.at(sums, slot, own)
    first = np.zeros(len(table), np.int64)
    first[slot] = np.arange(len(slot))
    depth, above = depths[first], shard["parent"].take(pa.array(first)).to_pylist()
    parent = table.find(_keys(pa.array([p or ROOT for p in above], pa.binary())))
    order = np.argsort(-depth, kind="stable")
    for level in np.split(order, np.flatnonzero(np.diff(depth[order])) + 1):
        if depth[level[0]]:
            np.add.at(sums, parent[level], sums[level])
    for at in range(0, len(table), 10_000):
        yield _sums(_binary(table.digests[at : at + 10_000]), sums[at : at + 10_000])


def _accumulate(rows: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carried_from, carried = None, np.zeros(2, np.int64)
        for shard in _shards(batches, rows):
            shard = shard.combine_chunks()
            convs, depths = shard["conv_id"].to_numpy(), shard["depth"].to_numpy()
            own = np.stack([shard["leaf"].to_numpy(), shard["saved"].to_numpy()], 1).astype(np.int64)
            # A conversation that this shard cuts is a chain of its own: shared nodes of others must not pass it on.
            head = int((convs == carried_from).sum()) if convs[0] == carried_from else 0
            tail = int((convs == convs[-1]).sum()) if depths[-1] else 0
            if head:
                chain = own[:head].cumsum(0) + carried
                yield _sums(shard["node"][:head], chain)
            if tail and head < len(convs):
                chain = own[-tail:].cumsum(0)
                yield _sums(shard["node"][-tail:], chain)
            if tail:
                carried_from, carried = convs[-1], chain[-1]
            else:
                carried_from = None
            whole = slice(head, max(head, len(convs) - tail))
            if whole.start < whole.stop:
                yield from _subtrees(shard.slice(whole.start, whole.stop - whole.start), own[whole], depths[whole])

    return run


_ENDS = "node binary, ends_sha256 string"


def _hash_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, conv_id) sorted by both -> the digest of each node's members, streamed."""
    node, state = None, None
    for batch in batches:
        done: list[tuple[bytes, str]] = []
        nodes, convs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        at = 0
        while at < len(nodes):
            end = at
            while end < len(nodes) and nodes[end] == nodes[at]:
                end += 1
            text = ",".join(map(str, convs[at:end])).encode()
            if nodes[at] == node:
                state.update(b"," + text)
            else:
                if node is not None:
                    done.append((node, state.hexdigest()))
                node, state = nodes[at], hashlib.sha256(text)
            at = end
        if done:
            yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.binary()), pa.array([d[1] for d in done])], names=["node", "ends_sha256"])
    if node is not None:
        yield pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([state.hexdigest()])], names=["node", "ends_sha256"])


# ---------------------------------------------------------------- the operator

def rebuilt_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, pos, turn digest, words) of the rebuilt conversations, and one row with pos 0 for each.

    A conversation c begins with the first ``crc32(c) mod 4`` turns of conversation ``c - c mod 20``
    and goes on with its own turns behind as many.
    """
    role, text = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in ("role", "text"))
    own = turns.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn"), role.alias("role"), F.md5(text.cast("binary")).alias("text_md5"),
        F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"))).alias("digest"),
        F.regexp_count(text, F.lit(WORD)).cast("bigint").alias("words"),
    )
    by = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text_md5")
    own = store(own.withColumn("pos", F.row_number().over(by).cast("bigint")).select("conv_id", "pos", "digest", "words"), "turns")
    base = (F.col("conv_id") - F.col("conv_id") % 20).alias("base_id")
    convs = own.where("pos = 1").select("conv_id", base, (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4).alias("h"))
    given = own.where("pos <= 3 AND conv_id % 20 = 0").select(F.col("conv_id").alias("base_id"), "pos", "digest", "words")
    taken = convs.join(given, "base_id").where("pos <= h").select("conv_id", "pos", "digest", "words")
    crc = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4
    rest = own.where(F.col("pos") > crc).select("conv_id", "pos", "digest", "words")
    none = F.lit(0).cast("bigint")
    roots = convs.select("conv_id", none.alias("pos"), F.lit(None).cast("binary").alias("digest"), none.alias("words"))
    return roots.union(taken).union(rest)


def trie(sequences: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The nodes of the trie of ``sequences`` (as of :func:`rebuilt_turns`).

    Returns conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.
    """
    spark = sequences.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    walked = sequences.repartition(parts, "conv_id").sortWithinPartitions("conv_id", "pos").select("conv_id", "digest", "words")
    paths = store(walked.mapInArrow(_walk, _PATHS), "paths")
    counted = store(
        paths.mapInArrow(_count(shard_rows), _COUNTS).groupBy("node").agg(
            F.first("parent").alias("parent"), F.first("depth").alias("depth"), F.first("words").alias("words"),
            F.sum("n_convs").alias("n_convs"), F.min("owner").alias("owner"),
        ), "nodes",
    )
    children = store(counted.where("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("n_children")), "children")
    nodes = store(
        counted.join(children, "node", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("bigint"))), "counted"
    )
    worth = nodes.select(
        F.col("owner").alias("conv_id"), "depth", (F.col("n_children") == 0).cast("bigint").alias("leaf"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("saved"),
    )
    zero = F.lit(0).cast("bigint")
    owned = paths.select("conv_id", "depth", "node", "parent").join(worth, ["conv_id", "depth"], "left").select(
        "conv_id", "depth", "node", "parent", F.coalesce("leaf", zero).alias("leaf"), F.coalesce("saved", zero).alias("saved")
    )
    owned = owned.repartition(parts, "conv_id").sortWithinPartitions("conv_id", F.desc("depth"))
    sums = store(
        owned.mapInArrow(_accumulate(shard_rows), _SUMS).groupBy("node").agg(
            F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens")
        ), "sums",
    )
    ending = paths.where("is_end").select("node", "conv_id").repartition(parts, "node").sortWithinPartitions("node", "conv_id")
    ends = store(ending.mapInArrow(_hash_ends, _ENDS), "ends")
    above = counted.select(F.col("node").alias("parent"), F.col("owner").alias("parent_conv_id"))
    out = join_stored(nodes.join(sums, "node").join(ends, "node", "left"), above, ["parent"])
    out = store(out.select(
        F.col("owner").alias("conv_id"), "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    ), "trie")
    for used in (paths, counted, children, nodes, sums, ends):
        drop_stored(used)
    return out


def head_length(conv_id: int) -> int:
    """How many turns conversation ``conv_id`` takes from its base."""
    return zlib.crc32(str(conv_id).encode()) % 4


def conversation_trie(turns: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The trie of the rebuilt conversations of ``turns`` (conv_id, turn, role, text)."""
    return trie(rebuilt_turns(turns), shard_rows)
