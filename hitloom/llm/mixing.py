"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Rows are dealt into blocks by a hash of their id and text.  A source's target fixes how
often its blocks are drawn: whole rounds over all blocks, then one more part of a
round in permuted order, of which the last block is cut between documents.  The
tree starts from the number of block draws of every source and halves them, source
by source, by hypergeometric draws, until each output shard has its exact quota.
A shard then gets the next draws of each source's permuted sequence, so shards are
disjoint, and its rows are ordered by a hash.  All randomness is hashes of a seed:
reruns agree.

Everything is DataFrame and SQL expressions.  Documents are read for their sizes;
the draws are tables of blocks; sums along the permuted order are taken within
strata of the hash, so no task sees a whole source.

Defined results
    a size is the number of runs of non-white-space (null text: 0); the null source
    is a source, weighted last; sources without words have target 0; null and
    repeated ids are allowed (only rows that share source, id and text are drawn
    together); ties of the hashes go by block and turn; an empty table gives an empty result; other columns are carried
    along, and new columns whose names clash get a leading ``_``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hitloom.llm.common import fresh, store

# A word, the weights by rank of the source, the most copies of a document.
WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)
MOST_COPIES = 3

#: Documents in a block, words in an output shard, levels of the tree at least, strata of a permuted order.
BLOCK_DOCS, SHARD_WORDS, LEAST_LEVELS, STRATA = 256, 16_000_000, 3, 1024
#: Levels of the tree that one task makes; below them its nodes are spread.
TOP_LEVELS = 8


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(WORD)), F.lit(0)).cast("long")


def target_sizes(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """(source, k, source_size, n_docs, target) from (source, source_size, n_docs).

    Targets share all sizes by weight.  One above ``most`` times its source's size
    stops there and the excess is shared again: so target = min(cap, level x weight),
    and the level follows from the sources ordered by cap / weight.  One row per source.
    """
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    ranked = sizes.withColumn("k", F.row_number().over(by_name) - 1)
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), F.pmod("k", F.lit(len(weights))))
    ranked = ranked.withColumns({"weight": weight, "cap": (F.col("source_size") * most).cast("double")})
    full = Window.orderBy(F.col("cap") / F.col("weight"), "k").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(full), F.lit(0.0))
    open_weight = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(full), F.lit(0.0))
    ranked = ranked.withColumn("level", left / open_weight)
    # the sources from the first whose cap lies above the level are not stopped
    level = F.min(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct(F.col("cap") / F.col("weight"), "k", "level"))).over(everything)
    target = F.coalesce(F.least("cap", F.col("weight") * level["level"]), F.col("cap"))
    return ranked.withColumn("target", target).select("source", F.col("k").cast("int").alias("k"), "source_size", "n_docs", "target")


def sum_before(rows: DataFrame, order: str, amount: str, name: str) -> DataFrame:
    """``rows`` with the sum of ``amount`` over the rows of the same k that stand before in hash order.

    ``order``: a column of even 64-bit hashes.  Strata of it are summed first; a
    window then holds the rows of one stratum, or the strata of one source.
    """
    rows = rows.withColumn("stratum", F.shiftrightunsigned(F.col(order), 64 - STRATA.bit_length() + 1).cast("int"))
    sums = rows.groupBy("k", "stratum").agg(F.sum(amount).alias("in_stratum"))
    along = Window.partitionBy("k").orderBy("stratum").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("k", "stratum", F.coalesce(F.sum("in_stratum").over(along), F.lit(0)).alias("base"))
    within = Window.partitionBy("k", "stratum").orderBy(order, "block", "turn").rowsBetween(Window.unboundedPreceding, -1)
    inside = rows.withColumn("inside", F.coalesce(F.sum(amount).over(within), F.lit(0)))
    return inside.join(sums, ["k", "stratum"]).withColumn(name, F.col("base") + F.col("inside")).drop("base", "inside", "stratum")


def _hypergeometric(successes: str, draws: str, population: str, uniform: str) -> str:
    """SQL: how many of ``draws`` from ``population`` are among ``successes``, by inverting the distribution at ``uniform``.

    Weights follow from the mode by the ratio of neighbours.  Outcomes beyond 12
    standard deviations have no weight that a double could tell from zero.
    """
    k, n, m = successes, draws, population
    mode = f"CAST(floor((CAST({n} AS DOUBLE) + 1) * ({k} + 1) / ({m} + 2)) AS BIGINT)"
    reach = f"CAST(12 * ceil(sqrt(CAST({n} AS DOUBLE) * {k} * ({m} - {k}) * ({m} - {n}) / greatest(CAST({m} AS DOUBLE) * {m} * ({m} - 1), 1))) + 12 AS BIGINT)"
    bounds = (
        f"named_struct('mode', least(greatest({mode}, 0, {n} - ({m} - {k})), {n}, {k}), 'reach', {reach}, "
        f"'low', greatest(0, {n} - ({m} - {k})), 'high', least({n}, {k}))"
    )
    up = f"CAST({k} - i AS DOUBLE) * ({n} - i) / (CAST(i + 1 AS DOUBLE) * ({m} - {k} - {n} + i + 1))"
    down = f"(CAST(i AS DOUBLE) * ({m} - {k} - {n} + i)) / (CAST({k} - i + 1 AS DOUBLE) * ({n} - i + 1))"
    rise = "if(least(b.high, b.mode + b.reach) > b.mode, sequence(b.mode, least(b.high, b.mode + b.reach) - 1), array())"
    fall = "if(greatest(b.low, b.mode - b.reach) < b.mode, sequence(b.mode, greatest(b.low, b.mode - b.reach) + 1, -1), array())"
    start = "named_struct('w', CAST(1 AS DOUBLE), 'sum', CAST(0 AS DOUBLE))"
    total = lambda steps, ratio: f"aggregate({steps}, {start}, (s, i) -> named_struct('w', s.w * {ratio}, 'sum', s.sum + s.w * {ratio}), s -> s.sum)"
    point = f"{uniform} * (1 + {total(rise, up)} + {total(fall, down)})"
    seek = lambda steps, ratio, sign, init: (
        f"aggregate({steps}, {init}, (s, i) -> if(s.x IS NOT NULL, s, named_struct('w', s.w * {ratio}, 'left', s.left - s.w * {ratio}, "
        f"'x', if(s.left - s.w * {ratio} < 0, i {sign} 1, CAST(NULL AS BIGINT)))))"
    )
    first = "named_struct('w', CAST(1 AS DOUBLE), 'left', p - 1, 'x', if(p < 1, b.mode, CAST(NULL AS BIGINT)))"
    rising = seek(rise, up, "+", first)
    falling = seek(fall, down, "-", "named_struct('w', CAST(1 AS DOUBLE), 'left', r.left, 'x', r.x)")
    found = f"coalesce(element_at(transform(array({rising}), r -> ({falling}).x), 1), b.mode)"
    return (
        f"element_at(transform(array({bounds}), b -> element_at(transform(array({point}), p -> {found}), 1)), 1)"
    )


def split_quotas(quotas: DataFrame, levels: int, seed: int) -> DataFrame:
    """(shard, k, quota): the block draws of every source dealt to 2**levels shards.

    ``quotas``: (k, quota).  A node holds the quotas of all sources; its left child
    gets half of its draws, source by source, and the right child the rest.
    """
    nodes = quotas.agg(F.sort_array(F.collect_list(F.struct("k", "quota"))).alias("q")).select(F.lit(1).cast("long").alias("node"), "q")
    for level in range(levels):
        if level and level % TOP_LEVELS == 0:
            nodes = store(nodes.repartition(nodes.sparkSession.sparkContext.defaultParallelism, "node"), "nodes")
        uniform = f"(shiftrightunsigned(xxhash64({int(seed)}L, node, e.k), 11) / CAST(9007199254740992 AS DOUBLE))"
        take = _hypergeometric("e.quota", "a.n", "a.m", uniform)
        # the state holds draws left (n), population left (m), and what the left child got
        sql = (
            "aggregate(q, named_struct('n', floor(total / 2), 'm', total, 'got', CAST(array() AS array<bigint>)), "
            f"(a, e) -> element_at(transform(array({take}), x -> named_struct('n', a.n - x, 'm', a.m - e.quota, 'got', concat(a.got, array(x)))), 1), "
            "a -> a.got)"
        )
        nodes = nodes.withColumn("total", F.expr("aggregate(q, 0L, (s, e) -> s + e.quota)")).withColumn("got", F.expr(sql))
        left = F.expr("zip_with(q, got, (e, x) -> named_struct('k', e.k, 'quota', x))")
        right = F.expr("zip_with(q, got, (e, x) -> named_struct('k', e.k, 'quota', e.quota - x))")
        halves = F.array(F.struct((F.col("node") * 2).alias("node"), left.alias("q")), F.struct((F.col("node") * 2 + 1).alias("node"), right.alias("q")))
        nodes = nodes.select(F.explode(halves).alias("half")).select("half.*")
    return nodes.select((F.col("node") - (1 << levels)).alias("shard"), F.explode("q").alias("e")).select("shard", "e.k", "e.quota")


@dataclass
class MixPlan:
    """Stored tables of one mix: sources, the draws of whole blocks, and the documents drawn from cut blocks."""

    sources: DataFrame  # source, k, source_size, target, n_blocks
    draws: DataFrame  # k, block, copies (array of turn, shard)
    picks: DataFrame  # k, block, id, turn, shard
    shards: int
    seed: int
    id_col: str
    text_col: str
    source_col: str


def _row_id(id_col: str, text_col: str) -> Column:
    """What tells rows of a source apart: null and repeated ids still have their texts."""
    return F.xxhash64(F.col(f"`{id_col}`"), F.col(f"`{text_col}`"))


def _block(row_id: Column, n_blocks: Column, seed: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed), row_id), n_blocks)


def plan_mix(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights: tuple[float, ...] = WEIGHTS, seed: int = 0,
) -> MixPlan:
    """Decide which blocks and documents of each source are drawn, how often, and for which shard."""
    meta = store(docs.select(
        _row_id(id_col, text_col).alias("id"), F.col(f"`{source_col}`").alias("source"), word_count(F.col(f"`{text_col}`")).alias("size"),
    ), "sizes")
    sizes = meta.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    targets = target_sizes(store(sizes, "source_sizes"), weights)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    targets = targets.withColumn("rounds", F.least(whole.cast("long"), F.lit(MOST_COPIES)))
    targets = targets.withColumns({
        "rest": F.col("target") - F.col("rounds") * F.col("source_size"),
        "n_blocks": F.ceil(F.col("n_docs") / BLOCK_DOCS).cast("long"),
    })
    sources = store(targets, "sources")
    known = meta.join(sources.select(F.col("source").alias("of"), "k", "n_blocks"), F.col("source").eqNullSafe(F.col("of")))
    known = known.select("id", "size", "k", _block(F.col("id"), F.col("n_blocks"), seed).alias("block"))
    blocks = store(known.groupBy("k", "block").agg(F.sum("size").alias("words")), "blocks")

    # the part of a round: blocks in permuted order while their words fit
    ordered = blocks.withColumns({"order": F.xxhash64(F.lit(seed + 1), "k", "block"), "turn": F.lit(0)})
    ordered = sum_before(ordered, "order", "words", "before").join(sources.select("k", "rounds", "rest"), "k")
    fits = (F.col("words") > 0) & (F.col("before") + F.col("words") <= F.col("rest"))
    ordered = store(ordered.select(
        "k", "block", "words", "rounds", (F.col("rest") - F.col("before")).alias("room"), fits.alias("fits"),
        ((F.col("words") > 0) & ~fits & (F.col("before") < F.col("rest"))).alias("cut"),
    ), "ordered")
    turns = F.expr("if(rounds + CAST(fits OR cut AS INT) > 0, sequence(1L, rounds + CAST(fits OR cut AS INT)), CAST(array() AS array<bigint>))")
    drawn = ordered.where("words > 0 OR rounds > 0").select("k", "block", "cut", "rounds", F.explode(turns).alias("turn"))
    drawn = drawn.withColumns({"part": F.col("cut") & (F.col("turn") > F.col("rounds")), "one": F.lit(1).cast("long")})
    drawn = store(drawn.select("k", "block", "turn", "part", "one", F.xxhash64(F.lit(seed + 2), "k", "block", "turn").alias("order")), "drawn")

    words = sources.agg(F.sum("target")).first()[0] or 0
    levels = max(LEAST_LEVELS, int(words // SHARD_WORDS).bit_length())
    quotas = split_quotas(drawn.groupBy("k").agg(F.count(F.lit(1)).alias("quota")), levels, seed + 3)
    along = Window.partitionBy("k").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    ranges = quotas.withColumn("low", F.coalesce(F.sum("quota").over(along), F.lit(0))).where("quota > 0")
    slots = ranges.select("k", "shard", F.explode(F.expr("sequence(low, low + quota - 1)")).alias("rank"))
    placed = sum_before(drawn, "order", "one", "rank").join(store(slots, "slots"), ["k", "rank"])
    placed = store(placed.select("k", "block", "turn", "part", "shard"), "placed")
    draws = placed.where("NOT part").groupBy("k", "block").agg(F.sort_array(F.collect_list(F.struct("turn", "shard"))).alias("copies"))

    picks = _picks(known, ordered, seed)
    picks = picks.join(placed.where("part").select("k", "block", "turn", "shard"), ["k", "block"])
    return MixPlan(sources, store(draws, "draws"), store(picks, "picks"), 1 << levels, seed, id_col, text_col, source_col)


def _picks(known: DataFrame, ordered: DataFrame, seed: int) -> DataFrame:
    """(k, block, id) of the documents taken from each source's cut block (about BLOCK_DOCS of them).

    In permuted order, each that still fits; last, the smallest other one if the
    sum comes nearer to the room by going over it.
    """
    cut = ordered.where("cut").select("k", "block", "room")
    docs = known.join(F.broadcast(cut), ["k", "block"])  # one row per source
    docs = docs.groupBy("k", "block", "room", "id").agg(F.sum("size").alias("size")).where("size > 0")
    row = F.struct(F.xxhash64(F.lit(seed + 4), "id").alias("order"), "id", "size")
    lists = docs.groupBy("k", "block", "room").agg(F.sort_array(F.collect_list(row)).alias("docs"))
    lists = lists.withColumn("left", F.expr("aggregate(docs, room, (r, d) -> if(d.size <= r, r - d.size, r))"))
    lists = lists.withColumn("taken", F.expr(
        "aggregate(docs, named_struct('r', room, 'keep', CAST(array() AS array<boolean>)), (a, d) -> named_struct("
        "'r', if(d.size <= a.r, a.r - d.size, a.r), 'keep', concat(a.keep, array(d.size <= a.r))), a -> a.keep)"
    ))
    lists = lists.withColumn("extra", F.expr(
        "array_min(filter(transform(zip_with(docs, taken, (d, t) -> named_struct('size', d.size, 'order', d.order, 'id', d.id, 't', t)), "
        "x -> if(x.t OR x.size >= 2 * left, NULL, named_struct('size', x.size, 'order', x.order, 'id', x.id))), x -> x IS NOT NULL))"
    ))
    every = F.explode(F.arrays_zip("docs", "taken")).alias("x")
    every = lists.select("k", "block", "extra", every)
    last = F.col("extra").isNotNull() & F.col("x.docs.id").eqNullSafe(F.col("extra.id"))
    return every.where(F.col("x.taken") | last).select("k", "block", F.col("x.docs.id").alias("id"))


def allot(docs: DataFrame, plan: MixPlan) -> DataFrame:
    """``docs`` with source_size, target and copies (array of turn, shard: one entry per time the row is taken)."""
    size, target, copies = fresh(docs, "source_size", "target", "copies")
    of, k, n_blocks, block, drawn, pick, pick_k, pick_block, pick_id = fresh(
        docs, "of", "k", "n_blocks", "block", "drawn", "pick", "pick_k", "pick_block", "pick_id"
    )
    name = _row_id(plan.id_col, plan.text_col)
    sources = plan.sources.select(
        F.col("source").alias(of), F.col("k").alias(k), F.col("n_blocks").alias(n_blocks),
        F.col("source_size").alias(size), F.col("target").alias(target),
    )
    rows = docs.join(sources, F.col(f"`{plan.source_col}`").eqNullSafe(F.col(of)), "left")
    rows = rows.withColumn(block, _block(name, F.col(n_blocks), plan.seed))
    rows = rows.join(plan.draws.toDF(k, block, drawn), [k, block], "left")
    picks = plan.picks.select(
        F.col("k").alias(pick_k), F.col("block").alias(pick_block), F.col("id").alias(pick_id), F.struct("turn", "shard").alias(pick)
    )
    same = (F.col(k) == F.col(pick_k)) & (F.col(block) == F.col(pick_block)) & name.eqNullSafe(F.col(pick_id))
    rows = rows.join(picks, same, "left")
    empty = F.expr("CAST(array() AS array<struct<turn: bigint, shard: bigint>>)")
    taken = F.concat(F.coalesce(drawn, empty), F.when(F.col(pick).isNotNull(), F.array(pick)).otherwise(empty))
    return rows.withColumn(copies, taken).select(*[F.col(f"`{c}`") for c in docs.columns], size, target, copies)


def mix(docs: DataFrame, plan: MixPlan) -> DataFrame:
    """The mixed rows: each row of ``docs`` as often as it is taken, with its shard; shards are partitions, shuffled inside."""
    rows = allot(docs, plan)
    copies = rows.columns[-1]
    turn, shard = fresh(rows, "turn", "shard")
    rows = rows.withColumn(turn, F.explode(copies))
    rows = rows.withColumn(shard, F.col(turn)["shard"]).withColumn(turn, F.col(turn)["turn"])
    order = F.xxhash64(F.lit(plan.seed + 5), _row_id(plan.id_col, plan.text_col), turn)
    (by,) = fresh(rows, "order")
    rows = rows.withColumn(by, order).repartitionById(plan.shards, F.col(f"`{shard}`").cast("int")).sortWithinPartitions(by)
    return rows.select(*[F.col(f"`{c}`") for c in docs.columns], shard)
