"""Exact deduplication by progressive refinement: length, then prefix hash, then full hash.

Each step groups only rows that the step before left in a group of two or more,
so full texts are hashed only where length and prefix already agree.  Only ids,
lengths and hashes are shuffled while the groups are found.

Defined results
    null texts count as empty; texts are equal when identical after no change;
    null ids are ordered below all others; rows with the same text and the same
    largest id (repeated rows) are one document: `group_copies` marks them all
    kept, `drop_copies` returns one of them; an empty table gives an empty
    result; other columns are carried along by `drop_copies` unread.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitloom.llm.common import fresh, join_stored, store, text_or_empty

#: Characters of a text that the second step hashes.
PREFIX_CHARS = 64


def _length(text: Column) -> Column:
    return F.octet_length(text)


def _prefix(text: Column) -> Column:
    return F.xxhash64(F.substring(text, 1, PREFIX_CHARS))


def shared_prefixes(docs: DataFrame, text_col: str) -> DataFrame:
    """(len, prefix) of two or more rows: steps one and two in one pre-aggregated pass.

    A prefix group lies within a length group, so a length that one row has
    cannot survive the second step either.
    """
    text = text_or_empty(text_col)
    rows = docs.select(_length(text).alias("len"), _prefix(text).alias("prefix"))
    return store(rows.groupBy("len", "prefix").count().where("count > 1").drop("count"), "prefixes")


def _hashed(rows: DataFrame, text: Column, names: list[str], prefixes: DataFrame) -> DataFrame:
    """``rows`` with length, prefix and, for rows of a surviving group only, the full hash."""
    length, prefix, sha, flag = names
    keyed = prefixes.toDF(length, prefix).withColumn(flag, F.lit(True))
    rows = rows.withColumns({length: _length(text), prefix: _prefix(text)})
    joined = join_stored(rows, keyed, [length, prefix])
    return joined.withColumn(sha, F.when(F.col(flag), F.sha2(text, 256))).drop(flag)


def _groups(hashed: DataFrame, id_name: str, names: list[str]) -> DataFrame:
    """Step three: one row per text that two or more rows have, with the id that stays."""
    length, prefix, sha, _ = names
    per_id = hashed.where(F.col(sha).isNotNull()).groupBy(length, sha, id_name).count()
    best = F.max(F.struct(F.col(id_name).isNotNull().alias("known"), F.col(id_name).alias("id"), F.col("count").alias("n")))
    return (
        per_id.groupBy(length, sha)
        .agg(best.alias("best"), F.sum("count").alias("size"))
        .where("size > 1")
        .select(length, sha, F.col("best.id").alias("keep"), "size", F.col("best.n").alias("ties"))
    )


def group_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept, and the columns named in ``carry``."""
    names = ["len", "prefix", "sha", "shared"]
    prefixes = shared_prefixes(docs, text_col)
    along = {f"carry_{i}": c for i, c in enumerate(carry)}
    rows = docs.select(
        F.col(f"`{id_col}`").alias("id"), text_or_empty(text_col).alias("text"),
        *[F.col(f"`{c}`").alias(name) for name, c in along.items()],
    )
    hashed = store(_hashed(rows, F.col("text"), names, prefixes).drop("text", "prefix"), "hashed")
    groups = store(_groups(hashed, "id", names).select("len", "sha", "keep", "size"), "groups")
    out = join_stored(hashed, groups, ["len", "sha"])
    alone = F.col("size").isNull()
    keep = F.when(alone, F.col("id")).otherwise(F.col("keep"))
    return out.select(
        F.col("id").alias(id_col), keep.alias("keep_id"), F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
        F.col("id").eqNullSafe(keep).alias("kept"), *[F.col(name).alias(c) for name, c in along.items()],
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each text, the one with the largest id; columns unchanged.

    What goes is decided on ids, lengths and hashes; whole rows meet only the ids
    that go.  Rows of an id that repeats with another outcome, and repeated rows
    of one document, are looked at text by text.
    """
    names = ["len", "prefix", "sha", "shared"]
    prefixes = shared_prefixes(docs, text_col)
    slim = docs.select(F.col(f"`{id_col}`").alias("id"), text_or_empty(text_col).alias("text"))
    hashed = store(_hashed(slim, F.col("text"), names, prefixes).drop("text", "prefix"), "hashed")
    groups = store(_groups(hashed, "id", names), "groups")
    alone = F.col("size").isNull()
    stays = alone | F.col("id").eqNullSafe(F.col("keep"))
    decided = join_stored(hashed, groups, ["len", "sha"]).select(
        "id", stays.alias("stays"), (~alone & stays & (F.col("ties") > 1)).alias("tied"),
    )
    per_id = decided.groupBy("id").agg(
        F.min("stays").alias("all_stay"), F.max("stays").alias("any_stays"), F.max("tied").alias("tied"),
    )
    per_id = store(per_id.where("NOT all_stay OR tied"), "outcomes")
    (other,) = fresh(docs, "other")
    gone = store(per_id.where("NOT any_stays").select(F.col("id").alias(other)), "gone")
    unclear = store(per_id.where("any_stays").select(F.col("id").alias(other)), "unclear")
    same = F.col(f"`{id_col}`").eqNullSafe(F.col(other))
    rows = docs.join(gone, same, "left_anti")
    if unclear.isEmpty():
        return rows
    length, sha, keep, size, ties = fresh(docs, "len", "sha", "keep", "size", "ties")
    text = text_or_empty(text_col)
    looked_at = docs.join(unclear, same, "left_semi").withColumns({length: _length(text), sha: F.sha2(text, 256)})
    looked_at = join_stored(looked_at, groups.toDF(length, sha, keep, size, ties), [length, sha])
    left = looked_at.where(F.col(size).isNull() | F.col(f"`{id_col}`").eqNullSafe(F.col(keep)))
    once = F.coalesce(F.col(ties), F.lit(1)) == 1
    left = left.where(once).unionByName(left.where(~once).dropDuplicates([length, sha]))
    return rows.join(unclear, same, "left_anti").unionByName(left.select(*[F.col(f"`{c}`") for c in docs.columns]))
