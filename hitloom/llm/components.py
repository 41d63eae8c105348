"""Connected components of a graph given as an edge table, by alternating stars.

Large-star links every larger neighbour of a node to the smallest one, small-star
links a node and its smaller neighbours to the smallest.  Rounds repeat until the
edges no longer change; they then form one star per component.  Every half round
is stored, so hub nodes join as plain tables, which adaptive execution can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitloom.llm.common import drop_stored, store

#: Rounds need about the logarithm of the longest chain; this only stops a faulty loop.
MAX_ROUNDS = 60


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(a, b))")).first()
    return tuple(row)


def _star(edges: DataFrame, both_ways: bool) -> DataFrame:
    if both_ways:
        seen = edges.union(edges.select("b", "a").toDF("a", "b"))
    else:
        seen = edges
    least = store(seen.groupBy("a").agg(F.min("b").alias("least")).withColumn("least", F.least("a", "least")), "least")
    joined = seen.join(least, "a")
    if both_ways:
        out = joined.where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    else:
        out = joined.where("b != least").select(F.col("b").alias("a"), F.col("least").alias("b"))
        out = out.union(least.where("a != least").toDF("a", "b"))
    result = store(out.where("a != b").distinct(), "star")
    drop_stored(least)
    return result


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b: long); root is the smallest node reachable.

    Self links and repeated edges do no harm; no edges give no rows.
    """
    now = store(
        edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges"
    )
    before = _mark(now)
    for _ in range(MAX_ROUNDS):
        if not before[0]:
            break
        large = _star(now, both_ways=True)
        drop_stored(now)
        now = _star(large, both_ways=False)
        drop_stored(large)
        after = _mark(now)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("components did not settle")
    roots = now.select("b").distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots.select("b", F.col("b")))
