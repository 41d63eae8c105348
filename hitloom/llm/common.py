"""Helpers shared by the corpus operators: stored tables, column names, joins, sorted groups."""

from __future__ import annotations

import sys
import types
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from hitloom.session import work_dir

def ship(module: str) -> None:
    """Send the task functions of ``module`` by value: executors need no copy of this package."""
    for name in (__name__, module):
        cloudpickle.register_pickle_by_value(sys.modules[name])


def worker_keeps(kind: str, key: object, make: Callable[[], object]) -> object:
    """What ``make`` returned for (kind, key), kept while the Python worker lives, whatever its tasks unpickle.

    A worker keeps one such thing: another operator's is let go first.
    """
    state = sys.modules.setdefault("hitloom_worker_state", types.ModuleType("hitloom_worker_state")).__dict__
    if state.get("kept", (None, None, None))[:2] != (kind, key):
        state["kept"] = (None, None, None)
        state["kept"] = (kind, key, make())
    return state["kept"][2]


def store(df: DataFrame, kind: str) -> DataFrame:
    """Write a table into the cluster's shared folder and read it back.

    The new plan has no lineage, survives lost executors, and has a measured
    size from which the planner decides whether a join may broadcast it.
    """
    spark = df.sparkSession
    path = work_dir(spark, "llm", f"{kind}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_stored(df: DataFrame) -> None:
    """Delete a table made by :func:`store` (after its last use)."""
    spark = df.sparkSession
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hpath, True)


def text_or_empty(column: str) -> Column:
    return F.coalesce(F.col(f"`{column}`").cast("string"), F.lit(""))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names for working columns that no column of ``df`` has."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def small_batches(df: DataFrame, rows: int = 1000) -> DataFrame:
    """``df``, in a session that hands Python at most ``rows`` rows at a time: whole texts are large rows."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(df.sparkSession.conf.get(key, "0"))
    if now <= 0 or now > rows:
        df.sparkSession.conf.set(key, str(rows))
    return df


def with_fields(df: DataFrame, **kinds: str) -> StructType:
    """The schema of ``df`` and further columns, kinds as in DDL."""
    added = StructType.fromDDL(", ".join(f"`{name}` {kind}" for name, kind in kinds.items()))
    return StructType([*df.schema.fields, *added.fields])


def join_stored(rows: DataFrame, keyed: DataFrame, on: list[str]) -> DataFrame:
    """``rows`` left join ``keyed``, a stored table with unique keys ``on``.

    A small ``keyed`` is broadcast by its measured size.  Otherwise both sides are
    exchanged directly under the join, so that adaptive execution splits a key
    with a large share of the rows.  Nothing may be grouped by ``on`` in the same stage.
    """
    return rows.join(keyed, on, "left")


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of whole groups from a partition that is sorted by ``keys``.

    Holds one batch and the group that its end cuts, never the partition.
    """
    carry: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        end = tuple(c[-1] for c in columns)
        if last is not None and tuple(c[0] for c in columns) == end == last:
            carry.append(batch)
            continue
        cut = 0
        for i in range(batch.num_rows - 1, -1, -1):
            if any(c[i] != e for c, e in zip(columns, end)):
                cut = i + 1
                break
        if cut:
            yield pa.Table.from_batches([*carry, batch.slice(0, cut)])
            carry = [batch.slice(cut)]
        elif carry and last != end:
            yield pa.Table.from_batches(carry)
            carry = [batch]
        else:
            carry.append(batch)
        last = end
    if carry:
        yield pa.Table.from_batches(carry)
