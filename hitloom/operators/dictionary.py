"""Event names from dictionaries that are too large to be constants of a plan.

The dictionary travels as one broadcast variable (its size is checked before) and is
indexed once in each Python worker; an Arrow UDF then maps the ids of whole batches.
What a hit costs does not depend on the size of the dictionary, and no row ever
carries a part of it.
"""

from __future__ import annotations

import re
import sys
import types
import uuid
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hitloom.functions import nested

_ITEMS = re.compile(nested.ITEM_SEPARATOR)
_ASSIGN = re.compile(nested.ASSIGNMENT_SEPARATOR)


class KeyIndex:
    """Keys -> values.  The index over the keys is built once, however many batches ask it."""

    def __init__(self, keys: pa.Array, values: pa.Array):
        self._index = pd.Index(keys.to_pandas(), dtype=object)
        self._values = values

    def places(self, codes: pa.Array) -> pa.Array:
        """The place of each code; null for a null or unknown one."""
        encoded = pc.dictionary_encode(codes)
        at = self._index.get_indexer(pd.Index(encoded.dictionary.to_pandas(), dtype=object))
        known = pa.array(at, pa.int64(), mask=at < 0)
        return pc.take(known, encoded.indices)

    def look_up(self, codes: pa.Array) -> pa.Array:
        return pc.take(self._values, self.places(codes))


def item_keys(lists: pa.Array) -> tuple[pa.Array, pa.Array]:
    """(number of items, ids of all items) of event lists, cut at separators that no caret escapes."""
    if pc.any(pc.match_substring(lists, "^")).as_py():
        split = [None if v is None else _ITEMS.split(v) for v in lists.to_pylist()]
        lengths = pa.array([len(v or []) for v in split], pa.int32())
        return lengths, pa.array([_ASSIGN.split(x, maxsplit=1)[0] for v in split for x in v or []], pa.string())
    items = pc.split_pattern(lists, ",")
    lengths = pc.fill_null(pc.list_value_length(items), 0)
    return lengths, pc.list_element(pc.split_pattern(items.flatten(), "=", max_splits=1), 0)


def regrouped(values: pa.Array, lengths: pa.Array) -> pa.Array:
    offsets = pa.concat_arrays([pa.array([0], pa.int64()), pc.cumulative_sum(lengths.cast(pa.int64()))]).cast(pa.int32())
    return pa.ListArray.from_arrays(offsets, values)


def event_names(lists: pa.Array, index: KeyIndex | None) -> pa.Array:
    """The looked-up name of each item of each event list, in item order."""
    lengths, keys = item_keys(lists)
    return regrouped(pa.nulls(len(keys), pa.string()) if index is None else index.look_up(keys), lengths)


@dataclass(frozen=True)
class Shipped:
    """A broadcast dictionary, as an Arrow stream, and its name."""

    name: str
    content: Broadcast


def _indexes(shipped: Shipped) -> dict[int, KeyIndex]:
    """The indexes of a broadcast dictionary by version, made once in a worker (whatever its tasks unpickle)."""
    kept = sys.modules.setdefault("hitloom_worker_dictionaries", types.ModuleType("hitloom_worker_dictionaries")).__dict__.setdefault("kept", {})
    if shipped.name not in kept:
        kept.clear()
        table = pa.ipc.open_stream(shipped.content.value).read_all().combine_chunks()
        kept[shipped.name] = {}
        for version in pc.unique(table["version"]).to_pylist():
            own = table.filter(pc.equal(table["version"], version)).combine_chunks()
            kept[shipped.name][version] = KeyIndex(own["key"].chunk(0), own["value"].chunk(0))
    return kept[shipped.name]


def ship_dictionary(spark: SparkSession, key_values: DataFrame) -> Shipped:
    """``(version, key, value)`` rows, whose size the caller has checked, as one broadcast variable."""
    table = key_values.select("version", "key", "value").toArrow()
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as out:
        out.write_table(table)
    return Shipped(uuid.uuid4().hex, spark.sparkContext.broadcast(sink.getvalue().to_pybytes()))


def shipped_event_names(shipped: Shipped, lists: Column, version: Column) -> Column:
    """array<string>: the name of each item of ``lists`` in the dictionary of ``version``."""

    def names(texts: pa.Array, versions: pa.Array) -> pa.Array:
        indexes = _indexes(shipped)
        encoded = pc.dictionary_encode(versions)
        if len(encoded.dictionary) == 1 and not versions.null_count:
            return event_names(texts, indexes.get(encoded.dictionary[0].as_py()))
        lengths, keys = item_keys(texts)
        row = pc.take(versions, pa.array([i for i, n in enumerate(lengths.to_pylist()) for _ in range(n)], pa.int64()))
        found = pa.nulls(len(keys), pa.string())
        for v in encoded.dictionary.to_pylist():
            if v in indexes:
                here = pc.fill_null(pc.equal(row, v), False)
                found = pc.if_else(here, indexes[v].look_up(keys), found)
        return regrouped(found, lengths)

    return F.arrow_udf(names, "array<string>")(lists, version)
