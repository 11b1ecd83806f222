"""Statistics that users write in Python, computed in two phases: partial states before the shuffle, merged after it.

A state is a list of numbers of the user's choice, so that what is shuffled is small and no task ever holds a group. Tasks keep the states
of at most `STATES` groups; when there are more, they pass on what they have and start again. States of one group are then folded one
after the other from sorted partitions, first by group and part of the tasks, so that the states of a hot group are spread too.
"""

from __future__ import annotations

import importlib
from collections.abc import Callable, Iterator, Sequence
from pathlib import Path
from types import ModuleType
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Groups whose states a task holds.
STATES = 10_000

#: Parts of a group's states that are merged apart from each other first.
SPREAD = 64

_NAN = float("nan")


class Statistic(NamedTuple):
    """start() gives a state, update(state, values) takes in values, merge(state, state) joins two, finish(state) gives a number or None.

    Values are a numpy array for columns of numbers, flags or times, else a list of Python values (geometries: polygons of rings of points).
    """

    start: Callable[[], list[float]]
    update: Callable[[list[float], np.ndarray | list], list[float]]
    merge: Callable[[list[float], list[float]], list[float]]
    finish: Callable[[list[float]], float | None]


def statistics_of(spark: SparkSession, module: str | ModuleType) -> dict[str, Statistic]:
    """The statistics in a module by their names, but those that begin with an underscore.

    A name that ends in .py is a file; it is sent to the executors. A module by name must be installed on them.
    """
    if isinstance(module, str) and module.endswith(".py"):
        spark.sparkContext.addPyFile(module)
        module = Path(module).stem
    found = importlib.import_module(module) if isinstance(module, str) else module
    return {n: s for n, s in sorted(vars(found).items()) if isinstance(s, Statistic) and not n.startswith("_")}


def _groups(batch: pa.RecordBatch, by: Sequence[str]) -> Iterator[tuple[tuple, np.ndarray]]:
    """Keys of a batch and the places of their rows, in order."""
    codes = np.zeros(batch.num_rows, np.int64)
    for name in by:
        own = batch.column(name).dictionary_encode("encode").indices.to_numpy(zero_copy_only=False).astype(np.int64)
        codes = np.unique(codes * (own.max() + 1) + own, return_inverse=True)[1]
    order = np.argsort(codes, kind="stable")
    starts = np.flatnonzero(np.diff(codes[order], prepend=-1))
    keys = zip(*[batch.column(name).take(pa.array(order[starts])).to_pylist() for name in by], strict=True)
    for key, places in zip(keys, np.split(order, starts[1:]), strict=True):
        yield _key(key), places


def _key(values: Sequence) -> tuple:
    """A key that equals itself: all NaN are one object, as Spark groups them."""
    return tuple(_NAN if v != v else v for v in values)


def _values(column: pa.Array) -> np.ndarray | list:
    """A column without its nulls."""
    kept = column.drop_null()
    t = kept.type
    return kept.to_numpy(zero_copy_only=False) if pa.types.is_primitive(t) or pa.types.is_boolean(t) else kept.to_pylist()


def user_statistics(rows: DataFrame, by: str | Sequence[str], statistics: dict[str, Statistic], columns: Sequence[str]) -> DataFrame:
    """The group's columns and, as column_name, each statistic (double) of each column.

    Nulls are left out; a group without a value has what `finish(start())` gives. Null keys are a group, and so are NaN. Keys are of plain
    types (no arrays, structs or maps). No rows give no groups. States merge in no set order.
    """
    by = [by] if isinstance(by, str) else list(by)
    names = [(c, n) for c in columns for n in statistics]
    if not names or not by:
        raise ValueError("groups, columns and statistics are needed")
    if nested := [c for c in by if isinstance(rows.schema[c].dataType, (T.ArrayType, T.StructType, T.MapType))]:
        raise ValueError(f"no groups by {nested}")
    keys = [f"k{i}" for i in range(len(by))]
    key_type = T.StructType([T.StructField(k, rows.schema[c].dataType) for k, c in zip(keys, by, strict=True)])
    state_type = T.StructType([*key_type, T.StructField("part", T.IntegerType()), *[T.StructField(f"s{i}", T.ArrayType(T.DoubleType())) for i in range(len(names))]])
    end_type = T.StructType([*key_type, *[T.StructField(f"s{i}", T.DoubleType()) for i in range(len(names))]])
    of_columns = [statistics[n] for _, n in names]
    at = [columns.index(c) for c, _ in names]

    def packed(found: list[tuple[tuple, list]], types: pa.Schema, part: int | None) -> pa.RecordBatch:
        lines = [(*key, *([] if part is None else [part]), *values) for key, values in found]
        return pa.RecordBatch.from_arrays([pa.array(c, types.field(i).type) for i, c in enumerate(zip(*lines, strict=True))], schema=types)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, types, part = {}, None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            if types is None:
                part = batch.column("part")[0].as_py()
                types = _arrow(batch.schema, keys, len(names), pa.list_(pa.float64()), part=True)
            for key, places in _groups(batch, keys):
                if key not in held and len(held) >= STATES:
                    yield packed(list(held.items()), types, part)
                    held = {}
                states = held.setdefault(key, [s.start() for s in of_columns])
                values = [_values(batch.column(f"v{i}").take(pa.array(places))) for i in range(len(columns))]
                held[key] = [s.update(state, values[i]) if len(values[i]) else state for s, state, i in zip(of_columns, states, at, strict=True)]
        if held:
            yield packed(list(held.items()), types, part)

    def folded(last: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            now, states, done, types = None, [], [], None
            ended = lambda s: [f.finish(x) for f, x in zip(of_columns, s, strict=True)] if last else s
            for batch in batches:
                types = types or _arrow(batch.schema, keys, len(names), pa.float64() if last else pa.list_(pa.float64()), part=not last)
                lists = [batch.column(f"s{i}").to_pylist() for i in range(len(names))]
                for i, key in enumerate(zip(*[batch.column(k).to_pylist() for k in keys], strict=True)):
                    key, own = _key(key), [x[i] for x in lists]
                    if now == key:
                        states = [f.merge(a, b) for f, a, b in zip(of_columns, states, own, strict=True)]
                        continue
                    if now is not None:
                        done.append((now, ended(states)))
                    now, states = key, own
                    if len(done) >= STATES:
                        yield packed(done, types, None if last else 0)
                        done = []
            if now is not None:
                yield packed([*done, (now, ended(states))], types, None if last else 0)

        return fold

    plain = rows.select(*[F.col(c).alias(k) for c, k in zip(by, keys, strict=True)], F.pmod(F.spark_partition_id(), F.lit(SPREAD)).alias("part"), *[F.col(c).alias(f"v{i}") for i, c in enumerate(columns)])
    states = plain.mapInArrow(partial, state_type)
    spread = states.repartition(*keys, "part").sortWithinPartitions(*keys).mapInArrow(folded(False), state_type)
    ends = spread.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(folded(True), end_type)
    return ends.select(*[F.col(k).alias(c) for k, c in zip(keys, by, strict=True)], *[F.col(f"s{i}").alias(f"{c}_{n}") for i, (c, n) in enumerate(names)])


def _arrow(schema: pa.Schema, keys: Sequence[str], n: int, value: pa.DataType, part: bool) -> pa.Schema:
    own = [schema.field(k) for k in keys] + ([pa.field("part", pa.int32())] if part else [])
    return pa.schema([*own, *[pa.field(f"s{i}", value) for i in range(n)]])
