"""Exact percentiles of groups of any size: no group's values are held together once it is large."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType

from landweave.operators.regions import forget, written

#: Values of a group that an aggregate may hold; larger groups are searched digit by digit.
HELD = 100_000

#: Rows of ranks that may be broadcast: a group's key and three numbers each.
BROADCAST_ROWS = 100_000

#: Places of the binary digits that a pass counts, from the highest: twelve at a time.
SHIFTS = (52, 40, 28, 16, 4, 0)


@F.pandas_udf(LongType())
def _sortable(values: pd.Series) -> pd.Series:
    """Numbers in the order of doubles (a nan is the largest)."""
    bits = values.to_numpy(float).view(np.int64)
    return pd.Series(np.where(bits < 0, bits ^ np.int64(0x7FFFFFFFFFFFFFFF), bits))


@F.pandas_udf(DoubleType())
def _double(keys: pd.Series) -> pd.Series:
    bits = keys.to_numpy(np.int64)
    return pd.Series(np.where(bits < 0, bits ^ np.int64(0x7FFFFFFFFFFFFFFF), bits).view(float))


def _equal(left: str, right: str, columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in columns])


def _small(df: DataFrame) -> DataFrame:
    """A written table marked for broadcast if it has few rows."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def _searched(df: DataFrame, by: list[str], columns: Sequence[str], shares: Sequence[float]) -> DataFrame:
    """by and percentiles (an array by column of arrays by share) of large groups.

    Passes count the digits of values under the prefix found so far, of all groups, columns and ranks at once; the state has two ranks
    for each group, column and share.
    """
    pairs = F.array(*[F.struct(F.lit(i).alias("c"), F.col(f"`{c}`").cast("double").alias("v")) for i, c in enumerate(columns)])
    rows = df.select(*by, F.explode(pairs).alias("p")).select(*by, "p.c", "p.v").where("v is not null")
    rows = written(rows.select(*by, "c", _sortable("v").alias("key")), "keys")
    same = [*by, "c"]
    place = [(F.col("n") - 1) * F.lit(float(q)) for q in shares]
    ranks = F.array(*[F.struct(F.lit(2 * i + k).alias("t"), f(p).cast("long").alias("rank")) for i, p in enumerate(place) for k, f in enumerate((F.floor, F.ceil))])
    counts = rows.groupBy(*same).agg(F.count(F.lit(1)).alias("n"))
    state = written(counts.select(*same, "n", F.explode(ranks).alias("r")).select(*same, "n", "r.t", "r.rank", F.lit(0).cast("long").alias("prefix")), "ranks")
    before = None
    for shift in SHIFTS:
        counted = rows.withColumn("prefix", F.lit(0).cast("long") if before is None else F.shiftright("key", before))
        if before is not None:
            wanted = state.select(*same, "prefix").distinct()
            counted = counted.alias("x").join(_small(wanted).alias("s"), _equal("x", "s", [*same, "prefix"]), "left_semi")
        counted = counted.groupBy(*same, "prefix", F.shiftright("key", shift).alias("next")).agg(F.count(F.lit(1)).alias("m"))
        upto = W.partitionBy(*same, "prefix").orderBy("next").rowsBetween(W.unboundedPreceding, 0)  # at most 4096 digits under a prefix
        counted = counted.withColumn("upto", F.sum("m").over(upto))
        met = counted.alias("x").join(_small(state).alias("s"), _equal("x", "s", [*same, "prefix"]) & (F.col("s.rank") < F.col("x.upto")) & (F.col("s.rank") >= F.col("x.upto") - F.col("x.m")))
        new = written(met.select(*[F.col(f"s.{c}") for c in same], "s.n", "s.t", (F.col("s.rank") - F.col("x.upto") + F.col("x.m")).alias("rank"), F.col("x.next").alias("prefix")), "ranks")
        forget(state)
        state, before = new, shift
    forget(rows)
    found = state.select(*same, "n", "t", _double("prefix").alias("v")).groupBy(*same, "n").agg(F.map_from_entries(F.collect_list(F.struct("t", "v"))).alias("v"))
    at = lambda i: F.element_at("v", F.lit(i))
    values = [at(2 * i) + F.when(at(2 * i + 1) != at(2 * i), (p - F.floor(p)) * (at(2 * i + 1) - at(2 * i))).otherwise(0.0) for i, p in enumerate(place)]
    each = found.select(*by, "c", F.array(*values).alias("p")).groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct("c", "p"))).alias("all"))
    return each.select(*by, F.array(*[F.element_at("all", F.lit(i)) for i in range(len(columns))]).alias("percentiles"))


def percentiles(df: DataFrame, by: Sequence[str], columns: Sequence[str], shares: Sequence[float]) -> DataFrame:
    """by and, for each column, an array of its percentiles at the shares: exact, interpolated between neighbouring values; null without a value.

    Groups of at most HELD rows, counted first, are aggregated as they are; of larger ones no task holds the values. Without `by` there
    is one row.
    """
    by = list(by)
    exact = [F.percentile(F.col(f"`{c}`").cast("double"), F.array(*[F.lit(float(q)) for q in shares])).alias(c) for c in columns]
    out = ["*"] if not by else [*by, *[F.col(f"`{c}`") for c in columns]]
    named = lambda found: found.select(*by, *[F.get("percentiles", F.lit(i)).alias(c) for i, c in enumerate(columns)])
    if not by:
        if df.limit(HELD + 1).count() <= HELD:
            return df.agg(*exact)
        return named(_searched(df, by, columns, shares))
    large = written(df.groupBy(*by).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > HELD).select(*by), "large")
    if large.isEmpty():
        return df.groupBy(*by).agg(*exact).select(*out)
    few = _small(large).alias("s")
    usual = df.alias("x").join(few, _equal("x", "s", by), "left_anti").groupBy(*by).agg(*exact)
    hot = df.alias("x").join(few, _equal("x", "s", by), "left_semi")
    return usual.select(*out).unionByName(named(_searched(hot, by, columns, shares)).select(*out))
