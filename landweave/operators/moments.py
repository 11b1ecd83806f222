"""Weighted means and co-moments of many columns in one pass: partial ones of batches and tasks are combined pairwise."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Partial moments are combined by so many tasks before the driver combines what they give.
SLOTS = 64

#: (sum of weights, means, sums of weighted products of deviations)
Moments = tuple[float, np.ndarray, np.ndarray]


def of_rows(x: np.ndarray, w: np.ndarray) -> Moments:
    total = float(w.sum())
    mean = w @ x / total if total else np.zeros(x.shape[1])
    d = x - mean
    return total, mean, (d * w[:, None]).T @ d


def combined(a: Moments, b: Moments) -> Moments:
    """The moments of both sets of rows; nothing large cancels."""
    total = a[0] + b[0]
    if not total:
        return a
    gap = b[1] - a[1]
    return total, a[1] + gap * (b[0] / total), a[2] + b[2] + np.outer(gap, gap) * (a[0] * b[0] / total)


def moments(df: DataFrame, columns: Sequence[str], weigh: Callable[[np.ndarray], np.ndarray] | None = None, weight: str | None = None) -> list[Moments]:
    """Moments of the columns over the rows that have all of them, in one job.

    `weigh` gives each row's weights under one or several weightings (rows by weightings), from the matrix of its columns; there is one
    result for each. Without it `weight` names the column of weights, or all weigh 1. At most SLOTS rows a weighting reach the driver.
    """
    names = [*columns, *([weight] if weight else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[Moments] = []
        for batch in batches:
            x = np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(float) for i in range(len(names))], 1)
            x = x[~np.isnan(x).any(1)]
            if not len(x):
                continue
            w = x[:, len(columns) :] if weight else np.ones((len(x), 1)) if weigh is None else weigh(x)
            x = x[:, : len(columns)]
            new = [of_rows(x, w[:, j]) for j in range(w.shape[1])]
            found = [combined(a, b) for a, b in zip(found, new, strict=True)] if found else new
        if found:
            yield pa.RecordBatch.from_pydict({"k": pa.array(range(len(found)), pa.int32()), "total": [m[0] for m in found], "mean": [m[1] for m in found], "co": [m[2].ravel() for m in found]})

    def merge(group: tuple, part: pd.DataFrame) -> pd.DataFrame:
        rows = sorted(((t, m, c) for t, m, c in zip(part["total"], part["mean"], part["co"], strict=True)), key=lambda r: (r[0], *r[1]))
        out = None
        for t, m, c in rows:
            one = (t, np.asarray(m), np.asarray(c).reshape(len(m), -1))
            out = one if out is None else combined(out, one)
        return pd.DataFrame({"k": [group[1]], "total": [out[0]], "mean": [out[1]], "co": [out[2].ravel()]})

    schema = "k int, total double, mean array<double>, co array<double>"
    partial = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(names)]).mapInArrow(run, schema)
    slot = F.spark_partition_id() % SLOTS
    rows = partial.groupBy(slot.alias("slot"), "k").applyInPandas(merge, schema).collect()
    out: dict[int, Moments] = {}
    for r in sorted(rows, key=lambda r: (r.k, r.total, r.mean)):
        one = (r.total, np.array(r.mean), np.array(r.co).reshape(len(columns), -1))
        out[r.k] = combined(out[r.k], one) if r.k in out else one
    return [out[k] for k in sorted(out)]
