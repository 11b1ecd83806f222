"""Cells beside the cell a shift before them, block by block: every cell is shuffled once, and again only where its shift leaves its block."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landweave.operators.regions import SIDE


def _dealt(cells: DataFrame, rows: int, cols: int, shift: tuple[int, int]) -> DataFrame:
    """Cells in their own block (own), and in the block their shifted place lies in (moved); mostly that is one row with both."""

    def block(row: Column, col: Column) -> Column:
        return F.struct(F.floor(row / SIDE).alias("__y"), F.floor(col / SIDE).alias("__x"))

    row, col = F.pmod(F.col("row") + shift[0], F.lit(rows)), F.pmod(F.col("col") + shift[1], F.lit(cols))
    here, there = block(F.col("row"), F.col("col")), block(row, col)
    spread = cells.where("row is not null and col is not null").withColumns({"__mr": row.cast("long"), "__mc": col.cast("long"), "__here": here, "__there": there})
    spread = spread.withColumn("__block", F.explode(F.array_distinct(F.array("__here", "__there"))))
    return spread.withColumns({"__own": F.col("__block") == F.col("__here"), "__moved": F.col("__block") == F.col("__there")}).drop("__here", "__there")


def _pairs(block: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Places of the cells of a block, and of the cells that are shifted onto them; a cell that occurs twice meets each of the other's rows."""
    column = lambda name: block.column(name).to_numpy()
    own, moved = np.flatnonzero(column("__own")), np.flatnonzero(column("__moved"))
    left = pd.DataFrame({"row": column("row")[own].astype(np.int64), "col": column("col")[own].astype(np.int64), "i": own})
    right = pd.DataFrame({"row": column("__mr")[moved], "col": column("__mc")[moved], "j": moved})
    both = left.merge(right, on=["row", "col"])
    return both["i"].to_numpy(), both["j"].to_numpy()


def shift_join(cells: DataFrame, bands: Sequence[str], rows: int, cols: int, shift: tuple[int, int] = (1, 1)) -> DataFrame:
    """Each cell with the bands of the cell `shift` (rows, columns) before it as shifted_*; the grid wraps around.

    Cells (row, col whole numbers) without a place, or without a cell before them, are left out; a place that occurs twice gives both rows.
    """
    names, types = cells.columns, cells.schema
    result = T.StructType([*[T.StructField(f.name, f.dataType) for f in types], *[T.StructField(f"shifted_{b}", types[b].dataType) for b in bands]])

    def joined(block: pa.Table) -> pa.Table:
        i, j = map(pa.array, _pairs(block))
        out = block.select(names).take(i)
        for b in bands:
            out = out.append_column(f"shifted_{b}", block.column(b).take(j))
        return out

    return _dealt(cells, rows, cols, shift).groupBy("__block.__y", "__block.__x").applyInArrow(joined, result)


def shifted_products(cells: DataFrame, bands: Sequence[str], rows: int, cols: int, shift: tuple[int, int], mean: Sequence[float]) -> np.ndarray:
    """Sums of (x - mean)(y' - mean)' over all cells, y' being the cell `shift` (rows, columns) before; a null counts in none of its sums.

    Blocks give sums, so that only k x k numbers of each are added up.
    """
    k, middle = len(bands), np.asarray(mean, float)
    names = [f"p{i}" for i in range(k * k)]

    def summed(block: pa.Table) -> pa.Table:
        i, j = _pairs(block)
        columns = [block.column(b) for b in bands]
        x = np.column_stack([np.where(c.is_null().to_numpy(), 0.0, c.cast(pa.float64()).to_numpy() - m) for c, m in zip(columns, middle, strict=True)])
        return pa.table([pa.array([v]) for v in (x[i].T @ x[j]).ravel()], names=names)

    blocks = _dealt(cells.select("row", "col", *bands), rows, cols, shift).groupBy("__block.__y", "__block.__x")
    sums = blocks.applyInArrow(summed, ", ".join(f"{n} double" for n in names)).agg(*[F.sum(n) for n in names]).first()
    return np.array([v or 0.0 for v in sums]).reshape(k, k)
