"""Pixel functions: nodata, quality masks, indices, cell coordinates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of the quality band of a Landsat scene.
QA_BITS = {"fill": 0, "clear": 1, "water": 2, "cloud_shadow": 3, "snow": 4, "cloud": 5}

#: Scene classes of a Sentinel-2 scene that are usable.
SCL_KEPT = (2, 4, 5, 6, 7, 8, 11)


def nodata_to_null(column: Column, nodata: float) -> Column:
    """The value as double, null where it is nodata or NaN."""
    value = column.cast("double")
    return F.when((value != F.lit(float(nodata))) & ~F.isnan(value), value)


def null_to_nodata_int16(column: Column, nodata: int = -9999) -> Column:
    """Null and what doesn't fit as nodata, the rest cut towards zero.

    It is rounded to nine places first: a mean or deviation that is a whole number comes out a hair below or above it by the order of its rows.
    """
    column = F.round(column, 9)
    whole = F.when(column >= 0, F.floor(column)).otherwise(F.ceil(column))
    return F.coalesce(whole.try_cast("smallint"), F.lit(nodata).cast("smallint"))


def qa_bitmask(qa: Column, **flags: bool) -> Column:
    """Whether each named bit of the quality band is as asked: qa_bitmask(qa, cloud=False, snow=False)."""
    unknown = set(flags) - set(QA_BITS)
    if unknown or not flags:
        raise ValueError(f"flags must be among {sorted(QA_BITS)}")
    asked = sum(1 << QA_BITS[k] for k in flags)
    wanted = sum(1 << QA_BITS[k] for k, v in flags.items() if v)
    return qa.bitwiseAND(F.lit(asked)) == wanted


def qa_classmask(qa: Column, kept: Sequence[int] = SCL_KEPT) -> Column:
    return qa.isin(*kept)


def normalized_difference(a: Column, b: Column, scale: float = 10000.0) -> Column:
    """(a - b) / (a + b) * scale in doubles; null where the sum is 0."""
    a, b = a.cast("double"), b.cast("double")
    return F.try_divide(a - b, a + b) * F.lit(scale)


def apply_mask(df: DataFrame, mask: Column, bands: Sequence[str]) -> DataFrame:
    """The bands, null where the mask is not true."""
    return df.withColumns({b: F.when(mask, F.col(b)) for b in bands})


def cell_x(col: Column, x0: float, res: float) -> Column:
    return F.lit(x0) + (col + 0.5) * F.lit(res)


def cell_y(row: Column, y0: float, res: float) -> Column:
    return F.lit(y0) - (row + 0.5) * F.lit(res)


def pack_labels(pre: Column, post: Column) -> Column:
    """Two labels below 256 as one number."""
    return F.shiftleft(pre.cast("int"), 8) + post.cast("int")


def unpack_labels(packed: Column) -> tuple[Column, Column]:
    return F.shiftright(packed, 8), F.pmod(packed, F.lit(256))
