"""Covers of polygons by square cells of several levels, and the pairs of polygons whose covers meet.

A cell of level n is `size` times 2^n wide. A polygon that is at most twice as wide as `size` takes the one to four cells of its
own level that its bounding box touches. A wider one is refined: its cells are split, the largest first, where an edge crosses
them, until there are `most` of them; cells inside it stay whole. A country is a bounded number of rows, however small `size` is.

Two polygons that share a point have cells of which one is the other or lies in it. Ids, boxes and cells are all that is joined.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landweave.functions import geometry as G
from landweave.operators.regions import forget, written

#: Rows of a cover that may be broadcast: each has a key, a box and a cell, about 80 bytes.
BROADCAST_ROWS = 100_000


def _touched(e: np.ndarray, x0: float, y0: float, x1: float, y1: float) -> np.ndarray:
    """Whether edges (x1, y1, x2, y2) share a point with a closed box; a hair's breadth counts."""
    near = (np.minimum(e[:, 0], e[:, 2]) <= x1) & (np.maximum(e[:, 0], e[:, 2]) >= x0) & (np.minimum(e[:, 1], e[:, 3]) <= y1) & (np.maximum(e[:, 1], e[:, 3]) >= y0)
    dx, dy = e[:, 2] - e[:, 0], e[:, 3] - e[:, 1]
    sides = np.stack([dx * (y - e[:, 1]) - dy * (x - e[:, 0]) for x in (x0, x1) for y in (y0, y1)])
    slack = 1e-9 * (np.abs(dx) + np.abs(dy)) * (x1 - x0)
    return near & (sides.min(0) <= slack) & (sides.max(0) >= -slack)


def _inside(e: np.ndarray, x: float, y: float) -> bool:
    c = e[(e[:, 1] > y) != (e[:, 3] > y)]
    return bool((x < (c[:, 2] - c[:, 0]) * (y - c[:, 1]) / (c[:, 3] - c[:, 1]) + c[:, 0]).sum() % 2)


def refined(edges: np.ndarray, size: float, most: int) -> list[tuple[int, int, int, bool]]:
    """(level, cx, cy, inner): cells of a polygon's edges, at most about `most`. The others are crossed by an edge."""
    xs, ys = edges[:, [0, 2]], edges[:, [1, 3]]
    level = max(0, math.ceil(math.log2(max(np.ptp(xs), np.ptp(ys)) / size)))
    inner, heap, n = [], [], 0

    def add(level: int, cx: int, cy: int, e: np.ndarray) -> None:
        nonlocal n
        wide = size * 2.0**level
        touched = e[_touched(e, cx * wide, cy * wide, (cx + 1) * wide, (cy + 1) * wide)]
        if len(touched):
            heapq.heappush(heap, (-level, n, cx, cy, touched))
            n += 1
        elif _inside(edges, (cx + 0.5) * wide, (cy + 0.5) * wide):
            inner.append((level, cx, cy, True))

    wide = size * 2.0**level
    for cx in range(math.floor(xs.min() / wide), math.floor(xs.max() / wide) + 1):
        for cy in range(math.floor(ys.min() / wide), math.floor(ys.max() / wide) + 1):
            add(level, cx, cy, edges)
    while heap and heap[0][0] < 0 and len(heap) + len(inner) + 3 <= most:
        up, _, cx, cy, touched = heapq.heappop(heap)
        for i in (0, 1):
            for j in (0, 1):
                add(-up - 1, 2 * cx + i, 2 * cy + j, touched)
    return inner + [(-up, cx, cy, False) for up, _, cx, cy, _ in heap]


def boxed(shapes: DataFrame, size: float) -> DataFrame:
    """The shapes (key, geom, ...) that have points, with box and level: that of the cells that are as wide as the box."""
    rows = shapes.withColumn("box", G.geom_bbox(F.col("geom"))).where("box.xmin is not null")
    width = F.greatest(F.col("box.xmax") - F.col("box.xmin"), F.col("box.ymax") - F.col("box.ymin"))
    return rows.withColumn("level", F.when(width > size, F.ceil(F.log2(width / size))).otherwise(0).cast("int"))


def _width(size: float) -> Column:
    return F.lit(float(size)) * F.pow(F.lit(2.0), F.col("level"))


def _touching(rows: DataFrame, size: float) -> DataFrame:
    """`boxed` rows of levels 0 and 1, once for each of the one to four cells (cx, cy) of their level that their box touches."""
    at = lambda c: F.floor(F.col(f"box.{c}") / _width(size))
    return rows.where("level <= 1").withColumn("cx", F.explode(F.sequence(at("xmin"), at("xmax")))).withColumn("cy", F.explode(F.sequence(at("ymin"), at("ymax"))))


def _small(rows: DataFrame, size: float) -> DataFrame:
    """Cells of the `boxed` rows of levels 0 and 1, as `cover`."""
    one = [F.floor(F.col(f"box.{c}min") / _width(size)) == F.floor(F.col(f"box.{c}max") / _width(size)) for c in "xy"]
    return _touching(rows, size).select("key", "box", "level", "cx", "cy", F.lit(False).alias("inner"), (one[0] & one[1]).alias("sure"))


def _large(rows: DataFrame, size: float, most: int) -> DataFrame:
    """Cells of the `boxed` rows of higher levels, as `cover`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [refined(np.reshape(e, (-1, 4)), size, most) for e in batch.column("edges").to_numpy(zero_copy_only=False)]
            owner = pa.array(np.repeat(np.arange(len(found)), [len(f) for f in found]))
            level, cx, cy, inner = (np.array([c[i] for f in found for c in f], t) for i, t in enumerate((np.int32, np.int64, np.int64, bool)))
            columns = [batch.column("key").take(owner), batch.column("box").take(owner), *map(pa.array, (level, cx, cy, inner, np.ones(len(inner), bool)))]
            yield pa.RecordBatch.from_arrays(columns, ["key", "box", "level", "cx", "cy", "inner", "sure"])

    large = rows.where("level > 1").select("key", "box", G.flat_edges(F.col("geom")).alias("edges"))
    kind = dict(rows.dtypes)["key"]
    return large.mapInArrow(run, f"key {kind}, box struct<xmin:double,ymin:double,xmax:double,ymax:double>, level int, cx long, cy long, inner boolean, sure boolean")


def cover(shapes: DataFrame, size: float, most: int = 64) -> DataFrame:
    """Cells of shapes (key, geom): key, box, level, cx, cy, inner (the cell lies in the shape) and sure (the shape has a point in the cell)."""
    rows = boxed(shapes, size)
    return _small(rows, size).unionByName(_large(rows, size, most))


def _near(sides: Sequence[DataFrame], levels: Sequence[Sequence[int]], size: float, columns: Sequence[Sequence[str]], test: Column | None) -> list[DataFrame]:
    """Pairs of the `boxed` rows of levels 0 and 1, with their `columns`; with `test` the l_key of left ones in a pair that passes.

    Rows go to their cells with what they carry, and nothing is moved after that. A pair is made in one cell only, of those of the
    lower level: the one with the lower left corner of what the boxes share, which lies in the covers of both.
    """
    number = int(sides[0].sparkSession.conf.get("spark.sql.shuffle.partitions"))  # few bytes and much work: not to be merged by size
    found = []
    for low, high in ((0, 1), (1, 0)):
        to = [w for w in levels[high] if w <= 1]
        below = (lambda v, w: v <= w) if low == 0 else (lambda v, w: v < w)
        if not any(below(v, w) for v in levels[low] for w in to):
            continue
        cells = [_touching(s, size).select(*[F.col(c).alias(f"{p}_{c}") for c in dict.fromkeys([*of, "box"])], "level", "cx", "cy") for s, p, of in zip(sides, "lr", columns, strict=True)]
        a = cells[low].withColumn("up", F.explode(F.array_compact(F.array(*[F.when(below(F.col("level"), w), F.lit(w)) for w in to]))))
        a = a.withColumns({"x": F.expr("shiftright(cx, up - level)"), "y": F.expr("shiftright(cy, up - level)")}).repartition(number, "up", "x", "y")
        b = cells[high].withColumnsRenamed({"level": "b_up", "cx": "b_x", "cy": "b_y"}).repartition(number, "b_up", "b_x", "b_y").hint("merge")  # cells of dense places may spill; a broadcast, chosen by the size of files, would hold all
        meets = (F.col("up") == F.col("b_up")) & (F.col("x") == F.col("b_x")) & (F.col("y") == F.col("b_y")) & G.bbox_overlaps(F.col("l_box"), F.col("r_box"))
        if test is None:
            first = [F.col(f"c{k}") == F.floor(F.greatest(f"l_box.{k}min", f"r_box.{k}min") / _width(size)) for k in "xy"]
            found.append(a.join(b, meets & first[0] & first[1]).select(*[f"{p}_{c}" for p, of in zip("lr", columns, strict=True) for c in of]))
        else:
            left, right = (a, b) if low == 0 else (b, a)
            found.append(left.join(right, meets & test, "left_semi").select("l_key"))
    return found


def _under(low: DataFrame, high: DataFrame, same: bool) -> DataFrame:
    """Cells of `low` with the cells of `high` that they lie in (or, with `same`, are)."""
    of_high = sorted(r[0] for r in high.select("level").distinct().collect())  # at most one for each power of two
    rise = F.filter(F.array(*[F.lit(v) for v in of_high]).cast("array<int>"), lambda v: v >= F.col("a_level") if same else v > F.col("a_level"))
    a = low.select(*[F.col(c).alias(f"a_{c}") for c in low.columns]).withColumn("up", F.explode(rise))
    a = a.withColumns({"x": F.expr("shiftright(a_cx, up - a_level)"), "y": F.expr("shiftright(a_cy, up - a_level)")})
    b = high.select(*[F.col(c).alias(f"b_{c}") for c in high.columns])
    b = F.broadcast(b) if high.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else b
    met = a.join(b, (F.col("up") == F.col("b_level")) & (F.col("x") == F.col("b_cx")) & (F.col("y") == F.col("b_cy"))).where(G.bbox_overlaps(F.col("a_box"), F.col("b_box")))
    certain = (F.col("b_inner") & F.col("a_sure")) | ((F.col("up") == F.col("a_level")) & F.col("a_inner") & F.col("b_sure"))
    return met.select("a_key", "b_key", certain.alias("certain"))


def _far(sides: Sequence[DataFrame], levels: Sequence[Sequence[int]], size: float, most: int) -> DataFrame | None:
    """Pairs (l_key, r_key, certain) of `boxed` rows with a row of a level above 1 in them, each once, written; none without such rows."""
    wide = [bool(of) and of[-1] > 1 for of in levels]
    if not any(wide):
        return None
    large = [written(_large(s, size, most), "cover") if w else None for s, w in zip(sides, wide, strict=True)]
    small = [_small(s, size) for s in sides]
    every = [s if of is None else s.unionByName(of) for s, of in zip(small, large, strict=True)]
    meet = ([(large[0], every[1])] if wide[0] else []) + ([(small[0], large[1])] if wide[1] else [])
    ab = [_under(a, b, True).toDF("l_key", "r_key", "certain") for a, b in meet]
    ba = [_under(b, a, False).toDF("r_key", "l_key", "certain") for a, b in meet]
    found = reduce(DataFrame.unionByName, ab + ba)
    pairs = written(found.groupBy("l_key", "r_key").agg(F.max("certain").alias("certain")), "meeting")
    for s in large:
        if s is not None:
            forget(s)
    return pairs


def meeting(left: DataFrame, right: DataFrame, size: float, most: int = 64, carried: Sequence[Sequence[str]] = ((), ()), test: Column | None = None) -> DataFrame:
    """Pairs (l_key, r_key, certain), each once, of shapes (key, geom) whose boxes overlap and whose covers meet; `certain` ones share a point.

    They have the columns `carried` of the left and of the right shapes too (l_..., r_...), `box` among them if it is asked for. With `test`, a condition on
    such a pair, there are no pairs but the l_key of left shapes that have a pair which is certain or passes; a near pair that passes is
    the last that its shape is tested in. Pairs of shapes at most twice as wide as `size` are neither moved nor stored; those with a
    wider shape are stored by key and take their columns afterwards.
    """
    sides = [boxed(s, size) for s in (left, right)]
    found = sides[0].select(F.lit(0).alias("side"), "level").unionByName(sides[1].select(F.lit(1).alias("side"), "level")).distinct().collect()
    levels = [sorted(r.level for r in found if r.side == k) for k in (0, 1)]
    near = _near(sides, levels, size, [["key", *of] for of in carried], test)
    near = [p if test is not None else p.withColumn("certain", F.lit(False)) for p in near]
    far = _far(sides, levels, size, most)

    def with_columns(pairs: DataFrame) -> DataFrame:
        for s, p, of in zip(sides, "lr", carried, strict=True):
            pairs = pairs.join(s.select(*[F.col(c).alias(f"{p}_{c}") for c in ("key", *of)]), f"{p}_key") if of else pairs
        return pairs

    if far is None:
        every = near
    elif test is None:
        every = [*near, with_columns(far)]
    else:
        sure = far.where("certain").select("l_key").distinct()
        every = [*near, sure, with_columns(far.where("not certain").join(sure, "l_key", "left_anti")).where(test).select("l_key")]
    names = ["l_key"] if test is not None else ["l_key", "r_key", "certain", *[f"{p}_{c}" for p, of in zip("lr", carried, strict=True) for c in of]]
    if not every:  # no two shapes
        none = left.select(F.col("key").alias("l_key")).limit(0)
        if test is not None:
            return none
        none = none.crossJoin(right.select(F.col("key").alias("r_key")).limit(0)).withColumn("certain", F.lit(False))
        return with_columns(none).select(*names)
    return reduce(DataFrame.unionByName, [p.select(*names) for p in every])
