"""Superpixels on cells, and the outline edges of regions."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landweave.operators import regions
from landweave.operators.regions import forget, written, written_in_buckets


#: Cells along a side of a block that is searched at once, about.
SIDE = 64

#: Cells in a bucket of blocks, about: each of them is a task in every round.
BUCKET = 16_384


def segment_slic(cells: DataFrame, bands: Sequence[str], step: int | None = None, compactness: float = 0.1, rounds: int = 10, n_segments: int | None = None, connected: bool = True, least: float = 0.5) -> DataFrame:
    """The cells (row, col, bands) with `segment`: the seed nearest in colour and space, made of one piece.

    Seeds start as the means of squares of `step` cells, or of as many cells as make about `n_segments` of them. In each round a cell
    chooses among the seeds of its own square and the eight around it, by the squared colour distance plus `compactness` squared times
    the squared distance in steps; ties go to the smaller seed. Seeds then move to the means of their cells. Blocks of cells are dealt
    to buckets once, as many as the cells ask for; a round sends them their seeds and takes back sums by seed. Cells with a missing band are left out.

    With `connected` each segment is one 4-connected region, named by its smallest cell (row * 2^32 + col): pieces of fewer cells than
    `least` of an even share join the neighbour with the longest border, unless they have none. Without it segments are named by their seed.
    """
    own = cells.dropna(subset=list(bands)).select("row", "col", *bands)
    if (step is None) == (n_segments is None):
        raise ValueError("either step or n_segments is needed")
    count = own.count()
    step = max(1, round(math.sqrt(count / n_segments))) if step is None else step
    wide = max(1, SIDE // step)  # squares along a block's side
    number = min(int(own.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1 + count // BUCKET)
    held = written_in_buckets(regions.blocks(own, [], step * wide), "blocks", ["br", "bc"], number)
    square = lambda c: F.floor(F.col(c) / step).cast("int")
    names = ["row", "col", *bands]
    seeds = own.groupBy(square("row").alias("sr"), square("col").alias("sc")).agg(F.array(*[F.avg(c) for c in names]).alias("at"))
    near = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)])
    weight = (compactness / step) ** 2

    def chosen(cells: pa.StructArray, around: pa.StructArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """A block's cells as a matrix, its seeds' squares, and the seed of each cell."""
        x = np.stack([f.to_numpy(zero_copy_only=False).astype(float) for f in cells.flatten()], 1)
        fields = {f.name: around.field(i) for i, f in enumerate(around.type)}
        sr, sc = (fields[c].to_numpy() for c in ("sr", "sc"))
        at = fields["at"].flatten().to_numpy().reshape(len(sr), -1)
        r, c = (np.floor_divide(x[:, i], step).astype(np.int64) for i in (0, 1))
        r0, c0 = min(r.min(), sr.min()) - 1, min(c.min(), sc.min()) - 1
        grid = np.full((max(r.max(), sr.max()) - r0 + 2, max(c.max(), sc.max()) - c0 + 2), -1)
        grid[sr - r0, sc - c0] = np.arange(len(sr))
        best, seed = np.full(len(x), np.inf), np.full(len(x), -1)
        for i in (-1, 0, 1):
            for j in (-1, 0, 1):
                k = grid[r - r0 + i, c - c0 + j]
                d = x - at[k]
                cost = np.where(k >= 0, (d[:, 2:] ** 2).sum(1) + (d[:, :2] ** 2).sum(1) * weight, np.inf)
                less = cost < best
                best[less], seed[less] = cost[less], k[less]
        return x, np.stack([sr, sc], 1), seed

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cells, around in zip(batch.column("cells"), batch.column("seeds"), strict=True):
                x, squares, seed = chosen(cells.values, around.values)
                used, at = np.unique(seed, return_inverse=True)
                total = np.stack([np.bincount(at, x[:, k]) for k in range(x.shape[1])], 1)
                lists = pa.ListArray.from_arrays(np.arange(len(used) + 1, dtype=np.int32) * x.shape[1], total.ravel())
                yield pa.RecordBatch.from_arrays([pa.array(squares[used, 0].astype(np.int32)), pa.array(squares[used, 1].astype(np.int32)), pa.array(np.bincount(at)), lists], ["sr", "sc", "n", "total"])

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cells, around in zip(batch.column("cells"), batch.column("seeds"), strict=True):
                _, squares, seed = chosen(cells.values, around.values)
                yield pa.RecordBatch.from_arrays([*cells.values.flatten(), *(pa.array(squares[seed, k].astype(np.int32)) for k in (0, 1))], [*names, "__sr", "__sc"])

    def dealt(seeds: DataFrame) -> DataFrame:
        """Blocks with the seeds of their squares and those around."""
        met = F.transform(near, lambda o: F.struct(F.floor((F.col("sr") + o["i"]) / wide).cast("int").alias("br"), F.floor((F.col("sc") + o["j"]) / wide).cast("int").alias("bc")))
        sent = seeds.select(F.explode(F.array_distinct(met)).alias("b"), "sr", "sc", "at").select("b.*", "sr", "sc", "at").repartition(number, "br", "bc")
        return held.join(sent.groupBy("br", "bc").agg(F.collect_list(F.struct("sr", "sc", "at")).alias("seeds")), ["br", "bc"])

    seeds = written(seeds, "seeds")
    for _ in range(rounds - 1):
        found = dealt(seeds).mapInArrow(sums, "sr int, sc int, n long, total array<double>")
        mean = F.array(*[F.sum(F.get("total", F.lit(i))) / F.sum("n") for i in range(len(names))])
        new = written(found.groupBy("sr", "sc").agg(mean.alias("at")), "seeds")
        forget(seeds)
        seeds = new
    kinds = dict(own.dtypes)
    out = written(dealt(seeds).mapInArrow(named, ", ".join(f"`{c}` {kinds[c]}" for c in names) + ", __sr int, __sc int"), "chosen")
    forget(seeds)
    forget(held)
    if not connected:
        return out.select(*names, F.concat_ws("_", "__sr", "__sc").alias("segment"))
    number = F.shiftleft(F.col("row").cast("long"), 32) + F.col("col")
    pieces = written(regions.connected_regions(out.withColumn("cell", number), ["__sr", "__sc"]).select(*names, "cell", "region"), "pieces")
    forget(out)
    sizes = pieces.groupBy("region").agg(F.count(F.lit(1)).alias("n"))
    roots = regions.merge_small(sizes, regions.region_borders(pieces), least * step * step)
    return pieces.join(roots, "region").select(*names, F.col("root").alias("segment"))


#: Segmentations by name; each takes (cells, bands) and its options and adds `segment`. Users add their own.
SEGMENTATIONS: dict[str, Callable[..., DataFrame]] = {"slic": segment_slic}


def segment(method: str, cells: DataFrame, bands: Sequence[str], **options) -> DataFrame:
    if method not in SEGMENTATIONS:
        raise ValueError(f"no segmentation {method!r}; there are {sorted(SEGMENTATIONS)}")
    return SEGMENTATIONS[method](cells, bands, **options)


def region_edges(cells: DataFrame, region: str = "region") -> DataFrame:
    """Directed outline edges of regions (region, x1, y1, x2, y2; y downwards): sides that no other cell of the region shares."""
    sides = [((0, 0), (1, 0)), ((1, 0), (1, 1)), ((1, 1), (0, 1)), ((0, 1), (0, 0))]
    edge = lambda a, b: F.struct((F.col("col") + a[0]).alias("x1"), (F.col("row") + a[1]).alias("y1"), (F.col("col") + b[0]).alias("x2"), (F.col("row") + b[1]).alias("y2"))
    edges = cells.select(region, F.explode(F.array(*[edge(a, b) for a, b in sides])).alias("e")).select(region, "e.*")
    back = edges.select(region, F.col("x2").alias("x1"), F.col("y2").alias("y1"), F.col("x1").alias("x2"), F.col("y1").alias("y2"))
    return edges.join(back, [region, "x1", "y1", "x2", "y2"], "left_anti")


def region_rings(cells: DataFrame, region: str = "region") -> DataFrame:
    """Outline rings of regions as rows: region, ring, seq, x, y (the start of each edge; y downwards), the region on the right hand.

    Where two cells of a region touch at a corner only, the outline stays with its cell. Edges are chained by pointer doubling, so
    that a ring of n edges takes about 2 log2 n joins and no task holds a ring. `ring` is the least edge number in it.
    """
    sides = [((0, 0), (1, 0)), ((1, 0), (1, 1)), ((1, 1), (0, 1)), ((0, 1), (0, 0))]
    side = lambda i, a, b: F.struct(F.lit(i).alias("side"), (F.col("col") + a[0]).alias("x1"), (F.col("row") + a[1]).alias("y1"), (F.col("col") + b[0]).alias("x2"), (F.col("row") + b[1]).alias("y2"))
    edges = cells.select(region, "row", "col", F.explode(F.array(*[side(i, a, b) for i, (a, b) in enumerate(sides)])).alias("e")).select(region, "row", "col", "e.*")
    back = edges.select(region, F.col("x2").alias("x1"), F.col("y2").alias("y1"), F.col("x1").alias("x2"), F.col("y1").alias("y2"))
    number = F.shiftleft(F.col("row").cast("long"), 34) + F.col("col").cast("long") * 4 + F.col("side")
    edges = written(edges.join(back, [region, "x1", "y1", "x2", "y2"], "left_anti").withColumn("id", number), "edges")

    starts = edges.select(region, F.col("x1").alias("x2"), F.col("y1").alias("y2"), F.col("id").alias("to"), F.col("side").alias("turn"))
    same_cell = F.col("turn") == (F.col("side") + 1) % 4
    state = edges.join(starts, [region, "x2", "y2"]).groupBy("id").agg(F.min_by("to", F.struct(~same_cell, "to")).alias("to"))
    follow = written(state, "follow")
    state = written(follow.select("id", "to", F.least("id", "to").alias("ring")), "ring")
    while True:  # the least edge number within 2, 4, 8 ... edges ahead
        ahead = state.select(F.col("id").alias("to"), F.col("to").alias("after"), F.col("ring").alias("theirs"))
        new = written(state.join(ahead, "to").select("id", F.col("after").alias("to"), F.least("ring", "theirs").alias("ring"), (F.col("theirs") < F.col("ring")).alias("moved")), "ring")
        state = new.drop("moved")
        if new.where("moved").isEmpty():
            break
    rings = state.select("id", "ring")
    # edges left until the one before the ring's first, again by doubling
    steps = follow.join(rings, "id").select("id", "ring", F.when(F.col("to") != F.col("ring"), F.col("to")).alias("to"), F.when(F.col("to") != F.col("ring"), 1).otherwise(0).cast("long").alias("left"))
    steps = written(steps, "steps")
    while not steps.where("to is not null").isEmpty():
        ahead = steps.select(F.col("id").alias("__to"), F.col("to").alias("after"), F.col("left").alias("more"))
        new = steps.join(ahead, F.col("to") == F.col("__to"), "left")
        steps = written(new.select("id", "ring", F.col("after").alias("to"), (F.col("left") + F.coalesce("more", F.lit(0))).alias("left")), "steps")
    lengths = steps.where(F.col("id") == F.col("ring")).select("ring", F.col("left").alias("whole"))
    found = steps.join(lengths, "ring").select("id", "ring", (F.col("whole") - F.col("left")).alias("seq"))
    return edges.join(found, "id").select(region, "ring", "seq", F.col("x1").alias("x"), F.col("y1").alias("y"))
