"""Connected regions of equal cells, small-region removal, labelling of change."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Cells along a side of a block in which regions are found first.
SIDE = 256

#: Rows of (region, root) that may be broadcast: two numbers each.
BROADCAST_ROWS = 100_000


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder (`spark.checkpoint.dir`). Where that is unset one is made, if executors are local; else that is an error."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="landweave-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write in the shared folder and read again: lineage is cut, lost executors cost nothing."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def written_in_buckets(df: DataFrame, name: str, keys: list[str], number: int | None = None) -> DataFrame:
    """`written`, in `number` buckets by the keys (as many as a shuffle has partitions): joins by these keys move the other side only."""
    spark = df.sparkSession
    number, table = number or int(spark.conf.get("spark.sql.shuffle.partitions")), f"landweave_{name}_{uuid.uuid4().hex}"
    writer = df.repartition(number, *keys).write.bucketBy(number, *keys).format("parquet")
    writer.option("path", shared_folder(spark, name)).saveAsTable(table)
    found = spark.table(table)
    spark.sql(f"DROP TABLE {table}")  # the name only: its folder is in no warehouse, and is read as long as the plan is
    return found


def forget(table: DataFrame) -> None:
    """Delete the folder of a `written` table that nothing reads any more: a loop's state, once the next is written."""
    spark = table.sparkSession
    for folder in {file.rsplit("/", 1)[0] for file in table.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def neighbours(cells: DataFrame, same: list[str]) -> DataFrame:
    """Pairs (a > b) of cell numbers that touch along an edge and agree in `same`; cells has cell, row, col."""
    right = cells.select(*same, F.col("cell").alias("other"), F.col("row").alias("row"), (F.col("col") - 1).alias("col"))
    below = cells.select(*same, F.col("cell").alias("other"), (F.col("row") - 1).alias("row"), F.col("col").alias("col"))
    both = right.unionByName(below)
    pairs = cells.join(both, [*same, "row", "col"])
    return pairs.select(F.greatest("cell", "other").alias("a"), F.least("cell", "other").alias("b"))


def connected(pairs: DataFrame) -> DataFrame:
    """node and root (the smallest node reachable) of every node in a pair but the roots themselves; pairs are (a > b).

    Large-star and small-star steps alternate until nothing changes: rounds grow with the logarithm of a component's size, whatever its
    form. Each round is written to the shared folder and the one before it deleted.
    """
    edges, before = written(pairs, "pairs"), None
    # A node in many pairs keeps its least at first, and its others hang on that one.
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    new = _hung(edges, least)
    while True:
        stars = written(new, "stars")
        forget(edges)
        edges = stars
        row = tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if row == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = row
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a > b").distinct()
        new = _hung(large, large.groupBy("a").agg(F.min("b").alias("m")))


def _hung(edges: DataFrame, least: DataFrame) -> DataFrame:
    """The small-star step: each node keeps its least neighbour below (m), and its others below hang on that one."""
    other = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return least.select("a", F.col("m").alias("b")).unionByName(other).distinct()


def blocks(cells: DataFrame, by: list[str], side: int = SIDE) -> DataFrame:
    """One row for each square of `side` cells (and each value of `by`): br, bc, and its cells with all their columns, at most side * side of them."""
    at = [F.floor(F.col(c) / side).cast("int").alias(n) for c, n in (("row", "br"), ("col", "bc"))]
    return cells.groupBy(*by, *at).agg(F.collect_list(F.struct(*[F.col(f"`{c}`") for c in cells.columns])).alias("cells"))


def _merged(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least index that each of n indices hangs together with, by pairs (a, b): roots are hooked to smaller ones until no pair has two."""
    label = np.arange(n)
    while len(a):
        x, y = label[a], label[b]
        open_ = x != y
        a, b, x, y = a[open_], b[open_], x[open_], y[open_]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while (label != (up := label[label])).any():
            label = up
    return label


class Block:
    """The cells of a square as arrays, in the order of their numbers, and its pairs of neighbours (indices)."""

    def __init__(self, cells: pa.StructArray, by: list[str]):
        names = [f.name for f in cells.type]
        field = lambda c: cells.field(names.index(c))
        self.cells = cells.take(pc.array_sort_indices(field("cell")))
        cells = self.cells
        row, col = (field(c).to_numpy().astype(np.int64) for c in ("row", "col"))
        self.row, self.col = row, col
        self.codes = np.zeros(len(row), np.int64)
        self.known = np.ones(len(row), bool)
        for c in by:
            coded = field(c).dictionary_encode()
            self.known &= coded.is_valid().to_numpy(zero_copy_only=False)
            self.codes = self.codes * (len(coded.dictionary) + 1) + coded.indices.fill_null(0).to_numpy(zero_copy_only=False)
        r, c = row - row.min(), col - col.min()
        self.grid = np.full((r.max() + 2, c.max() + 2), -1)
        self.grid[r[::-1], c[::-1]] = np.arange(len(r))[::-1]  # of cells at one place the first
        here = self.grid[r, c]
        self.twice = here != np.arange(len(r))
        ends = [(np.flatnonzero(~self.twice), self.grid[r + i, c + j][~self.twice]) for i, j in ((0, 1), (1, 0))]
        self.pairs = [(a[b >= 0], b[b >= 0]) for a, b in ends] + [(np.flatnonzero(self.twice), here[self.twice])]

    def same(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (self.codes[a] == self.codes[b]) & self.known[a] & self.known[b]


def connected_regions(cells: DataFrame, value: str | list[str], tile: list[str] | None = None, mask: Column | None = None, side: int = SIDE) -> DataFrame:
    """The cells (cell, row, col, value) with `region`: the smallest cell number of the 4-connected cells of equal value, tile by tile.

    Regions are found in blocks of `side` by `side` cells first; only the strips along blocks' borders meet, and only regions that reach a
    border are contracted. Cells without a value are regions of their own. Cells at one place with one value are in one region.
    """
    values, tile = [value] if isinstance(value, str) else list(value), tile or []
    kept = cells if mask is None else cells.where(mask)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("cells")
            for i in range(len(lists)):
                block = Block(lists[i].values, values)
                pairs = [(a[k], b[k]) for a, b in block.pairs for k in [block.same(a, b)]]
                label = _merged(len(block.row), *(np.concatenate(x) for x in zip(*pairs, strict=True)))
                number = block.cells.field([f.name for f in block.cells.type].index("cell"))
                yield pa.RecordBatch.from_arrays([*block.cells.flatten(), number.take(pa.array(label))], [*(f.name for f in block.cells.type), "__label"])

    kinds = dict(kept.dtypes)
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in kept.columns) + f", __label {kinds['cell']}"
    labelled = written(blocks(kept, tile, side).select("cells").mapInArrow(run, schema), "labelled")
    # Neighbours over a border: the last row or column of a block and the first of the next.
    strip = labelled.select(*tile, *values, "row", "col", "__label")
    crossed = []
    for axis in ("row", "col"):
        first = strip.where(F.pmod(F.col(axis), F.lit(side)) == 0).withColumn(axis, F.col(axis) - 1).withColumnRenamed("__label", "__other")
        last = strip.where(F.pmod(F.col(axis), F.lit(side)) == side - 1)
        crossed.append(last.join(first, [*tile, *values, "row", "col"]).select(F.greatest("__label", "__other").alias("a"), F.least("__label", "__other").alias("b")))
    roots = connected(crossed[0].unionByName(crossed[1]).where("a <> b").distinct()).select(F.col("node").alias("__label"), "root")
    roots = F.broadcast(roots) if roots.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else roots
    return labelled.join(roots, "__label", "left").withColumn("region", F.coalesce("root", "__label")).select(*kept.columns, "region")


def region_borders(cells: DataFrame, region: str = "region", side: int = SIDE) -> DataFrame:
    """a, b (a > b) and length: cell sides that regions of cells (cell, row, col, region) share; within blocks first, then over their borders."""
    kind = dict(cells.dtypes)[region]
    cells = cells.select("cell", "row", "col", F.col(region).alias("__region"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("cells")
            for i in range(len(lists)):
                block = Block(lists[i].values, ["__region"])
                a, b = (np.concatenate(x) for x in zip(*block.pairs[:2], strict=True))
                apart = block.codes[a] != block.codes[b]
                names = block.cells.field([f.name for f in block.cells.type].index("__region"))
                x, y = (names.take(pa.array(k[apart])) for k in (a, b))
                yield pa.RecordBatch.from_arrays([x, y], ["x", "y"])

    inner = blocks(cells, [], side).select("cells").mapInArrow(run, f"x {kind}, y {kind}")
    for axis in ("row", "col"):
        first = cells.where(F.pmod(F.col(axis), F.lit(side)) == 0).select((F.col(axis) - 1).alias(axis), "col" if axis == "row" else "row", F.col("__region").alias("y"))
        last = cells.where(F.pmod(F.col(axis), F.lit(side)) == side - 1).select("row", "col", F.col("__region").alias("x"))
        inner = inner.unionByName(last.join(first, ["row", "col"]).where("x <> y").select("x", "y"))
    return inner.groupBy(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).agg(F.count(F.lit(1)).alias("length"))


def merge_small(sizes: DataFrame, borders: DataFrame, least: float) -> DataFrame:
    """region and root of every region (region, n): those of fewer than `least` cells join the neighbour they share the longest border with.

    Of equal borders (a, b, length) the larger neighbour, then the smaller number. All small regions choose at once and what hangs together
    by choices becomes one, named by its smallest number, until no small region has a neighbour; their number at least halves in a round.
    """
    sizes, edges = written(sizes.select("region", "n"), "sizes"), written(borders, "borders")
    names = written(sizes.select("region", F.col("region").alias("root")), "names")
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"), "length"))
        small = sizes.where(F.col("n") < least).select(F.col("region").alias("a"))
        near = both.join(small, "a", "left_semi").join(sizes.select(F.col("region").alias("b"), "n"), "b")
        picks = written(near.groupBy("a").agg(F.min(F.struct((-F.col("length")).alias("l"), (-F.col("n")).alias("m"), "b"))["b"].alias("b")), "picks")
        if picks.isEmpty():
            return names
        roots = connected(picks.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
        to = lambda c: roots.select(F.col("node").alias(c), F.col("root").alias(f"__{c}"))
        moved = lambda df, c: df.join(to(c), c, "left").withColumn(c, F.coalesce(f"__{c}", c)).drop(f"__{c}")
        new = [
            written(moved(sizes, "region").groupBy("region").agg(F.sum("n").alias("n")), "sizes"),
            written(moved(moved(edges, "a"), "b").where("a <> b").groupBy(F.greatest("a", "b").alias("x"), F.least("a", "b").alias("y")).agg(F.sum("length").alias("length")).select(F.col("x").alias("a"), F.col("y").alias("b"), "length"), "borders"),
            written(moved(names, "root"), "names"),
        ]
        for old in (sizes, edges, names, picks, roots):
            forget(old)
        sizes, edges, names = new


def filter_mmu(changed: DataFrame, min_area: float, cell_area: float = 1.0) -> DataFrame:
    """Changed cells (cell, row, col) in 4-connected clumps of at least `min_area`."""
    regions = connected_regions(changed.withColumn("one", F.lit(1)), "one")
    big = regions.groupBy("region").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") * abs(cell_area) >= min_area)
    return regions.join(big.select("region"), "region", "left_semi").drop("one")


def label_change(changed: DataFrame, before: DataFrame, after: DataFrame) -> DataFrame:
    """Changed cells with pre and post codes (0 where there is none), grouped by contiguous equal pair."""
    pre, post = before.select("row", "col", F.col("code").alias("pre")), after.select("row", "col", F.col("code").alias("post"))
    both = changed.join(pre, ["row", "col"], "left").join(post, ["row", "col"], "left")
    both = both.withColumns({"pre": F.coalesce("pre", F.lit(0)), "post": F.coalesce("post", F.lit(0))})
    return connected_regions(both, ["pre", "post"])


def filter_no_change(objects: DataFrame) -> DataFrame:
    return objects.where("pre <> post")
