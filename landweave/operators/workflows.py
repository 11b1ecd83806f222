"""Whole jobs put together from the operators: change with labels, training and prediction of objects, validation, segments."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from landweave.functions import geometry as G
from landweave.operators import accuracy, change, covers, models, regions, segments, shifts, spatial
from landweave.operators.cube import query_tiles
from landweave.sources import store


def join_tiles(frames: Sequence[DataFrame], keys: Sequence[str], value: str = "value", how: str = "inner") -> DataFrame:
    """keys and `values`, the frames' values in order; `full` keeps every key and the values that are there."""
    if how not in ("inner", "full"):
        raise ValueError(f"no join {how!r}")
    parts = [f.select(*keys, F.col(value).alias(f"__v{i}")) for i, f in enumerate(frames)]
    both = reduce(lambda a, b: a.join(b, list(keys), how), parts)
    values = F.array(*[F.col(f"__v{i}") for i in range(len(parts))])
    return both.select(*keys, (values if how == "inner" else F.filter(values, lambda v: v.isNotNull())).alias("values"))


def pair_dates(pre: DataFrame, post: DataFrame, grids: tuple[DataFrame, DataFrame] | None = None, keys: Sequence[str] = ("row", "col")) -> DataFrame:
    """Cells of both dates as pre_* and post_* columns; if the grids (one row each) are given, they must be equal."""
    if grids is not None and grids[0].first() != grids[1].first():
        raise ValueError("the two images are not on one grid")
    side = lambda df, name: df.select(*keys, *[F.col(c).alias(f"{name}_{c}") for c in df.columns if c not in keys])
    return side(pre, "pre").join(side(post, "post"), list(keys))


def shift_join(cells: DataFrame, bands: Sequence[str], rows: int, cols: int, shift: tuple[int, int] = (1, 1)) -> DataFrame:
    """Each cell with the bands of the cell `shift` (rows, columns) before it as shifted_*; the grid wraps around."""
    return shifts.shift_join(cells, bands, rows, cols, shift)


def land_cover_at_change(cover: DataFrame, changed: DataFrame, key: str = "id") -> DataFrame:
    """Objects of a map (cells: row, col, id) that any changed cell touches."""
    return cover.join(changed.select("row", "col").distinct(), ["row", "col"], "left_semi").select(key).distinct()


def change_fraction(cells: DataFrame) -> DataFrame:
    return cells.agg(F.avg(F.col("changed").cast("double")).alias("fraction"))


def tile_report(results: DataFrame, failed: Column) -> DataFrame:
    """Tiles by outcome."""
    return results.groupBy(F.when(failed, "failed").otherwise("succeeded").alias("status")).agg(F.count(F.lit(1)).alias("n"))


def detect_and_classify_change(pairs: DataFrame, pre: Sequence[str], post: Sequence[str], before: DataFrame, after: DataFrame, threshold: float | None = None, method: str = "distance", min_area: float = 1, cell_area: float = 1.0, match: bool = False, **options) -> tuple[DataFrame, DataFrame]:
    """(objects, cells): changed objects with pre and post code and area, and their cells (cell, row, col, pre, post, region).

    Cells change by the distance of the bands (after matching the first date's histograms to the second's, if `match`; against a threshold, or
    Kapur's if there is none) or by the factors of `imadmaf`; clumps below
    min_area go, the rest are labelled with both maps' codes (row, col, code), and objects whose codes agree go. No change gives no rows.
    """
    if method == "distance":
        d = change.change_distance(pairs, pre, post, match)
        found = d.where(F.col("distance") > threshold) if threshold is not None else change.threshold_change("kapur", d, "distance", **options).where("changed")
    elif method == "imadmaf":
        found = change.imadmaf(regions.written(pairs, "pair"), pre, post, **options).where("changed")
    else:
        raise ValueError(f"no method {method!r}")
    clumps = regions.filter_mmu(regions.written(found.select("cell", "row", "col"), "changed"), min_area, cell_area).drop("region")
    cells = regions.written(regions.filter_no_change(regions.label_change(clumps, before, after)), "labelled")
    objects = cells.groupBy("region", "pre", "post").agg((F.count(F.lit(1)) * abs(cell_area)).alias("area"))
    return objects, cells


def extract_training(cells: DataFrame, zones: DataFrame, classes: DataFrame, bands: Sequence[str], statistic: str = "mean", sample: float = 1.0, tile: Sequence[str] = (), zone: str = "feature_id", categorical: Sequence[str] = ()) -> DataFrame:
    """Rows for training: one for each training object with cells: its statistic of every band, and its tag.

    cells: row, col, bands; zones: row, col, zone; classes: zone, tag and the tile columns. Rows with a missing feature are left out.
    """
    kept = models.sample_exact(classes, sample, tile, zone) if tile else classes
    return spatial.zonal_stats(zones.join(kept.select(zone), zone, "left_semi"), cells, bands, statistic, zone, categorical).dropna(subset=list(bands)).join(kept.select(zone, "tag"), zone)


#: Classifiers by name; users add their own.
MODELS: dict[str, Callable[..., PipelineModel]] = {"rf": models.fit_rf, "boosted": models.fit_boosted, "leafwise": models.fit_leafwise, "softmax": models.fit_softmax}


def fit_model(name: str, rows: DataFrame, features: Sequence[str], label: str = "tag", outliers: str | None = None, **options) -> PipelineModel:
    """A classifier by name; rows that are outliers of their class go first if `outliers` names the rows' key."""
    if name not in MODELS:
        raise ValueError(f"no model {name!r}; there are {sorted(MODELS)}")
    rows = models.remove_outliers(rows, features, label, outliers) if outliers else rows
    return MODELS[name](rows, features, label, **options)


_REGISTRY = "path string, recipe string, training_set string"


def save_model(model: PipelineModel, spark: SparkSession, path: str, name: str, recipe: str, training_set: str) -> DataFrame:
    """Save a model under a unique name in the store of `path` and return its registry. Of two writers of a name one succeeds, the other gets a ValueError."""
    if store.has(spark, path, name):
        raise ValueError(f"there is a model {name!r} already")
    folder = store.fresh_folder(path, "models")
    models.save(model, folder)
    if not store.publish(spark, path, name, {"path": folder, "recipe": recipe, "training_set": training_set}):
        store.delete(spark, folder)
        raise ValueError(f"there is a model {name!r} already")
    return store.records(spark, path, _REGISTRY)


def load_model(spark: SparkSession, path: str, name: str) -> PipelineModel:
    found = store.records(spark, path, _REGISTRY).where(F.col("name") == name).first()
    if found is None:
        raise ValueError(f"no model {name!r}")
    return models.load(spark, found["path"])


def predict_objects(model: PipelineModel, cells: DataFrame, zones: DataFrame, bands: Sequence[str], name: str, statistic: str = "mean", zone: str = "feature_id") -> DataFrame:
    """Classification rows of objects: zone, tag, confidence and the name they go by."""
    rows = spatial.zonal_stats(zones, cells, bands, statistic, zone).dropna(subset=list(bands))
    return models.predict(model, rows).select(zone, F.col("prediction").alias("tag"), "confidence", F.lit(name).alias("name"))


def validate_map(valid: DataFrame, predicted: DataFrame, size: float, scale: float = 1.0) -> DataFrame:
    """The accuracy report of predicted polygons against valid ones (geom, class), weighted by common area: n_rows, overall, classes (JSON).

    Different geometries meet, and count as often as their classes have them: a pair has the numbers of rows of each class.
    """

    def counted(rows: DataFrame) -> DataFrame:
        n = spatial.keyed(rows.select("geom", "class")).where("key is not null").groupBy("key", "class").agg(F.first("geom").alias("geom"), F.count(F.lit(1)).alias("n"))
        return regions.written(n.groupBy("key").agg(F.first("geom").alias("geom"), F.collect_list(F.struct("class", "n")).alias("classes")), "shapes")

    areas = spatial.common_areas(counted(valid), counted(predicted), size, scale)
    pairs = areas.select("weight", "r_classes", F.explode("l_classes").alias("l")).select("weight", "l", F.explode("r_classes").alias("r"))
    pairs = pairs.select(F.col("l.class").alias("truth"), F.col("r.class").alias("pred"), "weight", (F.col("l.n") * F.col("r.n")).alias("n"))
    sums = pairs.groupBy("truth", "pred").agg(F.sum(F.col("weight") * F.col("n")).alias("weight"), F.sum("n").alias("n"))
    return accuracy.validation_report(regions.written(sums, "overlaps"), "n")


def store_segments(cells: DataFrame, path: str, name: str, algorithm: str, parameters: str, segment: str = "segment") -> DataFrame:
    """The stored outlines (with name) of a segmentation; written first, under a row with its algorithm and parameters, if the name is not there yet.

    Of two writers of a name one stores, both get what is stored.
    """
    spark = cells.sparkSession
    if not store.has(spark, path, name):
        folder = store.fresh_folder(path, "objects")
        segments.region_rings(cells, segment).write.parquet(folder)
        if not store.publish(spark, path, name, {"path": folder, "algorithm": algorithm, "parameters": parameters}):
            store.delete(spark, folder)
    found = store.records(spark, path, "path string, algorithm string, parameters string").where(F.col("name") == name).first()
    return spark.read.parquet(found["path"]).withColumn("name", F.lit(name))


def objects_in_tiles(objects: DataFrame, tiles: DataFrame, size: float) -> DataFrame:
    """The objects (id, geom, ...) that lie in a tile's box (tile_x, tile_y, xmin, ymin, xmax, ymax), with its keys; of several tiles the first.

    An object meets tiles in the square of `size` that holds its lower left corner; a tile is in all squares it touches.
    """
    box = G.geom_bbox(F.col("geom"))
    place = lambda c: F.floor(c / size).cast("long")
    inner = objects.withColumn("__box", box).where("__box.xmin is not null").withColumns({"__x": place(F.col("__box.xmin")), "__y": place(F.col("__box.ymin"))})
    sides = ["xmin", "ymin", "xmax", "ymax"]
    outer = tiles.select("tile_x", "tile_y", F.struct(*[F.col(c).cast("double").alias(c) for c in sides]).alias("__tile")).distinct()
    outer = outer.withColumn("__x", F.explode(F.sequence(place(F.col("__tile.xmin")), place(F.col("__tile.xmax"))))).withColumn("__y", F.explode(F.sequence(place(F.col("__tile.ymin")), place(F.col("__tile.ymax")))))
    held = inner.join(outer, ["__x", "__y"]).where(G.bbox_contained(F.col("__box"), F.col("__tile")))
    first = held.groupBy("id").agg(F.min(F.struct("tile_x", "tile_y")).alias("t")).select("id", "t.*")
    return objects.join(first, "id")


def training_from_tiles(cube: DataFrame, tiles: DataFrame, objects: DataFrame, classes: DataFrame, bands: Sequence[str], x0: float, y0: float, res: float, size: float, statistic: str = "mean", sample: float = 1.0, box: Sequence[float] | None = None, shape: DataFrame | None = None, categorical: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(rows, report): a training row for each object (id, geom) that lies in a tile of the region: tile_x, tile_y, id, tag and the statistic of each band.

    cube: tile_x, tile_y, row, col (of the whole grid), bands; if it is partitioned by tile, only the region's tiles are read, found while
    the job runs. tiles: tile_x, tile_y and their boxes. classes: id, tag. `sample` is the exact share of each tile's objects. The report
    has objects in tiles, drawn ones, and those dropped for lack of a value (without a cell, or with a band missing), by tile.
    """
    wanted = query_tiles(tiles, box=box, shape=shape, size=size)
    held = regions.written(objects_in_tiles(objects.join(classes.select("id", "tag"), "id"), wanted, size), "held")
    drawn = regions.written(models.sample_exact(held, sample, ["tile_x", "tile_y"]), "drawn")
    zones = spatial.rasterize_features(drawn.select(F.col("id").alias("seq"), "geom", "id"), x0, y0, res, value="id")
    keys = wanted.select("tile_x", "tile_y").distinct()
    cells = cube.join(F.broadcast(keys) if keys.limit(covers.BROADCAST_ROWS + 1).count() <= covers.BROADCAST_ROWS else keys, ["tile_x", "tile_y"])
    found = spatial.zonal_stats(zones, cells.select("row", "col", *bands), bands, statistic, "id", categorical).dropna(subset=list(bands))
    rows = regions.written(drawn.select("tile_x", "tile_y", "id", "tag").join(found, "id").select("tile_x", "tile_y", "id", "tag", *bands), "training")
    count = lambda df, name: df.groupBy("tile_x", "tile_y").agg(F.count(F.lit(1)).alias(name))
    report = count(held, "objects").join(count(drawn, "drawn"), ["tile_x", "tile_y"], "left").join(count(rows, "kept"), ["tile_x", "tile_y"], "left").fillna(0)
    return rows, report.select("tile_x", "tile_y", "objects", "drawn", (F.col("drawn") - F.col("kept")).alias("dropped"))


def fit_from_tiles(name: str, spark: SparkSession, path: str, method: str, rows: DataFrame, bands: Sequence[str], recipe: str, training_set: str, outliers: bool = False, **options) -> DataFrame:
    """Fit a classifier by name to training rows (id, tag, bands) and save it in the store of `path`; returns the registry."""
    if store.has(spark, path, name):
        raise ValueError(f"there is a model {name!r} already")
    model = fit_model(method, rows, bands, "tag", "id" if outliers else None, **options)
    return save_model(model, spark, path, name, recipe, training_set)


def user_statistics(cells: DataFrame, by: str, statistics: dict[str, Callable[[Column], Column]], columns: Sequence[str]) -> DataFrame:
    """A group's statistics by functions that the user gives: each takes a column and gives an aggregate (built in, or a grouped pandas UDF)."""
    return cells.groupBy(by).agg(*[f(F.col(c)).alias(f"{c}_{n}") for c in columns for n, f in statistics.items()])


def add_column_by_key(table: DataFrame, other: DataFrame, key: str, column: str) -> DataFrame:
    return table.join(other.select(key, column), key)


def segment_workflow(polygons: DataFrame, cells: DataFrame, bands: Sequence[str], truth: DataFrame, size: float) -> DataFrame:
    """Segments (id, geom) with their cells' band statistics and shape, and the class and quality of the first relevant truth polygon.

    truth: id, geom, class. cells: id, bands. `spatial.is_relevant` says which truth polygons are relevant; segments without one have nulls.
    """
    g = F.col("geom")
    shape = polygons.select("id", G.polygon_area(g).alias("area"), G.polygon_perimeter(g).alias("perimeter"), G.bbox_perimeter(g).alias("__box"))
    shape = shape.withColumns(G.shape_metrics(F.col("area"), F.col("perimeter"), F.col("__box"))).drop("__box")
    stats = spatial.region_band_stats(cells, bands, "id").join(shape, "id")
    first = spatial.match_first_relevant(polygons.select("id", "geom"), truth.select("id", "geom", "class"), size)
    return stats.join(first.drop("r_id").withColumnRenamed("r_class", "class"), "id", "left")
