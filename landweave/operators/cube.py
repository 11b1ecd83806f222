"""The cell table: reading, tiling, resampling, reducing over time, and recipes."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from landweave.functions import raster
from landweave.operators import spatial

STATISTICS: dict[str, Callable[[Column], Column]] = {"mean": F.avg, "min": F.min, "max": F.max, "std": F.stddev_pop}


def scan_cube(spark: SparkSession, path: str, bands: Sequence[str], nodata: float | None = None, where: Column | None = None) -> DataFrame:
    """Cells of a product with the named bands only; nodata becomes null. Filters and columns reach the scan."""
    df = spark.read.parquet(path)
    keys = [c for c in ("product", "tile_x", "tile_y", "t", "row", "col", "qa") if c in df.columns]
    df = df if where is None else df.where(where)
    value = F.col if nodata is None else lambda b: raster.nodata_to_null(F.col(b), nodata)
    return df.select(*keys, *[value(b).alias(b) for b in bands])


def region_shape(name: str, countries: DataFrame, regions: DataFrame) -> DataFrame:
    """The shapes (geom) of a name: those of a country, or of a region where no country has it."""
    found = countries.where(F.col("name") == name).select("geom", F.lit(0).alias("turn")).unionByName(regions.where(F.col("name") == name).select("geom", F.lit(1).alias("turn")))
    first = found.agg(F.min("turn").alias("turn"))
    return found.join(F.broadcast(first), "turn").select("geom")  # one row


def query_tiles(tiles: DataFrame, box: Sequence[float] | None = None, shape: DataFrame | None = None, begin=None, end=None, size: float = 1.0) -> DataFrame:
    """Tiles (xmin, ymin, xmax, ymax, t) that share a point with a shape (geom), or with a box if there is no shape, in an optional period.

    Shapes meet tiles by buckets of `size`, then exactly.
    """
    if begin is not None and end is not None:
        tiles = tiles.where(F.col("t").between(begin, end))
    if shape is not None:
        corner = lambda x, y: F.struct(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))
        ring = F.array(corner("xmin", "ymin"), corner("xmax", "ymin"), corner("xmax", "ymax"), corner("xmin", "ymax"))
        sides = ["xmin", "ymin", "xmax", "ymax"]
        places = tiles.select(*sides).distinct().select(F.struct(*sides).alias("id"), F.array(F.array(ring)).alias("geom"))
        met = spatial.spatial_semi_join(places, shape, size).select("id.*")
        return tiles.join(met, sides, "left_semi")
    if box is None:
        raise ValueError("a region or a box is needed")
    xmin, ymin, xmax, ymax = box
    return tiles.where((F.col("xmin") <= xmax) & (F.col("xmax") >= xmin) & (F.col("ymin") <= ymax) & (F.col("ymax") >= ymin))


def resample(target: DataFrame, source: DataFrame, place: Callable[[Column, Column], Column], x0: float, y0: float, res: float, keys: Sequence[str] = ()) -> DataFrame:
    """The source's bands on the target's cells, nearest cell, through a projection; cells outside the source have nulls.

    `place` gives the source's coordinates (struct of x and y) of a target cell's (row, col); x0, y0 and res are the source's corner and cell size.
    """
    at = target.withColumn("__p", place(F.col("row"), F.col("col")))
    at = at.withColumns({"__sr": F.floor((F.lit(y0) - F.col("__p.y")) / res).cast("int"), "__sc": F.floor((F.col("__p.x") - x0) / res).cast("int")}).drop("__p")
    bands = [c for c in source.columns if c not in ("row", "col", *keys)]
    src = source.select(*keys, F.col("row").alias("__sr"), F.col("col").alias("__sc"), *bands)
    return at.join(src, [*keys, "__sr", "__sc"], "left").select(*target.columns, *bands)


def load_like(target: DataFrame, source: DataFrame, ratio: float, keys: Sequence[str] = ()) -> DataFrame:
    """The source's bands on the target's cells, nearest cell; a target cell is `ratio` source cells wide."""
    at = lambda c: F.floor((F.col(c) + 0.5) * ratio).cast("int")
    bands = source.drop("row", "col").columns
    src = source.select(*[F.col(c).alias(f"__s_{c}") for c in (*keys, "row", "col")], *[b for b in bands if b not in keys])
    on = (at("row") == F.col("__s_row")) & (at("col") == F.col("__s_col"))
    for k in keys:
        on = on & (F.col(k) == F.col(f"__s_{k}"))
    return target.join(src, on, "left").drop(*[f"__s_{c}" for c in (*keys, "row", "col")])


def tile_grid(extents: DataFrame, res: float, size: int) -> DataFrame:
    """Tiles of extents (name, xmin, ymin, xmax, ymax), row by row: index, rows, cols, x, y; the last are smaller."""
    rows = F.ceil((F.col("ymax") - F.col("ymin")) / res)
    cols = F.ceil((F.col("xmax") - F.col("xmin")) / res)
    grid = extents.withColumn("n_rows", rows).withColumn("n_cols", cols)
    down = lambda n: F.sequence(F.lit(0), F.greatest(F.ceil(F.col(n) / size).cast("int") - 1, F.lit(0)))
    grid = grid.withColumn("tr", F.explode(down("n_rows"))).withColumn("tc", F.explode(down("n_cols")))
    return grid.select(
        "name",
        (F.col("tr") * F.ceil(F.col("n_cols") / size) + F.col("tc")).cast("long").alias("tile"),
        F.least(F.lit(size), F.col("n_rows") - F.col("tr") * size).cast("long").alias("rows"),
        F.least(F.lit(size), F.col("n_cols") - F.col("tc") * size).cast("long").alias("cols"),
        (F.col("xmin") + F.col("tc") * (res * size)).alias("x"),
        (F.col("ymax") - F.col("tr") * (res * size)).alias("y"),
    )


def regrid_to_tiles(cells: DataFrame, bands: Sequence[str], size: int, lon: Column | None = None) -> DataFrame:
    """Cells with tile keys; of several acquisitions of one cell and solar day the first with a value counts.

    The solar day is four minutes later for each degree of longitude; without one it is the day at 0 degrees.
    """
    solar = F.col("t") if lon is None else F.timestamp_micros((F.unix_micros(F.col("t").cast("timestamp")) + F.round(lon * 240_000_000)).cast("long"))
    tiled = cells.withColumns({"tile_x": F.floor(F.col("col") / size).cast("int"), "tile_y": F.floor(F.col("row") / size).cast("int"), "day": F.to_date(solar)})
    return tiled.groupBy("tile_x", "tile_y", "day", "row", "col").agg(*[F.min_by(b, F.when(F.col(b).isNotNull(), F.col("t"))).alias(b) for b in bands])


def temporal_reduce(cells: DataFrame, plan: dict[str, Sequence[str]], by: Sequence[str] = ("row", "col")) -> DataFrame:
    """Per cell, over time, missing values skipped: band -> statistics, as band_statistic. One aggregation for all."""
    return cells.groupBy(*by).agg(*[STATISTICS[s](b).alias(f"{b}_{s}") for b, stats in plan.items() for s in stats])


def recipe(
    cells: DataFrame,
    mask: Column,
    bands: Sequence[str],
    indices: dict[str, tuple[str, str]],
    plan: dict[str, Sequence[str]],
    nodata: int = -9999,
    terrain: DataFrame | None = None,
    by: Sequence[str] = ("row", "col"),
) -> DataFrame:
    """Mask, take nodata out, add indices, reduce over time, put nodata back as int16, and add terrain on the same cells."""
    clean = cells.select(*by, *[F.when(mask, raster.nodata_to_null(F.col(b), nodata)).alias(b) for b in bands])
    clean = clean.withColumns({name: raster.normalized_difference(F.col(a), F.col(b)) for name, (a, b) in indices.items()})
    out = temporal_reduce(clean, plan, by)
    features = [c for c in out.columns if c not in by]
    out = out.select(*by, *[raster.null_to_nodata_int16(F.col(c), nodata).alias(c) for c in features])
    return out if terrain is None else out.join(terrain, list(by), "full")


LANDSAT = ("blue", "green", "red", "nir", "swir1", "swir2")
SENTINEL = ("blue", "green", "red", "re1", "re2", "re3", "nir", "swir1", "swir2")
_CLEAN = dict(cloud=False, cloud_shadow=False, snow=False)


def landsat_001(cells: DataFrame, terrain: DataFrame | None = None) -> DataFrame:
    """Mean, extremes and deviation of six bands and NDVI."""
    return recipe(cells, raster.qa_bitmask(F.col("qa"), **_CLEAN), LANDSAT, {"ndvi": ("nir", "red")}, {b: ("mean", "min", "max", "std") for b in (*LANDSAT, "ndvi")}, terrain=terrain)


def landsat_002(cells: DataFrame, terrain: DataFrame | None = None) -> DataFrame:
    """Means of six bands and two indices, extremes of the indices."""
    plan = {b: ("mean",) for b in LANDSAT} | {i: ("mean", "min", "max") for i in ("ndvi", "ndmi")}
    return recipe(cells, raster.qa_bitmask(F.col("qa"), **_CLEAN), LANDSAT, {"ndvi": ("nir", "red"), "ndmi": ("nir", "swir1")}, plan, terrain=terrain)


def ndvi_mean(cells: DataFrame) -> DataFrame:
    """Mean NDVI of clear observations."""
    return recipe(cells, raster.qa_bitmask(F.col("qa"), clear=True), ("nir", "red"), {"ndvi": ("nir", "red")}, {"ndvi": ("mean",)})


def s2_001(cells: DataFrame, terrain: DataFrame | None = None, kept: Sequence[int] = raster.SCL_KEPT) -> DataFrame:
    """Means of nine bands and two indices, extremes of the indices; nodata is 0."""
    plan = {b: ("mean",) for b in SENTINEL} | {i: ("mean", "min", "max") for i in ("ndvi", "ndmi")}
    return recipe(cells, raster.qa_classmask(F.col("qa"), kept), SENTINEL, {"ndvi": ("nir", "red"), "ndmi": ("nir", "swir1")}, plan, nodata=0, terrain=terrain)


#: Recipes by name; users add their own.
RECIPES: dict[str, Callable[..., DataFrame]] = {"landsat_001": landsat_001, "landsat_002": landsat_002, "ndvi_mean": ndvi_mean, "s2_001": s2_001}


def run_recipe(name: str, cells: DataFrame, **options) -> DataFrame:
    if name not in RECIPES:
        raise ValueError(f"no recipe {name!r}; there are {sorted(RECIPES)}")
    return RECIPES[name](cells, **options)
