"""Vector sources and the catalogue tables: footprints, training and validation polygons, boundaries, products, listings, raster export."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from landweave.functions import catalog as C
from landweave.functions import geometry as G
from landweave.operators import spatial
from landweave.operators.numbering import sequential
from landweave.sources import store

# The form of a scene's product identifier, by mission prefix.
SCENE_ID = r"^{}_\w{{4}}_[0-9]{{6}}_[0-9]{{8}}_[0-9]{{8}}_[0-9]{{2}}_\w{{2}}$"


def read_features(spark: SparkSession, path: str, properties: dict[str, str], project=None) -> DataFrame:
    """Polygons of GeoJSON lines: line (the text), geom, the named properties (name -> type) and `path`; `project` takes and gives coordinates."""
    lines = spark.read.text(path).select(F.col("value").alias("line"), F.col("_metadata.file_path").alias("path"))
    geom = G.feature_geometry(F.col("line"))
    geom = geom if project is None else G.reproject(geom, project)
    out = lines.select("line", "path", geom.alias("geom"), *[F.get_json_object("line", f"$.properties.{n}").try_cast(t).alias(n) for n, t in properties.items()])
    return out.where(F.col("geom").isNotNull())


def ingest_footprints(polygons: DataFrame, countries: DataFrame, size: float = 5.0) -> tuple[DataFrame, DataFrame]:
    """(footprints, rejects) of (path, row, geom) in longitude and latitude: those that meet a country, named by path and row.

    Of polygons with one name the one of the least bounding box (then geometry) stays, the others are rejects, as are those outside.
    """
    rows = polygons.withColumns({"name": C.path_row_name(F.col("path"), F.col("row")), "id": F.xxhash64("path", "row", "geom")})
    inside = spatial.spatial_semi_join(rows, countries, size)
    kept = inside.groupBy("name").agg(F.min(F.struct(G.geom_bbox(F.col("geom")).alias("box"), "geom", "id")).alias("k")).select("name", "k.geom", "k.id")
    return kept.select("name", "geom"), rows.join(kept, "id", "left_anti").select("name", "geom")


def with_tags(rows: DataFrame, code: str, scheme: str, tags: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(tags, rows with `tag`): the tag of each row's code in a scheme, new ones added after the largest id. `tags` has tag, scheme, code."""
    own = tags.where(F.col("scheme") == scheme)
    new = rows.select(F.col(code).cast("long").alias("code")).where("code is not null").distinct().join(own.select(F.col("code").cast("long").alias("code")), "code", "left_anti")
    most = tags.agg(F.coalesce(F.max("tag"), F.lit(0)).cast("long").alias("most"))
    new = sequential(new, "code", "turn", 1).join(F.broadcast(most), F.lit(True)).select((F.col("turn") + F.col("most")).alias("tag"), F.lit(scheme).alias("scheme"), "code")
    every = tags.select(F.col("tag").cast("long").alias("tag"), "scheme", F.col("code").cast("long").alias("code")).unionByName(new)
    found = every.where(F.col("scheme") == scheme).select("tag", F.col("code").alias("__code"))
    return every, rows.join(found, F.col(code).cast("long") == F.col("__code"), "left").drop("__code")


def ingest_training(features: DataFrame, order: str, code: str, scheme: str, training_set: str, year: int, tags: DataFrame, every: int | None = None, path: str = "path") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(objects, classifications, tags) of labelled polygons in the order of a unique column.

    Every n-th is kept, from the first, if `every` is above 1. Objects: id, geom, filename, creation_year; classifications: id, tag, training_set.
    """
    numbered = sequential(features, order, "id")
    if every is not None and every > 1:
        numbered = numbered.where(F.col("id") % every == 0)
    tags, rows = with_tags(numbered, code, scheme, tags)
    objects = rows.select("id", "geom", C.file_basename(F.col(path), False).alias("filename"), F.lit(year).alias("creation_year"))
    return objects, rows.select("id", "tag", F.lit(training_set).alias("training_set")), tags


def ingest_validation(features: DataFrame, order: str, code: str, scheme: str, validation_set: str, year: int, tags: DataFrame, project=None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """As training polygons; `project` brings the geometry to longitude and latitude where it isn't."""
    rows = features if project is None else features.withColumn("geom", G.reproject(F.col("geom"), project))
    objects, classes, tags = ingest_training(rows, order, code, scheme, validation_set, year, tags)
    return objects, classes.withColumnRenamed("training_set", "valid_set"), tags


def ingest_boundaries(countries: DataFrame, regions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(countries, regions) of (iso, name, geom): one country for each name, and regions with the name of their country."""
    land = countries.groupBy("name").agg(F.min_by("iso", "iso").alias("iso"), F.min_by("geom", "iso").alias("geom"))
    return land, regions.join(land.select("iso", F.col("name").alias("country")), "iso").select("name", "country", "geom")


def manifest_of(spark: SparkSession, manifest: str, schema: StructType) -> DataFrame:
    """The datasets of all commits of a manifest."""
    folders = [r.path for r in store.records(spark, manifest, "path string").select("path").collect()]  # one for each registration
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def register_product(datasets: DataFrame, name: str, description: str, path: str, manifest: str, res: float, lonlat: Callable[[Column, Column], Column] | None = None) -> DataFrame:
    """Add a product's datasets (uri, xmin, ymin, xmax, ymax of cell centres, begin, end) to a manifest; those it has already stay as they are.

    Adds the product's name and description, an id, extents half a cell wider on each side and, by `lonlat` (x and y to a struct of longitude
    and latitude), the corners ul, ur, lr and ll as lon_ and lat_ columns. Returns the manifest. A registration is one commit, numbered: where
    another writer takes the number first, what is new is found again.
    """
    spark, half = datasets.sparkSession, res / 2
    wider = {**{k: F.col(k) - half for k in ("xmin", "ymin")}, **{k: F.col(k) + half for k in ("xmax", "ymax")}}
    rows = datasets.withColumns({"id": C.dataset_uuid(F.col("uri")), "product": F.lit(name), "description": F.lit(description), "path": F.lit(path), "center": C.mid_date(F.col("begin"), F.col("end")), **wider})
    if lonlat is not None:
        rows = with_corners(rows, lonlat)
    while True:
        version = store.records(spark, manifest, "path string").count()
        known = manifest_of(spark, manifest, rows.schema).select("id")
        folder = store.fresh_folder(manifest, "datasets")
        rows.dropDuplicates(["id"]).join(known, "id", "left_anti").select(*rows.columns).write.parquet(folder)
        if store.publish(spark, manifest, f"{version:09d}", {"path": folder}):
            return manifest_of(spark, manifest, rows.schema)
        store.delete(spark, folder)


def with_corners(rows: DataFrame, lonlat: Callable[[Column, Column], Column]) -> DataFrame:
    """Rows with a box (xmin, ymin, xmax, ymax) and the longitude and latitude of its corners, as lon_ul, lat_ul and so on."""
    at = {"ul": ("xmin", "ymax"), "ur": ("xmax", "ymax"), "lr": ("xmax", "ymin"), "ll": ("xmin", "ymin")}
    points = {k: lonlat(F.col(x), F.col(y)) for k, (x, y) in at.items()}
    return rows.withColumns({f"{n}_{k}": p[c] for k, p in points.items() for n, c in (("lon", "x"), ("lat", "y"))})


def list_catalog(rows: DataFrame, column: str) -> DataFrame:
    """The distinct values of a catalogue column."""
    return rows.select(column).where(F.col(column).isNotNull()).distinct()


def features_in_polygon(objects: DataFrame, shape: DataFrame, size: float, page: int = 0, length: int = 100) -> DataFrame:
    """A page, by id, of the objects (id, geom) that meet a shape."""
    return spatial.spatial_semi_join(objects, shape, size).orderBy("id").offset(page * length).limit(length)


def dataset_outlines(datasets: DataFrame, order: str, metadata: str = "metadata") -> DataFrame:
    """id (from 0, in order) and the_geom: the polygon text of the four corners in a dataset's JSON metadata."""
    at = lambda corner: F.concat_ws(" ", *[F.get_json_object(metadata, f"$.extent.coord.{corner}.{k}") for k in ("lon", "lat")])
    ring = F.concat_ws(", ", *[at(c) for c in ("ul", "ur", "lr", "ll", "ul")])
    return sequential(datasets, order, "id").select(F.col("id").cast("long").alias("id"), F.concat(F.lit("SRID=4326;POLYGON (("), ring, F.lit("))")).alias("the_geom"))


def select_scenes_for_order(scenes: DataFrame, shape: DataFrame, mission: int, size: float, scene_id: str = "scene_id") -> DataFrame:
    """Scenes (id, geom, scene_id) that meet a shape and whose identifier has a mission's form, in any case."""
    form = SCENE_ID.format(C.mission_prefix(mission).lower())
    return spatial.spatial_semi_join(scenes.where(F.lower(scene_id).rlike(form)), shape, size)


def extent(features: DataFrame) -> DataFrame:
    """One row: the bounding box of all geometries."""
    b = features.select(G.geom_bbox(F.col("geom")).alias("b"))
    return b.agg(*[f(f"b.{k}").alias(k) for f, k in ((F.min, "xmin"), (F.min, "ymin"), (F.max, "xmax"), (F.max, "ymax"))])


def raster_of(features: DataFrame, res: float, order: str = "seq", code: str = "code") -> DataFrame:
    """Grid (row, col, code) over the extent of polygons: the code of the last polygon over a cell's centre, 0 where there is none."""
    box = extent(features).first()  # one row
    if box["xmin"] is None:
        return features.sparkSession.createDataFrame([], "row int, col int, code int")
    rows, cols = (int((box[f"{a}max"] - box[f"{a}min"]) // res) + 1 for a in ("y", "x"))
    spark = features.sparkSession
    grid = spark.range(rows * cols).select(F.expr(f"cast(id div {cols} as int)").alias("row"), (F.col("id") % cols).cast("int").alias("col"))
    ordered = features.select(F.col(order).alias("seq"), "geom", F.col(code).cast("int").alias("code"))
    return spatial.rasterize_values(ordered, grid, box["xmin"], box["ymax"], res, value="code")


def export_raster(features: DataFrame, path: str, res: float, colours: DataFrame | None = None) -> DataFrame:
    """Write the code grid, and the colour table (code, rgba; 0 is transparent) of `colours` (code, color as #rrggbb)."""
    raster_of(features, res).write.mode("overwrite").parquet(f"{path}/codes")
    if colours is not None:
        table = colours.select(F.col("code").cast("int").alias("code"), C.hex_to_rgba(F.col("color")).alias("rgba"))
        clear = table.sparkSession.range(1).select(F.lit(0).alias("code"), F.array(*[F.lit(0)] * 4).alias("rgba"))
        table.unionByName(clear).write.mode("overwrite").parquet(f"{path}/colours")
    return features.sparkSession.read.parquet(f"{path}/codes")


def matching_paths(files: DataFrame, pattern: str) -> DataFrame:
    """The listed files whose path matches a pattern."""
    return files.where(F.col("path").rlike(pattern))
