"""Writers. Each writes in parallel by Spark's own sources and returns what it has written, read again where that has a schema."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landweave.functions import geometry as G
from landweave.operators import spatial


def write_stats_csv(stats: DataFrame, path: str, key: str = "id") -> list[str]:
    """A statistics table as CSV with a header: the key first, the other columns by name. Returns the columns."""
    columns = [key, *sorted(c for c in stats.columns if c != key)]
    stats.select(*[F.col(f"`{c}`") for c in columns]).write.mode("overwrite").csv(path, header=True)
    return columns


def feature_json(geom: Column, properties: dict[str, Column]) -> Column:
    """A GeoJSON feature of a multipolygon (an array of polygons, each an array of rings of x and y) as text; null properties are left out."""
    closed = F.transform(geom, lambda polygon: F.transform(polygon, lambda ring: F.transform(F.concat(ring, F.slice(ring, 1, 1)), lambda p: F.array(p["x"], p["y"]))))
    shape = F.struct(F.lit("MultiPolygon").alias("type"), closed.alias("coordinates"))
    return F.to_json(F.struct(F.lit("Feature").alias("type"), shape.alias("geometry"), F.struct(*[c.alias(n) for n, c in properties.items()]).alias("properties")))


def classified_features(objects: DataFrame, tags: DataFrame, name: str | None = None, region: DataFrame | None = None, size: float = 1.0, project=None) -> DataFrame:
    """Features (id, geom, class, code) of classified polygons (id, geom, tag, and name) with their tag's (tag, value, code).

    Of a map by `name` and those that share a point with a region (geom) only, if given; `project` takes and gives coordinates.
    """
    rows = objects if name is None else objects.where(F.col("name") == name)
    rows = rows if region is None else spatial.spatial_semi_join(rows, region, size)
    geom = F.col("geom") if project is None else G.reproject(F.col("geom"), project)
    return rows.join(tags, "tag").select("id", geom.alias("geom"), F.col("value").alias("class"), "code")


def export_vector(objects: DataFrame, path: str, tags: DataFrame, name: str | None = None, region: DataFrame | None = None, size: float = 1.0, project=None) -> None:
    """`classified_features` as GeoJSON lines with `class` and `code`."""
    rows = classified_features(objects if "id" in objects.columns else objects.withColumn("id", F.monotonically_increasing_id()), tags, name, region, size, project)
    rows.select(feature_json(F.col("geom"), {"class": F.col("class"), "code": F.col("code")}).alias("value")).write.mode("overwrite").text(path)


def write_feature_cube(cube: DataFrame, path: str, partition: Sequence[str] = ("product", "tile_x", "tile_y"), within: Sequence[str] = ()) -> DataFrame:
    """Persist a recipe's result by product and tile; a cube that is there already is returned as it is.

    Cells go to their partition's task first, a large partition to several: files are as many as partitions, not as partitions times
    tasks. With `within`, for tiles too small for folders of their own, files hold runs of cells in the order of these columns.
    """
    keys = [*partition, *within]
    dealt = cube.repartitionByRange(*keys).sortWithinPartitions(*keys) if within else cube.hint("rebalance", *partition)
    dealt.write.mode("ignore").partitionBy(*partition).parquet(path)
    return cube.sparkSession.read.parquet(path)


def write_cube_table(cube: DataFrame, name: str, buckets: int, keys: Sequence[str] = ("row", "col"), partition: Sequence[str] = (), path: str | None = None) -> DataFrame:
    """Persist cells as a table of `buckets` buckets by their keys, each one sorted file; a table of the name is returned as it is.

    Tables with equal buckets join by exactly these keys, and group by them, without moving a cell: pairs of dates, recipes, terrain.
    Choose buckets so that one fits a task (1 TB in 4,096 is 256 MB). `path` is a folder outside the warehouse. Two writers of one name
    at one time are not kept apart; a table with other buckets than asked for is an error, as its joins would shuffle.
    """
    spark = cube.sparkSession
    if not spark.catalog.tableExists(name):
        # repartitioned as the buckets are, so that a task writes whole buckets
        writer = cube.repartition(buckets, *[F.col(k) for k in keys]).write.bucketBy(buckets, *keys).sortBy(*keys).format("parquet")
        writer = writer.partitionBy(*partition) if partition else writer
        (writer if path is None else writer.option("path", path)).saveAsTable(name)
    found = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {name}").where("col_name IN ('Num Buckets', 'Bucket Columns')").collect()}
    if found != {"Num Buckets": str(buckets), "Bucket Columns": "[" + ", ".join(f"`{k}`" for k in keys) + "]"}:
        raise ValueError(f"table {name} is bucketed otherwise: {found}")
    return spark.table(name)


def save_training_matrix(rows: DataFrame, path: str, features: Sequence[str], label: str = "label") -> DataFrame:
    """Features and label of the training rows, instead of a fitted model."""
    rows.select(*features, label).write.mode("overwrite").parquet(path)
    return rows.sparkSession.read.parquet(path)
