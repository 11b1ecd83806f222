"""How many files a cube is written to."""

import glob
import tempfile

from pyspark.sql import functions as F

from landweave.plans import stores as S
from landweave.sources import sinks

SMALL = "/root/testdata/sf0.001"


def _cells(spark):
    cells = spark.range(0, 6400, 1, 16).select(F.expr("cast(id div 40 as int)").alias("row"), F.expr("cast(id % 40 as int)").alias("col"))
    return cells.withColumns({"tile_x": F.expr("col div 10"), "tile_y": F.expr("row div 8")})


def test_a_tile_is_one_file(spark):
    base = tempfile.mkdtemp(prefix="spark-")
    cube = sinks.write_feature_cube(_cells(spark), f"{base}/cube", ["tile_x", "tile_y"])
    assert cube.count() == 6400 and len(glob.glob(f"{base}/cube/*/*/*.parquet")) == 80


def test_small_tiles_share_files(spark):
    base = tempfile.mkdtemp(prefix="spark-")
    cube = sinks.write_feature_cube(_cells(spark), f"{base}/cube", ["tile_x"], ["tile_y"])
    assert cube.count() == 6400 and cube.select("tile_x", "tile_y").distinct().count() == 80
    assert len(glob.glob(f"{base}/cube/*/*.parquet")) <= 4 + 4  # no more than columns of tiles and tasks


def test_files_of_the_training_cube_do_not_grow_with_tiles(spark):
    cubes, tiles, _, _ = S._tiled(spark, SMALL)
    assert len(cubes.inputFiles()) <= 4 + 4 and tiles.count() == cubes.select("tile_x", "tile_y").distinct().count()
