"""Stores that writers share, and training from tiles; the queries beside their SQL."""

import os
import tempfile
from concurrent.futures import ThreadPoolExecutor

import duckdb
import pytest
from pyspark.sql import functions as F

from landweave.functions import geometry as G
from landweave.operators import models, workflows
from landweave.plans import queries as Q
from landweave.plans import stores
from landweave.sources import store, vectors

SMALL = "/root/testdata/sf0.001"


def test_of_many_writers_of_a_name_one_wins(spark):
    path = tempfile.mkdtemp(prefix="spark-")
    with ThreadPoolExecutor(16) as pool:
        won = list(pool.map(lambda i: store.publish(spark, path, "one", {"path": str(i)}), range(64)))
    assert won.count(True) == 1
    assert [(r.name, r.path) for r in store.records(spark, path, "path string").collect()] == [("one", str(won.index(True)))]
    assert [f for f in os.listdir(f"{path}/records") if not f.startswith(".")] == ["one.json"]
    for bad in ("", "_x", "../x", "a/b"):
        with pytest.raises(ValueError):
            store.publish(spark, path, bad, {})


def test_two_writers_of_a_model(spark):
    path = tempfile.mkdtemp(prefix="spark-")
    rows = spark.createDataFrame([(i, float(i % 2), i % 2) for i in range(40)], "id long, a double, tag int")
    model = models.fit_rf(rows, ["a"], "tag", trees=2, depth=2)

    def save(i):
        try:
            workflows.save_model(model, spark, path, "m", f"r{i}", "set")
            return i
        except ValueError:
            return None

    with ThreadPoolExecutor(4) as pool:
        won = [i for i in pool.map(save, range(4)) if i is not None]
    found = store.records(spark, path, workflows._REGISTRY).collect()
    assert len(won) == 1 and [r.recipe for r in found] == [f"r{won[0]}"]
    assert len(os.listdir(f"{path}/models")) == 1  # what lost is gone
    assert models.score(models.predict(workflows.load_model(spark, path, "m"), rows), "tag").first()[0] == 1.0


def test_two_writers_of_a_manifest_lose_and_repeat_nothing(spark):
    manifest = tempfile.mkdtemp(prefix="spark-")
    day = F.lit("2017-01-01").cast("timestamp")
    all_ = spark.range(30).select(F.concat(F.lit("u"), "id").alias("uri"), *[F.col("id").cast("double").alias(c) for c in ("xmin", "ymin", "xmax", "ymax")], day.alias("begin"), day.alias("end"))
    with ThreadPoolExecutor(3) as pool:
        list(pool.map(lambda k: vectors.register_product(all_.where(F.col("xmin") % 3 != k), "p", "d", "/p", manifest, 1.0), range(3)))
    found = vectors.register_product(all_.limit(0), "p", "d", "/p", manifest, 1.0)
    assert sorted(r.uri for r in found.select("uri").collect()) == sorted(f"u{i}" for i in range(30))


def test_training_reads_the_region_s_tiles_only(spark):
    cubes, tiles, objects, classes = stores._tiled(spark, SMALL)
    wanted = tiles.where("tile_x = 1").select("tile_x", "tile_y")
    plan = cubes.join(F.broadcast(wanted), ["tile_x", "tile_y"])._jdf.queryExecution().toString()
    assert "dynamicpruning" in plan
    rows, report = workflows.training_from_tiles(cubes, tiles, objects, classes, ["red", "nir"], 0.0, 0.0, 1.0, 10.0, sample=0.5, box=(12, -30, 25, -5))
    got = {(r.tile_x, r.tile_y): (r.objects, r.drawn, r.dropped) for r in report.collect()}
    assert all(drawn == objects // 2 and dropped >= 0 for objects, drawn, dropped in got.values())
    assert rows.count() == sum(drawn - dropped for _, drawn, dropped in got.values())
    half = cubes.withColumn("nir", F.when(F.col("row") >= 3, F.col("nir")))
    _, report = workflows.training_from_tiles(half, tiles, objects, classes, ["red", "nir"], 0.0, 0.0, 1.0, 10.0, box=(0, -8, 40, 0))
    assert report.agg(F.sum("dropped")).first()[0] > 0  # the rows of objects without a band are counted


def test_objects_in_tiles(spark):
    square = lambda x, y, w: [[[{"x": float(a), "y": float(b)} for a, b in ((x, y), (x + w, y), (x + w, y + w), (x, y + w))]]]
    objects = spark.createDataFrame([(1, square(1, 1, 2)), (2, square(8, 8, 4)), (3, square(10, 0, 10)), (4, square(-5, 3, 1)), (5, None)], f"id int, geom {G.GEOMETRY}")
    tiles = spark.createDataFrame([(0, 0, 0.0, 0.0, 10.0, 10.0), (1, 0, 10.0, 0.0, 20.0, 10.0)], "tile_x int, tile_y int, xmin double, ymin double, xmax double, ymax double")
    for size in (3.0, 10.0, 100.0):
        assert {(r.id, r.tile_x) for r in workflows.objects_in_tiles(objects, tiles, size).collect()} == {(1, 0), (3, 1)}


@pytest.mark.parametrize("name", ["training_from_tiles", "training_report", "model_store", "export_vector", "register_product", "scene_metadata_s2", "prepare_metadata", "ingest_boundaries", "cell_places", "dataset_uuid", "shifted_products", "weighted_covariance", "change_distance_matched", "stored_training_matrix", "store_segments", "pair_dates_tables", "recipe_from_tables", "user_statistics_merged", "user_statistics_geometry", "scan_cube", "write_stats_csv"])
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for f in os.listdir(SMALL):
        con.sql(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM read_parquet('{SMALL}/{f}')")
    want = con.sql(Q.SQL[name])
    plain = lambda rows: sorted((tuple(v if v is None or isinstance(v, str) else float(v) for v in r) for r in rows), key=repr)
    got = Q.QUERIES[name](spark, SMALL)
    assert sorted(got.columns) == sorted(want.columns)
    rows = plain(got.select(*want.columns).collect())
    assert rows and rows == plain(want.fetchall())
