"""Models, superpixels, outlines and sinks."""

import json
import tempfile

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from landweave.operators import models, segments
from landweave.plans import queries as Q
from landweave.sources import sinks

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def rows(spark):
    random = np.random.default_rng(5)
    made = [(i, i % 3, "ab"[i % 2], float(i % 3 + random.normal(0, 0.1)), float(random.normal(0, 0.1))) for i in range(600)]
    made += [(1000 + c, c, "a", 50.0, -50.0) for c in range(3)]
    return spark.createDataFrame(made, "id long, label int, kind string, x double, y double").cache()


def test_forest_learns_and_is_confident(rows):
    out = models.predict(models.fit_rf(rows.where("id < 400"), ["x", "y", "kind"], categorical=["kind"], trees=10, depth=4), rows.where("id >= 400 and id < 1000"))
    assert out.columns == [*rows.columns, "prediction", "confidence"]
    assert models.score(out).first()[0] > 0.95
    assert 1 / 3 <= out.agg(F.min("confidence")).first()[0] <= 1


def test_boosted_learns(rows):
    out = models.predict(models.fit_boosted(rows.where("id < 400"), ["x", "y"], rounds=3, depth=3), rows.where("id >= 400 and id < 1000"))
    assert models.score(out).first()[0] > 0.95
    with pytest.raises(ValueError):
        models.fit_boosted(rows, ["x"], reg_alpha=1.0)


def test_outliers_go_and_most_stay(rows):
    kept = models.remove_outliers(rows, ["x", "y"], contamination=0.1, trees=20)
    ids = {r["id"] for r in kept.select("id").collect()}
    assert not ids & {1000, 1001, 1002} and len(ids) >= 0.85 * 603
    assert ids == {r["id"] for r in models.remove_outliers(rows.repartition(7), ["x", "y"], contamination=0.1, trees=20).select("id").collect()}


def test_slic_against_plain_version(spark):
    random = np.random.default_rng(1)
    value = {(r, c): float(random.random()) for r in range(12) for c in range(9)}
    df = spark.createDataFrame([(r, c, v) for (r, c), v in value.items()], "row int, col int, v double")
    found = {(x["row"], x["col"]): x["segment"] for x in segments.segment_slic(df, ["v"], 4, 0.5, rounds=2, connected=False).collect()}
    groups = {}
    for (r, c), v in value.items():
        groups.setdefault((r // 4, c // 4), []).append((r, c, v))
    for _ in range(2):
        seeds = {k: np.mean(g, axis=0) for k, g in groups.items()}
        groups, chosen = {}, {}
        for (r, c), v in value.items():
            near = [k for k in seeds if abs(k[0] - r // 4) <= 1 and abs(k[1] - c // 4) <= 1]
            chosen[r, c] = min(near, key=lambda k: ((v - seeds[k][2]) ** 2 + ((r - seeds[k][0]) ** 2 + (c - seeds[k][1]) ** 2) * (0.5 / 4) ** 2, k))
            groups.setdefault(chosen[r, c], []).append((r, c, v))
    assert found == {k: f"{a}_{b}" for k, (a, b) in chosen.items()}


@pytest.mark.parametrize("name", ["sample_exact", "region_outline"])
def test_queries_against_their_sql(spark, name):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS FROM '{SMALL}/embeddings.parquet'")
    for t in ("lineitem", "part", "nation", "orders", "customer", "labels", "documents"):
        con.sql(f"CREATE VIEW {t} AS FROM '{SMALL}/{t}.parquet'")
    got = Q.QUERIES[name](spark, SMALL)
    want = con.sql(Q.SQL[name]).df()
    assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(map(tuple, want.to_numpy().tolist()))


def test_sinks(spark, rows):
    base = tempfile.mkdtemp(prefix="spark-")
    assert sinks.write_stats_csv(rows.select("y", "id", "x"), f"{base}/s") == ["id", "x", "y"]
    assert spark.read.csv(f"{base}/s", header=True).columns == ["id", "x", "y"]
    geom = "array<array<array<struct<x:double,y:double>>>>"
    square = [[[{"x": float(x), "y": float(y)} for x, y in ((0, 0), (1, 0), (1, 1))]]]
    objects = spark.createDataFrame([(square, 1)], f"geom {geom}, tag int")
    sinks.export_vector(objects, f"{base}/v", spark.createDataFrame([(1, "water", 7)], "tag int, value string, code int"))
    feature = json.loads(spark.read.text(f"{base}/v").first()[0])
    assert feature["properties"] == {"class": "water", "code": 7}
    assert feature["geometry"]["coordinates"] == [[[[0, 0], [1, 0], [1, 1], [0, 0]]]]
    cube = rows.select(F.lit("p").alias("product"), F.lit(1).alias("tile_x"), F.lit(2).alias("tile_y"), "id")
    assert sinks.write_feature_cube(cube, f"{base}/c").count() == 603
    assert sinks.write_feature_cube(cube.limit(1), f"{base}/c").count() == 603
