"""Covers of cells and the joins on them against plain tests of all pairs."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from landweave.functions import geometry as G
from landweave.operators import covers, spatial


def geom(*rings):
    return [[[{"x": float(x), "y": float(y)} for x, y in ring] for ring in rings]]


def star(random, x, y, far, corners=9):
    angles, d = np.sort(random.uniform(0, 2 * np.pi, corners)), random.uniform(0.2, 1, corners) * far
    return geom([(x + r * math.cos(a), y + r * math.sin(a)) for a, r in zip(angles, d, strict=True)])


@pytest.fixture(scope="module")
def sides(spark):
    """Stars of all sizes over a plane, one with a hole, squares on cell borders, and rows without a shape."""
    random = np.random.default_rng(11)
    left = [(i, star(random, *random.uniform(-300, 300, 2), 2 ** random.uniform(-2, 5))) for i in range(120)]
    left += [(500, geom([(0, 0), (4, 0), (4, 4), (0, 4)])), (501, None), (502, [])]
    right = [(i, star(random, *random.uniform(-300, 300, 2), 2 ** random.uniform(-2, 8), 30)) for i in range(60)]
    right += [(500, geom([(4, 4), (8, 4), (8, 8), (4, 8)])), (501, geom([(-256, -256), (256, -256), (256, 256), (-256, 256)], [(-100, -100), (100, -100), (100, 100), (-100, 100)])), (502, None)]
    schema = f"id int, geom {G.GEOMETRY}"
    return spark.createDataFrame(left, schema).cache(), spark.createDataFrame(right, schema).cache()


def plain_pairs(left, right):
    pairs = left.select(F.col("id").alias("l"), F.col("geom").alias("a")).crossJoin(right.select(F.col("id").alias("r"), F.col("geom").alias("b")))
    return {tuple(r) for r in pairs.where(G.intersects(F.col("a"), F.col("b"))).select("l", "r").collect()}


@pytest.mark.parametrize(("size", "most"), [(1.0, 64), (0.25, 16), (50.0, 64), (7.3, 4)])
def test_covers_lose_no_pair_and_are_sure_of_none_wrongly(sides, size, most):
    left, right = sides
    want = plain_pairs(left, right)
    found = covers.meeting(*[s.withColumnRenamed("id", "key") for s in sides], size, most).collect()
    pairs = {(r.l_key, r.r_key) for r in found}
    assert len(found) == len(pairs) and want <= pairs
    assert {(r.l_key, r.r_key) for r in found if r.certain} <= want
    assert {r.id for r in spatial.spatial_semi_join(left, right, size).select("id").collect()} == {a for a, _ in want}


def test_without_broadcast(sides, monkeypatch):
    monkeypatch.setattr(covers, "BROADCAST_ROWS", 0)
    assert plain_pairs(*sides) <= {(r.l_key, r.r_key) for r in covers.meeting(*[s.withColumnRenamed("id", "key") for s in sides], 1.0).collect()}


def test_a_country_is_a_bounded_cover_with_inner_cells(spark):
    coast = [(1e6 + r * math.cos(a), 1e6 + r * math.sin(a)) for a in np.linspace(0, 2 * np.pi, 2000, endpoint=False) for r in (1e6 * (0.7 + 0.2 * math.sin(5 * a) + 0.02 * math.sin(90 * a)),)]
    country = spark.createDataFrame([(1, geom(coast)), (2, geom([(0, 0), (1e5, 0), (1e5, 1e5), (0, 1e5)]))], f"key int, geom {G.GEOMETRY}")
    cells = covers.cover(country, 50.0).groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.count_if("inner").alias("inner")).collect()
    assert all(r.n <= 70 for r in cells) and all(r.inner > 0 for r in cells)


def test_geometry_is_not_joined_by_cells(sides):
    """Pairs carry keys and boxes until they are whole; only survivors take shapes."""
    pairs = covers.meeting(*[s.withColumnRenamed("id", "key") for s in sides], 1.0)
    assert pairs.columns == ["l_key", "r_key", "certain"]
