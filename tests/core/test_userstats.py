"""Statistics that users write, in two phases; shifts by blocks; tables of cells that join without a shuffle."""

import math
import tempfile
import uuid
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from landweave.functions import statistics
from landweave.operators import cube, regions, shifts, userstats, workflows
from landweave.operators.userstats import Statistic, statistics_of, user_statistics
from landweave.sources import sinks

_COUNT = Statistic(lambda: [0.0], lambda s, v: [s[0] + len(v)], lambda a, b: [a[0] + b[0]], lambda s: s[0])


def test_hot_group_many_groups_and_odd_keys(spark, monkeypatch):
    monkeypatch.setattr(userstats, "STATES", 50)
    rows = spark.range(0, 30_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 7 == 0, None).otherwise(F.col("id") % 900).alias("g"), F.when(F.col("id") % 5 > 0, F.col("id") % 101).alias("v"),
        F.when(F.col("id") % 2 == 0, F.lit(float("nan"))).otherwise(1.0).alias("h"),
    )
    stats = {"n": _COUNT} | {n: getattr(statistics, n) for n in ("skewness", "kurtosis")}
    got = {r.g: r for r in user_statistics(rows, "g", stats, ["v"]).collect()}
    want = {r.g: r for r in rows.groupBy("g").agg(F.count("v").alias("n"), F.skewness("v").alias("skewness"), F.kurtosis("v").alias("kurtosis")).collect()}
    assert got.keys() == want.keys() and None in got
    for g, r in want.items():
        assert got[g].v_n == r.n
        assert got[g].v_skewness == pytest.approx(r.skewness, abs=1e-9) and got[g].v_kurtosis == pytest.approx(r.kurtosis, abs=1e-9)
    both = user_statistics(rows, ["h", "g"], {"n": _COUNT}, ["v"])
    assert both.count() == rows.select("h", "g").distinct().count()
    assert {math.isnan(r.h) for r in user_statistics(rows, "h", {"n": _COUNT}, ["v"]).collect()} == {True, False}


def test_empty_tables_null_values_and_errors(spark):
    rows = spark.createDataFrame([("a", None), ("a", None), ("b", 2.0)], "g string, v double")
    got = {r.g: r.v_range for r in user_statistics(rows, "g", {"range": statistics.spread}, ["v"]).collect()}
    assert got == {"a": None, "b": 0.0}
    assert user_statistics(rows.limit(0), "g", {"n": _COUNT}, ["v"]).collect() == []
    with pytest.raises(ValueError):
        user_statistics(rows, "g", {}, ["v"])
    with pytest.raises(ValueError):
        user_statistics(rows.withColumn("g", F.array("g")), "g", {"n": _COUNT}, ["v"])


def test_module_from_a_file_over_geometries(spark):
    path = Path(tempfile.mkdtemp(prefix="spark-")) / "ring_statistics.py"
    path.write_text(
        "from landweave.operators.userstats import Statistic\n"
        "def _corners(geoms):\n    return float(sum(len(ring) for g in geoms for polygon in g for ring in polygon))\n"
        "corners = Statistic(lambda: [0.0], lambda s, v: [s[0] + _corners(v)], lambda a, b: [a[0] + b[0]], lambda s: s[0])\n"
        "_hidden = corners\n"
    )
    stats = statistics_of(spark, str(path))
    assert list(stats) == ["corners"]
    shapes = spark.range(20).selectExpr("id % 2 AS g", "array(array(transform(sequence(1, cast(id + 3 as int)), i -> struct(cast(i as double) AS x, 0d AS y)))) AS geom")
    assert {r.g: r.geom_corners for r in user_statistics(shapes, "g", stats, ["geom"]).collect()} == {0: 120.0, 1: 130.0}


def test_a_hot_group_is_partly_merged_before_the_shuffle(spark):
    plan = user_statistics(spark.range(0, 1000, 1, 8).select(F.lit(1).alias("g"), "id"), "g", {"n": _COUNT}, ["id"])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("MapInArrow") == 3 and text.count("Exchange hashpartitioning") == 2


@pytest.mark.parametrize("shift", [(1, 1), (0, 3), (-2, 0), (17, -9)])
def test_shift_over_blocks_is_the_plain_join(spark, monkeypatch, shift):
    monkeypatch.setattr(shifts, "SIDE", 8)
    rows, cols = 21, 19
    grid = np.random.default_rng(1).normal(size=(rows, cols, 2))
    cells = spark.createDataFrame([(r, c, *map(float, grid[r, c]), f"{r}-{c}") for r in range(rows) for c in range(cols)], "row int, col int, a double, b double, name string")
    moved = np.roll(grid, shift, (0, 1))
    got = shifts.shift_join(cells, ["a", "name"], rows, cols, shift).collect()
    assert len(got) == rows * cols
    for x in got:
        assert x.shifted_a == moved[x.row, x.col, 0] and x.name == f"{x.row}-{x.col}"
        assert x.shifted_name == f"{(x.row - shift[0]) % rows}-{(x.col - shift[1]) % cols}"
    flat, back = grid.reshape(-1, 2) - [0.1, 0.2], moved.reshape(-1, 2) - [0.1, 0.2]
    assert np.allclose(shifts.shifted_products(cells, ["a", "b"], rows, cols, shift, [0.1, 0.2]), flat.T @ back)


def test_shift_with_gaps_repeated_cells_and_nulls(spark):
    cells = spark.createDataFrame([(0, 0, 1.0), (0, 0, 2.0), (0, 1, 3.0), (2, 2, 9.0), (None, 1, 5.0), (1, 1, None)], "row int, col int, v double")
    got = sorted((r.row, r.col, r.v, r.shifted_v) for r in shifts.shift_join(cells, ["v"], 4, 4, (0, 1)).collect())
    assert got == [(0, 1, 3.0, 1.0), (0, 1, 3.0, 2.0)]
    assert shifts.shift_join(cells.limit(0), ["v"], 4, 4).collect() == []
    assert shifts.shifted_products(cells.limit(0), ["v"], 4, 4, (1, 1), [0.0]).tolist() == [[0.0]]
    assert shifts.shifted_products(cells, ["v"], 4, 4, (0, 1), [0.0]).tolist() == [[9.0]]


def test_tables_of_cells_join_and_group_without_a_shuffle(spark):
    def table(cells, buckets=4):
        return sinks.write_cube_table(cells, f"cells_{uuid.uuid4().hex}", buckets, path=regions.shared_folder(spark, "cells"))

    cells = spark.range(4000).selectExpr("cast(id % 1000 div 40 as int) AS row", "cast(id % 40 as int) AS col", "2 AS qa", "cast(id % 77 as int) AS nir", "cast(id % 31 as int) AS red")
    terrain = cells.select("row", "col", F.col("row").alias("slope")).distinct()
    a, b = table(cells), table(terrain)
    assert a.inputFiles() and len(a.inputFiles()) <= 4
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        whole = cube.recipe(a, F.lit(True), ("nir", "red"), {"ndvi": ("nir", "red")}, {"ndvi": ("mean",)}, terrain=b)
        pairs = workflows.pair_dates(b, a.groupBy("row", "col").agg(F.max("nir").alias("nir")))
        for df in (whole, pairs):
            assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
        plain = cube.recipe(cells, F.lit(True), ("nir", "red"), {"ndvi": ("nir", "red")}, {"ndvi": ("mean",)}, terrain=terrain)
        assert sorted(whole.collect()) == sorted(plain.collect()) and pairs.count() == 1000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_table_of_cells_is_written_once_and_of_other_buckets_is_an_error(spark):
    name, cells = f"cells_{uuid.uuid4().hex}", spark.createDataFrame([(0, 1, 5)], "row int, col int, v int")
    path = regions.shared_folder(spark, "cells")
    sinks.write_cube_table(cells, name, 2, path=path)
    assert sinks.write_cube_table(cells.limit(0), name, 2, path=path).collect() == [(0, 1, 5)]
    with pytest.raises(ValueError):
        sinks.write_cube_table(cells, name, 4, path=path)
