"""Land-cover operators: literal cases, plain numpy versions, and the registered SQL."""

import os

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from landweave.functions import catalog as C
from landweave.functions import geometry as G
from landweave.functions import raster as R
from landweave.operators import change, cube, regions, spatial
from landweave.plans import queries as Q

SMALL = "/root/testdata/sf0.001"


def one(spark, column, **values):
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]).select(column).first()[0]


def square(x, y, w, hole=None):
    ring = lambda a, b, s: [{"x": float(p), "y": float(q)} for p, q in ((a, b), (a + s, b), (a + s, b + s), (a, b + s))]
    return [[ring(x, y, w)] + ([ring(*hole)] if hole else [])]


def test_scalars(spark):
    assert tuple(one(spark, G.parse_box(F.lit("BOX(778783.5625 2951741.25,794875.8125 2970042.75)")))) == (778783.5625, 2951741.25, 794875.8125, 2970042.75)
    assert one(spark, C.path_row_name(F.lit(7), F.lit(45))) == "007045"
    assert one(spark, C.hex_to_rgba(F.lit("#0a1bff"))) == [10, 27, 255, 255]
    assert one(spark, C.dataset_uuid(F.lit("http://python.org/"))) == "4c565f0d-3f5a-5890-b41b-20cf47701c5e"
    assert one(spark, C.file_basename(F.lit("/a/b/c.tar.gz"), False)) == "c.tar"
    assert one(spark, R.qa_bitmask(F.lit(2), cloud=False, snow=False)) and not one(spark, R.qa_bitmask(F.lit(34), cloud=False))
    assert one(spark, R.normalized_difference(F.lit(1), F.lit(-1))) is None
    for v, want in ((1.9, 1), (-1.9, -1), (None, -9999), (1e9, -9999)):
        assert one(spark, R.null_to_nodata_int16(F.lit(v).cast("double"))) == want
    with pytest.raises(ValueError):
        R.qa_bitmask(F.lit(1), fog=True)
    with pytest.raises(ValueError):
        C.mission_prefix(6)


def test_nodata_round_trip(spark):
    df = spark.createDataFrame([(1,), (2,), (-9999,)], "v short")
    back = df.select(R.null_to_nodata_int16(R.nodata_to_null(F.col("v"), -9999)).alias("v"))
    assert [r.v for r in back.collect()] == [1, 2, -9999]


def test_geometry(spark):
    df = spark.createDataFrame([(1, square(0, 0, 3, (1, 1, 1))), (2, square(0, 0, 1))], f"id int, g {G.GEOMETRY}")
    g = F.col("g")
    rows = df.select(G.polygon_area(g), G.polygon_perimeter(g), G.bbox_perimeter(g), G.contains_point(g, F.lit(1.5), F.lit(1.5)), G.contains_point(g, F.lit(0.5), F.lit(0.5))).collect()
    assert [tuple(r) for r in rows] == [(8.0, 16.0, 12.0, False, True), (1.0, 4.0, 4.0, False, True)]


def test_projection_round_trip(spark):
    df = spark.createDataFrame([(-102.3, 21.9), (-99.1, 19.4), (-117.0, 32.5)], "lon double, lat double")
    p = G.lambert_conformal(F.col("lon"), F.col("lat"))
    for r in df.select("*", p.alias("p")).select("lon", "lat", G.lambert_conformal_inverse(F.col("p.x"), F.col("p.y")).alias("b")).collect():
        assert abs(r.b.x - r.lon) < 1e-7 and abs(r.b.y - r.lat) < 1e-7
    utm = df.limit(1).select(G.transverse_mercator(F.lit(-99.0), F.lit(0.0), 14)).first()[0]
    assert abs(utm.x - 500000) < 1e-6 and abs(utm.y) < 1e-6


def test_quality_of_overlap(spark):
    a = spark.createDataFrame([(1, square(0, 0, 1)), (2, square(5, 5, 1))], f"id int, geom {G.GEOMETRY}")
    b = spark.createDataFrame([(1, square(0.5, 0.5, 1)), (2, square(9, 9, 1))], f"id int, geom {G.GEOMETRY}")
    pairs = spatial.box_overlap_area(a, b, 0.3)
    q = spatial.overlap_quality(F.lit(1.0), F.lit(1.0), F.col("weight"))
    assert [tuple(r) for r in pairs.select("l_id", "r_id", q["underseg"], q["overseg"]).collect()] == [(1, 1, 0.75, 0.75)]


def test_tiles_and_recipes(spark):
    with pytest.raises(ValueError):
        cube.query_tiles(spark.range(1))
    with pytest.raises(ValueError):
        cube.run_recipe("none", spark.range(1))
    e = spark.createDataFrame([("a", 0.0, 0.0, 25.0, 10.0)], "name string, xmin double, ymin double, xmax double, ymax double")
    assert [(r.tile, r.rows, r.cols, r.x, r.y) for r in cube.tile_grid(e, 1.0, 10).orderBy("tile").collect()] == [(0, 10, 10, 0, 10), (1, 10, 10, 10, 10), (2, 10, 5, 20, 10)]


def test_alteration_against_numpy(spark):
    rng = np.random.default_rng(0)
    x = rng.standard_normal((400, 2))
    y = 0.8 * x + 0.3 * rng.standard_normal((400, 2))
    df = spark.createDataFrame([(i // 20, i % 20, *map(float, (*a, *b))) for i, (a, b) in enumerate(zip(x, y, strict=True))], "row int, col int, a double, b double, c double, d double")
    mx, my, s11, s22, s12 = change.weighted_moments(df, ["a", "b"], ["c", "d"])
    full = np.cov(np.column_stack([x, y]).T)
    assert np.allclose(s11, full[:2, :2]) and np.allclose(s22, full[2:, 2:]) and np.allclose(s12, full[:2, 2:]) and np.allclose(mx, x.mean(0))
    variates, var, rho = change.mad(df, ["a", "b"], ["c", "d"])
    got = np.array(df.select(*[m.alias(f"m{i}") for i, m in enumerate(variates)]).collect())
    assert np.allclose(got.var(0, ddof=1), var, rtol=1e-6) and rho[0] >= rho[1]
    out, rho = change.irmad(df, ["a", "b"], ["c", "d"], rounds=3)
    assert {"m1", "m2"} <= set(out.columns) and (rho <= 1).all()
    f = change.maf(df, ["a", "b"], 20, 20)
    assert {"f1", "f2"} <= set(f.columns)
    for dof, z, want in ((1, 1.0, 0.31731), (2, 1.0, 0.60653), (3, 2.0, 0.57241), (4, 3.0, 0.55783)):
        assert abs(one(spark, change.chi2_survival(F.lit(z), dof)) - want) < 1e-4
    changed = change.elliptic_threshold(df, ["a", "c"]).where("changed").count()
    assert changed == 20
    with pytest.raises(ValueError):
        change.threshold_change("none", df)


@pytest.mark.parametrize("merged", ["true", "false"])  # range partitions merged to one by their size, or not
def test_hist_match_against_numpy(spark, merged):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", merged)
    rng = np.random.default_rng(1)
    s, t = rng.integers(0, 40, 500), rng.integers(100, 300, 700)
    table = change.hist_match(spark.createDataFrame([(int(v),) for v in s], "v int"), spark.createDataFrame([(int(v),) for v in t], "v int"), "v")
    sv, sc = np.unique(s, return_counts=True)
    tv, tc = np.unique(t, return_counts=True)
    want = np.interp(np.cumsum(sc) / 500, np.cumsum(tc) / 700, tv)
    got = [r.matched for r in table.orderBy("value").collect()]
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert np.allclose(got, want)


def test_regions_against_flood_fill(spark):
    rng = np.random.default_rng(2)
    grid = rng.integers(0, 2, (15, 15))
    want, seen = {}, set()
    for start in range(225):
        stack = [start]
        while stack:
            c = stack.pop()
            if c in seen:
                continue
            seen.add(c)
            want[c] = start
            r, k = divmod(c, 15)
            stack += [a * 15 + b for a, b in ((r + 1, k), (r - 1, k), (r, k + 1), (r, k - 1)) if 0 <= a < 15 and 0 <= b < 15 and grid[a, b] == grid[r, k]]
    cells = spark.createDataFrame([(i, i // 15, i % 15, int(grid[divmod(i, 15)])) for i in range(225)], "cell long, row int, col int, v int")
    assert {r.cell: r.region for r in regions.connected_regions(cells, "v").collect()} == want


def test_winding_region_in_few_rounds(spark, monkeypatch):
    base, rounds, of = spark.conf.get("spark.checkpoint.dir"), [], regions.written
    monkeypatch.setattr(regions, "written", lambda df, name: (rounds.append(name), of(df, name))[1])
    before = set(os.listdir(base)) if os.path.isdir(base) else set()
    number = np.random.default_rng(3).permutation(600).tolist()
    chain = [(max(a, b), min(a, b)) for a, b in zip(number, number[1:])]
    roots = regions.connected(spark.createDataFrame(chain, "a long, b long")).collect()
    assert {r.node: r.root for r in roots} == dict.fromkeys(range(1, 600), 0)
    assert rounds.count("stars") <= 14
    assert len(set(os.listdir(base)) - before) == 1  # the rounds' folders but the last are gone


def test_no_pairs_no_roots(spark):
    assert regions.connected(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("name", ["recipe_ndvi_mean", "recipe_landsat_002", "rasterize_features", "zonal_stats_first", "quality_score", "accuracy_by_class", "match_first_relevant", "label_change"])
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for f in os.listdir(SMALL):
        con.sql(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM read_parquet('{SMALL}/{f}')")
    want, got = con.sql(Q.SQL[name]).df(), Q.QUERIES[name](spark, SMALL).toPandas()
    columns = sorted(want.columns)
    assert columns == sorted(got.columns)
    key = lambda df: sorted(tuple(None if v != v else v for v in row) for row in df[columns].astype(object).where(df[columns].notna(), None).values.tolist())
    assert [tuple(map(str, r)) for r in sorted(key(got), key=str)] == [tuple(map(str, r)) for r in sorted(key(want), key=str)] or sorted(map(repr, map(tuple, got[columns].astype(str).values))) == sorted(map(repr, map(tuple, want[columns].astype(str).values)))
