"""Whole jobs, exact overlaps, outline rings, metadata and vector sources."""

import json
import os
import tempfile

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from landweave.functions import catalog
from landweave.functions import geometry as G
from landweave.operators import change, cube, models, regions, segments, spatial, workflows
from landweave.plans import queries as Q
from landweave.plans import records as _records  # noqa: F401
from landweave.plans import workflows as W  # noqa: F401
from landweave.sources import metadata, vectors

SMALL = "/root/testdata/sf0.001"


def geom(*rings):
    return [[[{"x": float(x), "y": float(y)} for x, y in ring] for ring in rings]]


L = geom([(0, 0), (3, 0), (3, 1), (1, 1), (1, 3), (0, 3)])
RING = geom([(0, 0), (4, 0), (4, 4), (0, 4)], [(1, 1), (3, 1), (3, 3), (1, 3)])


@pytest.fixture(scope="module")
def shapes(spark):
    return spark.createDataFrame([(1, L), (2, RING)], f"id int, geom {G.GEOMETRY}")


def test_overlap_of_concave_and_holed(spark, shapes):
    other = spark.createDataFrame([(1, geom([(0.5, 0.5), (2.5, 0.5), (2.5, 2.5), (0.5, 2.5)])), (2, geom([(1.5, 1.5), (2, 1.5), (2, 2)])), (3, geom([(0, 0), (4, 4), (0, 4)]))], f"id int, geom {G.GEOMETRY}")
    got = {(r.l_id, r.r_id): round(r.weight, 9) for r in spatial.overlap_area(shapes, other, 1.3).collect()}
    assert got == {(1, 1): 1.75, (1, 3): 2.5, (2, 1): 1.75, (2, 3): 6.0}


def test_overlap_against_sampling(spark):
    random = np.random.default_rng(3)

    def star():
        angles, far = np.sort(random.uniform(0, 2 * np.pi, 9)), random.uniform(1, 5, 9)
        return geom([(5 + d * np.cos(a), 5 + d * np.sin(a)) for a, d in zip(angles, far, strict=True)])

    pairs = spark.createDataFrame([(i, star(), star()) for i in range(5)], f"id int, a {G.GEOMETRY}, b {G.GEOMETRY}").cache()
    points = pairs.crossJoin(spark.range(40_000).select(((F.col("id") % 200 + 0.5) / 20).alias("x"), (F.floor(F.col("id") / 200) + 0.5).alias("r"))).withColumn("y", F.col("r") / 20)
    inside = G.contains_point(F.col("a"), F.col("x"), F.col("y")) & G.contains_point(F.col("b"), F.col("x"), F.col("y"))
    want = {r.id: r.n / 400 for r in points.groupBy("id").agg(F.count_if(inside).alias("n")).collect()}
    left, right = (pairs.select("id", F.col(k).alias("geom")) for k in ("a", "b"))
    got = {r.l_id: r.weight for r in spatial.overlap_area(left, right, 4.0).where("l_id = r_id").collect()}
    assert all(abs(got.get(i, 0) - w) < 0.15 for i, w in want.items())


def test_intersects(spark, shapes):
    cases = [(geom([(1.5, 1.5), (2.5, 1.5), (2.5, 2.5)]), {1: False, 2: False}), (geom([(3, 0), (5, 0), (5, -1)]), {1: True, 2: True}), (geom([(-9, -9), (9, -9), (9, 9), (-9, 9)]), {1: True, 2: True}), (geom([(0.1, 0.1), (0.2, 0.1), (0.2, 0.2)]), {1: True, 2: True})]
    for other, want in cases:
        df = spark.createDataFrame([(other,)], f"geom {G.GEOMETRY}")
        got = {r.id for r in spatial.spatial_semi_join(shapes, df, 2.0).collect()}
        assert got == {k for k, v in want.items() if v}


def test_rings_with_hole_and_corner(spark):
    cells = {(r, c) for r in range(3) for c in range(3)} - {(1, 1)} | {(3, 3)}
    df = spark.createDataFrame([(r, c, 1) for r, c in cells], "row int, col int, region int")
    rings = {}
    for r in segments.region_rings(df).collect():
        rings.setdefault(r.ring, {})[r.seq] = (r.x, r.y)
    areas = []
    for ring in rings.values():
        assert sorted(ring) == list(range(len(ring)))
        p = np.array([ring[i] for i in sorted(ring)], float)
        assert (np.abs(np.diff(np.vstack([p, p[:1]]), axis=0)).sum(1) == 1).all()
        q = np.roll(p, -1, axis=0)
        areas.append(float((p[:, 0] * q[:, 1] - q[:, 0] * p[:, 1]).sum() / 2))
    assert sorted(areas) == [-1.0, 1.0, 9.0]


def test_jobs(spark):
    frames = [spark.createDataFrame(list(d.items()), "k int, value int") for d in ({1: 2, 3: 4}, {1: 6, 3: 7, 5: 6}, {1: 4, 3: 1, 9: 12, 5: 3})]
    assert {r.k: r["values"] for r in workflows.join_tiles(frames, ["k"]).collect()} == {1: [2, 6, 4], 3: [4, 7, 1]}
    assert {r.k: r["values"] for r in workflows.join_tiles(frames, ["k"], how="full").collect()} == {1: [2, 6, 4], 3: [4, 7, 1], 5: [6, 3], 9: [12]}
    with pytest.raises(ValueError):
        workflows.join_tiles(frames, ["k"], how="outer")
    with pytest.raises(ValueError):
        workflows.pair_dates(frames[0], frames[1], (spark.range(1), spark.range(1, 2)))
    random = np.random.default_rng(8)
    cells = spark.createDataFrame([(r, c, float((r // 4) % 2 * 5 + random.normal()), float(random.normal())) for r in range(32) for c in range(8)], "row int, col int, a double, b double")
    zones = cells.select("row", "col", F.expr("row div 4 * 10 + col div 4").cast("int").alias("feature_id"))
    classes = zones.select("feature_id", F.expr("cast(feature_id div 10 % 2 as int)").alias("tag")).distinct()
    rows = workflows.extract_training(cells, zones, classes, ["a", "b"])
    model = workflows.fit_model("rf", rows, ["a", "b"], trees=5, depth=3)
    store = tempfile.mkdtemp(prefix="spark-")
    assert workflows.save_model(model, spark, store, "m", "none", "first").count() == 1
    with pytest.raises(ValueError):
        workflows.save_model(model, spark, store, "m", "none", "first")
    with pytest.raises(ValueError):
        workflows.load_model(spark, store, "other")
    with pytest.raises(ValueError):
        workflows.fit_model("none", rows, ["a"])
    out = workflows.predict_objects(workflows.load_model(spark, store, "m"), cells, zones, ["a", "b"], "map")
    assert models.score(out.withColumnRenamed("tag", "prediction").join(classes, "feature_id"), "tag").first()[0] == 1.0
    stored = workflows.store_segments(zones, f"{store}/s", "one", "grid", "{}", "feature_id")
    assert stored.count() == 16 * 16 == workflows.store_segments(zones.limit(1), f"{store}/s", "one", "grid", "{}", "feature_id").count()


def test_no_change_gives_no_rows(spark):
    pairs = spark.createDataFrame([(i, i // 3, i % 3, 1.0, 1.0) for i in range(9)], "cell long, row int, col int, a double, b double")
    codes = pairs.select("row", "col", F.lit(1).alias("code"))
    objects, cells = workflows.detect_and_classify_change(pairs, ["a"], ["b"], codes, codes, threshold=0.5)
    assert objects.count() == cells.count() == 0
    with pytest.raises(ValueError):
        workflows.detect_and_classify_change(pairs, ["a"], ["b"], codes, codes, method="none")
    assert regions.filter_no_change(spark.createDataFrame([(1, 1), (1, 2)], "pre int, post int")).count() == 1


LANDSAT = """<espa_metadata xmlns="http://espa.cr.usgs.gov/v2"><global_metadata><satellite>LANDSAT_8</satellite><instrument>OLI_TIRS</instrument><acquisition_date>2017-02-03</acquisition_date><scene_center_time>17:01:02.57Z</scene_center_time>
<projection_information projection="UTM"><corner_point location="UL" x="500000" y="2000000"/><corner_point location="LR" x="600000" y="1900000"/><utm_proj_params><zone_code>14</zone_code></utm_proj_params></projection_information></global_metadata>
<bands>{}<band product="qa" name="pixel_qa" fill="1"><short_name>q</short_name><file_name>q.tif</file_name></band></bands></espa_metadata>"""
GRANULE = """<?xml version="1.0"?><n1:Tile_ID xmlns:n1="https://psd/x.xsd"><n1:General_Info><SENSING_TIME metadataLevel="Standard">2017-02-03T17:01:02.457Z</SENSING_TIME></n1:General_Info><n1:Geometric_Info><Tile_Geocoding metadataLevel="Brief">
<HORIZONTAL_CS_CODE>EPSG:32614</HORIZONTAL_CS_CODE><Size resolution="10"><NROWS>1</NROWS><NCOLS>1</NCOLS></Size><Size resolution="20"><NROWS>100</NROWS><NCOLS>200</NCOLS></Size><Geoposition resolution="20"><ULX>500000</ULX><ULY>2000000</ULY></Geoposition></Tile_Geocoding></n1:Geometric_Info></n1:Tile_ID>"""


def test_scene_metadata(spark):
    base = tempfile.mkdtemp(prefix="spark-")
    bands = "".join(f'<band product="sr" name="sr_band{i}"><file_name>b{i}.tif</file_name></band>' for i in range(1, 8))
    name = "LC08_L1TP_026047_20170203_20170204_01_T1.xml"
    for folder, text in (("good", LANDSAT.format(bands)), ("bare", LANDSAT.format("")), ("broken", "<espa"), ("none", None)):
        os.makedirs(f"{base}/{folder}")
        with open(f"{base}/{folder}/{name if text else 'other.xml'}", "w") as f:
            f.write(text or "<a/>")
    scenes, rejects = metadata.scene_metadata_landsat(metadata.list_files(spark, base, "*.xml", content=True))
    (s,) = scenes.collect()
    assert s.folder.endswith("/good") and s.red.endswith("/good/b4.tif") and s.qual.endswith("/q.tif") and str(s.acquired) == "2017-02-03 17:01:02" and s.zone == 14
    assert abs(s.ul_lon + 99) < 1e-9 and abs(s.ul_lat - 18.0878) < 1e-2 and s.lr_lon > s.ul_lon and s.lr_lat < s.ul_lat
    assert {r.folder.rsplit("/")[-1]: r.reason for r in rejects.collect()} == {"bare": "incomplete metadata", "broken": "incomplete metadata", "none": "not exactly one metadata file"}
    assert metadata.prepare_metadata(metadata.list_files(spark, base, "*.xml", content=True), "landsat", f"{base}/out").count() == 3
    with pytest.raises(ValueError):
        metadata.prepare_metadata(spark.range(1), "none", base)
    files = [("/d/S.SAFE/GRANULE/G/MTD_TL.xml", GRANULE)] + [(f"/d/S.SAFE/GRANULE/G/IMG_DATA/R20m/T_{b}_20m.jp2", None) for b in metadata.GRANULE_BANDS.values()]
    scenes, rejects = metadata.scene_metadata_s2(spark.createDataFrame(files, "path string, content string"))
    (s,) = scenes.collect()
    assert (s.lrx, s.lry, s.zone, str(s.acquired)) == (504000.0, 1998000.0, 14, "2017-02-03 17:01:02") and s.nir.endswith("_B8A_20m.jp2") and rejects.count() == 0
    assert metadata.scene_metadata_s2(spark.createDataFrame(files[:-1], "path string, content string"))[1].count() == 1


def test_utm_round_trip(spark):
    df = spark.createDataFrame([(-99.5, 19.3), (-101.7, 31.0)], "lon double, lat double").select("*", G.transverse_mercator(F.col("lon"), F.col("lat"), 14).alias("p"))
    for r in df.select("lon", "lat", G.transverse_mercator_inverse(F.col("p.x"), F.col("p.y"), F.lit(14), F.lit(False)).alias("b")).collect():
        assert abs(r.b.x - r.lon) < 1e-8 and abs(r.b.y - r.lat) < 1e-8


def test_file_products(spark):
    paths = ["/r/a/20170203T010203_VH_x_filtered.tif", "/r/a/20170203T010203_VV_x_filtered.tif", "/r/b/1_VH_filtered.tif", *[f"/c/{v}_{i}.tif" for v in ("tmax", "tmean", "tmin") for i in range(1, 13)], "/m/mask_7.tif"]
    files = spark.createDataFrame([(p,) for p in paths], "path string")
    pairs, rejects = metadata.radar_scenes(files.where("path like '/r/%'"))
    assert [str(r.acquired) for r in pairs.collect()] == ["2017-02-03 01:02:03"] and [r.missing for r in rejects.collect()] == [["vv"]]
    climate = metadata.file_manifest(files, metadata.CLIMATE)[0].collect()
    assert len(climate) == 1 and climate[0].tmin_dec == "/c/tmin_12.tif"
    assert [r.number for r in metadata.numbered_tiles(files.where("path like '/m/%'")).collect()] == [7]
    assert vectors.matching_paths(files, "VV").count() == 1


def test_vector_sources(spark):
    base = tempfile.mkdtemp(prefix="spark-")
    rows = [{"type": "Feature", "geometry": {"type": "Polygon", "coordinates": [[[i, 0], [i + 1, 0], [i, 1], [i, 0]]]}, "properties": {"n": i, "code": i % 2 + 3}} for i in range(7)]
    rows.append({"type": "Feature", "geometry": {"type": "Point", "coordinates": [0, 0]}, "properties": {"n": 99}})
    with open(f"{base}/train.json", "w") as f:
        f.write("\n".join(map(json.dumps, rows)))
    features = vectors.read_features(spark, f"{base}/train.json", {"n": "int", "code": "int"})
    assert features.count() == 7 and features.select(F.sum(G.polygon_area(F.col("geom")))).first()[0] == 3.5
    tags = spark.createDataFrame([(5, "own", 3), (9, "other", 4)], "tag long, scheme string, code long")
    objects, classes, tags = vectors.ingest_training(features, "n", "code", "own", "set", 2017, tags, every=3)
    assert {(r.id, r.tag) for r in classes.collect()} == {(0, 5), (3, 10), (6, 5)} and tags.count() == 3
    assert {r.filename for r in objects.collect()} == {"train"}
    assert vectors.ingest_validation(features, "n", "code", "own", "v", 2017, tags)[1].columns == ["id", "tag", "valid_set"]
    one = features.select(F.col("n").alias("path"), F.lit(4).alias("row"), "geom")
    land = spark.createDataFrame([(geom([(0, 0), (2.5, 0), (2.5, 2), (0, 2)]),)], f"geom {G.GEOMETRY}")
    kept, rejects = vectors.ingest_footprints(one, land)
    assert {r.name for r in kept.collect()} == {"000004", "001004", "002004"} and rejects.count() == 4
    b = features.select(F.concat(F.lit("c"), "n").alias("name"), F.col("n").cast("string").alias("iso"), "geom")
    assert vectors.ingest_boundaries(b, b.where("iso < '3'"))[1].count() == 3
    d = spark.createDataFrame([("u1", 0.0, 0.0, 1.0, 1.0), ("u2", 0.0, 0.0, 1.0, 1.0)], "uri string, xmin double, ymin double, xmax double, ymax double").withColumns({k: F.lit("2017-01-01").cast("timestamp") for k in ("begin", "end")})
    for part in (d.limit(1), d):
        m = vectors.register_product(part, "p", "a product", "/p", f"{base}/manifest", 0.5)
    assert m.count() == 2 and m.agg(F.min("xmin")).first()[0] == -0.25
    codes = vectors.export_raster(features.withColumnRenamed("n", "seq"), f"{base}/raster", 0.5, spark.createDataFrame([(3, "#ff0000")], "code int, color string"))
    assert codes.count() == 3 * 15 and spark.read.parquet(f"{base}/raster/colours").count() == 2
    assert vectors.raster_of(features.withColumnRenamed("n", "seq").limit(0), 0.5).count() == 0


@pytest.mark.parametrize("name", ["polygon_overlap_area", "validate_map", "spatial_semi_join", "export_raster", "detect_and_classify_change", "region_rings", "dataset_outlines", "scene_metadata", "ingest_training", "mid_date", "segment_workflow"])
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for f in os.listdir(SMALL):
        con.sql(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM read_parquet('{SMALL}/{f}')")
    want = con.sql(Q.SQL[name])
    plain = lambda rows: sorted((tuple(v if v is None or isinstance(v, str) else float(v) for v in r) for r in rows), key=repr)
    assert plain(Q.QUERIES[name](spark, SMALL).select(*want.columns).collect()) == plain(want.fetchall())


def test_relevance_by_centres(spark):
    square = lambda x, y, w: geom([(x, y), (x + w, y), (x + w, y + w), (x, y + w)])
    rows = [(1, square(0, 0, 40), square(-7, -7, 15)), (2, square(0, 0, 40), square(-8, -8, 15)), (3, square(0, 0, 40), square(32, 0, 16)), (4, RING, square(1.5, 1.5, 1))]
    df = spark.createDataFrame(rows, f"id int, l_geom {G.GEOMETRY}, r_geom {G.GEOMETRY}")
    common = F.element_at(F.create_map(F.lit(1), F.lit(64.0), F.lit(2), F.lit(49.0), F.lit(3), F.lit(128.0), F.lit(4), F.lit(0.0)), F.col("id"))
    assert {r.id: r.r for r in df.select("id", spatial.is_relevant(common).alias("r")).collect()} == {1: True, 2: False, 3: False, 4: False}
    c = df.select("id", G.centroid(F.col("l_geom")).alias("c")).collect()
    assert {r.id: (r.c.x, r.c.y) for r in c} == {1: (20.0, 20.0), 2: (20.0, 20.0), 3: (20.0, 20.0), 4: (2.0, 2.0)}


def test_kapur_options_and_imadmaf(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(0, 1, (40, 40, 3))
    after = base + rng.normal(0, 0.1, base.shape)
    after[5:9, 5:9] += 6
    rows = [(i * 40 + j, i, j, *map(float, base[i, j]), *map(float, after[i, j])) for i in range(40) for j in range(40)]
    pairs = spark.createDataFrame(rows, "cell long, row int, col int, a double, b double, c double, d double, e double, f double")
    x, y = ["a", "b", "c"], ["d", "e", "f"]
    changed = {i * 40 + j for i in range(5, 9) for j in range(5, 9)}
    for options in ({"threshold": "kapur", "bins": 60}, {"threshold": "elliptic", "outliers": 0.02}):
        found = {r.cell for r in change.imadmaf(regions.written(pairs, "pair"), x, y, rounds=20, **options).where("changed").collect()}
        assert len(found & changed) >= 14, options
    d = change.change_distance(pairs, x, y).withColumn("distance", F.when(F.col("cell") == 7, -1.0).otherwise(F.col("distance")))
    for bins in (50, "sturges", "scott", "freedman"):
        out = {r.cell: r.changed for r in change.kapur_threshold(d, "distance", bins=bins, no_data=-1.0, clip=None).collect()}
        assert out[7] is None and all(out[c] for c in changed), bins
    assert change.kapur_threshold(d, "distance", bins=50, from_mode=False).where("changed").count() >= 1


def test_labels_of_schemes(spark):
    tags = spark.createDataFrame([(1, "s", "forest", 10), (2, "s", "water", 20), (3, "t", "forest", 30)], "tag int, scheme string, value string, code int")
    assert catalog.label_encoding(tags, "s") == {"forest": 10, "water": 20} and catalog.label_encoding(tags, "s", True)[20] == "water"
    rows = spark.createDataFrame([(1, "forest"), (2, "sand")], "id int, label string")
    assert {r.id: r.code for r in catalog.encode_labels(rows, tags, "t").collect()} == {1: 30, 2: None}
    objects = spark.createDataFrame([("first", 2), ("other", 3)], "valid_set string, tag int")
    assert catalog.scheme_of_set(objects, tags, "first").first().scheme == "s"


def test_zones_with_categorical_bands(spark):
    cells = spark.createDataFrame([(0, 0, 1.0, None), (1, 0, 3.0, 5), (0, 1, 8.0, 7)], "row int, col int, red double, cover int")
    zones = spark.createDataFrame([(0, 0, 1), (1, 0, 1), (0, 1, 1)], "row int, col int, feature_id int")
    assert tuple(spatial.zonal_stats(zones, cells, ["red", "cover"], "mean", categorical=["cover"]).first()) == (1, 4.0, 5)


def test_rasterize_against_point_tests(spark):
    random = np.random.default_rng(5)
    rows = []
    for i in range(12):
        angles, far = np.sort(random.uniform(0, 2 * np.pi, 11)), random.uniform(2, 14, 11)
        ring = [(10 + i % 3 + d * np.cos(a), 10 - i % 4 + d * np.sin(a)) for a, d in zip(angles, far, strict=True)]
        rows.append((i, i * 10, geom(ring, [(9.5, 9.5), (10.5, 9.5), (10.5, 10.5), (9.5, 10.5)])))
    rows.append((12, 120, geom([(3, 3), (6, 3), (6, 6), (3, 6)])))  # edges along cells' borders
    features = spark.createDataFrame(rows, f"seq int, feature_id int, geom {G.GEOMETRY}")
    for size, limits in ((1.0, (20, 18)), (0.7, (None, None))):
        got = {(r.row, r.col): r.feature_id for r in spatial.rasterize_features(features, 0.0, 20.0, size, *limits).collect()}
        grid = spark.range(45 * 45).select((F.col("id") % 45).cast("int").alias("row"), F.expr("cast(id div 45 as int)").alias("col"))
        x, y = (F.col("col") + 0.5) * size, 20.0 - (F.col("row") + 0.5) * size
        hit = grid.crossJoin(F.broadcast(features)).where(G.contains_point(F.col("geom"), x, y))
        want = {(r.row, r.col): r.f for r in hit.groupBy("row", "col").agg(F.max_by("feature_id", "seq").alias("f")).collect()}
        want = {k: v for k, v in want.items() if limits[0] is None or (k[0] < limits[0] and k[1] < limits[1])}
        assert got == want
    assert spatial.rasterize_features(features.limit(0), 0.0, 20.0, 1.0).count() == 0


def test_equal_area_projection(spark):
    df = spark.createDataFrame([(-99.5, 19.3), (-101.7, 31.0), (-102.0, 23.0), (-86.8, 14.6)], "lon double, lat double")
    p = df.select("lon", "lat", G.lambert_equal_area(F.col("lon"), F.col("lat"), 23.0, -102.0, 1000.0, 2000.0).alias("p"))
    for r in p.select("*", G.lambert_equal_area_inverse(F.col("p.x"), F.col("p.y"), 23.0, -102.0, 1000.0, 2000.0).alias("b")).collect():
        assert abs(r.b.x - r.lon) < 1e-8 and abs(r.b.y - r.lat) < 1e-8
    # a small square's area is that on the ellipsoid, wherever it lies
    e2, a = (2 - 1 / 298.257223563) / 298.257223563, 6378137.0
    for lon, lat in ((-110.0, 15.0), (-90.0, 31.0)):
        h = 0.005
        q = spark.range(1).select(*[G.lambert_equal_area(F.lit(lon + i * h), F.lit(lat + j * h), 23.0, -102.0).alias(n) for n, (i, j) in {"a": (-1, -1), "b": (1, -1), "c": (1, 1), "d": (-1, 1)}.items()]).first()
        ring = [q.a, q.b, q.c, q.d]
        area = sum(s.x * t.y - t.x * s.y for s, t in zip(ring, ring[1:] + ring[:1], strict=True)) / 2
        w = 1 - e2 * np.sin(np.radians(lat)) ** 2
        true = a * a * (1 - e2) / w**2 * np.cos(np.radians(lat)) * np.radians(2 * h) ** 2
        assert abs(area / true - 1) < 1e-6


def test_tiles_of_regions_and_segmentation_by_name(spark):
    square = geom([(0, 0), (10, 0), (0, 10)])
    countries = spark.createDataFrame([("here", square)], f"name string, geom {G.GEOMETRY}")
    regions_ = spark.createDataFrame([("here", geom([(50, 50), (60, 50), (60, 60)])), ("there", square)], f"name string, geom {G.GEOMETRY}")
    tiles = spark.createDataFrame([(1, 0, 0, 2, 2), (2, 8, 8, 10, 10), (3, 5, 5, 7, 7), (4, 52, 50, 54, 52)], "id int, xmin int, ymin int, xmax int, ymax int").withColumn("t", F.lit("2017-01-01").cast("timestamp"))
    for name in ("here", "there"):
        got = {r.id for r in cube.query_tiles(tiles, shape=cube.region_shape(name, countries, regions_), size=3.0).collect()}
        assert got == {1, 3}  # a country comes before a region; the corner of 3 lies on the edge
    with pytest.raises(ValueError):
        segments.segment("none", tiles, ["xmin"])
    cells = spark.createDataFrame([(r, c, float(c >= 4)) for r in range(8) for c in range(8)], "row int, col int, v double")
    assert segments.segment("slic", cells, ["v"], step=4, rounds=2).select("segment").distinct().count() == 4
