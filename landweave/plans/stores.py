"""Registered queries of sinks, stores, training from tiles and change steps, each beside its SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landweave.functions import catalog as FC
from landweave.functions import geometry as G
from landweave.functions import raster as R
from landweave.functions import statistics
from landweave.operators import change, cube, userstats, workflows
from landweave.operators.regions import shared_folder
from landweave.plans import views as V
from landweave.plans.queries import _BANDS, _LANDSAT, _POST, _PRE, registered, rounded
from landweave.plans.workflows import _S, _files
from landweave.sources import metadata, sinks, vectors

_ZONES = """zone AS (SELECT DISTINCT "row" // 3 AS zr, col // 4 AS zc, CAST("row" // 3 * 100 + col // 4 AS BIGINT) AS id FROM terrain WHERE "row" // 3 < 20),
  inside AS (SELECT id, zr, zc, CAST(zr * 3 // 8 AS INTEGER) AS tile_y, CAST(zc * 4 // 10 AS INTEGER) AS tile_x FROM zone WHERE zr * 3 // 8 = (zr * 3 + 2) // 8 AND zc * 4 // 10 = (zc * 4 + 3) // 10),
  met AS (SELECT * FROM inside WHERE tile_x * 10 <= 25 AND tile_x * 10 + 10 >= 12 AND tile_y * 8 <= 30 AND tile_y * 8 + 8 >= 5),
  cell AS (SELECT "row", col, avg(red) AS red, avg(nir) AS nir FROM obs GROUP BY ALL)"""


def _tiled(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """A cube of mean bands written by column of tiles (8 rows by 10 columns) in their order, its tiles, rectangles of 3 by 4 cells, and their classes."""
    cells = V.obs(spark, sf_dir).groupBy("row", "col").agg(F.avg("red").alias("red"), F.avg("nir").alias("nir"))
    keys = {"product": F.lit("mean"), "tile_x": F.floor(F.col("col") / 10).cast("int"), "tile_y": F.floor(F.col("row") / 8).cast("int")}
    path = shared_folder(spark, "cube")
    cubes = sinks.write_feature_cube(cells.withColumns(keys), path, ["product", "tile_x"], ["tile_y"])  # a tile has 80 cells
    x, y = F.col("tile_x") * 10.0, F.col("tile_y") * -8.0
    tiles = cubes.select("tile_x", "tile_y").distinct().select("tile_x", "tile_y", x.alias("xmin"), (y - 8).alias("ymin"), (x + 10).alias("xmax"), y.alias("ymax"))
    zone = V.terrain(spark, sf_dir).where("row div 3 < 20").select(F.expr("row div 3").alias("zr"), F.expr("col div 4").alias("zc")).distinct()
    zone = zone.select((F.col("zr") * 100 + F.col("zc")).alias("id"), (F.col("zc") * 4.0).alias("x"), (F.col("zr") * -3.0).alias("y"))
    point = lambda a, b: F.struct(a.alias("x"), b.alias("y"))
    ring = F.array(point(F.col("x"), F.col("y")), point(F.col("x") + 4, F.col("y")), point(F.col("x") + 4, F.col("y") - 3), point(F.col("x"), F.col("y") - 3))
    return cubes, tiles, zone.select("id", F.array(F.array(ring)).alias("geom")), zone.select("id", (F.col("id") % 3).cast("int").alias("tag"))


@registered(f""", {_ZONES} SELECT tile_x, tile_y, id, CAST(id % 3 AS INTEGER) AS tag, round(avg(red), 4) AS red, round(avg(nir), 4) AS nir FROM met JOIN cell c ON c."row" // 3 = zr AND c.col // 4 = zc GROUP BY ALL""")
def training_from_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training rows of the objects that lie in the tiles of a box."""
    cubes, tiles, objects, classes = _tiled(spark, sf_dir)
    rows, _ = workflows.training_from_tiles(cubes, tiles, objects, classes, ["red", "nir"], 0.0, 0.0, 1.0, 10.0, box=(12, -30, 25, -5))
    return rounded(rows)


@registered(f""", {_ZONES} SELECT tile_x, tile_y, count(*) AS objects, CAST(floor(count(*) * 0.5) AS BIGINT) AS drawn FROM met GROUP BY ALL""")
def training_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objects in tiles and how many of each were drawn, for half of them."""
    cubes, tiles, objects, classes = _tiled(spark, sf_dir)
    _, report = workflows.training_from_tiles(cubes, tiles, objects, classes, ["red", "nir"], 0.0, 0.0, 1.0, 10.0, sample=0.5, box=(12, -30, 25, -5))
    return report.select("tile_x", "tile_y", "objects", "drawn")


@registered(f""", {_ZONES} SELECT 'trained' AS name, 'means' AS recipe, 'zones' AS training_set, count(*) AS rows FROM met""")
def model_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registry after fitting and saving a model of the tiles' objects."""
    cubes, tiles, objects, classes = _tiled(spark, sf_dir)
    rows, _ = workflows.training_from_tiles(cubes, tiles, objects, classes, ["red", "nir"], 0.0, 0.0, 1.0, 10.0, box=(12, -30, 25, -5))
    found = workflows.fit_from_tiles("trained", spark, shared_folder(spark, "store"), "rf", rows, ["red", "nir"], "means", "zones", trees=3, depth=3)
    return found.select("name", "recipe", "training_set").join(F.broadcast(rows.agg(F.count(F.lit(1)).alias("rows"))), F.lit(True))  # one row


@registered(f"SELECT id, CAST(nation AS BIGINT) AS code, CASE WHEN nation < 10 THEN 'low' ELSE 'high' END AS class FROM {_S} s WHERE id % 2 = 0 AND x <= 700 AND x + 40 >= 200 AND y <= 600 AND y + 40 >= 100")
def export_vector(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classified squares of one map in a region, written as GeoJSON lines and read again."""
    nations = V.table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_nationkey").cast("long").alias("tag"))
    objects = V.suppliers_as_rectangles(spark, sf_dir)[0].join(nations, "id").withColumn("name", F.when(F.col("id") % 2 == 0, "even").otherwise("odd"))
    tags = nations.select("tag").distinct().select("tag", F.when(F.col("tag") < 10, "low").otherwise("high").alias("value"), F.col("tag").alias("code"))
    ring = [{"x": float(x), "y": float(y)} for x, y in ((200, 100), (700, 100), (700, 600), (200, 600))]
    region = spark.createDataFrame([([[ring]],)], f"geom {G.GEOMETRY}")
    path = shared_folder(spark, "vectors")
    sinks.export_vector(objects, path, tags, "even", region, 50.0)
    read = vectors.read_features(spark, path, {"class": "string", "code": "long"})
    back = objects.select("id", G.geom_bbox(F.col("geom")).alias("box"), "tag").join(read.select(G.geom_bbox(F.col("geom")).alias("box"), "class", "code"), "box")
    return back.where("tag = code and id % 2 = 0").select("id", "class", "code").distinct()


@registered("SELECT '/d/' || c_custkey || '.tif' AS uri, CAST(c_custkey % 90 AS DOUBLE) - 0.5 AS xmin, CAST(c_nationkey AS DOUBLE) + 1.5 AS ymax, CAST(c_custkey % 90 AS DOUBLE) - 0.5 AS lon_ul, CAST(c_nationkey AS DOUBLE) + 1.5 AS lat_ul FROM customer")
def register_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A manifest after two registrations that share half of the datasets; extents with their corners."""
    c = V.table(spark, sf_dir, "customer")
    at = {"xmin": F.col("c_custkey") % 90, "ymin": F.col("c_nationkey"), "xmax": F.col("c_custkey") % 90 + 1, "ymax": F.col("c_nationkey") + 1}
    day = F.lit("2017-01-01").cast("timestamp")
    rows = c.select("c_custkey", F.format_string("/d/%d.tif", "c_custkey").alias("uri"), *[v.cast("double").alias(k) for k, v in at.items()], day.alias("begin"), day.alias("end"))
    manifest, same = shared_folder(spark, "manifest"), lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    for part in (rows.where("c_custkey % 2 = 0"), rows):
        found = vectors.register_product(part.drop("c_custkey"), "p", "a product", "/p", manifest, 1.0, same)
    return found.select("uri", "xmin", "ymax", "lon_ul", "lat_ul")


@registered("SELECT '/d/S' || o_orderkey || '.SAFE' AS folder, CAST(o_custkey * 10 AS DOUBLE) AS ulx, CAST(o_custkey * 10 + 200 * 20 AS DOUBLE) AS lrx, CAST(1900000 - 100 * 20 AS DOUBLE) AS lry, 14 AS zone FROM orders WHERE o_orderkey % 4 = 0")
def scene_metadata_s2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Granules' metadata from XML and the names of their band files."""
    o = V.table(spark, sf_dir, "orders").where("o_orderkey % 4 = 0")
    text = F.format_string(
        "<n1:Level-2A_Tile_ID xmlns:n1=\"x\"><n1:General_Info><SENSING_TIME>2017-02-03T17:01:02.5Z</SENSING_TIME></n1:General_Info><n1:Geometric_Info><Tile_Geocoding><HORIZONTAL_CS_CODE>EPSG:32614</HORIZONTAL_CS_CODE><Size resolution=\"20\"><NROWS>100</NROWS><NCOLS>200</NCOLS></Size><Geoposition resolution=\"20\"><ULX>%d</ULX><ULY>1900000</ULY></Geoposition></Tile_Geocoding></n1:Geometric_Info></n1:Level-2A_Tile_ID>",
        F.col("o_custkey") * 10,
    )
    folder = F.format_string("/d/S%d.SAFE/GRANULE/G", "o_orderkey")
    xml = o.select(F.concat(folder, F.lit("/MTD_TL.xml")).alias("path"), text.alias("content"))
    names = F.explode(F.array(*[F.lit(f"/IMG_DATA/R20m/T_{b}_20m.jp2") for b in metadata.GRANULE_BANDS.values()]))
    images = o.select(folder.alias("folder"), names.alias("name")).select(F.concat("folder", "name").alias("path"), F.lit(None).cast("string").alias("content"))
    return metadata.scene_metadata_s2(xml.unionByName(images))[0].select("folder", "ulx", "lrx", "lry", "zone")


@registered("SELECT '/data/' || p_partkey AS folder, 'slope' AS missing FROM part WHERE p_size % 7 = 0")
def prepare_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rejects of a whole tree of terrain files, after both scenes and rejects were written."""
    rejects = metadata.prepare_metadata(_files(spark, sf_dir), "terrain", shared_folder(spark, "metadata"))
    return rejects.select("folder", F.array_join("missing", ",").alias("missing"))


@registered("SELECT c_custkey AS id, 'N' || c_nationkey AS name, 'R' || n_regionkey AS country FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_regionkey < 4")
def ingest_boundaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions with the name of their country; those of unknown countries go."""
    n = V.table(spark, sf_dir, "nation")
    none = F.lit(None).cast(G.GEOMETRY).alias("geom")
    countries = n.select(F.col("n_regionkey").cast("string").alias("iso"), F.format_string("R%d", "n_regionkey").alias("name"), none).where("iso < '4'")
    regions = n.select(F.col("n_regionkey").cast("string").alias("iso"), F.format_string("N%d", "n_nationkey").alias("name"), none)
    _, found = vectors.ingest_boundaries(countries, regions)
    c = V.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.format_string("N%d", "c_nationkey").alias("name"))
    return c.join(found.select("name", "country"), "name").select("id", "name", "country")


@registered('SELECT "row", col, CAST(10.0 + (col + 0.5) * 30.0 AS DOUBLE) AS x, CAST(5000.0 - ("row" + 0.5) * 30.0 AS DOUBLE) AS y FROM terrain')
def cell_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.terrain(spark, sf_dir).select("row", "col", R.cell_x(F.col("col"), 10.0, 30.0).alias("x"), R.cell_y(F.col("row"), 5000.0, 30.0).alias("y"))


@registered("""SELECT id, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-' || substr('89ab', CAST(strpos('0123456789abcdef', substr(h, 17, 1)) - 1 AS INTEGER) % 4 + 1, 1) || substr(h, 18, 3) || '-' || substr(h, 21, 12) AS uuid
  FROM (SELECT p_partkey AS id, sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || CAST('/data/' || p_partkey AS BLOB)) AS h FROM part)""")
def dataset_uuid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), FC.dataset_uuid(F.format_string("/data/%d", "p_partkey")).alias("uuid"))


@registered("SELECT a.\"row\" % 7 AS part, " + ", ".join(f"round(sum(a.{x} * b.{y}), 6) AS {x}_{y}" for x in _PRE for y in _PRE) + """ FROM pair a, pair b, (SELECT max("row") + 1 AS n_rows, max(col) + 1 AS n_cols FROM pair) e
  WHERE (b."row" + 1) % n_rows = a."row" AND (b.col + 1) % n_cols = a.col GROUP BY ALL""")
def shifted_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products of bands with those of the cell before, around the edges: what the shifted covariance sums."""
    p = V.pair(spark, sf_dir).select("row", "col", *_PRE)
    size = p.agg(F.max("row") + 1, F.max("col") + 1).first()
    s = workflows.shift_join(p, _PRE, *size)
    return rounded(s.groupBy((F.col("row") % 7).alias("part")).agg(*[F.sum(F.col(x) * F.col(f"shifted_{y}")).alias(f"{x}_{y}") for x in _PRE for y in _PRE]), 6)


_W = "(code + 1.0)"
_MEAN = {c: f"(SELECT sum({_W} * {c}) / sum({_W}) FROM pair)" for c in (*_PRE, *_POST)}


@registered("SELECT * FROM (VALUES " + ", ".join(f"('{a}', '{b}', (SELECT round(sum({_W} * ({a} - {_MEAN[a]}) * ({b} - {_MEAN[b]})) / (sum({_W}) - 1), 6) FROM pair))" for a in _PRE for b in _POST) + ") t(x, y, covariance)")
def weighted_covariance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The covariances of the two dates' bands, weighted by each cell's code."""
    cross = change.weighted_moments(V.pair(spark, sf_dir), _PRE, _POST, F.col("code") + 1.0)[4]
    rows = [(a, b, float(cross[i][j])) for i, a in enumerate(_PRE) for j, b in enumerate(_POST)]
    return rounded(spark.createDataFrame(rows, "x string, y string, covariance double"), 6)


@registered("SELECT cell, round(abs(" + "coalesce(matched, pre1) - post1), 4) AS distance FROM pair LEFT JOIN (WITH s AS (SELECT value, sum(n) OVER (ORDER BY value) / sum(n) OVER () AS share FROM (SELECT pre1 AS value, count(*) AS n FROM pair GROUP BY ALL)), t AS (SELECT value, sum(n) OVER (ORDER BY value) / sum(n) OVER () AS share FROM (SELECT post1 AS value, count(*) AS n FROM pair GROUP BY ALL)) SELECT s.value, CASE WHEN lo.value IS NULL THEN hi.value WHEN hi.value IS NULL OR lo.share = hi.share THEN lo.value ELSE lo.value + (s.share - lo.share) / (hi.share - lo.share) * (hi.value - lo.value) END AS matched FROM s ASOF LEFT JOIN t lo ON s.share >= lo.share ASOF LEFT JOIN t hi ON s.share <= hi.share) m ON m.value = pre1")
def change_distance_matched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The distance of one band whose first date is matched to the second."""
    return rounded(change.change_distance(V.pair(spark, sf_dir), ["pre1"], ["post1"], match=True).select("cell", "distance"))


@registered("SELECT cell, code FROM (SELECT *, count(*) OVER (PARTITION BY code) AS n FROM pair) WHERE n > 0 AND code < 5")
def stored_training_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training rows written instead of a model, and read again."""
    rows = V.pair(spark, sf_dir).where("code < 5")
    return sinks.save_training_matrix(rows, shared_folder(spark, "matrix"), ["cell", *_BANDS], "code").select("cell", "code")


@registered("SELECT code, count(*) AS edges FROM (SELECT p.code FROM pair p CROSS JOIN (VALUES (0, 1), (0, -1), (1, 0), (-1, 0)) d(i, j) WHERE NOT EXISTS (SELECT 1 FROM pair q WHERE q.code = p.code AND q.\"row\" = p.\"row\" + d.i AND q.col = p.col + d.j)) GROUP BY code")
def store_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored outlines of the codes' areas, asked for twice: the second time they are there."""
    cells, path = V.pair(spark, sf_dir).select("row", "col", "code"), shared_folder(spark, "segments")
    for part in (cells, cells.limit(1)):
        found = workflows.store_segments(part, path, "codes", "grid", "{}", "code")
    return found.groupBy("code").agg(F.count(F.lit(1)).alias("edges"))


def _as_table(cells: DataFrame, kind: str) -> DataFrame:
    spark = cells.sparkSession
    return sinks.write_cube_table(cells, f"{kind}_{uuid.uuid4().hex}", 8, path=shared_folder(spark, kind))


@registered('SELECT "row", col, t.elevation AS pre_v, o.v AS post_v FROM terrain t JOIN (SELECT "row", col, max(red) AS v FROM obs GROUP BY ALL) o USING ("row", col)')
def pair_dates_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of cells from two bucketed tables: the observations' groups and the join move nothing."""
    pre = _as_table(V.terrain(spark, sf_dir).select("row", "col", F.col("elevation").alias("v")), "pre")
    post = _as_table(V.obs(spark, sf_dir).select("row", "col", "red"), "post")
    return workflows.pair_dates(pre, post.groupBy("row", "col").agg(F.max("red").alias("v")))


@registered(_LANDSAT)
def recipe_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first Landsat recipe of a bucketed table's cells, with terrain from another: neither moves a cell."""
    cells = _as_table(V.obs(spark, sf_dir).select("row", "col", "qa", *cube.LANDSAT), "cube")
    return cube.run_recipe("landsat_001", cells, terrain=_as_table(V.terrain(spark, sf_dir), "terrain"))


@registered("""SELECT id, round(max(v) - min(v), 4) AS v_spread, round(avg(d * d * d) / pow(avg(d * d), 1.5), 6) AS v_skewness, round(avg(d * d * d * d) / pow(avg(d * d), 2) - 3, 6) AS v_kurtosis
  FROM (SELECT o_orderstatus AS id, o_totalprice AS v, o_totalprice - avg(o_totalprice) OVER (PARTITION BY o_orderstatus) AS d FROM orders) GROUP BY ALL""")
def user_statistics_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics written in Python, found in a module, in two phases; three groups hold all rows."""
    own = {n: s for n, s in userstats.statistics_of(spark, statistics).items() if n != "total_area"}
    rows = V.table(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("id"), F.col("o_totalprice").alias("v"))
    return rounded(userstats.user_statistics(rows, "id", own, ["v"]), 6).withColumn("v_spread", F.round("v_spread", 4))


@registered(f"SELECT nation, count(*) * 1600.0 AS geom_area FROM {_S} s GROUP BY ALL")
def user_statistics_geometry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The area of each nation's squares by a statistic over geometries."""
    nations = V.table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_nationkey").cast("long").alias("nation"))
    squares = V.suppliers_as_rectangles(spark, sf_dir)[0].join(nations, "id")
    return userstats.user_statistics(squares, "nation", {"area": statistics.total_area}, ["geom"])


@registered('SELECT "row", col, count(*) AS n, count(nullif(red, -9999)) AS known, CAST(sum(nullif(red, -9999)) AS BIGINT) AS red FROM obs WHERE col // 10 = 1 GROUP BY ALL')
def scan_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One band of one column of tiles, missing values as null, from a cube that is written once: the second time it is there."""
    cells, path = V.obs(spark, sf_dir).withColumn("tile_x", F.floor(F.col("col") / 10).cast("int")), shared_folder(spark, "cube")
    for part in (cells, cells.limit(0)):
        sinks.write_feature_cube(part, path, ["tile_x"])
    found = cube.scan_cube(spark, path, ["red"], -9999, F.col("tile_x") == 1)
    return found.groupBy("row", "col").agg(F.count(F.lit(1)).alias("n"), F.count("red").alias("known"), F.sum("red").cast("long").alias("red"))


@registered("SELECT CAST(o_custkey AS BIGINT) AS id, max(o_totalprice) AS b0_max, count(*) AS n FROM orders GROUP BY ALL")
def write_stats_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table of statistics as CSV, read again by the columns that were written."""
    stats = V.table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("id")).agg(F.count(F.lit(1)).alias("n"), F.max("o_totalprice").alias("b0_max"))
    path, kinds = shared_folder(spark, "csv"), {"id": "long", "n": "long", "b0_max": "double"}
    columns = sinks.write_stats_csv(stats, path)
    return spark.read.schema(", ".join(f"{c} {kinds[c]}" for c in columns)).csv(path, header=True, enforceSchema=False)
