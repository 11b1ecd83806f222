"""Registered queries of catalogues, vector sources, metadata and whole jobs, each beside its SQL."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landweave.functions import catalog as FC
from landweave.functions import geometry as G
from landweave.operators import change, scenes, segments, spatial, workflows
from landweave.plans import views as V
from landweave.plans.queries import _CHANGED, _LINKS, _POST, _PRE, _REACH, registered, rounded
from landweave.sources import metadata, vectors

_X, _Y = "CAST({k} * 37 % 1000 AS DOUBLE)", "CAST(CAST(floor(abs({b})) AS BIGINT) % 1000 AS DOUBLE)"
_S = f"(SELECT s_suppkey AS id, {_X.format(k='s_suppkey')} AS x, {_Y.format(b='s_acctbal')} AS y, CAST(s_nationkey AS BIGINT) AS nation FROM supplier)"
_C = f"(SELECT c_custkey AS id, {_X.format(k='c_custkey')} AS x, {_Y.format(b='c_acctbal')} AS y, CAST(c_nationkey AS BIGINT) AS nation FROM customer)"


def _triangles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id and geom: right triangles of 40 by 40 at the suppliers' places."""
    s = V.table(spark, sf_dir, "supplier")
    x, y = (F.col("s_suppkey") * 37 % 1000).cast("double"), (F.floor(F.abs("s_acctbal")) % 1000).cast("double")
    point = lambda a, b: F.struct(a.alias("x"), b.alias("y"))
    return s.select(F.col("s_suppkey").alias("id"), F.array(F.array(F.array(point(x, y), point(x + 40, y), point(x, y + 40)))).alias("geom"))


def _corner(p: str, q: str) -> str:
    return f"pow(greatest(40 - greatest({p}, 0) - greatest({q}, 0), 0), 2) / 2"


_A, _B, _P, _Q = "(c.x - s.x)", "(c.x + 15 - s.x)", "(c.y - s.y)", "(c.y + 15 - s.y)"
_TRIANGLE_PAIRS = f"""(SELECT * FROM (SELECT s.id AS l_id, c.id AS r_id, {_corner(_A, _P)} - {_corner(_B, _P)} - {_corner(_A, _Q)} + {_corner(_B, _Q)} AS weight
  FROM {_S} s JOIN {_C} c ON s.x <= c.x + 15 AND c.x <= s.x + 40 AND s.y <= c.y + 15 AND c.y <= s.y + 40) WHERE weight > 0)"""


@registered(f"SELECT l_id, r_id, round(weight, 4) AS weight FROM {_TRIANGLE_PAIRS}")
def polygon_overlap_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact common areas of triangles and squares."""
    return rounded(spatial.overlap_area(_triangles(spark, sf_dir), V.suppliers_as_rectangles(spark, sf_dir)[1], 50.0).select("l_id", "r_id", "weight"))


@registered(f"SELECT count(*) AS n_rows, round(sum(weight) FILTER (WHERE l_id % 3 = r_id % 3) / sum(weight), 4) AS overall FROM {_TRIANGLE_PAIRS}")
def validate_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The predicted squares' classes against the triangles'."""
    valid, predicted = (d.withColumn("class", F.col("id") % 3) for d in (_triangles(spark, sf_dir), V.suppliers_as_rectangles(spark, sf_dir)[1]))
    return rounded(workflows.validate_map(valid, predicted, 50.0).select("n_rows", "overall"))


@registered(f"""SELECT id FROM {_C} c WHERE EXISTS (SELECT 1 FROM {_S} s WHERE greatest(c.x - s.x, 0) + greatest(c.y - s.y, 0) <= 40 AND c.x + 15 >= s.x AND c.y + 15 >= s.y)""")
def spatial_semi_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Squares that share a point with any triangle, borders included."""
    return spatial.spatial_semi_join(V.suppliers_as_rectangles(spark, sf_dir)[1], _triangles(spark, sf_dir), 50.0).select("id")


@registered(f"SELECT id FROM {_C} WHERE x <= 700 AND x + 15 >= 200 AND y <= 600 AND y + 15 >= 100 ORDER BY id LIMIT 10 OFFSET 10")
def features_in_polygon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objects in a shape, as a page of a listing."""
    ring = [{"x": float(x), "y": float(y)} for x, y in ((200, 100), (700, 100), (700, 600), (200, 600))]
    shape = spark.createDataFrame([([[ring]],)], f"geom {G.GEOMETRY}")
    return vectors.features_in_polygon(V.suppliers_as_rectangles(spark, sf_dir)[1], shape, 50.0, page=1, length=10).select("id")


@registered(f"SELECT min(x) AS xmin, min(y) AS ymin, max(x) + 40 AS xmax, max(y) + 40 AS ymax FROM {_S}")
def extent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.extent(_triangles(spark, sf_dir))


@registered(f"""SELECT g."row", g.col, CAST(coalesce(arg_max(s.nation, s.id), 0) AS INTEGER) AS code FROM (
  SELECT CAST(r AS INTEGER) AS "row", CAST(c AS INTEGER) AS col, x0 + (c + 0.5) * 9.3 AS x, y1 - (r + 0.5) * 9.3 AS y FROM (SELECT min(x) AS x0, max(x) + 40 AS x1, min(y) AS y0, max(y) + 40 AS y1 FROM {_S}) e,
  range(0, 200) a(r), range(0, 200) b(c) WHERE r <= floor((y1 - y0) / 9.3) AND c <= floor((x1 - x0) / 9.3)) g
  LEFT JOIN {_S} s ON g.x > s.x AND g.x < s.x + 40 AND g.y > s.y AND g.y < s.y + 40 GROUP BY g."row", g.col""")
def export_raster(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The codes' grid of the suppliers' squares; the last of several counts."""
    nations = V.table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_nationkey").alias("code"))
    return vectors.raster_of(V.suppliers_as_rectangles(spark, sf_dir)[0].join(nations, "id"), 9.3, order="id")


def _reproject_sql() -> str:
    a, f = 6378137.0, 1 / 298.257223563
    e = math.sqrt(f * (2 - f))
    t = lambda p: math.tan(math.pi / 4 - p / 2) / ((1 - e * math.sin(p)) / (1 + e * math.sin(p))) ** (e / 2)
    m = lambda p: math.cos(p) / math.sqrt(1 - (e * math.sin(p)) ** 2)
    p1, p2, p0 = map(math.radians, (17.5, 29.5, 12.0))
    n = math.log(m(p1) / m(p2)) / math.log(t(p1) / t(p2))
    k = a * m(p1) / (n * t(p1) ** n)
    lat = "radians(14 + c_custkey % 190 / 10.0)"
    r = f"{k!r} * pow(tan(pi() / 4 - {lat} / 2) / pow((1 - {e!r} * sin({lat})) / (1 + {e!r} * sin({lat})), {e / 2!r}), {n!r})"
    angle = f"{n!r} * radians(c_custkey % 300 / 10.0 - 117 + 102)"
    return f"SELECT c_custkey AS id, round(2500000 + {r} * sin({angle}), 2) AS x, round({k * t(p0) ** n!r} - {r} * cos({angle}), 2) AS y FROM customer"


@registered(_reproject_sql())
def reproject(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Longitudes and latitudes in the conic projection with two standard parallels."""
    p = G.lambert_conformal(F.col("c_custkey") % 300 / 10.0 - 117, F.col("c_custkey") % 190 / 10.0 + 14)
    return V.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.round(p["x"], 2).alias("x"), F.round(p["y"], 2).alias("y"))


_TILES = ["SELECT l_partkey AS k, count(*) AS value FROM lineitem WHERE l_quantity < 10 GROUP BY ALL", "SELECT p_partkey AS k, CAST(p_size AS BIGINT) AS value FROM part WHERE p_size < 20"]


def _tile_frames(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    lines = V.table(spark, sf_dir, "lineitem").where("l_quantity < 10").groupBy(F.col("l_partkey").alias("k")).agg(F.count(F.lit(1)).alias("value"))
    parts = V.table(spark, sf_dir, "part").where("p_size < 20").select(F.col("p_partkey").alias("k"), F.col("p_size").cast("long").alias("value"))
    return [lines, parts]


@registered(f"SELECT k, a.value || ',' || b.value AS vals FROM ({_TILES[0]}) a JOIN ({_TILES[1]}) b USING (k)")
def join_tiles_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    return workflows.join_tiles(_tile_frames(spark, sf_dir), ["k"]).select("k", F.array_join(F.col("values").cast("array<string>"), ",").alias("vals"))


@registered(f"SELECT k, concat_ws(',', a.value, b.value) AS vals FROM ({_TILES[0]}) a FULL JOIN ({_TILES[1]}) b USING (k)")
def join_tiles_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return workflows.join_tiles(_tile_frames(spark, sf_dir), ["k"], how="full").select("k", F.array_join(F.col("values").cast("array<string>"), ",").alias("vals"))


@registered("""SELECT a.cell, round(a.pre1 - b.pre1, 6) AS step FROM pair a, pair b, (SELECT max("row") + 1 AS n_rows, max(col) + 1 AS n_cols FROM pair) e
  WHERE (b."row" + 1) % n_rows = a."row" AND (b.col + 1) % n_cols = a.col""")
def shift_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = V.pair(spark, sf_dir).select("cell", "row", "col", "pre1")
    size = p.agg(F.max("row") + 1, F.max("col") + 1).first()
    return rounded(workflows.shift_join(p, ["pre1"], *size).select("cell", (F.col("pre1") - F.col("shifted_pre1")).alias("step")), 6)


@registered("SELECT " + ", ".join(f"round(covar_samp({a}, {b}), 6) AS {a}_{b}" for a in _PRE for b in _POST) + " FROM pair")
def weighted_moments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The covariances of the two dates' bands, all weights 1."""
    cross = change.weighted_moments(V.pair(spark, sf_dir), _PRE, _POST)[4]
    return spark.range(1).select(*[F.round(F.lit(float(cross[i][j])), 6).alias(f"{a}_{b}") for i, a in enumerate(_PRE) for j, b in enumerate(_POST)])


@registered("SELECT round(avg(CASE WHEN sqrt(pow(pre1 - post1, 2) + pow(pre2 - post2, 2) + pow(pre3 - post3, 2)) > 0.25 THEN 1.0 ELSE 0.0 END), 6) AS fraction FROM pair")
def change_fraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = change.change_distance(V.pair(spark, sf_dir), _PRE, _POST)
    return rounded(workflows.change_fraction(d.withColumn("changed", F.col("distance") > 0.25)), 6)


@registered(f'SELECT DISTINCT code AS id FROM pair p WHERE EXISTS (SELECT 1 FROM ({_CHANGED}) c WHERE c.cell = p.cell)')
def land_cover_at_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = V.pair(spark, sf_dir)
    changed = change.change_distance(p, _PRE, _POST).where("distance > 0.25")
    return workflows.land_cover_at_change(p.select("row", "col", F.col("code").alias("id")), changed)


@registered(f""", c0 AS ({_CHANGED}), l0 AS ({_LINKS.format("c0")}), r0 AS (SELECT cell, cell AS root FROM c0 UNION SELECT l0.b, r0.root FROM r0 JOIN l0 ON l0.a = r0.cell AND r0.root < l0.b),
  g0 AS (SELECT cell, min(root) AS region FROM r0 GROUP BY cell), c AS (SELECT k.cell, k."row", k.col, p.code AS pre, (p.code + p.cell // 3) % 10 AS post, p.code * 100 + (p.code + p.cell // 3) % 10 AS code
  FROM c0 k JOIN pair p ON p.cell = k.cell JOIN g0 ON g0.cell = k.cell WHERE g0.region IN (SELECT region FROM g0 GROUP BY region HAVING count(*) >= 2)),
  l AS ({_LINKS.format("c")}), {_REACH.format("c")} SELECT region, CAST(any_value(pre) AS INTEGER) AS pre, CAST(any_value(post) AS INTEGER) AS post, count(*) * 900.0::DOUBLE AS area
  FROM (SELECT cell, min(root) AS region FROM r GROUP BY cell) JOIN c USING (cell) WHERE pre <> post GROUP BY region""")
def detect_and_classify_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objects of change of at least two cells of 30 m by 30 m, with the codes of both dates."""
    p = V.pair(spark, sf_dir)
    after = p.select("row", "col", F.expr("cast((code + cell div 3) % 10 as int)").alias("code"))
    objects, _ = workflows.detect_and_classify_change(p, _PRE, _POST, p.select("row", "col", "code"), after, threshold=0.25, min_area=1800, cell_area=900.0)
    return objects.select("region", "pre", "post", "area")


def _means(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Cells' mean bands, zones of 3 by 4 cells, and each zone's tag from its terrain."""
    cells = V.obs(spark, sf_dir).groupBy("row", "col").agg(F.avg("red").alias("red"), F.avg("nir").alias("nir"))
    zone = (F.floor(F.col("row") / 3) * 100 + F.floor(F.col("col") / 4)).cast("int")
    zones = V.terrain(spark, sf_dir).select("row", "col", "elevation", zone.alias("feature_id"))
    tags = zones.groupBy("feature_id").agg((F.avg("elevation") > 25).cast("int").alias("tag"))
    return cells, zones.select("row", "col", "feature_id"), tags


@registered("""SELECT feature_id, tag, round(avg(red), 4) AS red, round(avg(nir), 4) AS nir FROM (SELECT "row", col, avg(red) AS red, avg(nir) AS nir FROM obs GROUP BY ALL)
  JOIN (SELECT "row", col, CAST("row" // 3 * 100 + col // 4 AS INTEGER) AS feature_id FROM terrain) USING ("row", col)
  JOIN (SELECT CAST("row" // 3 * 100 + col // 4 AS INTEGER) AS feature_id, CAST(avg(elevation) > 25 AS INTEGER) AS tag FROM terrain GROUP BY 1) USING (feature_id) GROUP BY ALL""")
def extract_training(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells, zones, tags = _means(spark, sf_dir)
    return rounded(workflows.extract_training(cells, zones, tags, ["red", "nir"]).select("feature_id", "tag", "red", "nir"))


@registered()
def predict_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A forest of the training objects' statistics, applied to all objects."""
    cells, zones, tags = _means(spark, sf_dir)
    model = workflows.fit_model("rf", workflows.extract_training(cells, zones, tags, ["red", "nir"]), ["red", "nir"], trees=10, depth=5)
    return rounded(workflows.predict_objects(model, cells, zones, ["red", "nir"], "first"), 6)


@registered("SELECT code, count(*) * 1.0 AS area, (SELECT count(*) FROM (SELECT * FROM pair p2 CROSS JOIN (VALUES (0, 1), (0, -1), (1, 0), (-1, 0)) d(i, j) WHERE p2.code = p.code) s WHERE NOT EXISTS (SELECT 1 FROM pair q WHERE q.code = s.code AND q.\"row\" = s.\"row\" + s.i AND q.col = s.col + s.j)) AS edges FROM pair p GROUP BY code")
def region_rings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signed areas of the outline rings by code (holes count negative), from their corners in order: the number of cells."""
    rings = segments.region_rings(V.pair(spark, sf_dir).select("row", "col", "code"), "code")
    ends = rings.select("code", "ring", (F.col("seq") - 1).alias("seq"), F.col("x").alias("x2"), F.col("y").alias("y2"))
    first = rings.where("seq = 0").join(rings.groupBy("code", "ring").agg((F.max("seq")).alias("last")), ["code", "ring"]).select("code", "ring", F.col("last").alias("seq"), F.col("x").alias("x2"), F.col("y").alias("y2"))
    joined = rings.join(ends.where("seq >= 0").unionByName(first), ["code", "ring", "seq"])
    return joined.groupBy("code").agg((F.sum(F.expr("x * y2 - x2 * y")) / 2).alias("area"), F.count(F.lit(1)).alias("edges"))


@registered(f"""SELECT id, round(1600.0, 4) AS area, class, round(1 - common / 1600, 3) AS underseg, n FROM (SELECT s.id, coalesce(t.class, -1) AS class, t.common, o.n FROM {_S} s JOIN (SELECT l_suppkey AS id, count(*) AS n FROM (SELECT l_suppkey FROM lineitem) GROUP BY ALL) o USING (id)
  LEFT JOIN (SELECT l_id AS id, min(r_id) % 5 AS class, arg_min(weight, r_id) AS common FROM (SELECT l.id AS l_id, r.id AS r_id, (least(l.x + 40, r.x + 15) - greatest(l.x, r.x)) * (least(l.y + 40, r.y + 15) - greatest(l.y, r.y)) AS weight, ((l.x + 20 > r.x AND l.x + 20 < r.x + 15 AND l.y + 20 > r.y AND l.y + 20 < r.y + 15) OR (r.x + 7.5 > l.x AND r.x + 7.5 < l.x + 40 AND r.y + 7.5 > l.y AND r.y + 7.5 < l.y + 40)) AS centre
  FROM {_S} l JOIN {_C} r ON l.x < r.x + 15 AND r.x < l.x + 40 AND l.y < r.y + 15 AND r.y < l.y + 40) WHERE weight > 0.5 * 225 OR centre GROUP BY l_id) t USING (id))""")
def segment_workflow(spark: SparkSession, sf_dir: str) -> DataFrame:
    polygons, truth = V.suppliers_as_rectangles(spark, sf_dir)
    cells = V.table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("id"), "l_quantity")
    out = workflows.segment_workflow(polygons, cells, ["l_quantity"], truth.withColumn("class", F.col("id") % 5), 50.0)
    return out.join(cells.groupBy("id").agg(F.count(F.lit(1)).alias("n")), "id").select("id", "area", F.coalesce("class", F.lit(-1)).alias("class"), "underseg", "n")


@registered("SELECT o_orderstatus AS id, round(max(o_totalprice) - min(o_totalprice), 4) AS o_totalprice_range FROM orders GROUP BY ALL")
def user_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = V.table(spark, sf_dir, "orders").withColumnRenamed("o_orderstatus", "id")
    return rounded(workflows.user_statistics(rows, "id", {"range": lambda c: F.max(c) - F.min(c)}, ["o_totalprice"]))


@registered("SELECT name, 'S' || o_orderkey AS scene_id, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS acquired, CAST(CAST(floor(o_totalprice) AS BIGINT) % 100 AS DOUBLE) AS cloud_cover FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN footprints ON footprint = n_nationkey WHERE o_orderkey % 2 = 0 AND n_nationkey % 5 <> 4")
def ingest_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Day scenes of the footprints that are known."""
    o, c, n = (V.table(spark, sf_dir, t) for t in ("orders", "customer", "nation"))
    rows = o.join(c, F.col("o_custkey") == F.col("c_custkey")).join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    cloud = F.floor("o_totalprice") % 100
    listed = rows.select(
        F.col("n_regionkey").cast("string").alias("path"), F.col("n_nationkey").cast("string").alias("row"), F.when(F.col("o_orderkey") % 2 == 0, "Day").otherwise("NIGHT").alias("dayOrNight"),
        F.concat(F.lit("S"), F.col("o_orderkey").cast("string")).alias("sceneID"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("acquisitionDate"), cloud.alias("cloudCoverFull"), cloud.alias("CLOUD_COVER_LAND"),
        *[F.lit("0").alias(x) for x in ("upperLeftCornerLongitude", "lowerRightCornerLatitude", "lowerRightCornerLongitude", "upperLeftCornerLatitude")],
    )
    known = V.footprints(spark, sf_dir).where("footprint % 5 <> 4")
    return scenes.ingest_catalog(listed, known).select("name", "scene_id", F.date_format("acquired", "yyyy-MM-dd").alias("acquired"), "cloud_cover")


@registered("""SELECT c_custkey - (SELECT min(c_custkey) FROM customer) AS id, 'SRID=4326;POLYGON ((' || a || ' ' || (b + 1) || ', ' || (a + 1) || ' ' || (b + 1) || ', ' || (a + 1) || ' ' || b || ', ' || a || ' ' || b || ', ' || a || ' ' || (b + 1) || '))' AS the_geom
  FROM (SELECT c_custkey, c_custkey % 90 AS a, c_nationkey AS b FROM customer)""")
def dataset_outlines(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = F.col("c_custkey") % 90, F.col("c_nationkey").cast("long")
    at = lambda x, y: F.struct(x.alias("lon"), y.alias("lat"))
    coord = F.struct(at(a, b).alias("ll"), at(a + 1, b).alias("lr"), at(a, b + 1).alias("ul"), at(a + 1, b + 1).alias("ur"))
    rows = V.table(spark, sf_dir, "customer").select("c_custkey", F.to_json(F.struct(F.struct(coord.alias("coord")).alias("extent"))).alias("metadata"))
    return vectors.dataset_outlines(rows, "c_custkey")


@registered("SELECT DISTINCT o_orderpriority AS name FROM orders")
def list_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.list_catalog(V.table(spark, sf_dir, "orders").withColumnRenamed("o_orderpriority", "name"), "name")


def _scene_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Squares of customers with the identifier of a scene, of three missions."""
    mission = F.element_at(F.array(F.lit("LC08"), F.lit("le07"), F.lit("LT05")), (F.col("id") % 3 + 1).cast("int"))
    name = F.concat(mission, F.format_string("_L1TP_%06d_20170101_20170102_01_T1", "id"))
    return V.suppliers_as_rectangles(spark, sf_dir)[1].withColumn("scene_id", name)


@registered(f"SELECT 'le07_L1TP_' || lpad(CAST(id AS VARCHAR), 6, '0') || '_20170101_20170102_01_T1' AS scene_id FROM {_C} c WHERE id % 3 = 1 AND EXISTS (SELECT 1 FROM {_S} s WHERE greatest(c.x - s.x, 0) + greatest(c.y - s.y, 0) <= 40 AND c.x + 15 >= s.x AND c.y + 15 >= s.y)")
def select_scenes_for_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.select_scenes_for_order(_scene_names(spark, sf_dir), _triangles(spark, sf_dir), 7, 50.0).select("scene_id")


def _files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paths of terrain files, three to a part, one missing where p_size is a multiple of 7."""
    names = F.explode(F.array(*[F.lit(f"{n}.tif") for n in metadata.TERRAIN_FILES.values()])).alias("name")
    p = V.table(spark, sf_dir, "part").select("p_partkey", "p_size", names).where("not (p_size % 7 = 0 and name = 'slope_mosaic.tif')")
    return p.select(F.concat(F.lit("/data/"), F.col("p_partkey").cast("string"), F.lit("/"), F.col("name")).alias("path"))


@registered("SELECT folder, folder || '/srtm_mosaic.tif' AS elevation, folder || '/slope_mosaic.tif' AS slope, folder || '/aspect_mosaic.tif' AS aspect FROM (SELECT '/data/' || p_partkey AS folder FROM part WHERE p_size % 7 <> 0)")
def file_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metadata.file_manifest(_files(spark, sf_dir), metadata.TERRAIN)[0]


@registered("SELECT '/data/' || p_partkey AS folder, 'slope' AS missing FROM part WHERE p_size % 7 = 0")
def file_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metadata.file_manifest(_files(spark, sf_dir), metadata.TERRAIN)[1].select("folder", F.array_join("missing", ",").alias("missing"))


@registered("""SELECT '/scenes/' || o_orderkey AS folder, CASE WHEN o_orderkey % 2 = 0 THEN 'OLI_TIRS' ELSE 'ETM' END AS instrument, CAST(o_custkey * 30 AS DOUBLE) AS ulx, CAST(o_custkey * 30 + 100 AS DOUBLE) AS lrx,
  '/scenes/' || o_orderkey || '/f' || CASE WHEN o_orderkey % 2 = 0 THEN 4 ELSE 3 END || '.tif' AS red FROM orders""")
def scene_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scenes' metadata from XML: one text for each order."""
    o = V.table(spark, sf_dir, "orders")
    bands = "".join(f'<band name="sr_band{i}"><file_name>f{i}.tif</file_name></band>' for i in range(1, 8))
    text = F.format_string(
        "<espa_metadata><global_metadata><satellite>S</satellite><instrument>%s</instrument><acquisition_date>2017-02-03</acquisition_date><scene_center_time>17:01:02.5Z</scene_center_time><projection_information><corner_point location=\"UL\" x=\"%d\" y=\"2000000\"/><corner_point location=\"LR\" x=\"%d\" y=\"1900000\"/><utm_proj_params><zone_code>14</zone_code></utm_proj_params></projection_information></global_metadata><bands>" + bands + '<band name="pixel_qa"><file_name>qa.tif</file_name></band></bands></espa_metadata>',
        F.when(F.col("o_orderkey") % 2 == 0, "OLI_TIRS").otherwise("ETM"), F.col("o_custkey") * 30, F.col("o_custkey") * 30 + 100,
    )
    files = o.select(F.concat(F.lit("/scenes/"), F.col("o_orderkey").cast("string"), F.lit("/LC08_L1TP_026047_20170203_20170204_01_T1.xml")).alias("path"), text.alias("content"))
    return metadata.scene_metadata_landsat(files)[0].select("folder", "instrument", "ulx", "lrx", "red")


@registered("SELECT l_linenumber, count(*) AS n FROM (SELECT l_linenumber, row_number() OVER (ORDER BY l_orderkey, l_linenumber) - 1 AS id FROM lineitem) WHERE id % 5 = 0 GROUP BY ALL")
def ingest_training(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fifth labelled object in order, counted by its code."""
    key = F.format_string("%012d-%02d", "l_orderkey", "l_linenumber")
    rows = V.table(spark, sf_dir, "lineitem").select(key.alias("key"), "l_linenumber", F.lit(None).cast(G.GEOMETRY).alias("geom"), F.lit("/a/train.shp").alias("path"))
    tags = spark.createDataFrame([(7, "own", 3)], "tag long, scheme string, code long")
    _, classes, tags = vectors.ingest_training(rows, "key", "l_linenumber", "own", "first", 2017, tags, every=5)
    return classes.join(tags, "tag").groupBy(F.col("code").cast("int").alias("l_linenumber")).agg(F.count(F.lit(1)).alias("n"))


@registered("SELECT o_orderkey AS id, strftime(o_orderdate + INTERVAL 36 HOUR, '%Y-%m-%d %H:%M:%S') AS mid FROM orders")
def mid_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("o_orderdate")
    return V.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.date_format(FC.mid_date(d, d + F.expr("interval 3 days")), "yyyy-MM-dd HH:mm:ss").alias("mid"))
