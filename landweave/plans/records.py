"""Registered queries of tiles, projections, thresholds and records of vector sources, each beside its SQL."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landweave.functions import geometry as G
from landweave.functions import raster
from landweave.operators import change, cube, models, workflows
from landweave.plans import views as V
from landweave.plans.queries import QUERIES, SQL, registered, rounded
from landweave.plans.workflows import _C, _S, _files, _triangles
from landweave.sources import vectors

_MEETS = "greatest(c.x - s.x, 0) + greatest(c.y - s.y, 0) <= 40 AND c.x + {w} >= s.x AND c.y + {w} >= s.y"


@registered(f"""SELECT id FROM (SELECT o_orderkey AS id, CAST(o_custkey * 37 % 1000 AS DOUBLE) AS x, CAST(CAST(floor(o_totalprice) AS BIGINT) % 1000 AS DOUBLE) AS y FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate <= TIMESTAMP '1996-12-31') c
  WHERE EXISTS (SELECT 1 FROM {_S} s WHERE nation = 7 AND {_MEETS.format(w=10)})""")
def query_tiles_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tiles that meet the exact shape of a region, by its name, in a year."""
    o = V.table(spark, sf_dir, "orders")
    x, y = (F.col("o_custkey") * 37 % 1000).cast("double"), (F.floor("o_totalprice") % 1000).cast("double")
    tiles = o.select(F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("t"), x.alias("xmin"), y.alias("ymin"), (x + 10).alias("xmax"), (y + 10).alias("ymax"))
    nations = V.table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.concat(F.lit("region "), F.col("s_nationkey").cast("string")).alias("name"))
    shapes = _triangles(spark, sf_dir).join(nations, "id")
    countries = shapes.withColumn("name", F.concat(F.lit("country "), "name"))
    at = lambda d: F.lit(d).cast("timestamp")
    return cube.query_tiles(tiles, shape=cube.region_shape("region 7", countries, shapes), begin=at("1996-01-01"), end=at("1996-12-31"), size=50.0).select("id")


_DAYS = "SELECT CAST(o_custkey % 50 AS INTEGER) AS \"row\", CAST(o_custkey // 50 AS INTEGER) AS col, o_orderdate + to_microseconds(o_orderkey) AS t, CASE WHEN o_orderkey % 5 <> 0 THEN o_totalprice END AS v FROM orders"


@registered(f"""SELECT CAST(col // 8 AS INTEGER) AS tile_x, CAST("row" // 8 AS INTEGER) AS tile_y, CAST(CAST(t - INTERVAL 400 MINUTE AS DATE) AS VARCHAR) AS day, "row", col, arg_min(v, t) AS v FROM ({_DAYS}) GROUP BY ALL""")
def regrid_to_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tiles of observations, one for each cell and solar day at 100 degrees west."""
    t = F.timestamp_micros(F.unix_micros(F.col("o_orderdate").cast("timestamp")) + F.col("o_orderkey"))
    cells = V.table(spark, sf_dir, "orders").select(
        (F.col("o_custkey") % 50).cast("int").alias("row"), F.expr("cast(o_custkey div 50 as int)").alias("col"), t.alias("t"), F.when(F.col("o_orderkey") % 5 != 0, F.col("o_totalprice")).alias("v")
    )
    return cube.regrid_to_tiles(cells, ["v"], 8, lon=F.lit(-100.0)).withColumn("day", F.date_format("day", "yyyy-MM-dd"))


@registered("""SELECT c."row", c.col, t.elevation FROM (SELECT DISTINCT "row", col FROM obs) c
  LEFT JOIN terrain t ON t."row" = CAST(floor((60 - (60 - (c."row" + 0.5) * 0.75)) / 1.0) AS INTEGER) AND t.col = CAST(floor((c.col + 0.5) * 0.75 + 2 - 0.0) AS INTEGER)""")
def resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Elevation on a finer grid that lies elsewhere."""
    place = lambda r, c: F.struct(((c + 0.5) * 0.75 + 2).alias("x"), (60 - (r + 0.5) * 0.75).alias("y"))
    source = V.terrain(spark, sf_dir).select("row", "col", "elevation")
    return cube.resample(V.obs(spark, sf_dir).select("row", "col").distinct(), source, place, 0.0, V.Y0, 1.0)


def _equal_area_sql() -> str:
    e, pole, radius, b0, d = G._equal_area(23.0, 6378137.0, 1 / 298.257223563)
    s = "sin(radians(14 + c_custkey % 190 / 10.0))"
    beta = f"asin({1 - e * e!r} * ({s} / (1 - {e * e!r} * {s} * {s}) - ln((1 - {e!r} * {s}) / (1 + {e!r} * {s})) / {2 * e!r}) / {pole!r})"
    b = f"{radius!r} * sqrt(2 / (1 + {math.sin(b0)!r} * sin(beta) + {math.cos(b0)!r} * cos(beta) * cos(lam)))"
    return f"""SELECT id, round({b} * {d!r} * cos(beta) * sin(lam), 2) AS x, round({b} / {d!r} * ({math.cos(b0)!r} * sin(beta) - {math.sin(b0)!r} * cos(beta) * cos(lam)), 2) AS y, round(lon, 6) AS lon, round(lat, 6) AS lat
  FROM (SELECT c_custkey AS id, {beta} AS beta, radians(c_custkey % 300 / 10.0 - 117 + 102) AS lam, c_custkey % 300 / 10.0 - 117 AS lon, 14 + c_custkey % 190 / 10.0 AS lat FROM customer)"""


@registered(_equal_area_sql())
def reproject_equal_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Longitudes and latitudes in the azimuthal equal-area projection, and back."""
    c = V.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), G.lambert_equal_area(F.col("c_custkey") % 300 / 10.0 - 117, F.col("c_custkey") % 190 / 10.0 + 14, 23.0, -102.0).alias("p"))
    back = G.lambert_equal_area_inverse(F.col("p.x"), F.col("p.y"), 23.0, -102.0)
    return c.select("id", F.round("p.x", 2).alias("x"), F.round("p.y", 2).alias("y"), F.round(back["x"], 6).alias("lon"), F.round(back["y"], 6).alias("lat"))


@registered("SELECT l_orderkey, l_linenumber FROM lineitem, (SELECT avg(l_extendedprice) AS m, stddev_pop(l_extendedprice) AS s FROM lineitem) WHERE l_extendedprice > m - 1.5 * s AND l_extendedprice < m + 1.5 * s")
def clip_tails(spark: SparkSession, sf_dir: str) -> DataFrame:
    return change.clip_tails(V.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice"), "l_extendedprice", 1.5).select("l_orderkey", "l_linenumber")


@registered('SELECT "row", col, count(*) AS n, count(m) AS clear, CAST(sum(m) AS BIGINT) AS red FROM (SELECT "row", col, CASE WHEN qa & 2 = 2 THEN red END AS m FROM obs) GROUP BY ALL')
def apply_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    clear = raster.apply_mask(V.obs(spark, sf_dir).select("row", "col", "qa", "red"), raster.qa_bitmask(F.col("qa"), clear=True), ["red"])
    return clear.groupBy("row", "col").agg(F.count(F.lit(1)).alias("n"), F.count("red").alias("clear"), F.sum("red").alias("red"))


@registered('SELECT "row", col, t.elevation AS pre_v, o.v AS post_v FROM terrain t JOIN (SELECT "row", col, max(qa) AS v FROM obs GROUP BY ALL) o USING ("row", col)')
def pair_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    post = V.obs(spark, sf_dir).groupBy("row", "col").agg(F.max("qa").alias("v"))
    return workflows.pair_dates(V.terrain(spark, sf_dir).select("row", "col", F.col("elevation").alias("v")), post)


@registered("SELECT CASE WHEN value < 20 THEN 'failed' ELSE 'succeeded' END AS status, count(*) AS n FROM events GROUP BY ALL")
def tile_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return workflows.tile_report(V.table(spark, sf_dir, "events"), F.col("value") < 20)


@registered("SELECT o_orderkey AS id, o_custkey AS key, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey")
def add_column_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = V.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("key"))
    return workflows.add_column_by_key(o, V.table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "key"), "key", "c_mktsegment")


@registered("SELECT round(avg(CASE WHEN truth = pred THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM valid")
def score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(models.score(V.valid(spark, sf_dir).withColumnRenamed("pred", "prediction"), "truth"), 6)


@registered("SELECT '/data/' || p_partkey || '/slope_mosaic.tif' AS path FROM part WHERE p_size % 7 <> 0")
def matching_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.matching_paths(_files(spark, sf_dir), "slope").select("path")


@registered(f"SELECT id FROM {_C} WHERE x >= 200 AND x + 15 <= 700 AND y >= 100 AND y + 15 <= 600")
def within_box(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objects whose bounding box lies in a box."""
    outer = F.struct(*[F.lit(float(v)).alias(k) for k, v in {"xmin": 200, "ymin": 100, "xmax": 700, "ymax": 600}.items()])
    return V.suppliers_as_rectangles(spark, sf_dir)[1].where(G.bbox_contained(G.geom_bbox(F.col("geom")), outer)).select("id")


@registered(f"""SELECT name, x AS xmin, y AS ymin FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY x, y) AS k FROM (SELECT printf('%03d%03d', nation, id % 7) AS name, x, y FROM {_C} c WHERE EXISTS (SELECT 1 FROM {_S} s WHERE {_MEETS.format(w=15)}))) WHERE k = 1""")
def ingest_footprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Squares that meet a country, one for each path and row."""
    nations = V.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("path"))
    squares = V.suppliers_as_rectangles(spark, sf_dir)[1].join(nations, "id").select("path", (F.col("id") % 7).alias("row"), "geom")
    kept, _ = vectors.ingest_footprints(squares, _triangles(spark, sf_dir).select("geom"), 50.0)
    b = G.geom_bbox(F.col("geom"))
    return kept.select("name", b["xmin"].alias("xmin"), b["ymin"].alias("ymin"))


@registered("SELECT row_number() OVER (ORDER BY c_custkey) - 1 AS id, CAST(c_nationkey AS BIGINT) AS code, 'second' AS valid_set FROM customer")
def ingest_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objects in order with the code of their tag; one code has its tag already."""
    c = V.suppliers_as_rectangles(spark, sf_dir)[1].join(V.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), "c_nationkey"), "id")
    tags = spark.createDataFrame([(7, "own", 3), (9, "other", 4)], "tag long, scheme string, code long")
    _, classes, tags = vectors.ingest_validation(c.select(F.col("id").alias("key"), "c_nationkey", "geom", F.lit("/a/valid.shp").alias("path")), "key", "c_nationkey", "own", "second", 2017, tags)
    return classes.join(tags.where("scheme = 'own'"), "tag").select("id", "code", "valid_set")


#: SQL of queries that are registered elsewhere: least cost over the tried numbers of bins, and the entropy threshold, both over a histogram.
_SHIMAZAKI = """, v AS (SELECT l_quantity AS v, count(*) AS c FROM lineitem GROUP BY ALL), f AS (SELECT min(v) AS lo, max(v) AS hi, sum(c) AS n FROM v),
  h AS (SELECT bins, least(floor((v - lo) * bins / (hi - lo)), bins - 1) AS at, any_value(lo) AS lo, any_value(hi) AS hi, any_value(n) AS n, sum(c) AS c FROM v, f, (SELECT 100 + 10 * i AS bins FROM range(0, 290) r(i)) GROUP BY ALL),
  k AS (SELECT bins, (2 * any_value(n) / bins - (sum(c * c) / bins - pow(any_value(n) / bins, 2))) / pow((any_value(hi) - any_value(lo)) / bins, 2) AS cost FROM h GROUP BY bins)
  SELECT CAST(bins AS BIGINT) AS bins FROM k ORDER BY cost, bins LIMIT 1"""
_KAPUR = """, d AS (SELECT cell, sqrt(pow(pre1 - post1, 2) + pow(pre2 - post2, 2) + pow(pre3 - post3, 2)) AS d FROM pair), m AS (SELECT avg(d) AS m, stddev_pop(d) AS s FROM d),
  c AS (SELECT d FROM d, m WHERE d > m - 3 * s AND d < m + 3 * s), f AS (SELECT min(d) AS lo, (max(d) - min(d)) / 100.0::DOUBLE AS w FROM c),
  h AS (SELECT least(floor((d - lo) / w), 99) AS b FROM c, f), n AS (SELECT b, count(*) AS n FROM h GROUP BY b),
  k AS (SELECT b, n, n / sum(n) OVER () AS p FROM n WHERE b >= (SELECT b FROM n ORDER BY n DESC, b LIMIT 1)),
  q AS (SELECT b, sum(p) OVER (ORDER BY b) AS s, sum(p * ln(p)) OVER (ORDER BY b) AS e, sum(p * ln(p)) OVER () AS every, row_number() OVER (ORDER BY b) AS i, count(*) OVER () AS k FROM k),
  r AS (SELECT *, 1 - lead(s) OVER (ORDER BY b) AS rest, every - lead(e) OVER (ORDER BY b) AS rest_e FROM q),
  t AS (SELECT lo + (b + 1) * w AS cut FROM r, f WHERE i <= k - 2 ORDER BY ln(s) - e / s + ln(rest) - rest_e / rest DESC, i LIMIT 1)
  SELECT cell, d > cut AS changed FROM d, t"""
for _name, _sql in {"optimal_bins_shimazaki": _SHIMAZAKI, "kapur_threshold": _KAPUR}.items():
    assert _name in QUERIES
    SQL[_name] = V.with_views(_sql)
