"""The registered queries of the land-cover operators, each beside its SQL."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landweave.functions import catalog as FC
from landweave.functions import geometry as G
from landweave.functions import raster as R
from landweave.operators import accuracy, change, cube, models, regions, scenes, segments, spatial
from landweave.plans import views as V

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def registered(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = V.with_views(sql)
        return f

    return add


def rounded(df: DataFrame, places: int = 4) -> DataFrame:
    return df.select(*[F.round(c, places).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def _recipe_sql(bands: Sequence[str], mask: str, indices: dict[str, tuple[str, str]], plan: dict[str, Sequence[str]], nodata: int, terrain: bool) -> str:
    f = {"mean": "avg", "min": "min", "max": "max", "std": "stddev_pop"}
    clean = ", ".join(f"CASE WHEN {mask} AND {b} <> {nodata} THEN CAST({b} AS DOUBLE) END AS {b}" for b in bands)
    index = "".join(f", ({a} - {b}) / nullif({a} + {b}, 0) * 10000.0 AS {n}" for n, (a, b) in indices.items())
    out = ", ".join(f"CAST(trunc(round(coalesce({f[s]}({b}), {nodata}), 9)) AS SMALLINT) AS {b}_{s}" for b, stats in plan.items() for s in stats)
    made = f'SELECT "row", col, {out} FROM (SELECT *{index} FROM (SELECT "row", col, {clean} FROM obs)) GROUP BY "row", col'
    return f'SELECT * FROM ({made}) FULL JOIN terrain USING ("row", col)' if terrain else made


_LANDSAT = _recipe_sql(cube.LANDSAT, "qa & 56 = 0", {"ndvi": ("nir", "red")}, {b: ("mean", "min", "max", "std") for b in (*cube.LANDSAT, "ndvi")}, -9999, True)
_TWO = {"ndvi": ("nir", "red"), "ndmi": ("nir", "swir1")}
_TWO_PLAN = {i: ("mean", "min", "max") for i in _TWO}


@registered(_recipe_sql(("nir", "red"), "qa & 2 = 2", {"ndvi": ("nir", "red")}, {"ndvi": ("mean",)}, -9999, False))
def recipe_ndvi_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cube.run_recipe("ndvi_mean", V.obs(spark, sf_dir))


@registered(_LANDSAT)
def recipe_landsat_001(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cube.run_recipe("landsat_001", V.obs(spark, sf_dir), terrain=V.terrain(spark, sf_dir))


@registered(_recipe_sql(cube.LANDSAT, "qa & 56 = 0", _TWO, {b: ("mean",) for b in cube.LANDSAT} | _TWO_PLAN, -9999, True))
def recipe_landsat_002(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cube.run_recipe("landsat_002", V.obs(spark, sf_dir), terrain=V.terrain(spark, sf_dir))


@registered(_recipe_sql(cube.SENTINEL, "qa IN (2, 4, 5, 6, 7, 8, 11)", _TWO, {b: ("mean",) for b in cube.SENTINEL} | _TWO_PLAN, 0, True))
def recipe_s2_001(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cube.run_recipe("s2_001", V.obs(spark, sf_dir), terrain=V.terrain(spark, sf_dir))


@registered('SELECT "row", col, round(avg(red), 4) AS red_mean, min(red) AS red_min, max(red) AS red_max, round(stddev_pop(red), 4) AS red_std, round(avg(nir), 4) AS nir_mean FROM obs GROUP BY "row", col')
def temporal_reduce(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(cube.temporal_reduce(V.obs(spark, sf_dir), {"red": ("mean", "min", "max", "std"), "nir": ("mean",)}))


@registered("""SELECT c."row", c.col, t.elevation, t.slope FROM (SELECT DISTINCT "row", col FROM obs) c
  LEFT JOIN terrain t ON t."row" = CAST(floor((c."row" + 0.5) * 0.5) AS INTEGER) AND t.col = CAST(floor((c.col + 0.5) * 0.5) AS INTEGER)""")
def load_like(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cube.load_like(V.obs(spark, sf_dir).select("row", "col").distinct(), V.terrain(spark, sf_dir), 0.5)


@registered("""SELECT 'obs' AS name, CAST(tr * ceil(n_cols / 16.0) + tc AS BIGINT) AS tile, CAST(least(16, n_rows - tr * 16) AS BIGINT) AS rows, CAST(least(16, n_cols - tc * 16) AS BIGINT) AS cols,
  CAST(tc * 16 AS DOUBLE) AS x, CAST(n_rows - tr * 16 AS DOUBLE) AS y
  FROM (SELECT max("row") + 1 AS n_rows, max(col) + 1 AS n_cols FROM obs) e, range(0, 100000) a(tr), range(0, 100) b(tc) WHERE tr * 16 < n_rows AND tc * 16 < n_cols""")
def tile_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = V.obs(spark, sf_dir).agg(F.lit("obs").alias("name"), F.lit(0.0).alias("xmin"), F.lit(0.0).alias("ymin"), (F.max("col") + 1).cast("double").alias("xmax"), (F.max("row") + 1).cast("double").alias("ymax"))
    return cube.tile_grid(e, 1.0, 16)


@registered("""SELECT "row" // 8 AS ty, col // 8 AS tx, count(*) AS n FROM obs WHERE t BETWEEN TIMESTAMP '1995-01-01' AND TIMESTAMP '1997-12-31' AND (col // 8) * 8 <= 20 AND (col // 8) * 8 + 8 >= 10 AND ("row" // 8) * 8 <= 30 AND ("row" // 8) * 8 + 8 >= 5 GROUP BY ALL""")
def query_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = V.obs(spark, sf_dir).select("t", F.floor(F.col("row") / 8).cast("int").alias("ty"), F.floor(F.col("col") / 8).cast("int").alias("tx"))
    tiles = o.withColumns({"xmin": F.col("tx") * 8, "xmax": F.col("tx") * 8 + 8, "ymin": F.col("ty") * 8, "ymax": F.col("ty") * 8 + 8})
    found = cube.query_tiles(tiles, box=(10, 5, 20, 30), begin=F.lit("1995-01-01").cast("timestamp"), end=F.lit("1997-12-31").cast("timestamp"))
    return found.groupBy("ty", "tx").agg(F.count(F.lit(1)).alias("n"))


def _zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spatial.rasterize_features(V.polygons(spark, sf_dir), 0.0, V.Y0, 1.0)


@registered('SELECT z."row", z.col, z.feature_id, count(*) AS n_obs FROM zones z JOIN obs o ON z."row" = o."row" AND z.col = o.col GROUP BY ALL')
def rasterize_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = V.obs(spark, sf_dir).groupBy("row", "col").agg(F.count(F.lit(1)).alias("n_obs"))
    return _zones(spark, sf_dir).join(o, ["row", "col"])


@registered('SELECT o."row", o.col, coalesce(z.feature_id, 0) AS feature_id FROM (SELECT DISTINCT "row", col FROM obs) o LEFT JOIN zones z ON z."row" = o."row" AND z.col = o.col')
def country_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spatial.rasterize_values(V.polygons(spark, sf_dir), V.obs(spark, sf_dir).select("row", "col").distinct(), 0.0, V.Y0, 1.0)


def _zonal(statistic: str, sql: str) -> None:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        cells = V.obs(spark, sf_dir).groupBy("row", "col").agg(F.avg("red").alias("red"), F.avg("nir").alias("nir"))
        return rounded(spatial.zonal_stats(_zones(spark, sf_dir), cells, ["red", "nir"], statistic))

    query.__name__ = f"zonal_stats_{statistic}"
    made = ", ".join(f"round({sql.format(b)}, 4) AS {b}" for b in ("red", "nir"))
    registered(f'SELECT feature_id, {made} FROM zones JOIN (SELECT "row", col, avg(red) AS red, avg(nir) AS nir FROM obs GROUP BY "row", col) c USING ("row", col) GROUP BY feature_id')(query)


for _name, _sql in {"mean": "avg({0})", "median": "median({0})", "std": "stddev_samp({0})", "min": "min({0})", "max": "max({0})", "first": "arg_min({0}, col * 100000 + \"row\")"}.items():
    _zonal(_name, _sql)


@registered("""SELECT feature_id, round(avg(red), 4) AS red, arg_min(cover, col * 100000 + "row") AS cover FROM zones JOIN (
  SELECT "row", col, avg(red) AS red, CAST(max(qa) AS INTEGER) AS cover FROM obs GROUP BY "row", col) USING ("row", col) GROUP BY feature_id""")
def zonal_stats_categorical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mean of a measured band, the first value of a categorical one."""
    cells = V.obs(spark, sf_dir).groupBy("row", "col").agg(F.avg("red").alias("red"), F.max("qa").cast("int").alias("cover"))
    return rounded(spatial.zonal_stats(_zones(spark, sf_dir), cells, ["red", "cover"], "mean", categorical=["cover"]))


@registered("SELECT feature_id, " + ", ".join(f"round({f}(red), 4) AS red_{n}" for n, f in {"mean": "avg", "maximum": "max", "median": "median", "minimum": "min", "standard_deviation": "stddev_pop", "variance": "var_pop", "sum": "sum"}.items()) + ' FROM zones JOIN (SELECT "row", col, CAST(red AS DOUBLE) AS red FROM obs) o USING ("row", col) GROUP BY feature_id')
def zonal_statistics_multi(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = V.obs(spark, sf_dir).select("row", "col", F.col("red").cast("double").alias("red"))
    return rounded(spatial.zonal_statistics_multi(_zones(spark, sf_dir), cells, ["red"], ["mean", "maximum", "median", "minimum", "standard_deviation", "variance", "sum"]))


@registered('SELECT region, ' + ", ".join(f"{'round(' * (s in ('mean', 'std'))}{f}({b}){', 4)' * (s in ('mean', 'std'))} AS b{i}_{s}" for i, b in enumerate(("red", "nir"), 1) for s, f in {"max": "max", "min": "min", "mean": "avg", "std": "stddev_pop"}.items()) + ' FROM (SELECT "row" // 10 AS region, red, nir FROM obs) GROUP BY region')
def region_band_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = V.obs(spark, sf_dir).select(F.floor(F.col("row") / 10).cast("int").alias("region"), "red", "nir")
    return rounded(spatial.region_band_stats(cells, ["red", "nir"], "region"))


@registered("SELECT name, CAST(year(acquired) AS INTEGER) AS year, count(*) AS n FROM scenes WHERE cloud_cover_land < 20 AND starts_with(product, 'LE07') GROUP BY ALL")
def scene_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scenes.scene_counts(V.scenes(spark, sf_dir), "LE07")


@registered("""SELECT f.name, coalesce((SELECT string_agg(y || '=' || n, ',' ORDER BY y) FROM (SELECT CAST(year(acquired) AS INTEGER) AS y, count(*) AS n FROM scenes s WHERE s.name = f.name AND cloud_cover_land < 20 AND starts_with(product, 'LE07') GROUP BY ALL)), '') AS years,
  (SELECT CAST(min(year(acquired)) AS INTEGER) FROM scenes WHERE cloud_cover_land < 20 AND starts_with(product, 'LE07')) AS min_year, (SELECT CAST(max(year(acquired)) AS INTEGER) FROM scenes WHERE cloud_cover_land < 20 AND starts_with(product, 'LE07')) AS max_year FROM footprints f""")
def catalog_by_footprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scenes.catalog_by_footprint(V.scenes(spark, sf_dir), V.footprints(spark, sf_dir), "LE07")
    text = F.array_join(F.transform(F.sort_array(F.map_entries("years")), lambda e: F.concat_ws("=", e["key"].cast("string"), e["value"].cast("string"))), ",")
    return out.select("name", text.alias("years"), "min_year", "max_year")


def _score_sql(each: str, total: str) -> str:
    failed = "mission = 7 AND acquired >= TIMESTAMP '2003-05-31'"
    return f"""SELECT name, year, score, min(score) OVER (PARTITION BY name) AS min_score FROM (
  SELECT f.name, CAST(y AS INTEGER) AS year, round(coalesce(score, 0), 2) AS score FROM footprints f CROSS JOIN range(1990, 2018) r(y) LEFT JOIN (
    SELECT name, yy, sum({total}) AS score FROM (
      SELECT name, year(acquired) AS yy, mission, sum({each.format(failed=failed)}) AS v, count(*) AS n FROM (
        SELECT *, CASE product WHEN 'LT05' THEN 5 WHEN 'LE07' THEN 7 ELSE 8 END AS mission, cloud_cover_land / 100 AS c FROM scenes WHERE cloud_cover < 100) GROUP BY ALL) GROUP BY ALL) s ON s.name = f.name AND s.yy = r.y)"""


@registered(_score_sql("ln(CASE WHEN {failed} THEN 0.5 + c - 0.5 * c ELSE c END + 1e-6)", "(1 - exp(v)) * n"))
def quality_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scenes.quality_score(V.scenes(spark, sf_dir), V.footprints(spark, sf_dir))


@registered(_score_sql("CASE WHEN {failed} THEN 0.5 * (1 - c) ELSE 1 - c END", "v"))
def area_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scenes.area_sum(V.scenes(spark, sf_dir), V.footprints(spark, sf_dir))


@registered("SELECT name, " + ", ".join(f"max(score) FILTER (WHERE year = {y}) AS y{y}" for y in range(1992, 1999)) + " FROM (" + _score_sql("CASE WHEN {failed} THEN 0.5 * (1 - c) ELSE 1 - c END", "v") + ") GROUP BY name")
def score_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scenes.score_matrix(scenes.area_sum(V.scenes(spark, sf_dir), V.footprints(spark, sf_dir)), range(1992, 1999))


_LABELS = "(SELECT truth AS label FROM valid UNION SELECT pred FROM valid)"
_MATRIX = f"SELECT t.label AS truth, p.label AS pred, CAST(coalesce(sum(v.weight), 0) AS BIGINT) AS weight FROM {_LABELS} t CROSS JOIN {_LABELS} p LEFT JOIN valid v ON v.truth = t.label AND v.pred = p.label GROUP BY ALL"


@registered(_MATRIX)
def confusion_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return accuracy.confusion_matrix(V.valid(spark, sf_dir))


@registered(f"""SELECT label, round(coalesce(tp / nullif(of_truth, 0), 0), 4) AS producers, round(coalesce(tp / nullif(of_pred, 0), 0), 4) AS users, round(o.overall, 4) AS overall FROM (
  SELECT l.label, (SELECT coalesce(sum(weight), 0)::DOUBLE FROM valid WHERE truth = l.label AND pred = l.label) AS tp, (SELECT coalesce(sum(weight), 0)::DOUBLE FROM valid WHERE truth = l.label) AS of_truth, (SELECT coalesce(sum(weight), 0)::DOUBLE FROM valid WHERE pred = l.label) AS of_pred FROM {_LABELS} l)
  CROSS JOIN (SELECT sum(weight) FILTER (WHERE truth = pred)::DOUBLE / sum(weight) AS overall FROM valid) o""")
def accuracy_by_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(accuracy.accuracy(accuracy.confusion_matrix(V.valid(spark, sf_dir))))


@registered("""SELECT s_suppkey AS id, 1600.0 AS area, 160.0 AS perimeter, round(160.0 / 1600.0, 4) AS para, round(1600.0 * 160.0 / sqrt(1600.0), 4) AS compact, round(1600.0 * 160.0 / 160.0, 4) AS smooth,
  round(4 * pi() * 1600.0 / (160.0 * 160.0), 4) AS shape, round(2 * ln(40.0) / ln(1600.0), 4) AS frac, CAST(s_suppkey * 37 % 1000 AS DOUBLE) AS xmin, CAST(CAST(floor(abs(s_acctbal)) AS BIGINT) % 1000 AS DOUBLE) AS ymin FROM supplier""")
def polygon_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = F.col("geom")
    rows = V.suppliers_as_rectangles(spark, sf_dir)[0].select("id", G.polygon_area(g).alias("area"), G.polygon_perimeter(g).alias("perimeter"), G.bbox_perimeter(g).alias("box"), G.geom_bbox(g).alias("b"))
    metrics = G.shape_metrics(F.col("area"), F.col("perimeter"), F.col("box"))
    return rounded(rows.select("id", "area", "perimeter", *[c.alias(n) for n, c in metrics.items()], F.col("b.xmin").alias("xmin"), F.col("b.ymin").alias("ymin")))


@registered("""SELECT l.id AS l_id, r.id AS r_id, (least(l.x + 40, r.x + 15) - greatest(l.x, r.x)) * (least(l.y + 40, r.y + 15) - greatest(l.y, r.y)) AS weight
  FROM (SELECT s_suppkey AS id, CAST(s_suppkey * 37 % 1000 AS DOUBLE) AS x, CAST(CAST(floor(abs(s_acctbal)) AS BIGINT) % 1000 AS DOUBLE) AS y FROM supplier) l
  JOIN (SELECT c_custkey AS id, CAST(c_custkey * 37 % 1000 AS DOUBLE) AS x, CAST(CAST(floor(abs(c_acctbal)) AS BIGINT) % 1000 AS DOUBLE) AS y FROM customer) r
  ON l.x < r.x + 15 AND r.x < l.x + 40 AND l.y < r.y + 15 AND r.y < l.y + 40""")
def polygon_intersection_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = V.suppliers_as_rectangles(spark, sf_dir)
    return spatial.box_overlap_area(a, b, 50.0).select("l_id", "r_id", "weight")


@registered("""SELECT s_suppkey AS id, first AS match, round(1 - common / 1600, 3) AS underseg, round(1 - common / 225, 3) AS overseg FROM supplier LEFT JOIN (SELECT l_id AS s_suppkey, min(r_id) AS first, arg_min(weight, r_id) AS common FROM (
  SELECT l.id AS l_id, r.id AS r_id, (least(l.x + 40, r.x + 15) - greatest(l.x, r.x)) * (least(l.y + 40, r.y + 15) - greatest(l.y, r.y)) AS weight, ((l.x + 20 > r.x AND l.x + 20 < r.x + 15 AND l.y + 20 > r.y AND l.y + 20 < r.y + 15) OR (r.x + 7.5 > l.x AND r.x + 7.5 < l.x + 40 AND r.y + 7.5 > l.y AND r.y + 7.5 < l.y + 40)) AS centre
  FROM (SELECT s_suppkey AS id, CAST(s_suppkey * 37 % 1000 AS DOUBLE) AS x, CAST(CAST(floor(abs(s_acctbal)) AS BIGINT) % 1000 AS DOUBLE) AS y FROM supplier) l
  JOIN (SELECT c_custkey AS id, CAST(c_custkey * 37 % 1000 AS DOUBLE) AS x, CAST(CAST(floor(abs(c_acctbal)) AS BIGINT) % 1000 AS DOUBLE) AS y FROM customer) r
  ON l.x < r.x + 15 AND r.x < l.x + 40 AND l.y < r.y + 15 AND r.y < l.y + 40) WHERE weight > 0.5 * 225 OR centre GROUP BY l_id) USING (s_suppkey)""")
def match_first_relevant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every supplier's rectangle with its first relevant one of a customer, or nulls."""
    a, b = V.suppliers_as_rectangles(spark, sf_dir)
    found = spatial.match_first_relevant(a, b, 50.0)
    return found.select("id", F.col("r_id").alias("match"), "underseg", "overseg")


_LO_HI = "(SELECT CAST(min(l_quantity) AS DOUBLE) AS lo, CAST(max(l_quantity) AS DOUBLE) AS hi FROM lineitem)"


@registered(f"""SELECT CAST(b AS INTEGER) AS bin, coalesce(n, 0) AS n, round(lo + b * ((hi - lo) / 20.0), 4) AS low, round(lo + (b + 1) * ((hi - lo) / 20.0), 4) AS high FROM {_LO_HI} CROSS JOIN range(0, 20) r(b)
  LEFT JOIN (SELECT least(CAST(floor((l_quantity - lo) / ((hi - lo) / 20.0)) AS BIGINT), 19) AS k, count(*) AS n FROM lineitem, {_LO_HI} GROUP BY ALL) ON k = b""")
def histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(change.histogram(V.table(spark, sf_dir, "lineitem").select("l_quantity"), "l_quantity", 20))


@registered("SELECT CAST(ceil(log2(count(*))) + 1 AS BIGINT) AS bins FROM lineitem")
def optimal_bins_sturges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return change.optimal_bins(V.table(spark, sf_dir, "lineitem"), "l_quantity", "sturges")


@registered("SELECT CAST(ceil((max(l_quantity) - min(l_quantity)) / (3.59 * stddev_pop(l_quantity) * pow(count(*), -1.0 / 3))) AS BIGINT) AS bins FROM lineitem")
def optimal_bins_scott(spark: SparkSession, sf_dir: str) -> DataFrame:
    return change.optimal_bins(V.table(spark, sf_dir, "lineitem"), "l_quantity", "scott")


@registered("SELECT CAST(ceil((max(l_quantity) - min(l_quantity)) / (2 * (quantile_cont(l_quantity, 0.75) - quantile_cont(l_quantity, 0.25)) * pow(count(*), -1.0 / 3))) AS BIGINT) AS bins FROM lineitem")
def optimal_bins_freedman(spark: SparkSession, sf_dir: str) -> DataFrame:
    return change.optimal_bins(V.table(spark, sf_dir, "lineitem"), "l_quantity", "freedman")


@registered()
def optimal_bins_shimazaki(spark: SparkSession, sf_dir: str) -> DataFrame:
    return change.optimal_bins(V.table(spark, sf_dir, "lineitem"), "l_quantity", "shimazaki")


@registered("SELECT value, n, round(sum(n) OVER (ORDER BY value) / sum(n) OVER (), 6) AS share FROM (SELECT l_quantity AS value, count(*) AS n FROM lineitem GROUP BY ALL)")
def ecdf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(change.ecdf(V.table(spark, sf_dir, "lineitem"), "l_quantity"), 6)


_ECDF = "SELECT value, sum(n) OVER (ORDER BY value) / sum(n) OVER () AS share FROM (SELECT {0} AS value, count(*) AS n FROM obs GROUP BY ALL)"


@registered(f""", s AS ({_ECDF.format("red")}), t AS ({_ECDF.format("nir")}) SELECT s.value, round(CASE WHEN lo.value IS NULL THEN hi.value WHEN hi.value IS NULL OR lo.share = hi.share THEN lo.value
  ELSE lo.value + (s.share - lo.share) / (hi.share - lo.share) * (hi.value - lo.value) END, 4) AS matched FROM s ASOF LEFT JOIN t lo ON s.share >= lo.share ASOF LEFT JOIN t hi ON s.share <= hi.share""")
def hist_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = V.obs(spark, sf_dir)
    return rounded(change.hist_match(o.select(F.col("red").alias("v")), o.select(F.col("nir").alias("v")), "v"))


@registered("SELECT cell, round(sqrt(pow(pre1 - post1, 2) + pow(pre2 - post2, 2) + pow(pre3 - post3, 2)), 4) AS distance FROM pair")
def change_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(change.change_distance(V.pair(spark, sf_dir), _PRE, _POST).select("cell", "distance"))


_PRE, _POST = ("pre1", "pre2", "pre3"), ("post1", "post2", "post3")


@registered()
def kapur_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = change.change_distance(V.pair(spark, sf_dir), _PRE, _POST)
    return change.threshold_change("kapur", d, "distance", bins=100).select("cell", "changed")


@registered()
def change_imadmaf(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = change.imadmaf(regions.written(V.pair(spark, sf_dir), "pair"), _PRE, _POST, rounds=25, min_delta=0.01, bins=100)
    return rounded(found.select("cell", "f1", "f2", "f3", "changed"))


@registered()
def elliptic_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return change.threshold_change("elliptic", V.pair(spark, sf_dir), ("pre1", "post1")).select("cell", "changed")


_LINKS = 'SELECT a.cell AS a, b.cell AS b FROM {0} a JOIN {0} b ON a.code = b.code AND abs(a."row" - b."row") + abs(a.col - b.col) = 1'
_REACH = "r AS (SELECT cell, cell AS root FROM {0} UNION SELECT l.b, r.root FROM r JOIN l ON l.a = r.cell AND r.root < l.b)"


@registered(", l AS (" + _LINKS.format("pair") + "), " + _REACH.format("pair") + " SELECT cell, min(root) AS region FROM r GROUP BY cell")
def connected_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return regions.connected_regions(V.pair(spark, sf_dir).select("cell", "row", "col", "code"), "code").select("cell", "region")


_CHANGED = 'SELECT cell, "row", col, 1 AS code FROM pair WHERE sqrt(pow(pre1 - post1, 2) + pow(pre2 - post2, 2) + pow(pre3 - post3, 2)) > 0.25'


@registered(f", c AS ({_CHANGED}), l AS (" + _LINKS.format("c") + "), " + _REACH.format("c") + ", g AS (SELECT cell, min(root) AS region FROM r GROUP BY cell) SELECT cell, region FROM g WHERE region IN (SELECT region FROM g GROUP BY region HAVING count(*) >= 4)")
def filter_mmu(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = change.change_distance(V.pair(spark, sf_dir), _PRE, _POST).where("distance > 0.25")
    return regions.filter_mmu(d.select("cell", "row", "col"), 4).select("cell", "region")


@registered(f""", c AS (SELECT k.cell, k."row", k.col, p.code AS pre, (p.code + p.cell // 3) % 10 AS post, p.code * 100 + (p.code + p.cell // 3) % 10 AS code FROM ({_CHANGED}) k JOIN pair p ON p.cell = k.cell),
  l AS ({_LINKS.format("c")}), {_REACH.format("c")} SELECT cell, CAST(any_value(c.pre) AS INTEGER) AS pre, CAST(any_value(c.post) AS INTEGER) AS post, min(root) AS region FROM r JOIN c USING (cell) WHERE c.pre <> c.post GROUP BY cell""")
def label_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = V.pair(spark, sf_dir)
    changed = change.change_distance(p, _PRE, _POST).where("distance > 0.25").select("cell", "row", "col")
    after = p.select("row", "col", F.expr("cast((code + cell div 3) % 10 as int)").alias("code"))
    return regions.filter_no_change(regions.label_change(changed, p.select("row", "col", "code"), after)).select("cell", "pre", "post", "region")


@registered("""SELECT o_orderkey AS id, CAST(o_custkey AS DOUBLE) AS xmin, floor(o_totalprice) AS ymin, lower(printf('%02x', o_orderkey % 256)) AS hex, CAST(o_orderkey % 256 AS INTEGER) AS red FROM orders""")
def parse_box(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = V.table(spark, sf_dir, "orders")
    box = G.parse_box(F.concat(F.lit("BOX("), F.col("o_custkey").cast("string"), F.lit(" "), F.floor("o_totalprice").cast("string"), F.lit(",1 2)")))
    code = F.lpad(F.lower(F.hex(F.col("o_orderkey") % 256)), 2, "0")
    return o.select(F.col("o_orderkey").alias("id"), box["xmin"].alias("xmin"), box["ymin"].alias("ymin"), code.alias("hex"), F.get(FC.hex_to_rgba(F.concat(F.lit("#"), code, F.lit("0000"))), F.lit(0)).alias("red"))


@registered("SELECT p_partkey AS id, round(p_partkey % 1024 / 1024.0 * 360 - 180, 6) AS lon, round(degrees(atan(sinh(pi() * (1 - 2 * (p_size % 1024) / 1024.0)))), 6) AS lat FROM part")
def tile_corner_lonlat(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = G.tile_corner_lonlat(F.lit(10), F.col("p_partkey") % 1024, F.col("p_size") % 1024)
    return V.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.round(p["lon"], 6).alias("lon"), F.round(p["lat"], 6).alias("lat"))


@registered("SELECT event_id, pre, post, pre * 256 + post AS packed FROM (SELECT event_id, CAST(user_id % 256 AS INTEGER) AS pre, CAST(event_id % 256 AS INTEGER) AS post FROM events)")
def pack_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = V.table(spark, sf_dir, "events").select("event_id", R.pack_labels(F.col("user_id") % 256, F.col("event_id") % 256).alias("packed"))
    pre, post = R.unpack_labels(F.col("packed"))
    return packed.select("event_id", pre.alias("pre"), post.alias("post"), "packed")


_BANDS = ("pre1", "pre2", "pre3", "post1", "post2", "post3")


@registered()
def predict_pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A random forest of the cells' codes, applied to every cell."""
    p = V.pair(spark, sf_dir)
    return rounded(models.predict(models.fit_rf(p, _BANDS, "code"), p).select("cell", "code", "prediction", "confidence"), 6)


@registered()
def predict_leafwise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf-wise boosted trees of the cells' codes, applied to every cell."""
    p = V.pair(spark, sf_dir)
    return rounded(models.predict(models.fit_leafwise(p, _BANDS, "code", rounds=2, leaves=8, l1=0.1, l2=0.5), p).select("cell", "code", "prediction", "confidence"), 6)


@registered()
def predict_softmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boosted trees of three levels of the cells' codes, applied to every cell."""
    p = V.pair(spark, sf_dir)
    return rounded(models.predict(models.fit_softmax(p, _BANDS, "code", rounds=2, depth=3, gamma=0.1), p).select("cell", "code", "prediction", "confidence"), 6)


@registered()
def remove_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.remove_outliers(V.pair(spark, sf_dir), _BANDS, "code", "cell").select("cell", "code")


@registered("""SELECT code, CAST(floor(count(*) * 0.3) AS BIGINT) AS n FROM pair GROUP BY code""")
def sample_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.sample_exact(V.pair(spark, sf_dir).select("cell", "code"), 0.3, ["code"], "cell").groupBy("code").agg(F.count(F.lit(1)).alias("n"))


@registered()
def segment_slic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments.segment_slic(V.pair(spark, sf_dir).select("row", "col", "pre1", "pre2", "pre3"), ("pre1", "pre2", "pre3"), 5).select("row", "col", "segment")


@registered("""SELECT code, count(*) AS edges FROM (SELECT p.code, p."row", p.col, d.i, d.j FROM pair p CROSS JOIN (VALUES (0, 1), (0, -1), (1, 0), (-1, 0)) d(i, j)) s
  WHERE NOT EXISTS (SELECT 1 FROM pair q WHERE q.code = s.code AND q."row" = s."row" + s.i AND q.col = s.col + s.j) GROUP BY code""")
def region_outline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments.region_edges(V.pair(spark, sf_dir).select("row", "col", "code"), "code").groupBy("code").agg(F.count(F.lit(1)).alias("edges"))


_TAGS = "SELECT n_nationkey AS tag, CASE WHEN n_regionkey < 3 THEN 'old' ELSE 'new' END AS scheme, n_name AS value, CAST(n_nationkey * 7 AS INTEGER) AS code FROM nation"


def _tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = V.table(spark, sf_dir, "nation")
    scheme = F.when(F.col("n_regionkey") < 3, "old").otherwise("new")
    return n.select(F.col("n_nationkey").alias("tag"), scheme.alias("scheme"), F.col("n_name").alias("value"), (F.col("n_nationkey") * 7).cast("int").alias("code"))


@registered(f"SELECT c_custkey AS id, t.code FROM customer JOIN nation ON c_nationkey = n_nationkey LEFT JOIN ({_TAGS}) t ON t.scheme = 'old' AND t.value = n_name")
def encode_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The code of each object's label in a scheme."""
    n = V.table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("label"))
    rows = V.table(spark, sf_dir, "customer").join(n, F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("c_custkey").alias("id"), "label")
    return FC.encode_labels(rows, _tags(spark, sf_dir), "old").select("id", "code")


@registered(f"SELECT min(t.scheme) AS scheme FROM customer JOIN ({_TAGS}) t ON c_nationkey = t.tag WHERE c_mktsegment = 'BUILDING'")
def scheme_of_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    objects = V.table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("valid_set"), F.col("c_nationkey").alias("tag"))
    return FC.scheme_of_set(objects, _tags(spark, sf_dir), "BUILDING")
