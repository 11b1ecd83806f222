"""Views that give the given tables the shapes of a cube, terrain, scenes, an image pair and accuracy rows.

Each is written twice, for Spark and, in `SQL`, for DuckDB.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landweave.functions.geometry import reproject

#: Polygons over the cells of `obs`: seq, and rings of (x, y); a concave one, one with a hole, one across both.
POLYGONS: list[tuple[int, list[list[tuple[float, float]]]]] = [
    (1, [[(2, 58), (20, 58), (20, 50), (10, 50), (10, 30), (2, 30)]]),
    (2, [[(15, 45), (35, 45), (35, 25), (15, 25)], [(20, 40), (30, 40), (30, 30), (20, 30)]]),
    (3, [[(0, 60), (39, 40), (5, 15)]]),
]
Y0 = 60.0


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observations of cells: row, col, t, bands, qa."""
    price, quantity, lost = F.col("l_extendedprice"), F.col("l_quantity"), F.col("l_linenumber") == 7
    band = lambda c: F.when(lost, F.lit(-9999)).otherwise(c.cast("int"))
    red = F.floor(price / 10)
    bands = {
        "blue": F.floor(price / 20), "green": F.floor(price / 15), "red": red, "re1": F.floor(price / 12), "re2": F.floor(price / 11), "re3": F.floor(price / 13),
        "nir": red + F.floor(quantity * 100), "swir1": F.floor(quantity * 100), "swir2": F.floor(quantity * 50),
    }
    qa = F.when(F.col("l_returnflag") == "R", 32).when(F.col("l_returnflag") == "A", 8).otherwise(2)
    return table(spark, sf_dir, "lineitem").select(
        F.expr("cast(l_partkey div 40 as int)").alias("row"), (F.col("l_partkey") % 40).cast("int").alias("col"), F.col("l_shipdate").alias("t"), qa.alias("qa"), *[band(c).alias(b) for b, c in bands.items()]
    )


def terrain(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(F.expr("cast(p_partkey div 40 as int)").alias("row"), (F.col("p_partkey") % 40).cast("int").alias("col"), F.col("p_size").alias("elevation"), F.col("p_retailprice").alias("slope"))


def footprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(F.format_string("%03d%03d", "n_regionkey", "n_nationkey").alias("name"), F.col("n_nationkey").alias("footprint"))


def scenes(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, c = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    cloud = (F.floor("o_totalprice") % 100).cast("double")
    product = F.when(F.col("o_orderstatus") == "F", "LT05").when(F.col("o_orderstatus") == "O", "LE07").otherwise("LC08")
    rows = o.join(c, F.col("o_custkey") == F.col("c_custkey")).join(F.broadcast(footprints(spark, sf_dir)), F.col("c_nationkey") == F.col("footprint"))  # 25 nations
    return rows.select("name", F.col("o_orderdate").alias("acquired"), product.alias("product"), cloud.alias("cloud_cover"), cloud.alias("cloud_cover_land"))


def pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = lambda i: F.get("embedding", F.lit(i)).cast("double")
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("cell"), F.expr("cast(vec_id div 25 as int)").alias("row"), (F.col("vec_id") % 25).cast("int").alias("col"), F.col("label").alias("code"),
        *[e(i).alias(f"pre{i + 1}") for i in range(3)], *[e(i + 3).alias(f"post{i + 1}") for i in range(3)],
    )


def valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    return table(spark, sf_dir, "labels").join(docs, "doc_id").select(F.col("quality").alias("truth"), F.col("toxic").alias("pred"), F.col("n_chars").alias("weight"))


def polygons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The polygons once for each 60 rows of the grid of parts: as many as the table asks for."""
    blocks = table(spark, sf_dir, "part").select(F.expr("p_partkey div 2400").alias("k")).distinct()
    rows = [(seq, seq * 10, [[[{"x": float(x), "y": float(y)} for x, y in ring] for ring in rings]]) for seq, rings in POLYGONS]
    fixed = F.broadcast(spark.createDataFrame(rows, "seq int, feature_id int, geom array<array<array<struct<x:double,y:double>>>>"))  # three rows
    down = lambda x, y: F.struct(x.alias("x"), (y - F.col("k") * 60).alias("y"))
    return blocks.join(fixed, F.lit(True)).select("seq", (F.col("feature_id") + F.col("k") * 1000).cast("int").alias("feature_id"), reproject(F.col("geom"), down).alias("geom"))


def suppliers_as_rectangles(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Rectangles from suppliers and customers, over one plane."""

    def box(df: DataFrame, key: str, balance: str, wide: float) -> DataFrame:
        x, y = (F.col(key) * 37 % 1000).cast("double"), (F.floor(F.abs(balance)) % 1000).cast("double")
        point = lambda a, b: F.struct(a.alias("x"), b.alias("y"))
        ring = F.array(point(x, y), point(x + wide, y), point(x + wide, y + wide), point(x, y + wide))
        return df.select(F.col(key).alias("id"), F.array(F.array(ring)).alias("geom"))

    return box(table(spark, sf_dir, "supplier"), "s_suppkey", "s_acctbal", 40.0), box(table(spark, sf_dir, "customer"), "c_custkey", "c_acctbal", 15.0)


_EDGES = ", ".join(
    f"({seq}, {float(ax)}, {float(ay)}, {float(bx)}, {float(by)})" for seq, rings in POLYGONS for ring in rings for (ax, ay), (bx, by) in zip(ring, ring[1:] + ring[:1], strict=True)
)

SQL = {
    "obs": """SELECT CAST(l_partkey // 40 AS INTEGER) AS "row", CAST(l_partkey % 40 AS INTEGER) AS col, l_shipdate AS t,
  CASE l_returnflag WHEN 'R' THEN 32 WHEN 'A' THEN 8 ELSE 2 END AS qa, """
    + ", ".join(
        f"CASE WHEN l_linenumber = 7 THEN -9999 ELSE CAST({e} AS INTEGER) END AS {b}"
        for b, e in {
            "blue": "floor(l_extendedprice / 20)", "green": "floor(l_extendedprice / 15)", "red": "floor(l_extendedprice / 10)", "re1": "floor(l_extendedprice / 12)", "re2": "floor(l_extendedprice / 11)",
            "re3": "floor(l_extendedprice / 13)", "nir": "(floor(l_extendedprice / 10) + floor(l_quantity * 100))", "swir1": "floor(l_quantity * 100)", "swir2": "floor(l_quantity * 50)",
        }.items()
    )
    + " FROM lineitem",
    "terrain": 'SELECT CAST(p_partkey // 40 AS INTEGER) AS "row", CAST(p_partkey % 40 AS INTEGER) AS col, p_size AS elevation, p_retailprice AS slope FROM part',
    "footprints": "SELECT printf('%03d%03d', n_regionkey, n_nationkey) AS name, n_nationkey AS footprint FROM nation",
    "scenes": """SELECT f.name, o_orderdate AS acquired, CASE o_orderstatus WHEN 'F' THEN 'LT05' WHEN 'O' THEN 'LE07' ELSE 'LC08' END AS product,
  CAST(CAST(floor(o_totalprice) AS BIGINT) % 100 AS DOUBLE) AS cloud_cover, CAST(CAST(floor(o_totalprice) AS BIGINT) % 100 AS DOUBLE) AS cloud_cover_land
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN footprints f ON c_nationkey = f.footprint""",
    "pair": 'SELECT vec_id AS cell, CAST(vec_id // 25 AS INTEGER) AS "row", CAST(vec_id % 25 AS INTEGER) AS col, label AS code, '
    + ", ".join(f"CAST(embedding[{i}] AS DOUBLE) AS {n}" for i, n in enumerate(("pre1", "pre2", "pre3", "post1", "post2", "post3"), 1))
    + " FROM embeddings",
    "valid": "SELECT quality AS truth, toxic AS pred, n_chars AS weight FROM labels JOIN documents USING (doc_id)",
    "edges": f"SELECT * FROM (VALUES {_EDGES}) AS e(seq, x1, y1, x2, y2)",
    "zones": f"""SELECT CAST("row" + k * 60 AS INTEGER) AS "row", CAST(col AS INTEGER) AS col, CAST(max(seq) * 10 + k * 1000 AS INTEGER) AS feature_id FROM (SELECT DISTINCT p_partkey // 2400 AS k FROM part) CROSS JOIN (
  SELECT c."row", c.col, e.seq FROM (SELECT * FROM range(0, 60) r("row"), range(0, 40) k(col)) c JOIN edges e
  ON (e.y1 > {Y0} - (c."row" + 0.5)) <> (e.y2 > {Y0} - (c."row" + 0.5)) AND c.col + 0.5 < (e.x2 - e.x1) * ({Y0} - (c."row" + 0.5) - e.y1) / (e.y2 - e.y1) + e.x1
  GROUP BY c."row", c.col, e.seq HAVING count(*) % 2 = 1) GROUP BY "row", col, k""",
}


def with_views(query: str) -> str:
    """A query that may name the views."""
    return "WITH RECURSIVE " + ", ".join(f"{k} AS ({v})" for k, v in SQL.items()) + f" {query}"
