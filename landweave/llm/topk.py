"""Exact top-k search by inner product over a pivot-distance index.

An inner product search is a nearest neighbour search after one more coordinate: with M the largest norm
of all vectors, x becomes (x, sqrt(M^2 - |x|^2)) and q becomes (q, 0), and
d(q, x)^2 = |q|^2 + M^2 - 2 q.x. Each vector is keyed by its nearest pivot and its distance to it, and
vectors of one pivot are kept sorted by distance, in blocks: annuli around the pivot.

A query knows its distance to each pivot; by the triangle inequality an annulus [lo, hi] holds nothing
nearer than max(dq - hi, lo - dq). A pivot's annuli are held in order of distance. The annuli nearest to
the query are searched first and give a bound on its k-th score; the search then expands, first to half
the radius that the bound leaves and, with the better bound, to what is left of it. It stops there: no
annulus beyond holds anything as good. Scores are integers, so that the results are exact; the bounds only
decide what is looked at, with a margin for rounding.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, small_enough, written

#: Vectors in an index block, queries in a batch (about), pivots, and the vectors that the pivots are chosen from at most.
BLOCK, BATCH, PIVOTS, SAMPLE = 2048, 256, 32, 2000

#: Annuli of one pivot in a row of the directory.
SHELF = 1024

#: Parts of the radius to which the search expands in turn; the last is all of it.
EXPAND = (0.5, 1.0)

VECTORS = "pivot int, dist double, row long, id long, v array<long>"


def quantised(column: Column, scale: int = 64) -> Column:
    """floor(scale * x) of each component as longs; null where the vector is null or a component null, NaN or infinite."""
    as_double = column.cast("array<double>")
    finite = F.forall(as_double, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(finite, F.transform(as_double, lambda x: F.floor(F.lit(float(scale)) * x).cast("long")))


def _matrix(column: pa.Array | pd.Series, dims: int, kind: type = np.float64) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False) if isinstance(column, pa.Array) else np.concatenate(list(column))
    return flat.reshape(-1, dims).astype(kind)


def choose_pivots(sample: np.ndarray, count: int) -> np.ndarray:
    """Rows of a sample far from each other, found greedily from the first."""
    chosen = [0]
    nearest = ((sample - sample[0]) ** 2).sum(1)
    while len(chosen) < min(count, len(sample)) and nearest.max() > 0:
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, ((sample - sample[chosen[-1]]) ** 2).sum(1))
    return sample[chosen]


def _distances(vectors: np.ndarray, extra: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distances of vectors with one more coordinate to the pivots, which have it."""
    plain = (vectors**2).sum(1)[:, None] + (pivots[:, :-1] ** 2).sum(1) - 2 * vectors @ pivots[:, :-1].T
    return np.sqrt(np.maximum(plain + (extra[:, None] - pivots[:, -1]) ** 2, 0))


def _keyed(pivots: np.ndarray, top: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            x = _matrix(batch.column("v"), pivots.shape[1] - 1)
            d = _distances(x, np.sqrt(np.maximum(top - (x**2).sum(1), 0)), pivots)
            nearest = d.argmin(1)
            columns = {"pivot": nearest.astype(np.int32), "dist": d[np.arange(len(x)), nearest], "row": batch.column("row"), "id": batch.column("id"), "v": batch.column("v")}
            yield pa.RecordBatch.from_pydict(columns)

    return run


def build_index(vectors: DataFrame, pivots: np.ndarray, top: float, block: int = BLOCK) -> DataFrame:
    """Blocks of the index, written: pivot, block, lo, hi, rows, ids and the matrix of vectors, in annuli sorted by distance.

    `vectors` is a written table of row, id and v. Annuli of a pivot are found by counting: distances fall into fine rings,
    the rings' running counts give each ring its block, and rings that hold more than a block are cut by hash.
    """
    keyed = written(vectors.mapInArrow(_keyed(pivots, top), VECTORS), "pivot-keys")
    ring = F.floor(F.col("dist") / F.lit(max(top, 1.0) ** 0.5 / 512)).cast("long")
    rings = keyed.groupBy("pivot", ring.alias("ring")).agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(W.partitionBy("pivot").orderBy("ring").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    rings = rings.select(
        F.col("pivot").alias("r_pivot"), F.col("ring").alias("r_ring"), F.expr(f"({block} + n - 1) div {block}").alias("cuts"), F.floor(before / block).alias("annulus"), "n"
    )  # at most some thousand rings for each pivot
    rings = F.broadcast(rings)  # by the fixed number of rings, at most some thousand for each of the pivots
    placed = keyed.join(rings, (F.col("pivot") == F.col("r_pivot")) & (ring == F.col("r_ring")))
    cut = F.when(F.col("cuts") > 1, F.col("r_ring") * 4096 + F.pmod(F.xxhash64("row"), F.col("cuts"))).otherwise(F.lit(-1))
    placed = placed.select("pivot", F.col("annulus").alias("annulus"), cut.cast("long").alias("cut"), "dist", "row", "id", "v")

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["id", "row"], kind="stable")
        first = rows.iloc[0]
        body = np.concatenate(list(rows["v"])).astype("<i8").tobytes()
        out = {"pivot": first["pivot"], "lo": rows["dist"].min(), "hi": rows["dist"].max(), "rows": rows["row"].to_numpy().astype("<i8").tobytes(), "ids": rows["id"].to_numpy().astype("<i8").tobytes(), "body": body, "n": len(rows)}
        return pd.DataFrame([out])

    packed = placed.groupBy("pivot", "annulus", "cut").applyInPandas(pack, "pivot int, lo double, hi double, rows binary, ids binary, body binary, n int")
    return written(packed.withColumn("block", F.expr("uuid()")), "pivot-index")


def products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of rows of integers, exact: by doubles or longs where no sum can round or overflow, else by Python's integers.

    What lies beyond a long becomes the nearest long.
    """
    most = [int(np.abs(m.astype(np.float64)).max(initial=0)) + 1 for m in (q, x)]
    bound = most[0] * most[1] * q.shape[1]
    if bound < 1 << 53:
        return (q.astype(np.float64) @ x.astype(np.float64).T).astype(np.int64)
    if bound < 1 << 63:
        return q @ x.T
    exact = q.astype(object) @ x.astype(object).T
    return np.clip(exact, -(1 << 63), (1 << 63) - 1).astype(np.int64)


def _ranked(scores: np.ndarray, there: np.ndarray, k: int) -> np.ndarray:
    """For each row the k columns (in any order) with the highest scores of those there, ties to the first."""
    n = scores.shape[1]
    if int(np.abs(scores.astype(np.float64)).max(initial=0)) + 1 < (1 << 61) // n:
        key = np.where(there, np.arange(n) - scores * n, (1 << 63) - 1)
        return np.argpartition(key, k - 1, axis=1)[:, :k]
    by_score = np.argsort(~scores, axis=1, kind="stable")  # the complement turns the order, whatever the size
    first = np.argsort(~np.take_along_axis(there, by_score, 1), axis=1, kind="stable")[:, :k]
    return np.take_along_axis(by_score, first, 1)


def _scores(k: int, dims: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The k best candidates of each query in one block, of those that reach the query's bound."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = np.frombuffer(row["ids"], "<i8")
                x = np.frombuffer(row["body"], "<i8").reshape(len(ids), dims)
                asked = np.array([q["asked"] for q in row["queries"]], np.int64)
                own = np.array([q["row"] for q in row["queries"]], np.int64)
                scores = products(np.array([q["v"] for q in row["queries"]], np.int64), x)
                there = own[:, None] != np.frombuffer(row["rows"], "<i8")[None, :]
                least = np.array([-(1 << 63) if q["bound"] is None else q["bound"] for q in row["queries"]], np.int64)
                there &= scores >= least[:, None]
                # ids ascend, so that of equal scores the first have the smallest ids
                order = _ranked(scores, there, min(k, len(ids)))
                rows, cols = np.repeat(np.arange(len(asked)), order.shape[1]), order.ravel()
                kept = there[rows, cols]
                rows, cols = rows[kept], cols[kept]
                yield pa.RecordBatch.from_pydict({"asked": asked[rows], "vec_id": ids[cols], "score": scores[rows, cols]})

    return run


def _search(queries: DataFrame, pairs: DataFrame, index: DataFrame, k: int, dims: int) -> DataFrame:
    """Candidates (asked, vec_id, score) from pairs (asked, block), each block's queries in batches: as many as its queries, counted first, ask for."""
    pairs = written(pairs, "pairs")
    batches = pairs.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / BATCH).alias("batches"))
    rows = pairs.join(small_enough(written(batches, "batches")), "block").join(queries.select("asked", "row", "v", "bound"), "asked")
    number = F.pmod(F.xxhash64("asked"), F.col("batches"))
    batches = rows.withColumn("batch", number).groupBy("block", "batch").agg(F.collect_list(F.struct("asked", "row", "v", "bound")).alias("queries"))
    work = batches.join(index.select("block", "rows", "ids", "body"), "block").select("queries", "rows", "ids", "body")
    return work.mapInArrow(_scores(k, dims), "asked long, vec_id long, score long")


def _best(candidates: DataFrame, k: int) -> DataFrame:
    order = W.partitionBy("asked").orderBy(F.desc("score"), "vec_id")
    return candidates.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _directory(index: DataFrame) -> DataFrame:
    """A pivot's annuli in order of distance, SHELF to a row: pivot, annuli (lo, hi, block)."""
    turn = F.row_number().over(W.partitionBy("pivot").orderBy("lo", "hi", "block"))  # a row for some thousand vectors
    shelved = index.select("pivot", "lo", "hi", "block", F.floor((turn - 1) / SHELF).alias("shelf"))
    return written(shelved.groupBy("pivot", "shelf").agg(F.sort_array(F.collect_list(F.struct("lo", "hi", "block"))).alias("annuli")).drop("shelf"), "directory")


def top_k(vectors: DataFrame, is_query: Column, k: int = 20, pivots: int = PIVOTS, seeds: int = 4, block: int = BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k highest inner products with all other vectors, ties to smaller ids.

    `vectors` has id and v (array of long, null for vectors that take no part); rows of `is_query` are the queries. A vector with
    a null id can be neither asked nor named and takes no part. Candidates are all rows but the query's own: rows of one id are rows of
    their own, and two queries of one id are answered each. Of vectors of unlike lengths the shorter one counts as ended by zeros, an empty one as
    all zeros. Scores are exact for components of any size; those beyond a long become the nearest long. An empty table
    gives no rows, a query with fewer than k others gets all of them.
    """
    spark: SparkSession = vectors.sparkSession
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    usable = written(vectors.where(F.col("v").isNotNull() & F.col("id").isNotNull()).select(F.monotonically_increasing_id().alias("row"), F.col("id").cast("long").alias("id"), "v", is_query.alias("asks")), "vectors")
    norm = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    facts = usable.agg(F.max(norm).alias("top"), F.max(F.size("v")).alias("dims"), F.count(F.lit(1)).alias("n")).first()
    if facts.dims is None:
        return empty
    dims, top = max(facts.dims, 1), facts.top
    zeros = F.array_repeat(F.lit(0).cast("long"), F.lit(dims) - F.size("v"))
    usable = usable.select("row", "id", F.concat("v", zeros).alias("v"), "asks")

    # Pivots come from a bounded sample, the first by hash; every vector is indexed.
    drawn = usable.orderBy(F.xxhash64("id", "v"), "row").limit(SAMPLE).select("v").collect()
    sample = np.array(sorted(r.v for r in drawn), np.float64)
    whole = np.column_stack([sample, np.sqrt(np.maximum(top - (sample**2).sum(1), 0))])
    points = choose_pivots(whole, pivots)
    index = build_index(usable.select("row", "id", "v"), points, top, block)

    @F.pandas_udf("array<double>")
    def to_pivots(v: pd.Series) -> pd.Series:
        x = _matrix(v, dims)
        return pd.Series(list(_distances(x, np.zeros(len(x)), points)))

    asked = usable.where("asks").select(F.col("row").alias("asked"), "row", "id", "v", norm.alias("norm"), to_pivots("v").alias("d"))
    queries = written(asked, "queries")
    # Each query meets its pivots' directories by the pivot; the annuli that it must look at are picked out of them in place.
    met = queries.select("asked", "norm", F.posexplode("d").alias("pivot", "dq")).join(small_enough(_directory(index), BROADCAST_ROWS // SHELF), "pivot")
    nearest = F.transform("annuli", lambda a: F.struct(F.greatest(F.col("dq") - a["hi"], a["lo"] - F.col("dq"), F.lit(0.0)).alias("gap"), a["block"].alias("block")))
    turn = F.row_number().over(W.partitionBy("asked").orderBy("gap", "block"))
    ahead = met.select("asked", F.explode(F.slice(F.array_sort(nearest), 1, seeds)).alias("near")).select("asked", "near.gap", "near.block")
    ahead = written(ahead.withColumn("turn", turn).where(F.col("turn") <= seeds), "first-annuli")

    lowest = queries.select("asked", "row", "v", F.lit(None).cast("long").alias("bound"))
    found = written(_best(_search(lowest, ahead.select("asked", "block"), index, k, dims), k), "found")
    done = ahead.groupBy("asked").agg(F.max(F.struct("gap", "block")).alias("done"))
    for part in EXPAND:
        kth = found.groupBy("asked").agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("bound"))
        now = queries.join(kth, "asked", "left").join(done, "asked")
        # No point farther than the k-th best counts, with room for rounding; without k of them all do.
        room = F.lit(1e-6 * max(1.0, dims / 64) ** 0.5 * max(top, 1.0) ** 0.5)
        reach = F.sqrt(F.greatest(F.col("norm") + F.lit(top) - 2 * F.col("bound").cast("double"), F.lit(0.0))) * (1 + 1e-9) + room
        limit = F.when(F.col("bound").isNull(), F.lit(float("inf"))).otherwise(reach * part)
        now = written(now.select("asked", "row", "v", "bound", limit.alias("limit"), "done"), "bounds")
        open_ = F.filter(nearest, lambda a: (a > F.col("done")) & (a["gap"] <= F.col("limit")))
        pairs = met.join(now.select("asked", "limit", "done"), "asked").select("asked", F.explode(open_).alias("next")).select("asked", "next.block")
        new = _search(now, pairs, index, k, dims)
        found = written(_best(found.select("asked", "vec_id", "score").unionByName(new), k), "found")
        # All annuli up to the limit are done.
        done = now.select("asked", F.greatest(F.col("done"), F.struct(F.col("limit").alias("gap"), F.lit("~").alias("block"))).alias("done"))
    return found.join(queries.select("asked", F.col("id").alias("query_id")), "asked").select("query_id", "rank", "vec_id", "score")
