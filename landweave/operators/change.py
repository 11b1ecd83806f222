"""Bi-temporal change: distances, histogram matching, alteration detection, thresholds."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from landweave.operators import order, robust, shifts
from landweave.operators.moments import Moments, moments
from landweave.operators.regions import written

#: Most bins of a histogram that `kapur_threshold` takes: a long tail makes the methods ask for millions.
MOST_BINS = 100_000


def ecdf(values: DataFrame, value: str) -> DataFrame:
    """Distinct values, counts and cumulative share: range partitions are summed up each, and offset by those before them."""
    counts = values.where(F.col(value).isNotNull()).groupBy(F.col(value).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    ranged = written(counts.repartitionByRange("value").withColumn("part", F.spark_partition_id()), "counts")
    every, before = W.partitionBy(), W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    parts = ranged.groupBy("part").agg(F.sum("n").alias("own"))  # a row for each range partition
    parts = parts.select("part", F.coalesce(F.sum("own").over(before), F.lit(0)).alias("before"), F.sum("own").over(every).alias("all"))
    inside = F.sum("n").over(W.partitionBy("part").orderBy("value").rowsBetween(W.unboundedPreceding, 0))
    return ranged.withColumn("inside", inside).join(F.broadcast(parts), "part").select("value", "n", ((F.col("before") + F.col("inside")) / F.col("all")).alias("share"))


def hist_match(source: DataFrame, template: DataFrame, value: str) -> DataFrame:
    """value and matched: each source value's place among the template's values at equal cumulative share, interpolated."""
    s = ecdf(source, value).select("share", F.col("value").alias("s"), F.lit(None).cast("double").alias("t"), F.lit(1).alias("side"))
    t = ecdf(template, value).select("share", F.lit(None).cast("double").alias("s"), F.col("value").cast("double").alias("t"), F.lit(0).alias("side"))
    both = t.unionByName(s.withColumn("s", F.col("s").cast("double")))
    both = written(both.repartitionByRange("share", "side").withColumn("part", F.spark_partition_id()), "shares")
    point = F.when(F.col("t").isNotNull(), F.struct(F.col("share").alias("q"), F.col("t").alias("v")))
    # The nearest template points on either side: inside the range partition, else in the partitions before and after it.
    parts = both.groupBy("part").agg(F.min(point).alias("first"), F.max(point).alias("last"))  # a row for each range partition
    near = lambda column, *order: F.last(column, True).over(W.orderBy(*order).rowsBetween(W.unboundedPreceding, -1))
    parts = parts.select("part", near("last", "part").alias("before"), near("first", F.desc("part")).alias("after"))
    inside = lambda *order: F.last(point, True).over(W.partitionBy("part").orderBy(*order).rowsBetween(W.unboundedPreceding, 0))
    both = both.withColumn("low", inside("share", "side")).withColumn("high", inside(F.desc("share"), F.desc("side"))).join(F.broadcast(parts), "part")
    low = F.coalesce("low", "before")
    high = F.coalesce("high", "after", low)
    slope = F.try_divide(F.col("share") - low["q"], high["q"] - low["q"])
    matched = F.when(low.isNull(), high["v"]).when(low["q"] == F.col("share"), low["v"]).otherwise(low["v"] + slope * (high["v"] - low["v"]))
    return both.where(F.col("s").isNotNull()).select(F.col("s").alias("value"), F.coalesce(matched, low["v"]).alias("matched"))


def change_distance(pairs: DataFrame, pre: Sequence[str], post: Sequence[str], match: bool = False) -> DataFrame:
    """`distance` between the dates: absolute difference of one band, Euclidean of several; optionally pre is matched onto post first."""
    if match:
        for a, b in zip(pre, post, strict=True):
            table = hist_match(pairs.select(F.col(a).alias("v")), pairs.select(F.col(b).alias("v")), "v")
            table = table.withColumnRenamed("value", "__v").withColumnRenamed("matched", "__m")
            pairs = pairs.join(table, F.col(a).cast("double") == F.col("__v"), "left").withColumn(a, F.col("__m")).drop("__v", "__m")
    if len(pre) == 1:
        return pairs.withColumn("distance", F.abs(F.col(post[0]) - F.col(pre[0])))
    total = sum((F.pow(F.col(a) - F.col(b), 2) for a, b in zip(pre, post, strict=True)), F.lit(0.0))
    return pairs.withColumn("distance", F.sqrt(total))


def clip_tails(df: DataFrame, value: str, k: float = 3.0) -> DataFrame:
    """Rows strictly inside the mean plus or minus k population deviations."""
    facts = df.agg(F.avg(value).alias("__m"), F.stddev_pop(value).alias("__s"))
    return df.join(F.broadcast(facts), F.lit(True)).where((F.col(value) > F.col("__m") - k * F.col("__s")) & (F.col(value) < F.col("__m") + k * F.col("__s"))).drop("__m", "__s")


def histogram(df: DataFrame, value: str, bins: int) -> DataFrame:
    """bin, n, low and high of equal-width bins over the range; the last is closed; empty bins have 0."""
    facts = F.broadcast(df.agg(F.min(value).alias("lo"), F.max(value).alias("hi")))
    width = (F.col("hi") - F.col("lo")) / F.lit(float(bins))
    number = F.least(F.coalesce(F.floor(F.try_divide(F.col(value) - F.col("lo"), width)), F.lit(0)), F.lit(bins - 1)).cast("int")
    counts = df.where(F.col(value).isNotNull()).join(facts, F.lit(True)).groupBy(number.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    spine = facts.where("lo is not null").select("lo", width.alias("w"), F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return spine.join(counts, "bin", "left").select("bin", F.coalesce("n", F.lit(0)).alias("n"), (F.col("lo") + F.col("bin") * F.col("w")).alias("low"), (F.col("lo") + (F.col("bin") + 1) * F.col("w")).alias("high"))


def optimal_bins(df: DataFrame, value: str, method: str) -> DataFrame:
    """One row, bins: Sturges, Scott or Freedman-Diaconis by closed form, Shimazaki-Shinomoto by least cost."""
    x = F.col(value)
    n, span = F.count(x), F.max(x) - F.min(x)
    if method == "sturges":
        bins = F.ceil(F.log2(n)) + 1
    elif method == "scott":
        bins = F.ceil(span / (3.59 * F.stddev_pop(x) * F.pow(n, F.lit(-1 / 3))))
    elif method == "freedman":
        quarters = order.percentiles(df.select(x.alias("v")).where("v is not null"), [], ["v"], [0.25, 0.75])
        facts = df.agg(n.alias("n"), span.alias("span")).join(F.broadcast(quarters), F.lit(True))  # two rows
        width = 2 * (F.get("v", F.lit(1)) - F.get("v", F.lit(0))) * F.pow("n", F.lit(-1 / 3))
        return facts.select(F.ceil(F.try_divide("span", width)).cast("long").alias("bins"))
    elif method == "shimazaki":
        values = df.where(x.isNotNull()).groupBy(x.alias("v")).agg(F.count(F.lit(1)).alias("c"))
        facts = values.agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.sum("c").alias("n"))
        tried = values.join(F.broadcast(facts), F.lit(True)).withColumn("bins", F.explode(F.sequence(F.lit(100), F.lit(2990), F.lit(10))))
        at = F.least(F.floor((F.col("v") - F.col("lo")) * F.col("bins") / (F.col("hi") - F.col("lo"))), F.col("bins") - 1)
        filled = tried.groupBy("bins", at.alias("at"), "lo", "hi", "n").agg(F.sum("c").alias("c"))
        k = F.col("n") / F.col("bins")
        cost = (2 * k - (F.sum(F.col("c") * F.col("c")) / F.col("bins") - k * k)) / F.pow((F.col("hi") - F.col("lo")) / F.col("bins"), 2)
        return filled.groupBy("bins", "lo", "hi", "n").agg(cost.alias("cost")).agg(F.min_by("bins", F.struct("cost", "bins")).cast("long").alias("bins"))
    else:
        raise ValueError(f"no method {method!r}")
    return df.agg(bins.cast("long").alias("bins"))


def entropy_cut(bins: DataFrame, upper: bool = True, from_mode: bool = True) -> DataFrame:
    """One row, threshold: the edge with the largest entropy of what lies on its two sides, from the mode bin on unless told otherwise.

    bins has bin, n, low, high. The bin right after the cut is in neither side, as the method has it.
    """
    edge, way = (F.col("high"), F.col("bin")) if upper else (F.col("low"), -F.col("bin"))
    turned = bins.select(way.alias("at"), "n", edge.alias("edge"))
    mode = F.broadcast(turned.agg(F.min_by("at", F.struct(-F.col("n"), F.col("at"))).alias("mode")))
    kept = turned.join(mode, F.lit(True)).where((F.col("at") >= F.col("mode")) & (F.col("n") > 0)) if from_mode else turned.where("n > 0")
    total = F.sum("n").over(W.partitionBy())
    p = kept.select("at", "edge", "n", (F.col("n") / total).alias("p"))
    upto = W.orderBy("at").rowsBetween(W.unboundedPreceding, 0)
    q = p.select(
        "at", "edge", "n",
        F.sum("p").over(upto).alias("s"), F.sum(F.col("p") * F.log("p")).over(upto).alias("e"),
        F.sum(F.col("p") * F.log("p")).over(W.partitionBy()).alias("all_e"), F.row_number().over(W.orderBy("at")).alias("i"), F.count(F.lit(1)).over(W.partitionBy()).alias("k"), F.max("n").over(W.partitionBy()).alias("most"),
    )
    ahead = W.orderBy("at")
    s1, e1 = F.lead("s").over(ahead), F.lead("e").over(ahead)
    rest, rest_e = 1 - s1, F.col("all_e") - e1
    h = F.log("s") - F.col("e") / F.col("s") + F.log(rest) - rest_e / rest
    scored = q.withColumn("h", F.when(F.col("i") <= F.col("k") - 2, h).otherwise(F.lit(0.0)))
    best = F.min_by("edge", F.struct(-F.col("h"), F.col("i")))
    return scored.agg(F.when(F.max("most") == 1, F.pow(F.lit(2.0), F.min_by("n", "i"))).otherwise(best).alias("threshold"))


def kapur_threshold(df: DataFrame, value: str, bins: int | str = 1000, symmetrical: bool = False, clip: float | None = 3.0, from_mode: bool = True, no_data: float | None = None) -> DataFrame:
    """The rows with `changed`: beyond the entropy threshold of the clipped values' histogram (on both sides if symmetrical).

    `bins` is their number or the name of a method of `optimal_bins`. Values of `no_data` have no part in it; their `changed` is null.
    """
    known = df if no_data is None else df.where(F.col(value) != no_data)
    known = known if clip is None else clip_tails(known, value, clip)
    number = optimal_bins(known, value, bins).first()["bins"] if isinstance(bins, str) else bins
    if number is not None and number > MOST_BINS:
        raise ValueError(f"{number} bins asked for by {bins!r}; at most {MOST_BINS} are possible")
    h = histogram(known, value, number or 1)
    high = entropy_cut(h, from_mode=from_mode).withColumnRenamed("threshold", "__high")
    out = df.join(F.broadcast(high), F.lit(True))
    changed = F.col(value) > F.col("__high")
    if symmetrical:
        out = out.join(F.broadcast(entropy_cut(h, False, from_mode).withColumnRenamed("threshold", "__low")), F.lit(True))
        changed = changed | (F.col(value) < F.col("__low"))
    changed = F.coalesce(changed, F.lit(False))
    return out.withColumn("changed", changed if no_data is None else F.when(F.col(value) != no_data, changed)).drop("__high", "__low")


def weighted_moments(pairs: DataFrame, x: Sequence[str], y: Sequence[str], weight: Column | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Means of x and y, and their covariances S11, S22 and S12, weighted, in one pass."""
    if weight is not None:
        pairs = pairs.withColumn("__w", weight)
    return _parted(moments(pairs, [*x, *y], weight=None if weight is None else "__w")[0], len(x))


def _parted(found: Moments, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    total, mean, co = found
    s = co / (total - 1)
    return mean[:n], mean[n:], s[:n, :n], s[n:, n:], s[:n, n:]


def _project(columns: Sequence[str], mean: np.ndarray, vector: np.ndarray) -> Column:
    return sum((F.lit(float(v)) * (F.col(c).cast("double") - F.lit(float(m))) for c, m, v in zip(columns, mean, vector, strict=True)), F.lit(0.0))


def _canonical(mx: np.ndarray, my: np.ndarray, s11: np.ndarray, s22: np.ndarray, s12: np.ndarray, ridge: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The vectors of both dates, the variances of their variates' differences and the correlations, largest first."""
    eye = np.eye(len(mx))
    s11, s22 = (1 - ridge) * s11 + ridge * eye, (1 - ridge) * s22 + ridge * eye
    i1, i2 = (np.round(np.linalg.inv(np.linalg.cholesky(s)), 10) for s in (s11, s22))
    sym = lambda m: (m + m.T) / 2
    _, v1 = np.linalg.eigh(sym(i1 @ s12 @ np.linalg.inv(s22) @ s12.T @ i1.T))
    e2, v2 = np.linalg.eigh(sym(i2 @ s12.T @ np.linalg.inv(s11) @ s12 @ i2.T))
    a, b, mu = i1.T @ v1[:, ::-1], i2.T @ v2[:, ::-1], np.sqrt(np.maximum(e2[::-1], 0))
    a = a * np.where((np.diag(1 / np.sqrt(np.diag(s11))) @ s11 @ a).sum(0) < 0, -1, 1)
    b = b * np.where(np.diag(a.T @ s12 @ b) < 0, -1, 1)
    a2, b2 = (a * a).sum(0), (b * b).sum(0)
    var = (2 - ridge * (a2 + b2)) / (1 - ridge) - 2 * mu
    rho = mu * (1 - ridge) / np.sqrt((1 - ridge * a2) * (1 - ridge * b2))
    return a, b, var, rho


def _variates(x: Sequence[str], y: Sequence[str], mx: np.ndarray, my: np.ndarray, a: np.ndarray, b: np.ndarray) -> list[Column]:
    return [_project(x, mx, a[:, k]) - _project(y, my, b[:, k]) for k in range(len(x))]


def mad(pairs: DataFrame, x: Sequence[str], y: Sequence[str], weight: Column | None = None, ridge: float = 0.0) -> tuple[list[Column], np.ndarray, np.ndarray]:
    """Alteration variates as columns, their variances and the canonical correlations, largest first."""
    found = weighted_moments(pairs, x, y, weight)
    a, b, var, rho = _canonical(*found, ridge)
    return _variates(x, y, *found[:2], a, b), var, rho


#: Coefficients of erfc's rational approximation, of the highest power first.
_ERFC = (0.17087277, -0.82215223, 1.48851587, -1.13520398, 0.27886807, -0.18628806, 0.09678418, 0.37409196, 1.00002368, -1.26551223)


def chi2_survival(z: Column, dof: int) -> Column:
    """1 - distribution function of chi squared, by recurrence over the degrees of freedom; odd ones start from erfc."""
    half = F.greatest(z, F.lit(0.0)) / 2
    if dof % 2:
        # erfc by a rational approximation with relative error below 1.2e-7
        x = F.sqrt(half)
        t = 1 / (1 + x / 2)
        poly = F.lit(_ERFC[0])
        for c in _ERFC[1:]:
            poly = poly * t + c
        q, k = t * F.exp(poly - x * x), 1
    else:
        q, k = F.exp(-half), 2
    while k < dof:
        q = q + F.exp(F.lit(k / 2) * F.log(F.greatest(half, F.lit(1e-300))) - half - math.lgamma(k / 2 + 1))
        k += 2
    return q


def _survival(z: np.ndarray, dof: int) -> np.ndarray:
    """`chi2_survival` of an array."""
    half = np.maximum(z, 0.0) / 2
    if dof % 2:
        x = np.sqrt(half)
        t = 1 / (1 + x / 2)
        poly = np.full_like(t, _ERFC[0])
        for c in _ERFC[1:]:
            poly = poly * t + c
        q, k = t * np.exp(poly - x * x), 1
    else:
        q, k = np.exp(-half), 2
    while k < dof:
        q = q + np.exp(k / 2 * np.log(np.maximum(half, 1e-300)) - half - math.lgamma(k / 2 + 1))
        k += 2
    return q


def irmad(pairs: DataFrame, x: Sequence[str], y: Sequence[str], rounds: int = 50, min_delta: float = 0.001, ridge: float = 0.0) -> tuple[DataFrame, np.ndarray]:
    """Reweighted alteration variates m1, m2 ... of the pairs, and the correlations.

    A round is one job over the pairs: its tasks weigh rows by the last round's coefficients, which travel with the function, and give
    partial moments; the plan is the same in all rounds, and only k x k sums reach the driver.
    """
    n, weigh, before, delta, i = len(x), None, np.ones(len(x)), 1.0, 0
    while i < rounds and delta > min_delta:
        mx, my, *s = _parted(moments(pairs, [*x, *y], weigh)[0], n)
        a, b, var, rho = _canonical(mx, my, *s, ridge)

        def weigh(rows: np.ndarray, mx=mx, my=my, a=a, b=b, var=var) -> np.ndarray:
            m = (rows[:, :n] - mx) @ a - (rows[:, n:] - my) @ b
            return _survival((m * m / var).sum(1), n)[:, None]

        delta, before, i = float(np.abs(rho - before).max()), rho, i + 1
    return pairs.withColumns({f"m{k + 1}": m for k, m in enumerate(_variates(x, y, mx, my, a, b))}), rho


def shifted_covariance(cells: DataFrame, bands: Sequence[str], rows: int, cols: int, shift: tuple[int, int], mean: np.ndarray, n: int) -> np.ndarray:
    """Covariance of each cell with the cell `shift` (columns, rows) before it, around the edges."""
    return shifts.shifted_products(cells, bands, rows, cols, (shift[1], shift[0]), mean) / (n - 1)


def maf(cells: DataFrame, bands: Sequence[str], rows: int, cols: int, shift: tuple[int, int] = (1, 1)) -> DataFrame:
    """Autocorrelation factors f1, f2 ... of full grids, least difference to the shifted cell first; signs: largest component positive."""
    n, mean, co = moments(cells, bands)[0]
    c0 = co / (n - 1)
    ch = shifted_covariance(cells, bands, rows, cols, shift, mean, n)
    gamma = 2 * c0 - ch - ch.T
    inverse = np.linalg.inv(np.linalg.cholesky(c0))
    _, v = np.linalg.eigh(inverse @ ((gamma + gamma.T) / 2) @ inverse.T)
    v = v * np.sign(v[np.abs(v).argmax(0), range(len(bands))])
    return cells.withColumns({f"f{k + 1}": _project(bands, np.zeros(len(bands)), v[:, k]) for k in range(len(bands))})


def elliptic_threshold(df: DataFrame, bands: Sequence[str], outliers: float = 0.05, centered: bool = True, support_fraction: float | None = None, no_data: float | None = None, **options) -> DataFrame:
    """`changed`: rows beyond the (1 - outliers) percentile of the squared distance under a robust covariance (`robust.minimum_covariance_determinant`, whose options these are).

    Rows without one of the bands have no part in it and are unchanged; of rows whose first band is `no_data`, `changed` is null. Cuts are
    right to a share of 1 / `robust.CUTS` of the rows, so that no task holds all distances.
    """
    if len(bands) < 2:
        raise ValueError("two bands are needed")
    known = F.greatest(*[(F.isnull(b) | F.isnan(F.col(b).cast("double"))).cast("int") for b in bands]) == 0
    has_data = F.lit(True) if no_data is None else F.coalesce(F.col(bands[0]) != no_data, F.lit(True))
    rows = df.where(known & has_data)
    d = robust.distance(bands, *robust.minimum_covariance_determinant(rows, bands, centered, support_fraction, **options))
    cut = rows.agg(F.percentile_approx(d, F.lit(1 - outliers), F.lit(robust.CUTS))).first()[0]
    changed = known & F.coalesce(d > cut, F.lit(False))
    return df.withColumn("changed", changed if no_data is None else F.when(has_data, changed))


def imadmaf(pairs: DataFrame, x: Sequence[str], y: Sequence[str], rounds: int = 50, min_delta: float = 0.001, ridge: float = 0.0, shift: tuple[int, int] = (1, 1), threshold: str = "kapur", **options) -> DataFrame:
    """Reweighted alteration variates m1 ... of full grids (cell, row, col), their autocorrelation factors f1 ..., and `changed` by a threshold on these.

    Kapur's takes the first factor on both sides, the elliptic one all factors. `pairs` is a written table.
    """
    names = [f"m{k + 1}" for k in range(len(x))]
    variates, _ = irmad(pairs, x, y, rounds, min_delta, ridge)
    variates = written(variates.select("cell", "row", "col", *names), "variates")
    size = variates.agg(F.max("row") + 1, F.max("col") + 1).first()
    factors = written(maf(variates, names, size[0], size[1], shift), "factors")
    if threshold == "kapur":
        return threshold_change(threshold, factors, "f1", **{"symmetrical": True, **options})
    return threshold_change(threshold, factors, [f"f{k + 1}" for k in range(len(x))], **options)


#: Ways to find change by name; each takes (pairs, pre, post). Users add their own.
CHANGES = {"distance": change_distance, "imadmaf": imadmaf}

THRESHOLDS = {"kapur": kapur_threshold, "elliptic": elliptic_threshold}


def threshold_change(method: str, df: DataFrame, *args, **options) -> DataFrame:
    if method not in THRESHOLDS:
        raise ValueError(f"no threshold {method!r}; there are {sorted(THRESHOLDS)}")
    return THRESHOLDS[method](df, *args, **options)
