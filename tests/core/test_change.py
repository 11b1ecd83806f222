"""Alteration detection and robust thresholds against numpy."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from landweave.operators import change, moments, robust, workflows

X, Y = ["a", "b", "c"], ["d", "e", "f"]


@pytest.fixture(scope="module")
def image():
    """20 by 30 cells of two dates; a tenth has changed."""
    random = np.random.default_rng(4)
    base = random.normal(size=(600, 3)) @ random.normal(size=(3, 3)) + [100, 2000, -5]
    after = base @ np.diag([1.2, 0.8, 1.0]) + random.normal(0, 0.2, (600, 3))
    after[:60] += random.normal(0, 5, (60, 3))
    return np.hstack([base, after])


@pytest.fixture(scope="module")
def pairs(spark, image):
    rows = [(i, i // 30, i % 30, *map(float, r)) for i, r in enumerate(image)]
    rows.append((600, 50, 0, None, *map(float, image[0, 1:])))
    return spark.createDataFrame(rows, "cell long, row int, col int, " + ", ".join(f"{c} double" for c in X + Y)).repartition(5).cache()


def plain_mad(z, w):
    w = w / 1.0
    total = w.sum()
    mean = w @ z / total
    d = z - mean
    s = (d * w[:, None]).T @ d / (total - 1)
    s11, s22, s12 = s[:3, :3], s[3:, 3:], s[:3, 3:]
    i1, i2 = (np.round(np.linalg.inv(np.linalg.cholesky(m)), 10) for m in (s11, s22))
    e1, v1 = np.linalg.eigh(i1 @ s12 @ np.linalg.inv(s22) @ s12.T @ i1.T)
    e2, v2 = np.linalg.eigh(i2 @ s12.T @ np.linalg.inv(s11) @ s12 @ i2.T)
    a, b, rho = i1.T @ v1[:, ::-1], i2.T @ v2[:, ::-1], np.sqrt(e2[::-1])
    a = a * np.where((np.diag(1 / np.sqrt(np.diag(s11))) @ s11 @ a).sum(0) < 0, -1, 1)
    b = b * np.where(np.diag(a.T @ s12 @ b) < 0, -1, 1)
    return d[:, :3] @ a - d[:, 3:] @ b, 2 - 2 * rho, rho


def plain_irmad(z, rounds, least):
    w, before, delta, i = np.ones(len(z)), np.ones(3), 1.0, 0
    while i < rounds and delta > least:
        m, var, rho = plain_mad(z, w)
        w = np.array([robust.chi2_survival(v, 3) for v in (m * m / var).sum(1)])
        delta, before, i = np.abs(rho - before).max(), rho, i + 1
    return m, rho


def test_moments_of_parts_are_those_of_the_whole(pairs, image):
    (total, mean, co), (half, first, _) = moments.moments(pairs, X + Y, lambda x: np.stack([np.ones(len(x)), x[:, 0] < 100], 1).astype(float))
    assert total == 600 and np.allclose(mean, image.mean(0), rtol=1e-12) and np.allclose(co / 599, np.cov(image.T), rtol=1e-10)
    assert half == (image[:, 0] < 100).sum() and np.allclose(first, image[image[:, 0] < 100].mean(0))


def test_weighted_moments_with_weights(pairs, image):
    mx, my, s11, s22, s12 = change.weighted_moments(pairs, X, Y, F.col("col") + 1)
    w = np.arange(600) % 30 + 1
    want = np.cov(image.T, fweights=w)
    assert np.allclose(np.append(mx, my), np.average(image, axis=0, weights=w)) and np.allclose(np.block([[s11, s12], [s12.T, s22]]), want)


@pytest.mark.parametrize("rounds", [1, 4, 30])
def test_irmad_against_numpy(pairs, image, rounds):
    out, rho = change.irmad(pairs.where("a is not null"), X, Y, rounds=rounds, min_delta=0.001)
    want, want_rho = plain_irmad(image, rounds, 0.001)
    got = np.array(out.orderBy("cell").select("m1", "m2", "m3").collect())
    assert np.allclose(rho, want_rho, atol=1e-6) and np.allclose(got, want, atol=1e-4)


def test_a_round_of_irmad_is_one_job(spark, pairs):
    group, tracker = "irmad-rounds", spark.sparkContext.statusTracker()
    pairs.count()
    spark.sparkContext.setJobGroup(group, "rounds")
    change.irmad(pairs, X, Y, rounds=6, min_delta=0.0)
    jobs = len(tracker.getJobIdsForGroup(group))
    spark.sparkContext.setJobGroup("other", "other")
    assert jobs <= 12  # one action a round; adaptive plans run an action's shuffle as a job of its own


def test_maf_against_numpy(pairs, image):
    z = image[:, :3]
    d = z - z.mean(0)
    c0, grid = d.T @ d / 599, d.reshape(20, 30, 3)
    ch = d.T @ np.roll(grid, (1, 1), (0, 1)).reshape(600, 3) / 599
    i = np.linalg.inv(np.linalg.cholesky(c0))
    gamma = 2 * c0 - ch - ch.T
    _, v = np.linalg.eigh(i @ gamma @ i.T)
    v = v * np.sign(v[np.abs(v).argmax(0), range(3)])
    got = np.array(change.maf(pairs.where("a is not null"), X, 20, 30).orderBy("cell").select("f1", "f2", "f3").collect())
    assert np.allclose(got, z @ v, atol=1e-6)


@pytest.fixture(scope="module")
def planted():
    """2,000 rows, every fifth from a tight far cloud that draws a single start to it."""
    random = np.random.default_rng(8)
    x = random.multivariate_normal([0.5, -0.3], [[4, 1.5], [1.5, 1]], 2000)
    x[::5] = random.multivariate_normal([9, -9], [[0.1, 0], [0, 0.1]], 400)
    return x


def plain_mcd(x, share=None, starts=300):
    random, n, p = np.random.default_rng(0), *x.shape
    h = math.ceil((n + p + 1) / 2) if share is None else int(share * n)
    best = None
    for _ in range(starts):
        few = x[random.choice(n, p + 1, replace=False)]
        mean, cov, before = few.mean(0), np.cov(few.T, bias=True), math.inf
        while True:
            d = np.einsum("ij,jk,ik->i", x - mean, np.linalg.pinv(cov), x - mean)
            near = x[np.argsort(d)[:h]]
            mean, cov = near.mean(0), np.cov(near.T, bias=True)
            if np.linalg.det(cov) >= before * (1 - 1e-12):
                break
            before = np.linalg.det(cov)
        if best is None or before < best[0]:
            best = before, mean, cov
    return best[1:]


def plain_reweighted(x, mean, cov, centered):
    p = x.shape[1]
    mean, cov = (np.zeros(p), cov + np.outer(mean, mean)) if centered else (mean, cov)
    d = np.einsum("ij,jk,ik->i", x - mean, np.linalg.inv(cov), x - mean)
    cov = cov * np.sort(d)[math.ceil(len(d) / 2) - 1] / robust.chi2_above(0.5, p)
    near = x[np.einsum("ij,jk,ik->i", x - mean, np.linalg.inv(cov), x - mean) <= robust.chi2_above(0.025, p)]
    return (mean, near.T @ near / len(near)) if centered else (near.mean(0), np.cov(near.T, bias=True))


@pytest.mark.parametrize(("centered", "support"), [(True, None), (False, None), (False, 0.7)])
def test_robust_envelope_against_numpy(spark, planted, centered, support):
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(planted)], "cell long, a double, b double").repartition(5)
    mean, cov = robust.minimum_covariance_determinant(df, ["a", "b"], centered, support)
    want_mean, want = plain_reweighted(planted, *plain_mcd(planted, support), centered)
    # least determinants lie within a ten-thousandth of each other here: which of them is found makes a row or two of difference
    assert np.allclose(mean, want_mean, atol=0.01) and np.allclose(cov, want, rtol=0.01, atol=0.01)
    out = change.elliptic_threshold(df, ["a", "b"], outliers=0.25, centered=centered, support_fraction=support)
    changed = {r.cell for r in out.where("changed").collect()}
    assert set(range(0, 2000, 5)) <= changed and len(changed) == 500


def test_one_start_from_all_rows_fails_here(planted):
    mean, cov = np.zeros(2), planted.T @ planted / 2000
    for _ in range(100):
        d = np.einsum("ij,jk,ik->i", planted - mean, np.linalg.inv(cov), planted - mean)
        near = planted[np.argsort(d)[:1001]]
        cov = near.T @ near / 1001
    best = plain_mcd(planted)[1]
    assert np.linalg.det(cov) > 1.2 * np.linalg.det(best)


def test_elliptic_no_data_and_odd_rows(spark):
    random = np.random.default_rng(1)
    rows = [(i, *map(float, random.normal(size=2))) for i in range(200)] + [(200, -99.0, 0.0), (201, None, 1.0), (202, 50.0, 50.0), (203, float("nan"), 0.0)]
    out = {r.cell: r.changed for r in change.elliptic_threshold(spark.createDataFrame(rows, "cell long, a double, b double"), ["a", "b"], no_data=-99.0).collect()}
    assert out[200] is None and out[201] is False and out[203] is False and out[202] is True
    same = spark.createDataFrame([(i, 1.0, 1.0) for i in range(20)], "cell long, a double, b double")
    assert change.elliptic_threshold(same, ["a", "b"]).where("changed").isEmpty()
    with pytest.raises(ValueError):
        change.elliptic_threshold(same.limit(2), ["a", "b"])


def test_matched_change_job(spark):
    """With `match` an even brightening is no change; without it all cells change."""
    random = np.random.default_rng(6)
    rows = [(i, i // 10, i % 10, float(v), float(v + 40 + (30 if i < 3 else 0)), 1) for i, v in enumerate(random.permutation(100))]
    p = spark.createDataFrame(rows, "cell long, row int, col int, pre double, post double, code int").cache()
    after = p.select("row", "col", F.lit(2).alias("code"))
    sizes = []
    for match in (False, True):
        objects, _ = workflows.detect_and_classify_change(p, ["pre"], ["post"], p.select("row", "col", "code"), after, threshold=20.0, match=match)
        sizes.append(objects.agg(F.sum("area")).first()[0])
    assert sizes[0] == 100 and sizes[1] < 20
