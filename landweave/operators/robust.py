"""The minimum covariance determinant: location and covariance of the most concentrated share of the rows."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landweave.operators.moments import moments

#: Accuracy of the percentiles of distances: they are right to a share of 1 / CUTS of the rows.
CUTS = 100_000


def chi2_survival(z: float, dof: int) -> float:
    half, q, k = max(z, 0.0) / 2, 0.0, 2 - dof % 2
    q = math.erfc(math.sqrt(half)) if dof % 2 else math.exp(-half)
    while k < dof:
        q += math.exp(k / 2 * math.log(max(half, 1e-300)) - half - math.lgamma(k / 2 + 1))
        k += 2
    return q


def chi2_above(share: float, dof: int) -> float:
    """The value that chi squared exceeds with this probability."""
    low, high = 0.0, 10.0 * dof + 200
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if chi2_survival(middle, dof) > share else (low, middle)
    return (low + high) / 2


def _distances(x: np.ndarray, mean: np.ndarray, cov: np.ndarray) -> np.ndarray:
    d = x - mean
    return np.einsum("ij,jk,ik->i", d, np.linalg.pinv(cov), d)


def _estimate(x: np.ndarray, h: int, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    near = x[np.argpartition(d, h - 1)[:h]]
    return near.mean(0), np.cov(near.T, bias=True).reshape(x.shape[1], -1)


def _steps(x: np.ndarray, h: int, start: tuple[np.ndarray, np.ndarray], most: int) -> tuple[float, np.ndarray, np.ndarray]:
    """Concentration steps from an estimate: the h nearest rows give the next, until the determinant no longer falls."""
    mean, cov = start
    before = math.inf
    for _ in range(most):
        mean, cov = _estimate(x, h, _distances(x, mean, cov))
        det = float(np.linalg.det(cov))
        if not det < before * (1 - 1e-12):
            break
        before = det
    return float(np.linalg.det(cov)), mean, cov


def starts_of(sample: np.ndarray, share: float, starts: int, kept: int, seed: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """The best few estimates of a sample: random starts in fifths of it, the best of each in all of it, the best of these to the end."""
    random = np.random.default_rng(seed)
    p = sample.shape[1]
    parts = np.array_split(sample, 5) if len(sample) >= 500 else [sample]
    found = []
    for part in parts:
        h = min(len(part), max(p + 1, math.ceil(share * len(part))))
        tried = []
        for _ in range(math.ceil(starts / len(parts))):
            few = part[random.choice(len(part), min(len(part), p + 1), replace=False)]
            tried.append(_steps(part, h, (few.mean(0), np.cov(few.T, bias=True).reshape(p, -1)), 2))
        found += sorted(tried, key=lambda t: t[0])[:10]
    h = min(len(sample), max(p + 1, math.ceil(share * len(sample))))
    found = sorted((_steps(sample, h, t[1:], 2) for t in found), key=lambda t: t[0])[:10]
    found = sorted((_steps(sample, h, t[1:], 100) for t in found), key=lambda t: t[0])
    best: list[tuple[float, np.ndarray, np.ndarray]] = []
    for t in found:
        if all(not np.allclose(t[2], b[2], rtol=1e-6) for b in best):
            best.append(t)
    return [t[1:] for t in best[:kept]]


def distance(bands: Sequence[str], mean: np.ndarray, cov: np.ndarray) -> Column:
    """A row's squared distance."""
    inverse = np.linalg.pinv(cov)
    d = [F.col(b).cast("double") - F.lit(float(m)) for b, m in zip(bands, mean, strict=True)]
    return sum((F.lit(float(inverse[i, j])) * a * b for i, a in enumerate(d) for j, b in enumerate(d)), F.lit(0.0))


def minimum_covariance_determinant(rows: DataFrame, bands: Sequence[str], centered: bool = True, support_fraction: float | None = None, starts: int = 500, kept: int = 3, sample: int = 1500, rounds: int = 30, seed: int = 42) -> tuple[np.ndarray, np.ndarray]:
    """Location and covariance of rows that have all bands, reweighted.

    `starts` random starts are concentrated in a sample of at most `sample` rows, drawn in the order of a hash; the `kept` best of
    them go on over all rows, together, a step being two jobs. The least determinant wins. Its covariance is made consistent by the
    median distance, and rows within the 97.5 % quantile give the result. With `centered` the location is 0. `support_fraction` is the
    share of rows that is concentrated on, by default just over a half.
    """
    p = len(bands)
    n = rows.count()
    if n < p + 1:
        raise ValueError("too few rows")
    share = min(1.0, max(p + 1, math.ceil((n + p + 1) / 2) if support_fraction is None else int(support_fraction * n)) / n)
    order = F.xxhash64(*bands, F.lit(seed))
    drawn = rows.select(*[F.col(b).cast("double").alias(b) for b in bands]).orderBy(order, *bands).limit(sample)
    found = starts_of(np.array(drawn.collect(), float).reshape(-1, p), share, starts, kept, seed)

    def near(estimates: list[tuple[np.ndarray, np.ndarray]], cuts: list[float]):
        return moments(rows, bands, lambda x: np.stack([_distances(x, m, s) <= c * (1 + 1e-12) for (m, s), c in zip(estimates, cuts, strict=True)], 1).astype(float))

    def cuts_of(estimates: list[tuple[np.ndarray, np.ndarray]], q: float) -> list[float]:
        columns = [F.percentile_approx(distance(bands, *e), F.lit(q), F.lit(CUTS)) for e in estimates]
        return list(rows.agg(*columns).first())

    before = [math.inf] * len(found)
    for _ in range(rounds):
        found_moments = near(found, cuts_of(found, share))
        found = [(mean, co / total) for total, mean, co in found_moments]
        det = [float(np.linalg.det(s)) for _, s in found]
        if all(d >= b * (1 - 1e-9) for d, b in zip(det, before, strict=True)):
            break
        before = det
    mean, cov = min(found, key=lambda e: float(np.linalg.det(e[1])))
    if centered:
        mean, cov = np.zeros(p), cov + np.outer(mean, mean)
    middle = cuts_of([(mean, cov)], 0.5)[0]
    cov = cov * (middle / chi2_above(0.5, p))
    total, center, co = near([(mean, cov)], [chi2_above(0.025, p)])[0]
    return (mean, co / total + np.outer(center, center)) if centered else (center, co / total)
