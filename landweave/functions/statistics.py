"""Statistics in two phases for `operators.userstats`; a user's module looks like this one."""

from __future__ import annotations

import numpy as np

from landweave.operators.userstats import Statistic


def _central(values: np.ndarray) -> list[float]:
    """Count, mean, and sums of the second, third and fourth powers of what lies beside it."""
    v = np.asarray(values, float)
    d = v - v.mean()
    return [float(len(v)), float(v.mean()), *[float((d**p).sum()) for p in (2, 3, 4)]]


def _joined(a: list[float], b: list[float]) -> list[float]:
    """`_central` of two lots of values from those of each."""
    if not a[0] or not b[0]:
        return a if a[0] else b
    n, d = a[0] + b[0], b[1] - a[1]
    p, q = a[0] / n, b[0] / n
    m2 = a[2] + b[2] + d * d * p * b[0]
    m3 = a[3] + b[3] + d**3 * p * b[0] * (p - q) + 3 * d * (p * b[2] - q * a[2])
    m4 = a[4] + b[4] + d**4 * p * b[0] * (p * p - p * q + q * q) + 6 * d * d * (p * p * b[2] + q * q * a[2]) + 4 * d * (p * b[3] - q * a[3])
    return [n, a[1] + d * q, m2, m3, m4]


def _of_moments(finish) -> Statistic:
    return Statistic(lambda: [0.0] * 5, lambda state, values: _joined(state, _central(values)), _joined, finish)


#: Of all values; None where there are none, NaN where they are all equal.
skewness = _of_moments(lambda s: None if not s[0] else float("nan") if s[2] <= 0 else s[0] ** 0.5 * s[3] / s[2] ** 1.5)
kurtosis = _of_moments(lambda s: None if not s[0] else float("nan") if s[2] <= 0 else s[0] * s[4] / s[2] ** 2 - 3)

#: Largest less least value.
spread = Statistic(
    list,
    lambda state, values: [min([*state[:1], float(np.min(values))]), max([*state[1:], float(np.max(values))])],
    lambda a, b: [min(a[0], b[0]), max(a[1], b[1])] if a and b else a or b,
    lambda state: state[1] - state[0] if state else None,
)


def _area(geoms: list) -> float:
    """Common sum of polygons' outer rings less their holes."""
    total = 0.0
    for polygon in (p for geom in geoms for p in geom):
        for i, ring in enumerate(polygon):
            x, y = np.array([[p["x"], p["y"]] for p in ring], float).T
            own = abs(float((x * np.roll(y, -1) - y * np.roll(x, -1)).sum())) / 2
            total += own if i == 0 else -own
    return total


#: Of geometries: the sum of their areas.
total_area = Statistic(lambda: [0.0], lambda state, geoms: [state[0] + _area(geoms)], lambda a, b: [a[0] + b[0]], lambda state: state[0])
