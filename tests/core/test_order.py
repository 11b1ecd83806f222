"""Percentiles of large groups against numpy."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from landweave.operators import change, order, spatial


@pytest.fixture(scope="module")
def rows(spark):
    """A group with most rows, ties, infinities and signs; small ones; a null group; one without values."""
    random = np.random.default_rng(5)
    made = [("hot", float(v), float(round(v))) for v in random.normal(0, 1, 3000) * 10.0 ** random.integers(-200, 200, 3000)]
    made += [("hot", math.inf, -0.0), ("hot", -math.inf, 0.0), ("hot", None, 1.0)]
    made += [(f"s{i % 7}", float(v), float(i)) for i, v in enumerate(random.normal(size=60))]
    made += [(None, float(i), 2.0) for i in range(300)] + [("void", None, None)] * 3
    return made, spark.createDataFrame(made, "g string, a double, b double").repartition(6).cache()


@pytest.mark.parametrize("held", [10, 100, 100_000])
def test_percentiles_against_numpy(rows, held, monkeypatch):
    made, df = rows
    monkeypatch.setattr(order, "HELD", held)
    shares = [0.0, 0.25, 0.5, 0.9, 1.0]
    got = {r.g: (r.a, r.b) for r in order.percentiles(df, ["g"], ["a", "b"], shares).collect()}
    assert set(got) == {g for g, _, _ in made}
    for g, found in got.items():
        for k in (0, 1):
            values = np.array([r[1 + k] for r in made if r[0] == g and r[1 + k] is not None])
            if len(values):
                want = [np.sort(values)[int(q * (len(values) - 1))] if q * (len(values) - 1) % 1 == 0 else np.percentile(values, 100 * q) for q in shares]
                assert np.allclose(found[k], want, rtol=1e-12), (g, k)
            else:
                assert found[k] is None
    one = order.percentiles(df.where("g = 'hot'"), [], ["b"], [0.5]).collect()
    assert one[0].b == [np.median([r[2] for r in made if r[0] == "hot"])]


def test_medians_of_zones_and_bins(spark, monkeypatch):
    random = np.random.default_rng(6)
    value = random.integers(-50, 50, (40, 30))
    cells = spark.createDataFrame([(r, c, float(value[r, c]), int(c % 3)) for r in range(40) for c in range(30)], "row int, col int, v double, k int")
    zones = cells.select("row", "col", F.when(F.col("row") < 30, 1).otherwise(F.col("row")).alias("feature_id"))
    results = []
    for held in (50, 100_000):
        monkeypatch.setattr(order, "HELD", held)
        single = spatial.zonal_stats(zones, cells, ["v", "k"], "median", categorical=["k"])
        multi = spatial.zonal_statistics_multi(zones, cells, ["v"], ["mean", "median", "maximum"])
        assert single.columns == ["feature_id", "v", "k"] and multi.columns == ["feature_id", "v_mean", "v_median", "v_maximum"]
        bins = change.optimal_bins(cells, "v", "freedman").first()[0]
        results.append((sorted(map(tuple, single.collect())), sorted(map(tuple, multi.collect())), bins))
    assert results[0] == results[1]
    assert results[0][0][0] == (1, float(np.median(value[:30])), 0)
    q = np.percentile(value, [25, 75])
    assert results[0][2] == math.ceil(np.ptp(value) / (2 * (q[1] - q[0]) * 1200 ** (-1 / 3)))
