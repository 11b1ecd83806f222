"""Pairs of shapes are made where they are used: neither moved nor stored, and measured many at once."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from landweave.functions import geometry as G
from landweave.operators import covers, spatial, workflows
from landweave.sources import vectors


def geom(*rings):
    return [[[{"x": float(x), "y": float(y)} for x, y in ring] for ring in rings]]


def square(x, y, w):
    return geom([(x, y), (x + w, y), (x + w, y + w), (x, y + w)])


@pytest.fixture(scope="module")
def sides(spark):
    """Squares at different places, some on borders of cells; none repeats, so that there are more pairs than shapes."""
    random = np.random.default_rng(5)
    rows = lambda n, w: [(i, square(*random.integers(0, 40, 2) * 5, w), i % 3) for i in range(n)]
    schema = f"id int, geom {G.GEOMETRY}, class int"
    return spark.createDataFrame(rows(40, 40), schema), spark.createDataFrame(rows(60, 15), schema)


@pytest.fixture
def stored(monkeypatch):
    """Names of the tables that are written."""
    names = []
    for module in (spatial, covers, workflows.regions):
        plain = module.written
        monkeypatch.setattr(module, "written", lambda df, name, plain=plain: names.append(name) or plain(df, name))
    return names


def box(g):
    points = g[0][0]
    return points[0]["x"], points[0]["y"], points[2]["x"], points[2]["y"]


def shared(a, b):
    a, b = box(a), box(b)
    return min(a[2], b[2]) - max(a[0], b[0]), min(a[3], b[3]) - max(a[1], b[1])


@pytest.mark.parametrize("held", [200, 3])
@pytest.mark.parametrize("areas", [spatial.overlap_area, spatial.box_overlap_area])
def test_pairs_are_neither_moved_nor_stored(sides, stored, monkeypatch, areas, held):
    monkeypatch.setattr(spatial, "HELD", held)
    left, right = sides[0].unionByName(sides[0].withColumn("id", F.col("id") + 1000)), sides[1]
    found = areas(left, right, 25.0).select("l_id", "r_id", "weight")
    plan = found._jdf.queryExecution().executedPlan().toString().split("Join")
    assert "Exchange" not in plan[0] and stored == ["shapes", "shapes"]
    rows = [[(r.id, r.geom) for r in s.collect()] for s in (left, right)]
    want = {(i, j): w * h for i, a in rows[0] for j, b in rows[1] for w, h in (shared(a, b),) if w > 0 and h > 0}
    got = found.collect()
    assert len(got) == len(want) and {(r.l_id, r.r_id): r.weight for r in got} == want


def test_validation_stores_no_pairs(sides, stored):
    left, right = sides
    rows = [[(r.geom, r["class"]) for r in s.collect()] for s in (left, right)]
    want = [(w * h, p == q) for a, p in rows[0] for b, q in rows[1] for w, h in (shared(a, b),) if w > 0 and h > 0]
    report = workflows.validate_map(left, right, 25.0).first()
    assert report.n_rows == len(want) and abs(report.overall - sum(w for w, same in want if same) / sum(w for w, _ in want)) < 1e-12
    assert "meeting" not in stored and stored.count("overlaps") == 1  # the sums by class


def test_segments_store_no_pairs(sides, stored):
    left, right = sides
    cells = left.select("id", F.lit(1.0).alias("v"))
    rows = workflows.segment_workflow(left.select("id", "geom"), cells, ["v"], right, 25.0).collect()
    assert len(rows) == 40 and any(r["class"] is not None for r in rows)
    assert "meeting" not in stored and "overlaps" not in stored


def test_semi_joins_store_no_pairs(sides, stored, spark):
    left, right = sides
    rows = [[(r.id, r.geom) for r in s.collect()] for s in (right, left.limit(6))]
    want = {i for i, a in rows[0] if any(min(shared(a, b)) >= 0 for _, b in rows[1])}
    few = left.limit(6).localCheckpoint()
    assert {r.id for r in spatial.spatial_semi_join(right, few, 25.0).collect()} == want
    kept, rejects = vectors.ingest_footprints(right.select(F.col("id").alias("path"), F.lit(1).alias("row"), "geom"), few, 25.0)
    assert kept.count() == len(want) and rejects.count() == 60 - len(want)
    assert "meeting" not in stored


def test_a_shape_is_tested_until_it_meets_one(spark):
    """All 400 pairs meet: a semi join stops at the first of each shape."""
    rows = lambda n: spark.createDataFrame([(i, square(i / 100, 0, 5)) for i in range(n)], f"key int, geom {G.GEOMETRY}")
    found = covers.meeting(rows(20), rows(20), 50.0, 64, (["geom"], ["geom"]), G.intersects(F.col("l_geom"), F.col("r_geom")))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "LeftSemi" in plan and found.distinct().count() == 20


def test_areas_of_convex_polygons(spark):
    random = np.random.default_rng(2)

    def polygon(n):
        angles = np.sort(random.uniform(0, 2 * np.pi, n)) * random.choice([-1, 1])
        return 5 * np.stack([np.cos(angles), np.sin(angles)], 1) + random.uniform(-5, 5, 2)

    edges = lambda p: np.hstack([p, np.roll(p, -1, 0)])
    concave = np.array([(0, 0), (3, 0), (3, 1), (1, 1), (1, 3), (0, 3)], float)
    pairs = [(polygon(random.integers(3, 12)), polygon(random.integers(3, 12))) for _ in range(300)] + [(concave, polygon(5)), (polygon(4), concave)]
    sides = [pa.array([edges(pair[k]).ravel().tolist() for pair in pairs], pa.list_(pa.float64())) for k in (0, 1)]
    forms = [spatial._form(s) for s in sides]
    assert [len(f) % 2 for f in forms[0].to_pylist()[-2:]] == [1, 0]
    want = np.array([spatial._common_area(edges(p), edges(q)) for p, q in pairs])
    assert np.abs(spatial._areas(*forms) - want).max() < 1e-9 and (want > 0).sum() > 100


def test_whole_numbers_that_touch_share_nothing():
    """A triangle's long edge through corners of squares: no area is left by rounding."""
    triangle = np.array([(0, 0), (40, 0), (0, 40)], float)
    for x in range(41):
        box = np.array([(x, 40 - x), (x + 15, 40 - x), (x + 15, 55 - x), (x, 55 - x)], float)
        for p, q in ((triangle, box), (box, triangle)):
            assert spatial._convex_areas(p[None], q[None])[0] == 0


@pytest.mark.parametrize("areas", [spatial.common_areas, spatial.box_areas])
def test_regions_without_a_relevant_polygon_stay(sides, areas):
    left, right = sides
    found = spatial.match_first_relevant(left.unionByName(left.limit(1).withColumns({"id": F.lit(99), "geom": F.lit(None)})).select("id", "geom"), right, 25.0, areas).collect()
    some = {r.l_id: r.r_id for r in spatial.first_relevant(left.select("id", "geom"), right, 25.0, areas).collect()}
    assert sorted(r.id for r in found) == [*range(40), 99] and 0 < len(some) < 41
    assert {r.id: r.r_id for r in found} == {i: some.get(i) for i in (*range(40), 99)}
    assert all((r.r_id is None) == (r.underseg is None) == (r.dmetric is None) for r in found)


def test_a_centre_in_a_polygon_that_is_only_touched(spark):
    """As the reference's Relevant: a region around a polygon shares its border, and has its centre there."""
    u = geom([(0, 0), (10, 0), (10, 10), (9, 10), (9, 1), (1, 1), (1, 10), (0, 10)])
    regions = spark.createDataFrame([(1, u), (2, geom([(50, 0), (51, 0), (51, 1)]))], f"id int, geom {G.GEOMETRY}")
    truth = spark.createDataFrame([(7, square(2, 2, 6)), (8, geom([(1, 1), (9, 1), (9, 10), (1, 10)]))], f"id int, geom {G.GEOMETRY}")  # the first does not touch it
    found = {r.id: (r.r_id, r.underseg, r.overseg) for r in spatial.match_first_relevant(regions, truth, 4.0).collect()}
    assert found == {1: (8, 1.0, 1.0), 2: (None, None, None)}
