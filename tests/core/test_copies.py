"""Tables with many copies of few geometries: each is tested once, and every row gets what its geometry has got."""

import pytest
from pyspark.sql import functions as F

from landweave.functions import geometry as G
from landweave.functions import raster as R
from landweave.operators import covers, spatial, workflows

COPIES = 20
LEFT, RIGHT = [(0, 0), (30, 0), (200, 200), (500, 0)], [(-5, -5), (10, 10), (35, 38), (230, 210), (240, 200), (900, 900)]


def square(x, y, w):
    return [[[{"x": float(a), "y": float(b)} for a, b in ((x, y), (x + w, y), (x + w, y + w), (x, y + w))]]]


def common(a, b):
    wide, high = (min(p + 40, q + 15) - max(p, q) for p, q in zip(a, b, strict=True))
    return float(max(wide, 0) * max(high, 0))


@pytest.fixture
def sides(spark, monkeypatch):
    """Squares with ids that run over all copies, and the numbers of shapes that are compared."""
    met, plain = [], covers.meeting
    monkeypatch.setattr(covers, "meeting", lambda a, b, *rest: met.append((a.count(), b.count())) or plain(a, b, *rest))
    made = [[(k * len(places) + i, square(*p, w), (k + i) % 3) for k in range(COPIES) for i, p in enumerate(places)] for places, w in ((LEFT, 40), (RIGHT, 15))]
    return *[spark.createDataFrame(rows, f"id int, geom {G.GEOMETRY}, class int") for rows in made], met


@pytest.mark.parametrize("areas", [spatial.overlap_area, spatial.box_overlap_area])
def test_areas_of_copies(sides, areas):
    left, right, met = sides
    want = {(i, j): common(a, b) for i, a in enumerate(LEFT * COPIES) for j, b in enumerate(RIGHT * COPIES) if common(a, b) > 0}
    found = areas(left, right, 50.0).select("l_id", "r_id", "weight").collect()
    assert len(found) == len(want) and {(r.l_id, r.r_id): r.weight for r in found} == want
    assert met == [(len(LEFT), len(RIGHT))]


def test_semi_join_of_copies(sides):
    left, right, met = sides
    found = [r.id for r in spatial.spatial_semi_join(right, left, 50.0).select("id").collect()]
    assert sorted(found) == [j for j, b in enumerate(RIGHT * COPIES) if any(all(q <= p + 40 and p <= q + 15 for p, q in zip(a, b, strict=True)) for a in LEFT)]  # a border counts
    assert met == [(len(RIGHT), len(LEFT))]


def test_first_relevant_of_copies(sides):
    left, right, met = sides
    want = {}
    for i, a in enumerate(LEFT * COPIES):
        for j, b in enumerate(RIGHT * COPIES):
            inside = all(p < q + 7.5 < p + 40 for p, q in zip(a, b, strict=True))
            if common(a, b) > 225 / 2 or (common(a, b) > 0 and inside):
                want[i] = (j, (j // len(RIGHT) + j % len(RIGHT)) % 3, common(a, b))
                break
    for areas in (spatial.common_areas, spatial.box_areas):
        found = spatial.first_relevant(left.select("id", "geom"), right, 50.0, areas).collect()
        assert len(found) == len(want) and {r.l_id: (r.r_id, r.r_class, r.weight) for r in found} == want
    assert met == [(len(LEFT), len(RIGHT))] * 2


def test_segments_of_copies(sides):
    left, right, met = sides
    cells = left.select("id", F.col("id").cast("double").alias("v"))
    rows = workflows.segment_workflow(left.select("id", "geom"), cells, ["v"], right, 50.0).collect()
    assert len(rows) == len(LEFT) * COPIES and sum(r["class"] is not None for r in rows) == 2 * COPIES  # (200, 200) and (0, 0) have a relevant one
    assert met == [(len(LEFT), len(RIGHT))]


def test_validation_of_copies(sides):
    left, right, met = sides
    klass = lambda n, i: (i // n + i % n) % 3
    pairs = [(common(a, b), klass(len(LEFT), i) == klass(len(RIGHT), j)) for i, a in enumerate(LEFT * COPIES) for j, b in enumerate(RIGHT * COPIES) if common(a, b) > 0]
    report = workflows.validate_map(left.drop("id"), right.drop("id"), 50.0).first()
    assert report.n_rows == len(pairs) and abs(report.overall - sum(w for w, same in pairs if same) / sum(w for w, _ in pairs)) < 1e-12
    assert met == [(len(LEFT), len(RIGHT))]


def test_whole_numbers_are_cut_to_themselves(spark):
    df = spark.createDataFrame([(749.9999999999999, 750), (-1e-13 - 2, -2), (2.9999, 2), (750.0000000000001, 750)], "v double, want int")
    assert all(r.got == r.want for r in df.select("want", R.null_to_nodata_int16(F.col("v")).alias("got")).collect())
