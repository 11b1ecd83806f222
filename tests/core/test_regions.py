"""Regions by blocks, their borders, and segments of one piece, against flood fill."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from landweave.operators import regions, segments


def flood(value):
    """The smallest cell of each place's region; value: {(row, col): v}. Cells are row * 1000 + col."""
    seen = {}
    for start in sorted(value, key=lambda p: p[0] * 1000 + p[1]):
        stack = [start]
        while stack:
            p = stack.pop()
            if p in seen:
                continue
            seen[p] = start[0] * 1000 + start[1]
            r, c = p
            stack += [q for q in ((r + 1, c), (r - 1, c), (r, c + 1), (r, c - 1)) if q in value and value[q] is not None and value[q] == value[p]]
    return seen


@pytest.fixture(scope="module")
def grid():
    random = np.random.default_rng(2)
    value = {(r, c): int(random.integers(0, 2)) for r in range(-9, 14) for c in range(-5, 21) if random.random() < 0.95}
    for r in range(-9, 14):  # one region winds through all blocks
        for c in range(-5, 21):
            if r % 4 == 0 or (c == (20 if r % 8 < 4 else -5)):
                value[r, c] = 7
    value[3, 3] = value[3, 4] = None
    return value


def test_blocks_give_the_regions_of_a_flood(spark, grid):
    rows = [(r * 1000 + c, r, c, v, "x") for (r, c), v in grid.items()]
    df = spark.createDataFrame(rows, "cell long, row int, col int, v int, other string").repartition(4)
    for side in (4, 5, 256):
        got = regions.connected_regions(df, "v", side=side)
        assert got.columns == [*df.columns, "region"]
        assert {(r.row, r.col): r.region for r in got.collect()} == flood(grid)
    tiles = df.withColumn("t", F.col("col") >= 8).withColumn("v", F.coalesce("v", F.lit(-1)))
    halves = {k: flood({p: -1 if v is None else v for p, v in grid.items() if (p[1] >= 8) == k}) for k in (False, True)}
    assert {(r.row, r.col): r.region for r in regions.connected_regions(tiles, "v", ["t"], side=4).collect()} == halves[False] | halves[True]
    assert regions.connected_regions(df.where("false"), "v").count() == 0


def test_borders(spark, grid):
    want, names = {}, flood(grid)
    for r, c in grid:
        for q in ((r + 1, c), (r, c + 1)):
            if q in grid and names[q] != names[r, c]:
                key = max(names[q], names[r, c]), min(names[q], names[r, c])
                want[key] = want.get(key, 0) + 1
    df = spark.createDataFrame([(r * 1000 + c, r, c, names[r, c]) for r, c in grid], "cell long, row int, col int, region long").repartition(4)
    for side in (4, 256):
        assert {(r.a, r.b): r.length for r in regions.region_borders(df, side=side).collect()} == want


def test_small_regions_join_the_longest_border(spark):
    sizes = spark.createDataFrame([(1, 50), (2, 2), (3, 40), (4, 1), (5, 1), (6, 1)], "region long, n long")
    borders = spark.createDataFrame([(2, 1, 3), (3, 2, 5), (4, 3, 1), (5, 4, 4)], "a long, b long, length long")
    assert {r.region: r.root for r in regions.merge_small(sizes, borders, 3).collect()} == {1: 1, 2: 2, 3: 2, 4: 2, 5: 2, 6: 6}


@pytest.mark.parametrize("options", [{"step": 6}, {"n_segments": 20}])
def test_segments_are_of_one_piece(spark, options, monkeypatch):
    monkeypatch.setattr(segments, "SIDE", 12)
    random = np.random.default_rng(7)
    value = {(r, c): float((r // 9 + c // 7) % 3 + random.normal(0, 0.4)) for r in range(24) for c in range(30)}
    df = spark.createDataFrame([(r, c, v) for (r, c), v in value.items()] + [(50, 50, None)], "row int, col int, v double").repartition(4)
    found = {(r.row, r.col): r.segment for r in segments.segment_slic(df, ["v"], compactness=0.05, rounds=4, **options).collect()}
    assert set(found) == set(value)
    pieces = flood(found)
    count = {}
    for p, piece in pieces.items():
        count[piece] = count.get(piece, 0) + 1
    assert len(count) == len(set(found.values()))  # every segment one region
    assert 10 <= len(count) <= 40 and min(count.values()) >= 18
    assert all(found[p] == (piece // 1000 << 32) + piece % 1000 for p, piece in pieces.items())


def test_few_cells_take_few_buckets(spark, monkeypatch):
    monkeypatch.setattr(segments, "SIDE", 12)
    df = spark.createDataFrame([(r, c, float((r // 9 + c // 7) % 3)) for r in range(24) for c in range(30)], "row int, col int, v double")
    plans, bucketed, write = [], segments.written_in_buckets, segments.written
    monkeypatch.setattr(segments, "written", lambda d, name: (plans.append(d._jdf.queryExecution().executedPlan().toString()), write(d, name))[1])
    options = {"spark.sql.shuffle.partitions": "16", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in options}
    try:
        for size, most, moved in ((16_384, 1, [1, 1, 1]), (200, 4, [1, 2, 1])):
            for k, v in options.items():
                spark.conf.set(k, v)
            plans.clear()
            monkeypatch.setattr(segments, "BUCKET", size, raising=False)
            files = []
            monkeypatch.setattr(segments, "written_in_buckets", lambda *a, files=files: (found := bucketed(*a), files.extend(found.inputFiles()))[0])
            assert segments.segment_slic(df, ["v"], 6, rounds=2, connected=False).count() == 720
            assert len(files) <= most
            assert [p.count("Exchange ") for p in plans] == moved  # the blocks never
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_segments_want_a_size(spark):
    with pytest.raises(ValueError):
        segments.segment_slic(spark.createDataFrame([], "row int, col int, v double"), ["v"])


def test_blocks_in_buckets_stay_where_they_are(spark):
    blocks = regions.written_in_buckets(spark.range(500).selectExpr("cast(id % 9 as int) AS br", "cast(id % 7 as int) AS bc", "id").groupBy("br", "bc").agg(F.collect_list("id").alias("cells")), "blocks", ["br", "bc"])
    seeds = spark.range(900).selectExpr("cast(id % 9 as int) AS br", "cast(id % 7 as int) AS bc", "id AS at").groupBy("br", "bc").agg(F.collect_list("at").alias("seeds"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        met = blocks.join(seeds, ["br", "bc"])
        assert met._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1 and met.count() == 63
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    regions.forget(blocks)
