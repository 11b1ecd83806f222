"""Boosted trees against the same trees grown in numpy."""

import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from landweave.operators import boosting, models, workflows

NAMES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def rows(spark):
    random = np.random.default_rng(3)
    x = random.normal(size=(900, 3))
    x[:, 2] = random.integers(0, 4, 900)
    y = (x[:, 0] + 0.3 * random.normal(size=900) > 0).astype(int) + (x[:, 1] * (x[:, 2] - 1.5) > 0.5)
    made = [(i, *map(float, r), int(k)) for i, (r, k) in enumerate(zip(x, y, strict=True))]
    made[5] = (5, None, *made[5][2:])
    return spark.createDataFrame(made, "id long, a double, b double, c double, label int").repartition(5).cache()


def plain_tree(bins, g, h, width, depth, leaves, l1, l2, gamma, least_weight, least_rows):
    """Grown leaf by leaf, each leaf's histogram from its own rows."""
    unit = boosting.UNIT
    tree, rows, level = boosting.Tree(), {0: np.arange(len(bins))}, {0: 0}

    def best(node):
        found = None
        for f in range(bins.shape[1]):
            at = bins[rows[node], f]
            gs, hs, ns = (np.cumsum(np.bincount(at, w, width)) for w in (g[rows[node]], h[rows[node]], None))
            for b in np.flatnonzero(np.bincount(at, minlength=width)):
                gl, hl, nl, gr, hr, nr = gs[b], hs[b], ns[b], gs[-1] - gs[b], hs[-1] - hs[b], ns[-1] - ns[b]
                if min(nl, nr) < least_rows or min(hl, hr) < least_weight * unit:
                    continue
                s = lambda p, q: boosting.score(float(p / unit), float(q / unit), l1, l2)
                gain = (s(gl, hl) + s(gr, hr) - s(gs[-1], hs[-1])) / 2 - gamma
                if gain > 0 and (found is None or (-gain, f, b) < found):
                    found = (-gain, f, b)
        return found

    open_ = {0: best(0)}
    while leaves is None or len(rows) < leaves:
        can = [(v[0], n) for n, v in open_.items() if v is not None and level[n] < depth]
        if not can:
            break
        node = min(can)[1]
        _, f, b = open_.pop(node)
        left = tree.add_children(node, f, int(b))
        own = rows.pop(node)
        goes = bins[own, f] <= b
        for child, part in ((left, own[goes]), (left + 1, own[~goes])):
            rows[child], level[child] = part, level[node] + 1
            open_[child] = best(child)
    for node, own in rows.items():
        total, weight = g[own].sum() / unit, h[own].sum() / unit
        tree.value[node] = float(-0.1 * np.sign(total) * max(abs(total) - l1, 0.0) / (weight + l2))
    return tree


def shape(tree, node=0):
    """A tree without the numbers of its nodes."""
    if tree.feature[node] < 0:
        return round(tree.value[node], 12)
    return tree.feature[node], tree.bin[node], shape(tree, tree.child[node]), shape(tree, tree.child[node] + 1)


@pytest.mark.parametrize("kind", ["leafwise", "softmax"])
def test_trees_are_those_of_plain_boosting(rows, kind):
    options = {"leafwise": dict(depth=6, leaves=7, l1=0.5, l2=0.2, least_weight=1e-3, least_rows=20), "softmax": dict(depth=3, l1=0.0, l2=1.0, gamma=0.1, least_weight=1.0, least_rows=1)}[kind]
    fit = models.fit_leafwise if kind == "leafwise" else models.fit_softmax
    model = fit(rows, NAMES, rounds=2, bins=16, **options)
    held = rows.orderBy("id").toPandas()
    bins = boosting.to_bins(held[NAMES].to_numpy(float), model.cuts)
    margins = np.zeros((len(held), 3))
    for trees in model.rounds:
        g, h = boosting.gradients(margins, held["label"].to_numpy())
        want = [plain_tree(bins, g[:, k], h[:, k], 16, **{"leaves": None, "gamma": 0.0, **options}) for k in range(3)]
        assert [shape(t) for t in trees] == [shape(t) for t in want]
        margins += np.stack([np.array(t.value)[t.leaf_of(bins)] for t in want], 1)
    out = models.predict(model, rows).orderBy("id").toPandas()
    assert (out["prediction"] == margins.argmax(1)).all() and np.allclose(out["confidence"], boosting.softmax(margins).max(1))


def test_boosting_learns_by_name_and_is_stored(spark, rows):
    model = workflows.fit_model("leafwise", rows.where("id % 3 > 0"), NAMES, "label", categorical=["c"], rounds=4, leaves=8, step=0.5)
    out = models.predict(model, rows.where("id % 3 = 0"))
    assert models.score(out).first()[0] > 0.8
    path = tempfile.mkdtemp(prefix="spark-") + "/m"
    models.save(model, path)
    again = models.predict(models.load(spark, path), rows.where("id % 3 = 0"))
    assert sorted(again.select("id", "prediction", "confidence").collect()) == sorted(out.select("id", "prediction", "confidence").collect())


def test_boosting_of_odd_rows(spark, rows):
    one = spark.createDataFrame([(1.0, 0), (2.0, 0), (None, 0)], "a double, label int")
    out = models.predict(models.fit_leafwise(one, ["a"], rounds=1), one).collect()
    assert [(r["prediction"], r["confidence"]) for r in out] == [(0, 1.0)] * 3
    for bad in (one.where("a > 5"), one.withColumn("label", F.lit(-1)), one.withColumn("label", F.lit(0.5))):
        with pytest.raises(ValueError):
            models.fit_leafwise(bad, ["a"])
