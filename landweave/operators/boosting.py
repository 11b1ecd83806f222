"""Gradient boosting of classes by histograms: trees grown best leaf first or to a depth, with L1 and L2 terms, under the softmax loss.

Features become bins once, by quantiles that merge over partitions. A round fits one tree for each class, all of them in the same
passes over the rows. A pass sums gradients by (class, node, feature, bin) inside the tasks and over them; of two siblings the smaller
one is summed and the other is what is left of their parent. Only the best split of each node reaches the driver.

Gradients are rounded to whole multiples of 1 / `UNIT`, so that sums, and with them the trees, do not depend on how rows are dealt.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from landweave.operators.regions import forget, written

UNIT = 1 << 20

#: Histogram cells that a task holds at once (of three sums each); more nodes take more passes.
CELLS = 4_000_000

_HISTOGRAM = "tree int, node int, feature int, bin int, g long, h long, n long"


@dataclass
class Tree:
    """Nodes as arrays: feature (-1 for a leaf), the bin up to which rows go left, the left child (the right one follows it), and a leaf's value."""

    feature: list[int] = field(default_factory=lambda: [-1])
    bin: list[int] = field(default_factory=lambda: [0])
    child: list[int] = field(default_factory=lambda: [0])
    value: list[float] = field(default_factory=lambda: [0.0])

    def add_children(self, node: int, feature: int, last: int) -> int:
        self.feature[node], self.bin[node], self.child[node] = feature, last, len(self.feature)
        for column, v in ((self.feature, -1), (self.bin, 0), (self.child, 0), (self.value, 0.0)):
            column += [v, v]
        return self.child[node]

    def leaf_of(self, bins: np.ndarray) -> np.ndarray:
        """The leaf that each row of bins comes to."""
        feature, last, child = np.array(self.feature), np.array(self.bin), np.array(self.child)
        at, rows = np.zeros(len(bins), np.int64), np.arange(len(bins))
        while (inner := feature[at] >= 0).any():
            right = bins[rows, np.maximum(feature[at], 0)] > last[at]
            at = np.where(inner, child[at] + right, at)
        return at


def to_bins(x: np.ndarray, cuts: Sequence[np.ndarray]) -> np.ndarray:
    """Bins of rows of features: 0 where there is no value, else 1 more than the number of cuts below it."""
    out = np.zeros(x.shape, np.uint8)
    for f, c in enumerate(cuts):
        out[:, f] = np.where(np.isnan(x[:, f]), 0, 1 + np.searchsorted(c, x[:, f], "left"))
    return out


def softmax(margins: np.ndarray) -> np.ndarray:
    e = np.exp(margins - margins.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def gradients(margins: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and second derivatives of the loss by row and class, in whole multiples of 1 / UNIT; the second is doubled and at least one."""
    p = softmax(margins)
    g = p - (label[:, None] == np.arange(margins.shape[1]))
    return np.rint(g * UNIT), np.maximum(np.rint(2 * p * (1 - p) * UNIT), 1)


class BoostedModel:
    """An encoder of features, the cuts of its columns, and rounds of one tree for each class."""

    def __init__(self, encoder: PipelineModel, cuts: list[np.ndarray], classes: int, rounds: list[list[Tree]]):
        self.encoder, self.cuts, self.classes, self.rounds = encoder, cuts, classes, rounds

    def margins(self, bins: np.ndarray) -> np.ndarray:
        out = np.zeros((len(bins), self.classes))
        for trees in self.rounds:
            for k, tree in enumerate(trees):
                out[:, k] += np.array(tree.value)[tree.leaf_of(bins)]
        return out

    def transform(self, rows: DataFrame) -> DataFrame:
        """The rows with `probabilities` (array) and `prediction`, the first class of the largest."""
        cuts, classes, rounds = self.cuts, self.classes, self.rounds

        @F.pandas_udf("array<double>")
        def shares(features: pd.Series) -> pd.Series:
            if not len(features):
                return pd.Series([], dtype=object)
            model = BoostedModel(None, cuts, classes, rounds)
            return pd.Series(list(softmax(model.margins(to_bins(np.stack(features.to_numpy()).astype(float), cuts)))))

        out = self.encoder.transform(rows).withColumn("probabilities", shares(vector_to_array("__features")))
        best = F.array_position("probabilities", F.array_max("probabilities")) - 1
        return out.select(*[F.col(f"`{c}`") for c in rows.columns], "probabilities", best.cast("double").alias("prediction"))

    def save(self, path: str) -> None:
        spark = SparkSession.active()
        self.encoder.write().save(f"{path}/encoder")
        text = json.dumps({"classes": self.classes, "cuts": [c.tolist() for c in self.cuts], "rounds": [[t.__dict__ for t in trees] for trees in self.rounds]})
        spark.createDataFrame([(text,)], "boosted string").write.text(f"{path}/boosted")

    @classmethod
    def load(cls, path: str) -> BoostedModel:
        text = json.loads(SparkSession.active().read.text(f"{path}/boosted").first()[0])
        return cls(PipelineModel.load(f"{path}/encoder"), [np.array(c) for c in text["cuts"]], text["classes"], [[Tree(**t) for t in trees] for trees in text["rounds"]])


def quantile_cuts(features: DataFrame, column: str, bins: int) -> list[np.ndarray]:
    """At most bins - 2 cuts of each feature of an array column, at about equal shares of its values."""
    shares = F.array(*[F.lit(i / (bins - 1)) for i in range(1, bins - 1)])
    each = features.select(F.posexplode(column).alias("f", "x")).where(F.col("x").isNotNull() & ~F.isnan("x"))
    found = dict(each.groupBy("f").agg(F.percentile_approx("x", shares, F.lit(100 * bins)).alias("cuts")).collect())  # a row for each feature
    size = features.select(F.size(column)).first()[0]
    return [np.unique(np.array(found.get(f, []), float)) for f in range(size)]


@dataclass
class _Split:
    gain: float
    feature: int
    last: int
    left: tuple[int, int, int]  # g, h and n of the left child
    right: tuple[int, int, int]


def _histograms(state: DataFrame, trees: list[Tree], wanted: list[tuple[int, int]], features: int, bins: int) -> DataFrame:
    """Sums of the wanted leaves (tree, node) of growing trees by feature and bin."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots = [np.full(len(t.feature), -1) for t in trees]
        for slot, (k, node) in enumerate(wanted):
            slots[k][node] = slot
        used = sorted({k for k, _ in wanted})
        sums = np.zeros((3, len(wanted) * features * bins))
        for batch in batches:
            if not batch.num_rows:
                continue
            x, label, margins = _arrays(batch, features)
            g, h = gradients(margins, label)
            for k in used:
                slot = slots[k][trees[k].leaf_of(x)]
                rows = np.flatnonzero(slot >= 0)
                for f in range(features):
                    at = (slot[rows] * features + f) * bins + x[rows, f]
                    for row, weight in zip(sums, (g[rows, k], h[rows, k], None), strict=True):
                        row += np.bincount(at, weight, sums.shape[1])
        at = np.flatnonzero(sums[2])
        slot, rest = np.divmod(at, features * bins)
        names = np.array(wanted).reshape(-1, 2)[slot]
        columns = [names[:, 0], names[:, 1], rest // bins, rest % bins, *sums[:, at]]
        yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int32 if i < 4 else np.int64)) for i, c in enumerate(columns)], ["tree", "node", "feature", "bin", "g", "h", "n"])

    return state.mapInArrow(run, _HISTOGRAM)


def _arrays(batch: pa.RecordBatch, features: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    x = np.frombuffer(b"".join(batch.column("bins").to_pylist()), np.uint8).reshape(-1, features)
    return x, batch.column("label").to_numpy(), batch.column("margins").flatten().to_numpy().reshape(len(x), -1)


def _summed(histograms: DataFrame) -> DataFrame:
    return histograms.groupBy("tree", "node", "feature", "bin").agg(*[F.sum(c).cast("long").alias(c) for c in ("g", "h", "n")])


def score(g, h, l1: float, l2: float):
    """What a leaf takes off the loss, twice: numbers, arrays or columns."""
    if isinstance(g, (int, float, np.ndarray)):
        cut = np.sign(g) * np.maximum(np.abs(g) - l1, 0.0)
    else:
        cut = F.signum(g) * F.greatest(F.abs(g) - l1, F.lit(0.0))
    return cut * cut / (h + l2)


def _best_splits(histograms: DataFrame, l1: float, l2: float, gamma: float, least_weight: float, least_rows: int) -> dict[tuple[int, int], _Split]:
    """The best split of each node that has one of positive gain; of equal ones that of the first feature and bin. A row for each node reaches the driver."""
    upto = W.partitionBy("tree", "node", "feature").orderBy("bin").rowsBetween(W.unboundedPreceding, 0)
    whole = W.partitionBy("tree", "node", "feature")
    sums = histograms.select("tree", "node", "feature", "bin", *[F.sum(c).over(upto).alias(f"{c}l") for c in "ghn"], *[F.sum(c).over(whole).alias(f"{c}t") for c in "ghn"])
    sums = sums.withColumns({f"{c}r": F.col(f"{c}t") - F.col(f"{c}l") for c in "ghn"})
    s = lambda side: score(F.col(f"g{side}") / float(UNIT), F.col(f"h{side}") / float(UNIT), l1, l2)
    allowed = sums.where((F.col("nl") >= least_rows) & (F.col("nr") >= least_rows) & (F.col("hl") >= least_weight * UNIT) & (F.col("hr") >= least_weight * UNIT))
    gain = allowed.withColumn("gain", (s("l") + s("r") - s("t")) / 2 - gamma).where("gain > 0")
    best = gain.groupBy("tree", "node").agg(F.min(F.struct((-F.col("gain")).alias("gain"), "feature", "bin", "gl", "hl", "nl", "gr", "hr", "nr")).alias("b"))
    return {(r.tree, r.node): _Split(-r.b.gain, r.b.feature, r.b.bin, (r.b.gl, r.b.hl, r.b.nl), (r.b.gr, r.b.hr, r.b.nr)) for r in best.collect()}


def _grow(state: DataFrame, classes: int, features: int, bins: int, depth: int, leaves: int | None, l1: float, l2: float, gamma: float, least_weight: float, least_rows: int) -> tuple[list[Tree], list[dict[int, tuple[int, int, int]]]]:
    """A tree for each class, and the sums of its nodes.

    The best leaf is split first until there are `leaves` of them. As many leaves as may still be split are opened in one pass, so that
    passes grow with a tree's depth, not with its leaves; what was opened in vain is closed at the end.
    """
    spark = state.sparkSession
    grown = [Tree() for _ in range(classes)]
    levels = [{0: 0} for _ in range(classes)]
    sums: list[dict[int, tuple[int, int, int]]] = [{} for _ in range(classes)]
    splits: dict[tuple[int, int], _Split] = {}
    passes: list[DataFrame] = []
    wanted: list[tuple[int, int, int | None, int | None]] = [(k, 0, None, None) for k in range(classes)]  # tree, node, its larger sibling, their parent
    final: list[Tree | None] = [None] * classes
    while wanted:
        room = max(1, CELLS // (features * bins))
        parts = [_histograms(state, grown, [w[:2] for w in wanted[i : i + room]], features, bins) for i in range(0, len(wanted), room)]
        made = parts[0]
        for p in parts[1:]:
            made = made.unionByName(p)
        made = _summed(made)
        links = [(k, node, node, 1) for k, node, _, _ in wanted] + [(k, node, other, -1) for k, node, other, _ in wanted if other is not None]
        to = F.broadcast(spark.createDataFrame(links, "tree int, node int, to int, sign int"))  # two rows for each node
        signed = made.join(to, ["tree", "node"]).select("tree", F.col("to").alias("node"), "feature", "bin", *[(F.col(c) * F.col("sign")).alias(c) for c in "ghn"])
        parents = [(k, parent, other) for k, _, other, parent in wanted if other is not None]
        for table in passes if parents else []:
            old = F.broadcast(spark.createDataFrame(parents, "tree int, node int, to int"))
            signed = signed.unionByName(table.join(old, ["tree", "node"]).select("tree", F.col("to").alias("node"), "feature", "bin", "g", "h", "n"))
        passes.append(written(_summed(signed).where("n > 0"), "histograms"))
        splits |= _best_splits(passes[-1], l1, l2, gamma, least_weight, least_rows)
        if not sums[0]:
            totals = passes[-1].where("feature = 0").groupBy("tree").agg(F.sum("g"), F.sum("h"), F.sum("n"))
            for k, *total in totals.collect():
                sums[k][0] = tuple(total)
        wanted = []
        for k in range(classes):
            if final[k] is None:
                final[k], asked = _best_first(grown[k], k, levels[k], sums[k], splits, depth, leaves)
                wanted += asked
    for table in passes:
        forget(table)
    return final, sums


def _best_first(tree: Tree, k: int, level: dict[int, int], sums: dict[int, tuple[int, int, int]], splits: dict[tuple[int, int], _Split], depth: int, leaves: int | None) -> tuple[Tree | None, list]:
    """The finished tree, or the nodes whose histograms must be known first; `tree` is opened on the way."""
    kept, count = set(), 1
    heap = [(-splits[k, 0].gain, 0)] if (k, 0) in splits and depth > 0 else []
    asked = []

    def open_(node: int) -> None:
        s = splits[k, node]
        left = tree.add_children(node, s.feature, s.last)
        for child, total in ((left, s.left), (left + 1, s.right)):
            level[child], sums[child] = level[node] + 1, total
        if level[left] < depth:
            small, large = (left, left + 1) if s.left[2] <= s.right[2] else (left + 1, left)
            asked.append((k, small, large, node))

    while heap and (leaves is None or count < leaves):
        _, node = heapq.heappop(heap)
        if tree.feature[node] < 0:
            more = leaves - count if leaves is not None else len(heap) + 2
            if more > 1:  # open this one and those that may come after it
                for _, other in heapq.nsmallest(more, [(-splits[k, node].gain, node), *heap]):
                    if tree.feature[other] < 0:
                        open_(other)
                if asked:
                    return None, asked
            else:
                open_(node)
        kept.add(node)
        count += 1
        for child in (tree.child[node], tree.child[node] + 1):
            if (k, child) in splits and level[child] < depth:
                heapq.heappush(heap, (-splits[k, child].gain, child))
    return _closed(tree, kept, sums), []


def _closed(tree: Tree, kept: set[int], sums: dict[int, tuple[int, int, int]]) -> Tree:
    """The tree without the nodes below its last kept splits; `sums` become those of the new nodes."""
    out, names, todo = Tree(), {0: 0}, [0]
    while todo:
        node = todo.pop(0)
        if node in kept:
            left = out.add_children(names[node], tree.feature[node], tree.bin[node])
            for i in (0, 1):
                names[tree.child[node] + i] = left + i
                todo.append(tree.child[node] + i)
    new = {names[n]: s for n, s in sums.items() if n in names}
    sums.clear()
    sums.update(new)
    return out


def _moved(state: DataFrame, trees: list[Tree], features: int) -> DataFrame:
    """The rows with their margins after a round."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, _, margins = _arrays(batch, features)
                margins = margins + np.stack([np.array(t.value)[t.leaf_of(x)] for t in trees], 1)
                lists = pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * len(trees), margins.reshape(-1))
                yield pa.RecordBatch.from_arrays([batch.column("bins"), batch.column("label"), lists], ["bins", "label", "margins"])

    return state.mapInArrow(run, "bins binary, label int, margins array<double>")


def fit(rows: DataFrame, encoder: PipelineModel, label: str, rounds: int, depth: int, leaves: int | None, step: float, l1: float, l2: float, gamma: float, least_weight: float, least_rows: int, bins: int) -> BoostedModel:
    """Boosted trees of rows whose labels are class numbers from 0; rows without a label are left out. A missing value lies before all others."""
    if not 2 < bins <= 256 or (leaves is not None and leaves < 2):
        raise ValueError("bins must be from 3 to 256, leaves 2 or more")
    encoded = encoder.transform(rows.where(F.col(label).isNotNull())).select(vector_to_array("__features").alias("x"), F.col(label).cast("double").alias("label"))
    encoded = written(encoded, "encoded")
    facts = encoded.agg(F.max("label"), F.max((F.col("label") != F.floor("label")) | (F.col("label") < 0))).first()
    if facts[0] is None or facts[1]:
        raise ValueError("labels must be class numbers from 0, and there must be rows")
    classes = int(facts[0]) + 1
    cuts = quantile_cuts(encoded, "x", bins)
    features = len(cuts)

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                raw = [r.tobytes() for r in to_bins(x, cuts)]
                margins = pa.ListArray.from_arrays(np.arange(len(raw) + 1, dtype=np.int32) * classes, np.zeros(len(raw) * classes))
                yield pa.RecordBatch.from_arrays([pa.array(raw, pa.binary()), pa.array(batch.column("label").to_numpy().astype(np.int32)), margins], ["bins", "label", "margins"])

    state = written(encoded.mapInArrow(binned, "bins binary, label int, margins array<double>"), "boosting")
    forget(encoded)
    model = BoostedModel(encoder, cuts, classes, [])
    for i in range(rounds):
        trees, sums = _grow(state, classes, features, bins, depth, leaves, l1, l2, gamma, least_weight, least_rows)
        for tree, total in zip(trees, sums, strict=True):
            for node, f in enumerate(tree.feature):
                if f < 0:
                    g, h = (v / UNIT for v in total[node][:2])
                    tree.value[node] = float(-step * np.sign(g) * max(abs(g) - l1, 0.0) / (h + l2))
        model.rounds.append(trees)
        if i + 1 < rounds:
            new = written(_moved(state, trees, features), "boosting")
            forget(state)
            state = new
    forget(state)
    return model
