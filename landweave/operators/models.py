"""Models on rows: sampling, outliers, classifiers, predictions with their confidence."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, OneVsRest, RandomForestClassifier
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from landweave.operators import boosting
from landweave.operators.regions import written


def sample_exact(rows: DataFrame, share: float, tile: Sequence[str], key: str = "id", seed: int = 42) -> DataFrame:
    """floor(share * n) rows of each tile, the same on reruns; all rows unless 0 < share < 1."""
    if not 0 < share < 1:
        return rows
    turn = F.row_number().over(W.partitionBy(*tile).orderBy(F.xxhash64(F.col(key), F.lit(seed)), key))
    counted = rows.groupBy(*tile).agg(F.floor(F.count(F.lit(1)) * share).alias("__most"))
    return rows.withColumn("__turn", turn).join(counted, list(tile)).where("__turn <= __most").select(*rows.columns)


def _encoded(features: Sequence[str], categorical: Sequence[str]) -> list:
    """Stages that one-hot encode the categorical features and assemble all; an unknown category is an error."""
    stages = [s for c in categorical for s in (StringIndexer(inputCol=c, outputCol=f"__{c}_index", handleInvalid="error"), OneHotEncoder(inputCol=f"__{c}_index", outputCol=f"__{c}_hot", dropLast=False))]
    return [*stages, VectorAssembler(inputCols=[f"__{c}_hot" if c in categorical else c for c in features], outputCol="__features")]


def one_hot(rows: DataFrame, categorical: Sequence[str]) -> PipelineModel:
    """The encoder of categorical features, fitted once and used again when predicting; it adds `__features`."""
    return Pipeline(stages=_encoded(categorical, categorical)).fit(rows)


def fit_rf(rows: DataFrame, features: Sequence[str], label: str = "label", categorical: Sequence[str] = (), trees: int = 50, depth: int = 10, seed: int = 42) -> PipelineModel:
    """A random forest; labels are class numbers from 0."""
    forest = RandomForestClassifier(featuresCol="__features", labelCol=label, numTrees=trees, maxDepth=depth, seed=seed, predictionCol="prediction")
    return Pipeline(stages=[*_encoded(features, categorical), forest]).fit(rows)


def fit_boosted(rows: DataFrame, features: Sequence[str], label: str = "label", categorical: Sequence[str] = (), rounds: int = 50, depth: int = 10, step: float = 0.1, gamma: float = 0.0, seed: int = 42, **other: float) -> PipelineModel:
    """Boosted trees, one model for each class against the rest. L1 and L2 terms are not to be had and are refused."""
    if other:
        raise ValueError(f"no parameters {sorted(other)}")
    trees = GBTClassifier(maxIter=rounds, maxDepth=depth, stepSize=step, minInfoGain=gamma, seed=seed)
    rest = OneVsRest(classifier=trees, featuresCol="__features", labelCol=label, predictionCol="prediction", rawPredictionCol="rawPrediction")
    return Pipeline(stages=[*_encoded(features, categorical), rest]).fit(rows)


def _encoder(rows: DataFrame, features: Sequence[str], categorical: Sequence[str]) -> PipelineModel:
    """As `_encoded`, but a missing number stays missing."""
    *stages, assembler = _encoded(features, categorical)
    return Pipeline(stages=[*stages, assembler.setHandleInvalid("keep")]).fit(rows)


def fit_leafwise(rows: DataFrame, features: Sequence[str], label: str = "label", categorical: Sequence[str] = (), rounds: int = 50, depth: int = 30, leaves: int = 31, step: float = 0.1, l1: float = 0.0, l2: float = 0.0, least_weight: float = 1e-3, least_rows: int = 20, bins: int = 255) -> boosting.BoostedModel:
    """Boosted trees that split their best leaf next, up to so many leaves, with L1 and L2 terms; softmax over the classes."""
    return boosting.fit(rows, _encoder(rows, features, categorical), label, rounds, depth, leaves, step, l1, l2, 0.0, least_weight, least_rows, bins)


def fit_softmax(rows: DataFrame, features: Sequence[str], label: str = "label", categorical: Sequence[str] = (), rounds: int = 50, depth: int = 10, step: float = 0.1, gamma: float = 0.0, l1: float = 0.0, l2: float = 1.0, least_weight: float = 1.0, least_rows: int = 1, bins: int = 256) -> boosting.BoostedModel:
    """Boosted trees grown to a depth, where a split must gain more than `gamma`; softmax over the classes."""
    return boosting.fit(rows, _encoder(rows, features, categorical), label, rounds, depth, None, step, l1, l2, gamma, least_weight, least_rows, bins)


def save(model: PipelineModel | boosting.BoostedModel, path: str) -> None:
    model.save(path)


def load(spark: SparkSession, path: str) -> PipelineModel | boosting.BoostedModel:
    """A saved model of either kind."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/boosted")
    return boosting.BoostedModel.load(path) if folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder) else PipelineModel.load(path)


def predict(model: PipelineModel | boosting.BoostedModel, rows: DataFrame) -> DataFrame:
    """The rows' columns with prediction (int) and confidence, the largest class probability.

    Margins of `fit_boosted` become probabilities by the logistic function and are normalised over the classes.
    """
    out = model.transform(rows)
    if "probabilities" in out.columns:
        shares = F.col("probabilities")
    elif "probability" in out.columns:
        shares = vector_to_array("probability")
    else:
        odds = F.transform(vector_to_array("rawPrediction"), lambda m: 1 / (1 + F.exp(-2 * m)))
        shares = F.transform(odds, lambda p: p / F.aggregate(odds, F.lit(0.0), lambda a, b: a + b))
    return out.select(*[F.col(f"`{c}`") for c in rows.columns], F.col("prediction").cast("int").alias("prediction"), F.array_max(shares).alias("confidence"))


def score(predicted: DataFrame, label: str = "label") -> DataFrame:
    """The share of labelled rows whose prediction is right."""
    return predicted.where(F.col(label).isNotNull()).agg(F.avg((F.col("prediction") == F.col(label)).cast("double")).alias("accuracy"))


def _usual_depth(n: np.ndarray | float) -> np.ndarray:
    """The mean depth of an unsuccessful search in a binary tree of n leaves."""
    n = np.asarray(n, float)
    return np.where(n > 2, 2 * (np.log(np.maximum(n - 1, 1)) + np.euler_gamma) - 2 * (n - 1) / np.maximum(n, 1), np.where(n == 2, 1.0, 0.0))


def _grown(x: np.ndarray, random: np.random.Generator, most: int) -> list[tuple[int, float, int, float]]:
    """An isolation tree: (feature or -1, cut, number of the left node, depth if a leaf); the right node follows the left one."""
    nodes: list = [None]
    todo = [(0, np.arange(len(x)), 0)]
    while todo:
        at, rows, depth = todo.pop()
        low, high = x[rows].min(0), x[rows].max(0)
        open_ = np.flatnonzero(high > low)
        if depth >= most or not len(open_):
            nodes[at] = (-1, 0.0, 0, depth + float(_usual_depth(len(rows))))
            continue
        f = int(random.choice(open_))
        cut = float(random.uniform(low[f], high[f]))
        left = x[rows, f] <= cut
        nodes[at] = (f, cut, len(nodes), 0.0)
        todo += [(len(nodes), rows[left], depth + 1), (len(nodes) + 1, rows[~left], depth + 1)]
        nodes += [None, None]
    return nodes


def remove_outliers(rows: DataFrame, features: Sequence[str], label: str = "label", key: str = "id", contamination: float = 0.1, trees: int = 100, sample: int = 256, seed: int = 42, together: int = 10) -> DataFrame:
    """The rows that an isolation forest of their class leaves: those not among the `contamination` share isolated soonest.

    Every row is scored, once, and carries its columns along. A tree grows from about `sample` rows of its class, drawn by a hash of the
    key, and `together` trees of a class in one task, so that a task holds no more; the forest has at most 2 * sample nodes for each class
    and tree. Labels may be of any type; rows without one go. A class keeps rows whose depth ties with its cut.
    """
    rows = rows.where(F.col(label).isNotNull())
    counts = rows.groupBy(label).agg(F.count(F.lit(1)).alias("__n"))
    draw = lambda t: F.pmod(F.xxhash64(F.col(key), t, F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)
    x = F.array(*[F.col(f).cast("double") for f in features]).alias("__x")
    drawn = (
        rows.select(F.col(label), F.col(key).cast("string").alias("__key"), F.col(key), x)
        .join(counts, label)
        .withColumn("__tree", F.explode(F.filter(F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: draw(t) < F.lit(float(sample)) / F.col("__n"))))
        .select(F.col(label).cast("string").alias("label"), "__key", "__x", "__tree", F.floor(F.col("__tree") / together).alias("__together"))
    )

    def grow(group: tuple, part: pd.DataFrame) -> pd.DataFrame:
        out = []
        for tree, own in part.groupby("__tree"):
            random = np.random.default_rng([seed, int(tree), *group[0].encode()])
            x = np.stack(own.sort_values("__key")["__x"].to_numpy())
            out.append((group[0], *map(list, zip(*_grown(x, random, int(np.ceil(np.log2(max(len(x), 2))))), strict=True))))
        return pd.DataFrame(out, columns=["label", "f", "cut", "child", "depth"])

    grown = drawn.groupBy("label", "__together").applyInPandas(grow, "label string, f array<int>, cut array<double>, child array<int>, depth array<double>")
    forest: dict[str, list[tuple[np.ndarray, ...]]] = {}
    for r in grown.toLocalIterator():
        forest.setdefault(r["label"], []).append((np.array(r["f"]), np.array(r["cut"]), np.array(r["child"]), np.array(r["depth"])))

    @F.pandas_udf("double")
    def depths(classes: pd.Series, features: pd.Series) -> pd.Series:
        x, total = np.stack(features.to_numpy()) if len(features) else np.zeros((0, 1)), np.zeros(len(features))
        for c in classes.unique():
            own = np.flatnonzero(classes.to_numpy() == c)
            for f, cut, child, depth in forest.get(c, []):
                at = np.zeros(len(own), int)
                while (inner := f[at] >= 0).any():
                    right = x[own, np.maximum(f[at], 0)] > cut[at]
                    at = np.where(inner, child[at] + right, at)
                total[own] += depth[at]
        return pd.Series(total)

    scored = written(rows.withColumn("__depth", depths(F.col(label).cast("string"), x)), "scored")
    cuts = scored.groupBy(F.col(label).alias("__label")).agg(F.percentile_approx("__depth", F.lit(contamination), F.lit(10_000)).alias("__cut"))
    return scored.join(cuts, F.col(label) == F.col("__label")).where("__depth >= __cut").select(*[F.col(f"`{c}`") for c in rows.columns])
