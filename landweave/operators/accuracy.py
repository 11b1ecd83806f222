"""Area-weighted accuracy of maps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def confusion_matrix(rows: DataFrame, truth: str = "truth", pred: str = "pred", weight: str = "weight") -> DataFrame:
    """truth, pred and weight for every two labels, 0 where there are no rows. Classes are few."""
    sums = rows.groupBy(F.col(truth).alias("truth"), F.col(pred).alias("pred")).agg(F.sum(weight).alias("weight"))
    labels = sums.select(F.col("truth").alias("label")).union(sums.select("pred")).distinct()
    square = labels.select(F.col("label").alias("truth"), F.lit(1).alias("k")).join(labels.select(F.col("label").alias("pred"), F.lit(1).alias("k")), "k").drop("k")
    return square.join(sums, ["truth", "pred"], "left").withColumn("weight", F.coalesce("weight", F.lit(0)))


def accuracy(matrix: DataFrame) -> DataFrame:
    """label, producers, users and overall accuracy; 0 where there is nothing to divide by."""
    hit = F.when(F.col("truth") == F.col("pred"), F.col("weight")).otherwise(0)
    by_truth = matrix.groupBy(F.col("truth").alias("label")).agg(F.sum(hit).alias("tp"), F.sum("weight").alias("of_truth"))
    by_pred = matrix.groupBy(F.col("pred").alias("label")).agg(F.sum("weight").alias("of_pred"))
    total = matrix.agg(F.sum(hit).alias("right"), F.sum("weight").alias("all"))
    share = lambda a, b: F.coalesce(F.try_divide(F.col(a).cast("double"), F.col(b).cast("double")), F.lit(0.0))
    return by_truth.join(by_pred, "label").join(F.broadcast(total), F.lit(True)).select("label", share("tp", "of_truth").alias("producers"), share("tp", "of_pred").alias("users"), share("right", "all").alias("overall"))


def validation_report(rows: DataFrame, count: str | None = None) -> DataFrame:
    """One row: number of rows, overall accuracy, and the classes' figures as JSON. A row stands for as many as `count`, if given."""
    per = accuracy(confusion_matrix(rows))
    classes = F.to_json(F.sort_array(F.collect_list(F.struct("label", "producers", "users"))))
    n = F.count(F.lit(1)) if count is None else F.coalesce(F.sum(count), F.lit(0)).cast("long")
    return per.agg(F.first("overall").alias("overall"), classes.alias("classes")).join(F.broadcast(rows.agg(n.alias("n_rows"))), F.lit(True))
