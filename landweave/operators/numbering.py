"""Sequence numbers over a whole table without one task holding it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from landweave.operators.regions import written


def sequential(df: DataFrame, order: str, name: str = "seq", first: int = 0) -> DataFrame:
    """The rows numbered in the order of a unique column: range partitions are sorted, counted, and offset by the counts before them."""
    ranged = df.repartitionByRange(order).withColumn("__part", F.spark_partition_id())
    turn = F.row_number().over(W.partitionBy("__part").orderBy(order))
    numbered = written(ranged.withColumn("__turn", turn), "numbered")
    counts = numbered.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    before = F.coalesce(F.sum("__n").over(W.orderBy("__part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.select("__part", before.alias("__before"))  # a row for each range partition
    numbered = numbered.join(F.broadcast(offsets), "__part")
    return numbered.withColumn(name, F.col("__before") + F.col("__turn") + (first - 1)).drop("__part", "__turn", "__before")
