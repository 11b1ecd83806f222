"""Small helpers that the corpus operators share: the shared scratch folder and text normalising."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows that a checked broadcast may hold; beyond it a plain join is used.
BROADCAST_ROWS = 100_000

#: Ways in which a hot key is dealt out where a join salts it.
SALTS = 16


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder that driver and executors share.

    The folder is `spark.checkpoint.dir`. Where that is unset one is made, if the executors are local; on a cluster that is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="landweave-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a table in the shared folder and read it again: lineage is cut, lost executors cost nothing."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_of(column: str = "text") -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def salt_of(*columns: str, ways: int = SALTS) -> Column:
    """A stable salt of a row."""
    return F.pmod(F.xxhash64(*columns), F.lit(ways)).cast("int")


def with_salts(df: DataFrame, ways: int = SALTS) -> DataFrame:
    """Every row once for each salt: the unique side of a salted join."""
    return df.withColumn("salt", F.explode(F.array(*[F.lit(i) for i in range(ways)])))


def small_enough(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Mark a written table for broadcast if its row count is within the bound, else leave the join to Spark."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
