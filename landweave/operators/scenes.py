"""The scene catalogue: ingestion, counts, availability scores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landweave.functions import catalog as C


def ingest_catalog(rows: DataFrame, footprints: DataFrame) -> DataFrame:
    """Day scenes of known footprints from a scene list (path, row, dayOrNight, sceneID, acquisitionDate, clouds, corners)."""
    named = rows.withColumn("name", C.path_row_name(F.col("path"), F.col("row"))).where(F.lower("dayOrNight") == "day")
    known = footprints.select("name").distinct()
    return named.join(known, "name").select(
        "name",
        F.col("sceneID").alias("scene_id"),
        F.col("acquisitionDate").cast("timestamp").alias("acquired"),
        F.col("cloudCoverFull").cast("double").alias("cloud_cover"),
        F.col("CLOUD_COVER_LAND").cast("double").alias("cloud_cover_land"),
        F.col("upperLeftCornerLongitude").cast("double").alias("xmin"),
        F.col("lowerRightCornerLatitude").cast("double").alias("ymin"),
        F.col("lowerRightCornerLongitude").cast("double").alias("xmax"),
        F.col("upperLeftCornerLatitude").cast("double").alias("ymax"),
    )


def scene_counts(scenes: DataFrame, prefix: str, cloud_below: float = 20) -> DataFrame:
    """Scenes by footprint and year, of a mission's prefix and under a cloud limit, in order."""
    kept = scenes.where((F.col("cloud_cover_land") < cloud_below) & F.col("product").startswith(prefix))
    return kept.groupBy("name", F.year("acquired").alias("year")).agg(F.count(F.lit(1)).alias("n")).orderBy("name", "year")


def catalog_by_footprint(scenes: DataFrame, footprints: DataFrame, prefix: str, cloud_below: float = 20) -> DataFrame:
    """Every footprint with its counts by year as a map, and the first and last year of all."""
    counts = scene_counts(scenes, prefix, cloud_below)
    entries = F.sort_array(F.collect_list(F.struct("year", "n")))  # a few years for each footprint
    nested = counts.groupBy("name").agg(F.map_from_entries(entries).alias("years"))
    span = counts.agg(F.min("year").alias("min_year"), F.max("year").alias("max_year"))
    empty = F.map_from_arrays(F.array().cast("array<int>"), F.array().cast("array<bigint>"))
    return footprints.join(nested, "name", "left").withColumn("years", F.coalesce("years", empty)).join(F.broadcast(span), F.lit(True))  # one row


def _by_mission(scenes: DataFrame, cloud_below: float, missions: Sequence[int]) -> DataFrame:
    mission = F.coalesce(*[F.when(F.col("product").startswith(C.mission_prefix(m)), F.lit(m)) for m in missions])
    kept = scenes.where(F.col("cloud_cover") < cloud_below).withColumn("mission", mission).where(F.col("mission").isNotNull())
    c = F.col("cloud_cover_land")
    return kept.groupBy("name", F.year("acquired").alias("year"), "mission").agg(
        F.sum(C.scene_log_badness(c, F.col("mission"), F.col("acquired"))).alias("badness"),
        F.sum(C.scene_good_surface(c, F.col("mission"), F.col("acquired"))).alias("good"),
        F.count(F.lit(1)).alias("n"),
    )


def _over_years(scored: DataFrame, footprints: DataFrame, years: tuple[int, int]) -> DataFrame:
    spine = footprints.select("name", F.explode(F.sequence(F.lit(years[0]), F.lit(years[1]))).alias("year"))
    out = spine.join(scored, ["name", "year"], "left").withColumn("score", F.round(F.coalesce("score", F.lit(0.0)), 2))
    least = out.groupBy("name").agg(F.min("score").alias("min_score"))
    return out.join(least, "name")


def quality_score(scenes: DataFrame, footprints: DataFrame, cloud_below: float = 100, years: tuple[int, int] = (1990, 2017), missions: Sequence[int] = (5, 7, 8)) -> DataFrame:
    """Footprint x year: the sum over missions of (1 - product of unusable shares) times scenes; and the least over years."""
    by = _by_mission(scenes, cloud_below, missions)
    scored = by.groupBy("name", "year").agg(F.sum((1 - F.exp("badness")) * F.col("n")).alias("score"))
    return _over_years(scored, footprints, years)


def area_sum(scenes: DataFrame, footprints: DataFrame, cloud_below: float = 100, years: tuple[int, int] = (1990, 2017), missions: Sequence[int] = (5, 7, 8)) -> DataFrame:
    """Footprint x year: the sum of usable shares; and the least over years."""
    scored = _by_mission(scenes, cloud_below, missions).groupBy("name", "year").agg(F.sum("good").alias("score"))
    return _over_years(scored, footprints, years)


def score_matrix(scores: DataFrame, years: Sequence[int]) -> DataFrame:
    """Footprints down, years across."""
    wide = scores.groupBy("name").pivot("year", list(years)).agg(F.first("score"))
    return wide.withColumnsRenamed({str(y): f"y{y}" for y in years})
