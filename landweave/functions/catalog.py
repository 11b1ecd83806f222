"""Scene catalogue functions: names, dates, identifiers, scores of a scene."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The day from which the scan lines of mission 7 are incomplete.
SLC_FAILURE = dt.date(2003, 5, 31)
MISSION_PREFIX = {4: "LT04", 5: "LT05", 7: "LE07", 8: "LC08"}


def path_row_name(path: Column, row: Column) -> Column:
    return F.format_string("%03d%03d", path.cast("int"), row.cast("int"))


def mission_prefix(mission: int, default: str | None = None) -> str:
    if mission not in MISSION_PREFIX and default is None:
        raise ValueError(f"no mission {mission}")
    return MISSION_PREFIX.get(mission, default)


def _failed(mission: Column, acquired: Column) -> Column:
    return (mission == 7) & (acquired >= F.lit(SLC_FAILURE))


def scene_log_badness(cloud: Column, mission: Column, acquired: Column) -> Column:
    """Logarithm of the share of a scene that can't be used."""
    c = cloud.cast("double") / 100
    return F.log(F.when(_failed(mission, acquired), F.lit(0.5) + c - F.lit(0.5) * c).otherwise(c) + F.lit(1e-6))


def scene_good_surface(cloud: Column, mission: Column, acquired: Column) -> Column:
    """Share of a scene that can be used."""
    good = F.lit(1.0) - cloud.cast("double") / 100
    return F.when(_failed(mission, acquired), F.lit(0.5) * good).otherwise(good)


def mid_date(begin: Column, end: Column) -> Column:
    """The middle of a period."""
    return F.timestamp_micros(F.floor((F.unix_micros(begin.cast("timestamp")) + F.unix_micros(end.cast("timestamp"))) / 2).cast("long"))


def dataset_uuid(path: Column, namespace: uuid.UUID = uuid.NAMESPACE_URL) -> Column:
    """The version 5 UUID of a path."""
    digest = F.substring(F.sha1(F.concat(F.lit(bytearray(namespace.bytes)), path.cast("binary"))), 1, 32)
    variant = F.lower(F.hex(F.conv(F.substring(digest, 17, 2), 16, 10).cast("int").bitwiseAND(F.lit(0x3F)).bitwiseOR(F.lit(0x80)).cast("long")))
    return F.concat_ws(
        "-",
        F.substring(digest, 1, 8),
        F.substring(digest, 9, 4),
        F.concat(F.lit("5"), F.substring(digest, 14, 3)),
        F.concat(variant, F.substring(digest, 19, 2)),
        F.substring(digest, 21, 12),
    )


def hex_to_rgba(color: Column) -> Column:
    """array(r, g, b, 255) of a colour like #0a1b2c."""
    part = lambda i: F.conv(F.substring(F.ltrim(color), i, 2), 16, 10).cast("int")
    return F.array(part(2), part(4), part(6), F.lit(255))


def file_basename(path: Column, suffix: bool = True) -> Column:
    name = F.regexp_extract(path, "([^/]*)$", 1)
    return name if suffix else F.regexp_replace(name, r"(?<=.)\.[^.]*$", "")


def label_encoding(tags: DataFrame, scheme: str, inverse: bool = False) -> dict:
    """Label -> code of a scheme's tags (tag, scheme, value, code), or code -> label: a configured, small set."""
    rows = tags.where(F.col("scheme") == scheme).select("value", "code").collect()
    return {r["code"]: r["value"] for r in rows} if inverse else {r["value"]: r["code"] for r in rows}


def encode_labels(rows: DataFrame, tags: DataFrame, scheme: str, label: str = "label", code: str = "code") -> DataFrame:
    """The rows with the code of their label in a scheme; null where the scheme has no such label."""
    own = tags.where(F.col("scheme") == scheme).select(F.col("value").alias("__label"), F.col("code").alias("__code"))
    return rows.join(own, F.col(label) == F.col("__label"), "left").withColumn(code, F.col("__code")).drop("__label", "__code")


def scheme_of_set(objects: DataFrame, tags: DataFrame, name: str) -> DataFrame:
    """One row, scheme: that of the tags by which a set's objects (valid_set, tag) are labelled, the first in order."""
    return objects.where(F.col("valid_set") == name).join(tags, "tag").agg(F.min("scheme").alias("scheme"))
