"""Line dedup by the number of distinct sites that carry a line.

Each line's key is a digest of the trimmed line. A HyperLogLog sketch of the sites per key merges by
aggregation; keys whose estimate lies near the threshold are counted exactly. Lines on at least
`min_sites` sites are boilerplate: they stay where they occur first (smallest doc_id, then position)
and go everywhere else.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import salt_of, text_of, with_salts, written

#: The estimate's relative error at lg_k = 10 is about 3 %; keys outside this band are at least fifteen
#: standard errors from the threshold.
BAND = (0.5, 2.0)

TRIM = r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$"
WORD = r"[^\x20\x09-\x0D]+"


def _lines(docs: DataFrame, site: str, min_words: int) -> DataFrame:
    pos = docs.select(
        "doc_id",
        F.xxhash64(text_of()).alias("body"),
        F.coalesce(F.col(site), F.lit("")).alias("site"),
        F.posexplode(F.split(text_of(), "\n")).alias("pos", "line"),
    )
    key = F.regexp_replace("line", TRIM, "")
    return pos.where(F.col("line").rlike(rf"(?:{WORD}[\x20\x09-\x0D]+){{{min_words - 1}}}{WORD}")).select(
        F.unhex(F.md5(key)).alias("key"), "doc_id", "body", "pos", "site"
    )


def boilerplate(lines: DataFrame, min_sites: int, lg_k: int = 10) -> DataFrame:
    """Keys on at least `min_sites` sites, with their first place: key, first struct(doc_id, pos)."""
    place = F.min(F.struct("doc_id", "pos")).alias("first")
    sketched = written(
        lines.groupBy("key")
        .agg(F.hll_sketch_agg("site", lg_k).alias("sketch"), place)
        .withColumn("estimate", F.hll_sketch_estimate("sketch"))
        .where(F.col("estimate") >= BAND[0] * min_sites)
        .select("key", "first", "estimate"),
        "line-sketches",
    )
    near = sketched.where(F.col("estimate") < BAND[1] * min_sites)
    # Pairs are made distinct before they are counted, so that a hot line costs a row for each site and task.
    exact = (
        lines.select("key", "site", salt_of("doc_id").alias("salt"))
        .join(with_salts(near.select("key")), ["key", "salt"], "left_semi")
        .groupBy("key", "site")
        .agg(F.lit(1).alias("one"))
        .groupBy("key")
        .agg(F.count(F.lit(1)).alias("sites"))
        .where(F.col("sites") >= min_sites)
    )
    sure = sketched.where(F.col("estimate") >= BAND[1] * min_sites).select("key", "first")
    return sure.unionByName(near.join(exact, "key").select("key", "first"))


def remove_boilerplate(
    docs: DataFrame, min_sites: int = 10, site: str = "source", min_words: int = 3
) -> DataFrame:
    """The documents' columns, text without cross-site boilerplate, and `line_report` (n_lines, n_removed).

    A null text is empty (one empty line); a null site counts as the site ''. Lines of fewer than
    `min_words` words are never boilerplate. Repeated rows with one doc_id get the same result each.
    n_chars, where there is one, is that of the new text. No document is dropped: one whose lines
    all go has an empty text. An existing column named line_report is replaced.
    """
    lines = written(_lines(docs, site, min_words), "lines")
    flagged = boilerplate(lines, min_sites)
    drops = (
        lines.withColumn("salt", salt_of("doc_id"))
        .join(with_salts(flagged), ["key", "salt"])
        .where(~F.struct("doc_id", "pos").eqNullSafe(F.col("first")))
        .groupBy("doc_id", "body")
        .agg(F.collect_set("pos").alias("drop"))
        .select(F.col("doc_id").alias("drop_id"), F.col("body").alias("drop_body"), "drop")
    )
    columns = [c for c in docs.columns if c != "line_report"]
    own = docs.select(
        F.struct(*columns).alias("row"),
        F.col("doc_id").alias("row_id"),
        F.xxhash64(text_of()).alias("row_body"),
        F.split(text_of(), "\n").alias("parts"),
    )
    both = own.join(
        drops, F.col("row_id").eqNullSafe(F.col("drop_id")) & (F.col("row_body") == F.col("drop_body")), "left"
    )
    kept = F.array_except(F.sequence(F.lit(0), F.size("parts") - 1), F.col("drop"))
    text = F.when(F.col("drop").isNull(), F.coalesce(F.col("row.text"), F.lit(""))).otherwise(
        F.array_join(F.transform(kept, lambda i: F.get(F.col("parts"), i)), "\n")
    )
    out = both.select("row", "parts", "drop", text.alias("new_text"))
    return out.select(
        *[
            F.col("new_text").alias("text")
            if c == "text"
            else F.char_length("new_text").cast("long").alias("n_chars")
            if c == "n_chars"
            else F.col(f"row.`{c}`")
            for c in columns
        ],
        F.struct(
            F.size("parts").cast("long").alias("n_lines"),
            F.when(F.col("drop").isNull(), 0).otherwise(F.size("drop")).cast("long").alias("n_removed"),
        ).alias("line_report"),
    )
