"""Exact dedup by a log-structured merge index of text digests.

Batches of documents are gathered in memtables (a map-side aggregation by digest) and flushed as
sorted runs, Parquet files ordered by digest. Compaction merges the runs by digest; it keeps one identifier
(the smallest unless asked otherwise) and a count: what the index has is the result. Digests with more
than one row are hits. A filter of the hits (a Bloom filter of bounded size, in segments by the digest's first
bits) picks the texts that may be hits, and these alone are moved and verified by their bytes; where texts of one
digest differ, their groups are formed by the texts themselves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import salt_of, scratch_path, text_of, with_salts, written

#: Bits of a filter for each digest, and the most that a filter has (16 MB): beyond it, it lets more texts pass, never fewer.
BITS_EACH, MOST_BITS = 12, 1 << 27

#: Bits in a segment of a filter, and bits set for a digest.
SEGMENT, PROBES = 1 << 19, 4


def _places(digests: list[str], segments: int) -> tuple[np.ndarray, np.ndarray]:
    """The segment of each digest and its bits there (rows of PROBES)."""
    words = np.array([[int(d[i : i + 15], 16) if d[i : i + 15] else 0 for i in (0, 15, 30)] for d in digests], np.uint64).reshape(-1, 3)
    step = words[:, 2] | np.uint64(1)
    bits = (words[:, 1, None] + np.arange(PROBES, dtype=np.uint64) * step[:, None]) % np.uint64(SEGMENT)
    return (words[:, 0] % np.uint64(segments)).astype(np.int64), bits.astype(np.int64)


def build_filter(digests: DataFrame, count: int) -> list[bytes]:
    """The filter of a table's digests (`count` of them): its segments. Tasks set bits, segments merge, and the bounded whole is fetched."""
    segments = min(MOST_BITS // SEGMENT, max(1, -(-count * BITS_EACH // SEGMENT)))

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            segment, places = _places(batch.column("digest").to_pylist(), segments)
            for k in np.unique(segment).tolist():
                held.setdefault(k, np.zeros(SEGMENT, bool))[places[segment == k].ravel()] = True
        for k, own in held.items():
            yield pa.RecordBatch.from_pydict({"segment": pa.array([k], pa.int32()), "bits": pa.array([np.packbits(own).tobytes()], pa.binary())})

    def merged(rows: pd.DataFrame) -> pd.DataFrame:
        own = np.bitwise_or.reduce([np.frombuffer(b, np.uint8) for b in rows["bits"]])
        return pd.DataFrame({"segment": rows["segment"].iloc[:1], "bits": [own.tobytes()]})

    schema = "segment int, bits binary"
    # Digests are dealt by segment first, so that a task holds few segments.
    dealt = digests.select("digest", F.substring("digest", 1, 15).alias("part")).repartition("part").select("digest")
    parts = dealt.mapInArrow(bits, schema).groupBy("segment").applyInPandas(merged, schema)
    out = [bytes(SEGMENT // 8)] * segments
    for r in parts.collect():
        out[r.segment] = bytes(r.bits)
    return out


def may_hold(digest: Column, segments: list[bytes]) -> Column:
    """Whether a digest may be among a filter's: false is certain."""

    @F.pandas_udf("boolean")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        table = np.frombuffer(b"".join(segments), np.uint8)
        for digests in batches:
            segment, places = _places(digests.tolist(), len(segments))
            at = segment[:, None] * SEGMENT + places
            yield pd.Series((table[at >> 3] >> (7 - (at & 7)) & 1).all(1), dtype=bool)

    return run(digest)


class DigestIndex:
    """A log-structured index from digest to (kept identifier, rows), in a folder that all executors share.

    `keep` is "smallest" or "largest"; a null identifier is kept only where there is no other. `fan_in` is the number of runs of a
    level at which `flush` compacts them into one of the next.
    """

    SCHEMA = "digest string, keep_id long, n long"

    def __init__(self, spark: SparkSession, path: str | None = None, keep: str = "smallest", fan_in: int = 4):
        if keep not in ("smallest", "largest"):
            raise ValueError(f"keep must be smallest or largest, not {keep!r}")
        self.spark, self.keep, self.fan_in = spark, keep, fan_in
        self.path = path or scratch_path(spark, "digest-index")
        self.levels: list[list[str]] = [[]]
        self._made = 0

    @property
    def runs(self) -> list[str]:
        return [run for level in self.levels for run in level]

    def _best(self, column: str) -> Column:
        return F.min(column) if self.keep == "smallest" else F.max(column)

    def _write(self, entries: DataFrame, level: int) -> None:
        self._made += 1
        run = f"{self.path}/level{level}-run{self._made}"
        (
            entries.select("digest", "keep_id", "n")
            .repartitionByRange("digest")
            .sortWithinPartitions("digest")
            .write.option("parquet.bloom.filter.enabled#digest", "true")
            .option("parquet.bloom.filter.adaptive.enabled", "true")  # as large as a file's digests ask for
            .parquet(run)
        )
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(run)

    def flush(self, digests: DataFrame) -> None:
        """Flush the memtables of a batch `(doc_id, digest)` as one sorted run; full levels are compacted."""
        self._write(digests.groupBy("digest").agg(self._best("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("n")), 0)
        level = 0
        while len(self.levels[level]) >= self.fan_in:
            self._merge(self.levels[level], level + 1)
            self.levels[level] = []
            level += 1

    def _read(self, runs: list[str]) -> DataFrame:
        if not runs:
            return self.spark.createDataFrame([], self.SCHEMA)
        rows = self.spark.read.schema(self.SCHEMA).parquet(*runs)
        return rows if len(runs) == 1 else rows.groupBy("digest").agg(self._best("keep_id").alias("keep_id"), F.sum("n").alias("n"))

    def _merge(self, runs: list[str], level: int) -> None:
        self._write(self._read(runs), level)

    def entries(self) -> DataFrame:
        """All entries, runs merged on read."""
        return self._read(self.runs)

    def compact(self) -> None:
        """Merge all runs into one of the last level."""
        runs, last = self.runs, len(self.levels)
        if len(runs) > 1:
            self.levels = [[]]
            self._merge(runs, last)

    def lookup(self, digests: list[str]) -> DataFrame:
        """Entries of a few digests; the filters of the runs' files skip files and row groups without them."""
        return self.entries().where(F.col("digest").isin(digests))


def exact_duplicates(docs: DataFrame, keep: str = "smallest", batches: int = 4, digest_chars: int = 64) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when their bytes are; a null text counts as empty. Rows that repeat a doc_id with the same text count each and
    share the decision. A null doc_id is never kept where there is another; rows of a group that has no other are all kept, with a
    null keep_id. An empty table gives an empty result. Other columns are not read. `digest_chars` shortens the index's key (tests
    provoke collisions with it); byte verification splits texts whose keys collide, so the result does not depend on it.
    """
    spark = docs.sparkSession
    sha = F.sha2(text_of(), 256)
    digests = written(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), sha.alias("text_sha256")), "digests"
    ).withColumn("digest", F.substring("text_sha256", 1, digest_chars))

    index = DigestIndex(spark, keep=keep)
    for batch in range(batches):
        index.flush(digests.where(salt_of("doc_id", ways=batches) == batch))
    index.compact()
    hits = written(index.entries().where("n > 1"), "hits")

    # Byte verification: texts that the filter lets pass are dealt by digest, equal ones combined on the map side first, so
    # that a task holds one copy of a text, not all its copies. A digest with two texts is a collision.
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("body"), sha.alias("text_sha256"))
    texts = texts.withColumn("digest", F.substring("text_sha256", 1, digest_chars))
    passed = texts.where(may_hold(F.col("digest"), build_filter(hits, hits.count())))
    bodies = passed.groupBy("digest", "body").agg(F.lit(1).alias("one"))
    collided = written(bodies.groupBy("digest").agg(F.count(F.lit(1)).alias("texts")).where("texts > 1").select("digest"), "collided")

    found = digests.withColumn("salt", salt_of("doc_id")).join(with_salts(hits), ["digest", "salt"], "left")
    row = ("doc_id", "keep_id", F.coalesce("n", F.lit(1)).cast("long").alias("group_size"), "text_sha256")
    one = F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id")
    found = found.select("digest", "doc_id", one, "n", "text_sha256")
    if collided.isEmpty():
        out = found.select(*row)
    else:
        # Of collided digests the texts themselves are the groups.
        best = F.min("doc_id") if keep == "smallest" else F.max("doc_id")
        own = texts.join(collided, "digest")
        groups = own.groupBy("digest", "body").agg(best.alias("keep_id"), F.count(F.lit(1)).alias("n"))
        out = found.join(collided, "digest", "left_anti").select(*row).unionByName(own.join(groups, ["digest", "body"]).select(*row))
    return out.select("doc_id", "keep_id", "group_size", F.col("keep_id").eqNullSafe(F.col("doc_id")).alias("kept"), "text_sha256")
