"""Packing documents into sequences by shortest-pack-first over the histogram of lengths.

Documents are cut into pieces of the sequence length and a rest. Whole pieces are sequences of their own.
Rests are packed by their histogram alone: lengths from the longest to the shortest, each into the packs
that are shortest so far, as many at once as there are; what comes out is packing patterns and their
counts. Patterns are joined back to the rests by each rest's rank among those of its length.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import text_of, written
from .encoding import encoder, in_slices

SLOTS = 4096


def pack_histogram(counts: dict[int, int], size: int) -> list[tuple[tuple[int, ...], int]]:
    """(pattern, count): the lengths in a pack, longest first, and the number of packs like it.

    Lengths are placed longest first, each into the open packs with the most room; packs open when none has room. The
    work depends on the number of lengths and patterns, not on the number of documents.
    """
    room: dict[int, list[tuple[tuple[int, ...], int]]] = defaultdict(list)
    done: list[tuple[tuple[int, ...], int]] = []
    for length in sorted((x for x, n in counts.items() if n), reverse=True):
        left = counts[length]
        while left:
            most = max(room, default=-1)
            if most < length:
                fits = size // length
                whole, rest = divmod(left, fits)
                made = [((length,) * fits, whole)] if whole else []
                made += [((length,) * rest, 1)] if rest else []
                for pattern, n in made:
                    free = size - sum(pattern)
                    (room[free] if free else done).append((pattern, n))
                left = 0
                continue
            pattern, n = room[most].pop()
            if not room[most]:
                del room[most]
            used = min(n, left)
            if n > used:
                room[most].append((pattern, n - used))
            free = most - length
            (room[free] if free else done).append(((*pattern, length), used))
            left -= used
    return done + [x for packs in room.values() for x in packs]


def plan_rows(patterns: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, last rank, first sequence, offset): ranks of a length in turn go to a slot of a pattern's packs."""
    ranks: dict[int, int] = defaultdict(int)
    rows, sequence = [], 0
    for pattern, n in patterns:
        offset = 0
        for length in pattern:
            rows.append((length, ranks[length], ranks[length] + n - 1, sequence, offset))
            ranks[length] += n
            offset += length
        sequence += n
    return rows


def _measure(path: str, end_id: int, size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for batch in batches:
            texts, doc_ids = batch.column("text"), batch.column("doc_id")
            for a, b in in_slices(texts, 4_000_000):  # fewer, larger slices: a word is looked up once in each
                ids, bounds = enc.encode(texts.slice(a, b - a))
                raw = np.insert(ids, bounds[1:], end_id).astype("<u4").tobytes()
                bounds = bounds + np.arange(len(bounds))
                crcs = [[zlib.crc32(raw[4 * i : 4 * min(i + size, y)]) for i in range(x, y, size)] for x, y in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_pydict({"doc_id": doc_ids.slice(a, b - a), "doc_tokens": np.diff(bounds), "crcs": pa.array(crcs, pa.list_(pa.int64()))})

    return run


def _ranked(rows: DataFrame, by: list[str], weight: str, order: list[str]) -> DataFrame:
    """`rank`: the sum of `weight` over the rows of the group before this one. Groups are dealt to SLOTS windows each."""
    slot = W.partitionBy(*by, "slot")
    sums = rows.groupBy(*by, "slot").agg(F.sum(weight).alias("slot_sum"))
    over = W.partitionBy(*by).orderBy("slot") if by else W.orderBy("slot")
    before = F.coalesce(F.sum("slot_sum").over(over.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    sums = sums.select(*by, "slot", before.alias("slot_before"))
    inside = F.coalesce(F.sum(weight).over(slot.orderBy(*order).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    return rows.withColumn("inside", inside).join(sums, [*by, "slot"]).withColumn("rank", F.col("inside") + F.col("slot_before")).drop("inside", "slot_before")


def pack(docs: DataFrame, tokenizer: str, size: int = 1024, end_id: int = 0) -> DataFrame:
    """One row for each piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Whole texts are encoded and `end_id` ends each document, so that a null or empty text is one token. Sequences
    are numbered from 0: first those of whole pieces, then those of packed rests. Rows that repeat a doc_id are packed
    each. Other columns are not read. An empty table gives no rows.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    measured = written(
        texts.mapInArrow(_measure(tokenizer, end_id, size), "doc_id long, doc_tokens long, crcs array<long>"), "lengths"
    ).select(
        "*",
        F.expr(f"doc_tokens div {size}").alias("whole"),
        (F.col("doc_tokens") % size).alias("rest"),
        F.pmod(F.xxhash64("doc_id"), F.lit(SLOTS)).cast("int").alias("slot"),
    )
    order = ["doc_id", "doc_tokens", "crcs"]
    # At most `size` lengths come to the driver.
    counts = {r.rest: r.n for r in measured.where("rest > 0").groupBy("rest").agg(F.count(F.lit(1)).alias("n")).collect()}
    plan = plan_rows(pack_histogram(counts, size))
    first_rest = measured.agg(F.coalesce(F.sum("whole"), F.lit(0)).alias("first_rest"))

    wholes = (
        _ranked(measured.where("whole > 0"), [], "whole", order)
        .select("doc_id", "doc_tokens", "rank", F.posexplode(F.slice("crcs", F.lit(1), F.col("whole").cast("int"))).alias("k", "ids_crc32"))
        .select(
            "doc_id",
            (F.col("k").cast("long") * size).alias("start"),
            F.lit(size).cast("long").alias("length"),
            "ids_crc32",
            "doc_tokens",
            (F.col("rank") + F.col("k")).alias("sequence_id"),
            F.lit(0).cast("long").alias("offset"),
        )
    )
    schema = "p_length long, p_first long, p_last long, p_sequence long, p_offset long"
    patterns = spark.createDataFrame(plan, schema)  # patterns depend on the lengths that occur, not on the documents
    ranked = _ranked(measured.where("rest > 0").withColumn("one", F.lit(1).cast("long")), ["rest"], "one", order)
    rests = (
        ranked.join(F.broadcast(patterns), (F.col("rest") == F.col("p_length")) & F.col("rank").between(F.col("p_first"), F.col("p_last")))
        .crossJoin(F.broadcast(first_rest))  # one row
        .select(
            "doc_id",
            (F.col("doc_tokens") - F.col("rest")).alias("start"),
            F.col("rest").alias("length"),
            F.element_at("crcs", -1).alias("ids_crc32"),
            "doc_tokens",
            (F.col("first_rest") + F.col("p_sequence") + F.col("rank") - F.col("p_first")).alias("sequence_id"),
            F.col("p_offset").alias("offset"),
        )
    )
    return wholes.unionByName(rests)
