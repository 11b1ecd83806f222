"""Token ids in directly addressable code blocks.

A block holds the ids of some documents in doc_id order. Each id is split into chunks of 8 bits; level k
holds the k-th chunk of every id that has one, a bitmap tells which ids go on to the next level, and a
rank directory counts the set bits before every 512th. A chunk's place in the next level is the rank of
its bit, so that any id is read from its block without decoding others.

The file format is Parquet with one row for each block (`BLOCK`): Spark's writer commits whole files, a
lost executor's blocks are written again, and any reader of the store gets them back. Files are in
ascending doc_id order, as are the blocks in a file.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import scratch_path, small_enough, text_of, written
from .encoding import encoder, in_slices

BLOCK = "part int, block int, first_doc long, last_doc long, n_docs long, before long, n_tokens long, payload binary"

STEP = 512  # bits between two counts of a rank directory
#: Distinct units that a worker's encoder holds; this operator holds little else.
UNITS = 1_000_000
_HEAD = struct.Struct("<4sIII")
_MAGIC = b"DAC2"


def _bytes(values: np.ndarray, kind: str) -> bytes:
    return np.ascontiguousarray(values, kind).tobytes()


def pack_ids(ids: np.ndarray) -> bytes:
    """Directly addressable codes of ids: number of levels, then each level's length, chunks, bitmap and ranks."""
    rest, out = ids.astype(np.uint64), []
    while True:
        chunks, high = (rest & 255).astype(np.uint8), rest >> np.uint64(8)
        more = high > 0
        bits = np.packbits(more, bitorder="little")
        pad = np.zeros(-(-len(more) // STEP) * STEP, bool)
        pad[: len(more)] = more
        ranks = np.concatenate([[0], np.cumsum(pad.reshape(-1, STEP).sum(1))])
        out.append(struct.pack("<I", len(chunks)) + chunks.tobytes() + bits.tobytes() + _bytes(ranks, "<u4"))
        rest = high[more]
        if not len(rest):
            return struct.pack("<I", len(out)) + b"".join(out)


class Codes:
    """Reads `pack_ids` in place: `code[i]` walks the levels by rank, `all()` decodes in bulk."""

    def __init__(self, data: memoryview | bytes):
        self.levels = []
        (n,), at = struct.unpack_from("<I", data, 0), 4
        for _ in range(n):
            (size,) = struct.unpack_from("<I", data, at)
            at += 4
            chunks = np.frombuffer(data, np.uint8, size, at)
            at += size
            bits = np.frombuffer(data, np.uint8, -(-size // 8), at)
            at += len(bits)
            ranks = np.frombuffer(data, "<u4", -(-size // STEP) + 1, at)
            at += 4 * len(ranks)
            self.levels.append((chunks, bits, ranks))

    def __len__(self) -> int:
        return len(self.levels[0][0])

    def __getitem__(self, i: int) -> int:
        if not 0 <= i < len(self):
            raise IndexError(i)
        value, shift = 0, 0
        for chunks, bits, ranks in self.levels:
            value |= int(chunks[i]) << shift
            shift += 8
            if not bits[i >> 3] >> (i & 7) & 1:
                break
            begin = i // STEP * STEP
            own = np.unpackbits(bits[begin >> 3 : (i >> 3) + 1], bitorder="little")[: i - begin]
            i = int(ranks[i // STEP]) + int(own.sum())
        return value

    def all(self) -> np.ndarray:
        values: np.ndarray | None = None
        for chunks, bits, _ in reversed(self.levels):
            own = chunks.astype(np.uint32)
            if values is not None:
                own[np.unpackbits(bits, bitorder="little")[: len(own)].astype(bool)] |= values << 8
            values = own
        return values


def pack_block(doc_ids: np.ndarray, bounds: np.ndarray, ids: np.ndarray, nulls: int = 0) -> bytes:
    """A block: the documents' ids (the first `nulls` of them null), where their tokens begin, and the codes."""
    head = _HEAD.pack(_MAGIC, len(doc_ids), len(ids), nulls)
    return head + _bytes(doc_ids, "<i8") + _bytes(bounds, "<u4") + pack_ids(ids)


def open_block(data: bytes) -> tuple[pa.Array, np.ndarray, Codes]:
    """doc_ids, bounds (one more than documents) and codes of a block; token j of document i is codes[bounds[i] + j]."""
    magic, docs, _, nulls = _HEAD.unpack_from(data, 0)
    if magic != _MAGIC:
        raise ValueError("not a block of directly addressable codes")
    at = _HEAD.size
    doc_ids = pa.array(np.frombuffer(data, "<i8", docs, at), pa.int64(), mask=np.arange(docs) < nulls)
    bounds = np.frombuffer(data, "<u4", docs + 1, at + 8 * docs)
    return doc_ids, bounds, Codes(memoryview(data)[at + 8 * docs + 4 * (docs + 1) :])


def _with_end(ids: np.ndarray, bounds: np.ndarray, end_id: int | None) -> tuple[np.ndarray, np.ndarray]:
    if end_id is None:
        return ids, bounds
    return np.insert(ids, bounds[1:], end_id).astype(np.uint32), bounds + np.arange(len(bounds))


def _block_writer(path: str, end_id: int | None, block_tokens: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    schema = pa.schema([("block", pa.int32()), *[(c, pa.int64()) for c in ("first_doc", "last_doc", "n_docs", "before", "n_tokens")], ("payload", pa.binary())])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, made, before = encoder(path, UNITS), 0, 0
        held: list[tuple[pa.Array, np.ndarray, np.ndarray]] = []

        def flush() -> pa.RecordBatch:
            nonlocal made, before
            doc_ids = pa.concat_arrays([d for d, _, _ in held])
            bounds = np.concatenate([[0], np.cumsum(np.concatenate([np.diff(b) for _, b, _ in held]))])
            ids = np.concatenate([i for _, _, i in held])
            known = doc_ids.drop_null()  # null ids come first
            ends = (known[0].as_py(), known[-1].as_py()) if len(known) else (None, None)
            payload = pack_block(doc_ids.fill_null(0).to_numpy(), bounds, ids, doc_ids.null_count)
            row = [made, *ends, len(doc_ids), before, len(ids), payload]
            made, before = made + 1, before + len(ids)
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(row, schema, strict=True)], schema=schema)

        for batch in batches:
            texts, doc_ids = batch.column("text"), batch.column("doc_id")
            for a, b in in_slices(texts):
                ids, bounds = _with_end(*enc.encode(texts.slice(a, b - a)), end_id)
                held.append((doc_ids.slice(a, b - a), bounds, ids))
                if sum(len(i) for _, _, i in held) >= block_tokens:
                    yield flush()
        if held:
            yield flush()

    return write


def write_token_file(docs: DataFrame, out: str, tokenizer: str, end_id: int | None = 1, block_tokens: int = 1 << 18) -> None:
    """Encode every whole text, end each document with `end_id`, and write blocks in ascending doc_id order.

    A null or empty text is the end id alone. Rows that repeat a doc_id stay beside each other, ordered by text. Rows of
    null doc_id come before all others. An empty table gives an empty file.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    blocks = (
        rows.repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id", "text")
        .mapInArrow(_block_writer(tokenizer, end_id, block_tokens), BLOCK.replace("part int, ", ""))
    )
    blocks.select(F.spark_partition_id().alias("part"), "*").write.option("compression", "zstd").parquet(out)


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    """The blocks of a token file and `base`: the tokens of all blocks before. A block knows those of its own part; payloads stay put."""
    blocks = spark.read.schema(BLOCK).parquet(path)
    # One row for each part, however long its texts are: as many as there are tasks.
    parts = blocks.groupBy("part").agg(F.sum("n_tokens").alias("part_tokens"))
    ahead = F.sum("part_tokens").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1))
    parts = written(parts.select(F.col("part").alias("p"), F.coalesce(ahead, F.lit(0)).alias("part_base")), "part-bases")
    joined = blocks.join(small_enough(parts), F.col("part") == F.col("p"))
    return joined.withColumn("base", F.col("part_base") + F.col("before")).drop("p", "part_base")


def _summary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for base, payload in zip(batch.column("base").to_pylist(), batch.column("payload").to_pylist(), strict=True):
            doc_ids, bounds, codes = open_block(payload)
            raw = codes.all().astype("<u4").tobytes()
            crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
            starts = base + bounds.astype(np.int64)
            yield pa.RecordBatch.from_pydict({"doc_id": doc_ids, "start": starts[:-1], "n_tokens": np.diff(starts), "ids_crc32": np.array(crc, np.int64)})


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from the blocks' ids."""
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    return read_blocks(spark, path).select("base", "payload").mapInArrow(_summary, schema)


def tokens_at(spark: SparkSession, path: str, doc_id: int, places: list[int]) -> list[int]:
    """Some of a document's tokens, by random access: its block is found by its document range, no other is read."""
    rows = spark.read.schema(BLOCK).parquet(path).where((F.col("first_doc") <= doc_id) & (F.col("last_doc") >= doc_id))
    for row in rows.select("payload").toLocalIterator():
        doc_ids, bounds, codes = open_block(bytes(row.payload))
        own = np.flatnonzero(np.array([x == doc_id for x in doc_ids.to_pylist()]))
        if len(own):
            begin, end = int(bounds[own[0]]), int(bounds[own[0] + 1])
            return [codes[begin + p] for p in places if 0 <= p < end - begin]
    raise KeyError(doc_id)


def token_file(docs: DataFrame, tokenizer: str, end_id: int | None = 1) -> DataFrame:
    """Write a token file in the shared folder and read its documents back."""
    spark = docs.sparkSession
    path = scratch_path(spark, "tokens")
    write_token_file(docs, path, tokenizer, end_id)
    return read_documents(spark, path)
