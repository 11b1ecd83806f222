"""Alignment of two tokenizers over a corpus: token groups, links and how sharply ids correspond.

Texts are shuffled whole, so that each distinct text is encoded and aligned once; counts of id pairs weigh a text by its copies, and
its measures are joined back to the documents by the text's digest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_of, written
from .encoding import _UNEVEN, Encoder, in_slices
from .pieces import PieceEncoder, ragged

#: At most so many id pairs (and, of them, so many texts) are singled out as frequent: those on more than one of so many rows.
FREQUENT = 100_000

MEASURES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


class SpacedEncoder(Encoder):
    """Encodes texts with a space before each; special tokens' strings are plain text. An empty text has no ids."""

    def __init__(self, path: str, most: int = 400_000):
        super().__init__(path, most)
        self.tokenizer.encode_special_tokens = True
        if self.drops_space:
            raise ValueError("a byte-level vocabulary is needed")
        inverse = {c: b for b, c in enumerate(_byte_signs())}
        raw: dict[int, bytes] = {}
        for token, i in self.tokenizer.get_vocab(with_added_tokens=False).items():
            raw[i] = bytes(inverse[c] for c in token)
        names = [raw.get(i, b"") for i in range(max(raw) + 1)]
        self.lengths = np.array([len(b) for b in names], np.int64)
        self.begins = np.cumsum(self.lengths) - self.lengths
        self.raw = np.frombuffer(b"".join(names), np.uint8)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if len(self.units) > self.most or self.used > 16 * self.most:
            self._forget()
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        blank = pa.scalar("", pa.large_string())
        empty = pc.equal(texts, blank).to_numpy(zero_copy_only=False)
        odd = pc.match_substring_regex(texts, _UNEVEN).to_numpy(zero_copy_only=False)
        # A unit is asked for with the space before it, a line's first with its newline.
        even = pc.if_else(pa.array(odd), blank, texts)
        lists = pc.split_pattern(pc.replace_substring(even, "\n", " \n"), " ")
        numbers = self._numbers(lists.flatten())
        counts = self.counts[numbers]
        first = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        counts[first[:-1][odd | empty]] = 0  # these have one empty unit
        ends = np.append(0, np.cumsum(counts))
        flat, bounds = self.ids[ragged(self.starts[numbers], counts)], ends[first]
        if not odd.any():
            return flat, bounds
        # Texts with uneven white space are encoded as they are.
        parts = [flat[a:b] for a, b in zip(bounds, bounds[1:], strict=False)]
        where = np.flatnonzero(odd)
        for i, ids in zip(where, self._plain([" " + t for t in texts.take(pa.array(where)).to_pylist()]), strict=True):
            parts[i] = ids
        return np.concatenate(parts), np.append(0, np.cumsum([len(x) for x in parts]))


def _byte_signs() -> list[str]:
    """The characters by which byte-level vocabularies write bytes: printable Latin-1 as itself, the others from U+0100 on in turn."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]


_encoders: dict[tuple[str, str], tuple[SpacedEncoder, PieceEncoder]] = {}


def encoders(a: str, b: str) -> tuple[SpacedEncoder, PieceEncoder]:
    """This worker's encoders of the two vocabularies."""
    if (a, b) not in _encoders:
        _encoders[a, b] = SpacedEncoder(a), PieceEncoder(b)
    return _encoders[a, b]


def _spelled(ids: np.ndarray, lengths: np.ndarray, starts: np.ndarray, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all ids, and where each id's end."""
    counts = lengths[ids]
    return raw[ragged(starts[ids], counts)], np.cumsum(counts)


def _same_as_text(bytes_: np.ndarray, ends: np.ndarray, bounds: np.ndarray, texts: list[bytes]) -> np.ndarray:
    """Whether each text's ids spell the text with a space before it."""
    at = np.append(0, ends)[bounds]
    return np.array([len(t) > 0 and y - x == len(t) + 1 and bytes_[x:y].tobytes() == b" " + t for x, y, t in zip(at[:-1], at[1:], texts, strict=True)], bool)


def _without(ids: np.ndarray, bounds: np.ndarray, kept: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    counts = np.diff(bounds)
    return ids[np.repeat(kept, counts)], np.append(0, np.cumsum(np.where(kept, counts, 0)))


class _Digits:
    """Decimal ids with a sign after each, as flat bytes."""

    def __init__(self, most: int):
        names = [str(i).encode() for i in range(most)]
        self.size = np.array([len(n) for n in names])
        self.table = np.zeros((most, self.size.max() + 1), np.uint8)
        for i, n in enumerate(names):
            self.table[i, : len(n)] = list(n)

    def joined(self, ids: np.ndarray, signs: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The bytes, and where each id's sign ends."""
        size = self.size[ids]
        rows = self.table[ids]
        rows[np.arange(len(ids)), size] = signs
        return rows[np.arange(rows.shape[1]) <= size[:, None]].tobytes(), np.cumsum(size + 1)


def align(texts: pa.Array, enc_a: SpacedEncoder, enc_b: PieceEncoder, digits: _Digits) -> dict[str, pa.Array]:
    """Of each text: counts of ids, groups and links, the groups' digest, and its distinct linked pairs (a << 32 | b) with their links.

    A link is a stretch of bytes between neighbouring ends of tokens of either side: just one token of each covers it.
    """
    raw_texts = pc.fill_null(texts.cast(pa.large_string()), "").cast(pa.large_binary()).to_pylist()
    sides = []
    for enc, lengths, starts, raw in ((enc_a, enc_a.lengths, enc_a.begins, enc_a.raw), (enc_b, enc_b.vocabulary.lengths, enc_b.vocabulary.starts, enc_b.vocabulary.raw)):
        ids, bounds = enc.encode(texts)
        ids = ids.astype(np.int64)
        sides.append((ids, bounds, *_spelled(ids, lengths, starts, raw)))
    kept = np.logical_and(*[_same_as_text(bytes_, ends, bounds, raw_texts) for _, bounds, bytes_, ends in sides])
    (a, at_a), (b, at_b) = (_without(ids, bounds, kept) for ids, bounds, _, _ in sides)
    end_a, end_b = np.cumsum(enc_a.lengths[a]), np.cumsum(enc_b.vocabulary.lengths[b])

    # All ends in turn, those of a first where both sides end: what lies before each is counted by running sums.
    every = np.concatenate([end_a, end_b])
    order = np.argsort(every, kind="stable")  # two sorted runs
    every, of_a = every[order], order < len(end_a)
    again = np.append(False, every[1:] == every[:-1]) if len(every) else np.zeros(0, bool)
    both, links = every[again], every[~again]  # ends of groups, among them those of all texts, and of links
    before_a = np.cumsum(of_a) - of_a
    link_a = before_a[~again]
    link_b = np.flatnonzero(~again) - link_a
    group = np.cumsum(again) - again
    group_a, group_b = group[of_a], group[~of_a]
    last_a, last_b = np.append(again[1:], False)[of_a], again[~of_a]
    n = len(kept)
    text_ends = np.append(0, end_a)[at_a]
    per_text = lambda ends: np.diff(np.searchsorted(ends, text_ends, "right"))

    # Groups as text: a group's ids of a, then of b, each with the sign that comes after it.
    count_a, count_b = np.bincount(group_a, minlength=len(both)), np.bincount(group_b, minlength=len(both))
    place_a = np.arange(len(a)) + (np.cumsum(count_b) - count_b)[group_a]
    place_b = np.arange(len(b)) + np.cumsum(count_a)[group_b]
    ids, signs = np.zeros(len(a) + len(b), np.int64), np.full(len(a) + len(b), ord(","), np.uint8)
    ids[place_a], ids[place_b] = a, b
    signs[place_a[last_a]], signs[place_b[last_b]] = ord("|"), ord(";")
    written_, ends = digits.joined(ids, signs)
    at = np.append(0, ends)[at_a + at_b]
    shas = [hashlib.sha256(written_[x : y - 1]).hexdigest() if y > x else "" for x, y in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]

    # Distinct pairs of each text: runs of sorted numbers of text, a and b.
    n_links = per_text(links)
    bits_a, bits_b = (int(len(x)).bit_length() for x in (enc_a.lengths, enc_b.vocabulary.lengths))
    keys = np.sort((np.repeat(np.arange(n), n_links) << (bits_a + bits_b)) | (a[link_a] << bits_b) | b[link_b])
    new = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    times = np.diff(np.append(new, len(keys)))
    keys = keys[new]
    owner = keys >> (bits_a + bits_b)
    pair = ((keys >> bits_b) & ((1 << bits_a) - 1)) << 32 | keys & ((1 << bits_b) - 1)
    lists = pa.array(np.append(0, np.cumsum(np.bincount(owner, minlength=n))), pa.int32())
    return {
        "n_a": np.diff(at_a), "n_b": np.diff(at_b), "n_groups": per_text(both), "n_links": n_links, "groups_sha256": pa.array(shas, pa.string()),
        "pairs": pa.ListArray.from_arrays(lists, pa.array(pair)), "times": pa.ListArray.from_arrays(lists, pa.array(times.astype(np.int32))),
    }


def aligned_texts(docs: DataFrame, tokenizer_a: str, tokenizer_b: str) -> DataFrame:
    """One row for each distinct text (null as empty): digest, copies, the measures of `align`, pairs and times."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc_a, enc_b = encoders(tokenizer_a, tokenizer_b)
        digits = _Digits(max(len(enc_a.lengths), len(enc_b.vocabulary.lengths)))
        for batch in batches:
            texts = batch.column("text")
            for x, y in in_slices(texts):
                own = {c: batch.column(c).slice(x, y - x) for c in ("digest", "copies")}
                yield pa.RecordBatch.from_pydict(own | align(texts.slice(x, y - x), enc_a, enc_b, digits))

    distinct = docs.groupBy(text_of().alias("text")).agg(F.count(F.lit(1)).alias("copies"))
    texts = distinct.select(F.sha2("text", 256).alias("digest"), "copies", "text")
    return texts.mapInArrow(run, "digest string, copies long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<int>")


def pair_counts(aligned: DataFrame) -> DataFrame:
    """pair, its count (documents that hold it, copies too), its rows (distinct texts), and whether no pair of its id of a has a larger count."""
    counts = aligned.select("copies", F.explode("pairs").alias("pair")).groupBy("pair").agg(F.sum("copies").alias("count"), F.count(F.lit(1)).alias("texts"))
    counts = written(counts, "pair-counts")
    first = F.shiftright("pair", 32)
    most = counts.groupBy(first.alias("a")).agg(F.max("count").alias("most"))
    return counts.join(most, first == F.col("a")).select("pair", "count", "texts", (F.col("count") == F.col("most")).alias("best"))


def _sums(aligned: DataFrame, counts: DataFrame) -> DataFrame:
    """digest, n_best and count_sum of each text with links.

    Pairs on more than 1 / `FREQUENT` of the rows, `FREQUENT` at most, are looked up where the text is; the others are joined,
    so that no pair that many texts hold is shuffled.
    """
    spark = aligned.sparkSession
    counts = written(counts, "counts")
    rows = counts.agg(F.sum("texts")).first()[0] or 0
    frequent = counts.where(F.col("texts") > rows / FREQUENT)
    held = frequent.select("pair", "count", "best").orderBy("pair").toPandas()  # at most FREQUENT rows
    shared = spark.sparkContext.broadcast((held["pair"].to_numpy(np.int64), held["count"].to_numpy(np.int64), held["best"].to_numpy(bool)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, count, best = shared.value
        for batch in batches:
            lists = batch.column("pairs")
            pair, times = lists.flatten().to_numpy(), batch.column("times").flatten().to_numpy().astype(np.int64)
            bounds = np.append(0, np.cumsum(pc.list_value_length(lists).to_numpy()))
            at = np.minimum(np.searchsorted(keys, pair), max(len(keys) - 1, 0))
            known = keys[at] == pair if len(keys) else np.zeros(len(pair), bool)
            at = at[known]
            total, good = np.zeros(len(pair), np.int64), np.zeros(len(pair), np.int64)
            total[known], good[known] = count[at] * times[known], best[at] * times[known]
            per_text = lambda x: np.diff(np.append(0, np.cumsum(x))[bounds])
            left = pa.array(np.append(0, np.cumsum(~known))[bounds], pa.int32())
            yield pa.RecordBatch.from_pydict({
                "digest": batch.column("digest"), "n_best": per_text(good), "count_sum": per_text(total),
                "pairs": pa.ListArray.from_arrays(left, pa.array(pair[~known])), "times": pa.ListArray.from_arrays(left, pa.array(times[~known])),
            })

    looked = aligned.select("digest", "pairs", "times").mapInArrow(run, "digest string, n_best long, count_sum long, pairs array<long>, times array<long>")
    looked = written(looked.withColumn("text", F.monotonically_increasing_id()), "looked-up")
    rare = looked.select("text", F.explode(F.arrays_zip("pairs", "times")).alias("p")).select("text", "p.pairs", "p.times")
    joined = rare.join(counts.where(F.col("texts") <= rows / FREQUENT), F.col("pairs") == F.col("pair"))
    more = joined.groupBy("text").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"), F.sum(F.col("count") * F.col("times")).alias("more_sum"))
    found = looked.select("text", "digest", "n_best", "count_sum").join(more, "text", "left")
    return found.select("digest", (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"), (F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).alias("count_sum"))


def alignment(docs: DataFrame, tokenizer_a: str, tokenizer_b: str) -> DataFrame:
    """One row for each row of docs: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    A text that is null or empty, or that one of the tokenizers does not spell as it is (with the space before it), has zeros and an
    empty digest. Rows that repeat count each; null doc_ids stay. An empty table gives no rows. Other columns are not read.
    """
    aligned = written(aligned_texts(docs, tokenizer_a, tokenizer_b), "aligned")
    sums = _sums(aligned, pair_counts(aligned))
    measured = aligned.drop("pairs", "times").join(sums, "digest")
    measured = written(measured.select("digest", "copies", *MEASURES, "groups_sha256"), "measured")
    # Texts with more than 1 / FREQUENT of the documents, FREQUENT at most, are looked up; no key of the join has more.
    owners = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.sha2(text_of(), 256).alias("digest"))
    total = measured.agg(F.sum("copies")).first()[0] or 0
    many = F.col("copies") > max(1.0, total / FREQUENT)
    usual = owners.join(F.broadcast(measured.where(many).select("digest")), "digest", "left_anti").join(measured.where(~many), "digest")
    hot = owners.join(F.broadcast(measured.where(many)), "digest")
    return usual.unionByName(hot).select("doc_id", *MEASURES, "groups_sha256")
