"""Language identification by rank-order profiles of n-grams.

A language's profile is its most frequent letter n-grams (1 to 3 letters, word ends marked) in order. A
document's own most frequent n-grams are compared with each profile by the out-of-place distance: the
sum of the differences in rank, the profile's length for an n-gram that it lacks.

An n-gram's code holds its letters' code points, whatever the script: 21 bits each, in three places, with 0 for a word's
end. Of one letter it is the negative code point.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import small_enough, written
from .encoding import release

PROFILE = 300
#: Fitting takes about so many documents of each language at most.
SAMPLE = 1000
BITS = 21

_letters: np.ndarray | None = None


def _symbols() -> np.ndarray:
    """Code point -> itself if it is a letter, else 0."""
    global _letters
    if _letters is None:
        alpha = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
        _letters = np.where(alpha, np.arange(0x110000), 0).astype(np.int64)
    return _letters


def grams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Codes and counts of a whole text's n-grams, none if it has no letter."""
    points = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), "<u4")
    s = _symbols()[points]
    s = np.concatenate([[0], s[(s > 0) | (np.concatenate([[1], s[:-1]]) > 0)], [0]])  # one end for each word
    a, b, c = s[:-2], s[1:-1], s[2:]
    mid = b > 0
    left, right = s[:-1], s[1:]
    two = ((left << 2 * BITS) | right)[(left | right) > 0]
    three = ((a << 2 * BITS) | (b << BITS) | c)[mid]
    codes = np.sort(np.concatenate([-b[mid], two, three]))
    if not len(codes):
        return codes, codes
    first = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
    return codes[first], np.diff(np.concatenate([first, [len(codes)]]))


def top_ranked(codes: np.ndarray, counts: np.ndarray, most: int = PROFILE) -> np.ndarray:
    """The most frequent codes (which ascend) in order; ties to the smaller code."""
    if len(codes) > most:
        often = counts >= np.partition(counts, len(counts) - most)[len(counts) - most]
        codes, counts = codes[often], counts[often]
    return codes[np.argsort(-counts, kind="stable")[:most]]


def is_held_out(doc_id: str = "doc_id") -> Column:
    """Whether crc32 of the doc_id as text leaves 0 modulo 5. A row without a doc_id is held out too: nothing is learned from it."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    release()
    for batch in batches:
        parts: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text"), strict=True):
            parts.setdefault(lang, []).append(grams(text.as_py()))
        for lang, own in parts.items():
            codes, place = np.unique(np.concatenate([c for c, _ in own]), return_inverse=True)
            sums = np.bincount(place, np.concatenate([n for _, n in own]), len(codes)).astype(np.int64)
            yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(codes), pa.string()), "code": pa.array(codes, pa.int64()), "n": sums})


def fit_profiles(labelled: DataFrame, sample: int = SAMPLE, most: int = PROFILE) -> dict[str, list[int]]:
    """Language -> its `most` most frequent n-grams in order, from about `sample` documents of each language.

    Rows without a language or text are left out, as is a language whose sample has no letter. The sample is by hash of doc_id and
    text, so it is the same again.
    """
    rows = labelled.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = written(rows.groupBy(F.col("lang").alias("of")).agg(F.count(F.lit(1)).alias("n")), "languages")
    draw = F.pmod(F.xxhash64("doc_id", F.xxhash64("text")), F.lit(1 << 30)) / float(1 << 30)
    taken = rows.join(small_enough(sizes), F.col("lang") == F.col("of")).where(draw < F.lit(float(sample)) / F.col("n"))
    counts = taken.select("lang", "text").mapInArrow(_count, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    best = W.partitionBy("lang").orderBy(F.desc("n"), "code")  # the n-grams of about `sample` documents
    ranked = counts.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= most).collect()  # `most` for each language
    profiles: dict[str, list[int]] = {lang: [] for lang in sorted({r.lang for r in ranked})}
    for r in sorted(ranked, key=lambda r: r["rank"]):
        profiles[r.lang].append(r.code)
    return profiles


def out_of_place(there: np.ndarray, most: int = PROFILE) -> np.ndarray:
    """Distances, 0 to 1, of a document's ranked n-grams to profiles: `there` has a row for each, the n-grams' ranks or `most` where it lacks one."""
    n = there.shape[1]
    return np.where(there < most, np.abs(there - np.arange(n)), most).sum(1) / (n * most)


def _classifier(profiles: dict[str, list[int]], most: int):
    @F.pandas_udf("lang_pred string, score double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        release()
        langs = list(profiles)
        known = np.unique(np.array([c for codes in profiles.values() for c in codes], np.int64))
        places = np.full((len(langs), len(known) + 1), most, np.int32)  # the last column is for n-grams that no profile has
        for row, codes in zip(places, profiles.values(), strict=True):
            row[np.searchsorted(known, codes)] = np.arange(len(codes))
        for texts in batches:
            names, scores = [], []
            for text in texts:
                ranked = top_ranked(*grams(text), most)
                if not len(ranked) or not langs:
                    names.append("und")
                    scores.append(0.0)
                    continue
                at = np.searchsorted(known, ranked)
                at[known[np.minimum(at, len(known) - 1)] != ranked] = len(known)
                distances = out_of_place(places[:, at], most)
                best = int(np.argmin(distances))
                names.append(langs[best])
                scores.append(1.0 - float(distances[best]))
            yield pd.DataFrame({"lang_pred": names, "score": scores})

    return run


def identify(docs: DataFrame, profiles: dict[str, list[int]], most: int = PROFILE) -> DataFrame:
    """The documents' columns and `language` (lang_pred, score 0..1: 1 less the distance to the nearest profile).

    A text that is null or has no letter is `und` with score 0, as is every text if there are no profiles. Ties go
    to the language first in order. Only the text is looked at. An existing column named language is replaced.
    """
    return docs.withColumn("language", _classifier(profiles, most)(F.col("text")))
