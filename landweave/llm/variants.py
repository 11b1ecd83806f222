"""Spelling variants: words that are one edit apart, and the more frequent form that each goes back to.

Words are counted over the whole corpus first. Two words of which the longer has m letters are one edit apart when their common
prefix and suffix together reach m - 1. The prefix is cut off at one of `pieces` places, so that near words share what lies
before the place's section and after it, and meet under that key; words of a key are compared as dense padded matrices of
code points, block against block. Keys with more words than a block are dealt to pairs of blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small_enough, text_of, written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Elements of a dense comparison held at once.
VOLUME = 4_000_000


def words_of(docs: DataFrame, planted: int = 97) -> DataFrame:
    """`word`, one row for each run of letters; where the crc32 of `<doc_id>:<run>` is a multiple of `planted`, a letter is missing from it.

    A null doc_id is an empty one there, a null text has no runs. `planted` of 0 leaves all runs as they are.
    """
    runs = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.explode(F.regexp_extract_all(text_of(), F.lit("([A-Za-zÀ-ÿ]+)"), F.lit(1))).alias("run"))
    runs = runs.select("doc_id", F.translate("run", UPPER, LOWER).alias("run"))
    if not planted:
        return runs.select(F.col("run").alias("word"))
    crc = F.crc32(F.concat(F.coalesce("doc_id", F.lit("")), F.lit(":"), F.col("run")).cast("binary"))
    at = (F.col("crc") % F.char_length("run")).cast("int")
    less = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.char_length("run")))
    return runs.select("run", crc.alias("crc")).select(F.when(F.col("crc") % planted == 0, less).otherwise(F.col("run")).alias("word"))


def count_words(words: DataFrame, least_length: int = 5, least_count: int = 3) -> DataFrame:
    """word and n of the distinct words long and frequent enough."""
    counts = words.where(F.char_length("word") >= least_length).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counts.where(F.col("n") >= least_count)


def _keys(pieces: int) -> Column:
    """The keys of a word, as the longer (m its length) and as the shorter of a pair (m one more): m, j, and what lies before and after section j of m."""
    w, size = F.col("word"), F.char_length("word")

    def key(more: int, j: int) -> Column:
        m = size + more
        before, after = F.floor(m * j / pieces).cast("int"), m - F.floor(m * (j + 1) / pieces).cast("int")
        return F.concat_ws("|", m.cast("string"), F.lit(str(j)), F.substring(w, F.lit(1), before), F.substring(w, size - after + 1, after))

    return F.array(*[key(more, j) for more in (0, 1) for j in range(pieces)])


def _near(left: np.ndarray, right: np.ndarray, m: int, j: int, pieces: int) -> tuple[np.ndarray, np.ndarray]:
    """Which rows of `left` and `right` (g blocks of n words of m or m - 1 code points, those with a 0 at the end) are one edit apart.

    A pair is near under the key of the section in which its prefix ends only, so that it is found once.
    """
    size = lambda x: m - (x[..., m - 1] == 0)
    turned = lambda x: np.where((x[..., m - 1] == 0)[..., None], np.roll(x, 1, -1), x)[..., ::-1]
    longer = np.maximum(size(left)[:, :, None], size(right)[:, None, :])
    least = np.minimum(size(left)[:, :, None], size(right)[:, None, :])

    def common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        differ = a[:, :, None, :] != b[:, None, :, :]
        first = differ.argmax(-1)
        return np.minimum(np.where(differ.any(-1), first, m), least)

    prefix, suffix = common(left, right), common(turned(left), turned(right))
    at = np.minimum(prefix, m - 1)
    own = (at >= m * j // pieces) & (at < m * (j + 1) // pieces)
    return np.nonzero((longer == m) & (prefix + suffix >= m - 1) & own & ((prefix < m) | (least < m)))


def _compare(pieces: int):
    """Batches of (unit, side, word, n), sorted by unit and side, to pairs of near words."""

    def tiles(m: int, j: int, codes: np.ndarray, begin: np.ndarray, end: np.ndarray, split: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of rows: units of one shape are stacked. `split` is where a unit's second side begins (its end, if it has one side)."""
        shapes = np.stack([split - begin, end - split], 1)
        for a, b in np.unique(shapes, axis=0).tolist():
            same = np.flatnonzero((shapes == (a, b)).all(1))
            right_from, n = (begin[same], a) if b == 0 else (split[same], b)
            if a * n < 2 and b == 0:
                continue
            some = max(1, VOLUME // max(1, n * m))  # rows of the left side at once
            many = max(1, some // a)  # units at once
            for u in range(0, len(same), many):
                for first in range(0, a, some):
                    rows = begin[same[u : u + many], None] + np.arange(first, min(a, first + some))
                    cols = right_from[u : u + many, None] + np.arange(n)
                    g, x, y = _near(codes[rows], codes[cols], m, j, pieces)
                    x, y = rows[g, x], cols[g, y]
                    kept = (x < y) if b == 0 else np.ones(len(x), bool)
                    yield x[kept], y[kept]

    def whole(table: pa.Table) -> Iterator[pa.RecordBatch]:
        unit, words = table.column("unit").combine_chunks(), table.column("word").combine_chunks()
        new = np.append(True, pc.not_equal(unit[1:], unit[:-1]).to_numpy(zero_copy_only=False)) if len(unit) else np.zeros(0, bool)
        begin = np.flatnonzero(new)
        end = np.append(begin[1:], len(unit))
        side = table.column("side").to_numpy()
        # a unit's second side begins where `side` changes
        split = np.array(end)
        changed = np.flatnonzero((side[1:] != side[:-1]) & ~new[1:]) + 1
        split[np.searchsorted(begin, changed, "right") - 1] = changed
        heads = pc.split_pattern(unit.take(pa.array(begin)), "|", max_splits=2)
        m, j = (pc.list_element(heads, k).cast(pa.int32()).to_numpy() for k in (0, 1))
        text = words.to_pylist()
        for size, section in sorted(set(zip(m.tolist(), j.tolist(), strict=True))):
            mine = np.flatnonzero((m == size) & (j == section))
            lengths = end[mine] - begin[mine]
            rows = np.repeat(begin[mine] - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())
            codes = np.frombuffer("".join([text[i].ljust(size, "\0") for i in rows.tolist()]).encode("utf-32-le"), np.uint32).reshape(-1, size)
            base = np.cumsum(lengths) - lengths
            for x, y in tiles(size, section, codes, base, base + lengths, base + (split[mine] - begin[mine])):
                if len(x):
                    x, y = pa.array(rows[x]), pa.array(rows[y])
                    n = table.column("n")
                    yield pa.RecordBatch.from_pydict({"a": words.take(x), "n_a": n.take(x).combine_chunks(), "b": words.take(y), "n_b": n.take(y).combine_chunks()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            table = pa.Table.from_batches(held)
            unit = table.column("unit")
            last = pc.index(unit, unit[-1]).as_py()  # the last unit may go on in the next batch
            if last:
                yield from whole(table.slice(0, last))
                held = table.slice(last).to_batches()
        if held:
            yield from whole(pa.Table.from_batches(held))

    return run


def near_words(counts: DataFrame, pieces: int = 4, block: int = 512) -> DataFrame:
    """Pairs (a, n_a, b, n_b) of words (word, n; distinct) that differ by one inserted, deleted or replaced code point, each once.

    A key's words are one unit if there are at most `block` of them, else each pair of their blocks is one.
    Words need at least `pieces` letters.
    """
    keyed = written(counts.select("word", "n", F.explode(_keys(pieces)).alias("key")), "keyed")
    sizes = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("size"))
    hot = written(sizes.where(F.col("size") > block).select("key", F.ceil(F.col("size") / block).cast("int").alias("blocks")), "hot")
    blocked = keyed.join(small_enough(hot), "key", "left").withColumn("own", F.pmod(F.xxhash64("word"), F.coalesce("blocks", F.lit(1))).cast("int"))
    dealt = blocked.withColumn("other", F.explode(F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1)))
    low, high = F.least("own", "other"), F.greatest("own", "other")
    unit = F.concat_ws("|", "key", low.cast("string"), high.cast("string"))
    rows = dealt.select(unit.alias("unit"), (F.col("own") == high).cast("int").alias("side"), "word", "n")
    # few bytes and much work: not merged by size
    parts = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartition(parts, "unit").sortWithinPartitions("unit", "side", "word")
    return rows.mapInArrow(_compare(pieces), "a string, n_a long, b string, n_b long")


def roots(forms: DataFrame) -> DataFrame:
    """word and root of every word with a form (word, form): the end of its chain of forms. Chains have no circle.

    Pointers are doubled: a round for each doubling of the longest chain.
    """
    state = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = state.select(F.col("word").alias("root"), F.col("root").alias("after"))
        new = written(state.join(ahead, "root", "left").select("word", F.coalesce("after", "root").alias("root"), F.col("after").isNotNull().alias("moved")), "roots")
        state = new.select("word", "root")
        if new.where("moved").isEmpty():
            return state


def spelling_variants(counts: DataFrame, times: int = 2, pieces: int = 4, block: int = 512) -> DataFrame:
    """Each word (word, n) with form, root, n_near and form_n.

    n_near counts the words one edit away. The form is the most frequent of them (of equals the first by code points) if that is at
    least `times` as frequent as the word, else null; the root is the end of the chain of forms, the word itself where it has none.
    """
    counts = written(counts, "words")
    pairs = near_words(counts, pieces, block)
    both = pairs.select(F.explode(F.array(F.struct(F.col("a").alias("word"), F.col("b").alias("other"), F.col("n_b").alias("m")), F.struct(F.col("b").alias("word"), F.col("a").alias("other"), F.col("n_a").alias("m")))).alias("p")).select("p.*")
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("m")).alias("m"), "other")).alias("best"))
    found = counts.join(best, "word", "left")
    has = -F.col("best.m") >= times * F.col("n")
    found = found.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(has, F.col("best.other")).alias("form"), F.when(has, -F.col("best.m")).alias("form_n"))
    found = written(found, "found")
    ends = roots(found.where("form is not null").select("word", "form"))
    return found.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
