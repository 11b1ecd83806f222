"""Mixing sources to target weights along a time-varying curriculum.

Each source has a weight schedule over training time 0..1, piecewise linear. Its integral is the
source's weight; weights share all words, and a source's target stops at `max_passes` times its size,
the excess shared anew. A source's words, passed through in a shuffled order as often as the target
asks, form its cumulative token demand; inverting the integral of the schedule at a document's place in
that demand gives its training position, and documents are range-sorted by it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from landweave.operators.numbering import sequential

from .common import small_enough, text_of, written

WORD = r"[^\x20\x09-\x0D]+"

#: Schedules of the sources, in turn by code point order: knots (time, weight) whose integrals are 5, 2 and 1.
SCHEDULES: list[list[tuple[float, float]]] = [
    [(0.0, 7.5), (1.0, 2.5)],
    [(0.0, 2.0), (1.0, 2.0)],
    [(0.0, 0.5), (1.0, 1.5)],
]


def _integrals(knots: Sequence[tuple[float, float]]) -> list[float]:
    total, out = 0.0, [0.0]
    for (t0, w0), (t1, w1) in zip(knots, knots[1:], strict=False):
        total += (t1 - t0) * (w0 + w1) / 2
        out.append(total)
    return out


def _pick(which: Column, values: Sequence) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), which)


def training_time(share: Column, knots: Sequence[tuple[float, float]]) -> Column:
    """The time by which `share` (0..1) of a schedule's integral is spent: the integral, inverted segment by segment."""
    sums = _integrals(knots)
    out = F.lit(float(knots[-1][0]))
    for (t0, w0), (t1, w1), s0, s1 in reversed(list(zip(knots, knots[1:], sums, sums[1:], strict=False))):
        slope = (w1 - w0) / (t1 - t0)
        rest = share * F.lit(sums[-1]) - F.lit(s0)
        root = F.sqrt(F.greatest(F.lit(w0 * w0) + F.lit(2 * slope) * rest, F.lit(0.0)))
        inside = F.lit(t0) + F.try_divide(F.lit(2.0) * rest, F.lit(w0) + root)
        out = F.when(share * F.lit(sums[-1]) <= F.lit(s1), F.coalesce(inside, F.lit(t0))).otherwise(out)
    return out


def source_targets(
    sizes: DataFrame, schedules: list[list[tuple[float, float]]], max_passes: int
) -> DataFrame:
    """source, source_size, target and schedule of each source, written. Sources may be many: none of this is done in one task.

    Sources are numbered in code point order by range partitions. Shares are settled in rounds: what the sources at their limit
    leave is shared by weight among the others, until no share is above its source's limit.
    """
    weights = [_integrals(k)[-1] for k in schedules]
    order = F.concat(F.col("source").isNull().cast("int").cast("string"), F.coalesce(F.hex(F.col("source").cast("binary")), F.lit("")))
    each = sizes.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn("order", order)
    each = written(
        sequential(each, "order", "turn")
        .withColumn("schedule", F.pmod(F.col("turn"), F.lit(len(schedules))).cast("int"))
        .withColumn("weight", _pick(F.col("schedule"), weights))
        .select("source", "source_size", "schedule", "weight", (F.col("source_size") * max_passes).cast("long").alias("limit")),
        "sources",
    )
    total = each.agg(F.sum("source_size")).first()[0] or 0
    level, full = 0.0, -1
    while True:
        # Those at their limit: at first none, then the ones that the last level brought there.
        capped = F.lit(False) if full < 0 else F.col("limit") <= F.col("weight") * F.lit(level)
        row = each.agg(
            F.coalesce(F.sum(F.when(capped, F.col("limit"))), F.lit(0)).alias("held"),
            F.sum(F.when(~capped, F.col("weight"))).alias("open"),
            F.count_if(capped).alias("full"),
        ).first()
        if row.full == full or not row.open:
            level = level if row.open else float("inf")
            break
        level, full = (total - row.held) / row.open, row.full
    share = F.when(F.col("limit") <= F.col("weight") * F.lit(level), F.col("limit").cast("double")).otherwise(F.col("weight") * F.lit(level))
    return each.select("source", "source_size", "schedule", share.alias("target"))


def mix(
    docs: DataFrame,
    schedules: list[list[tuple[float, float]]] = SCHEDULES,
    max_passes: int = 3,
    whole_documents: bool = False,
) -> DataFrame:
    """The documents' columns and `mix`: size, source_size, target, taken, passes (array of pass, words, position).

    Words are `[^\\x20\\x09-\\x0D]+`; a null or empty text has none, is never taken, and keeps a row. Null sources are one
    source, last in turn. The order within a source is by md5 of doc_id, then doc_id and size, so reruns agree; rows that share
    doc_id, source and size are taken alike, as the first of them, which can move a source's sum by their words. The last document
    of a source's last pass is taken in part, or, with `whole_documents`, as a whole if half of it fits.
    """
    columns = [c for c in docs.columns if c != "mix"]
    plan = mix_plan(docs, schedules, max_passes, whole_documents, F.col("source").alias("plan_source"))
    keys = [F.col("doc_id").alias("plan_id"), "plan_source", F.col("mix.size").alias("plan_size")]
    plan = plan.groupBy(*keys).agg(F.min("mix").alias("mix"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), _size().alias("size"))
    own = F.col("row.doc_id").eqNullSafe(F.col("plan_id")) & F.col("row.source").eqNullSafe(F.col("plan_source")) & (F.col("size") == F.col("plan_size"))
    return rows.join(plan, own).select(*[F.col(f"row.`{c}`") for c in columns], "mix")


def _size() -> Column:
    """The words of the text."""
    return F.regexp_count(text_of(), F.lit(WORD)).cast("long")


def mix_plan(
    docs: DataFrame,
    schedules: list[list[tuple[float, float]]] = SCHEDULES,
    max_passes: int = 3,
    whole_documents: bool = False,
    *more: Column,
) -> DataFrame:
    """doc_id and mix of every row (see `mix`), and columns of its source; texts are read once and not moved."""
    sizes = written(docs.select("source", F.col("doc_id").alias("id"), _size().alias("size")), "sizes")
    targets = source_targets(sizes, schedules, max_passes)
    # Order within a source: by digest. Its first three digits deal a hot source out to 4096 windows, and the windows'
    # sums, a row for each source and digit group, are summed up first.
    each = sizes.withColumn("digest", F.md5(F.coalesce(F.col("id").cast("string"), F.lit("")).cast("binary"))).withColumn(
        "slot", F.substring("digest", 1, 3)
    )
    slots = each.groupBy("source", "slot").agg(F.sum("size").alias("slot_size"))
    before = W.partitionBy("source").orderBy("slot").rowsBetween(W.unboundedPreceding, -1)
    slots = slots.withColumn("slot_before", F.coalesce(F.sum("slot_size").over(before), F.lit(0)))
    t = targets.withColumnRenamed("source", "t_source")
    slots = slots.join(small_enough(t), F.col("source").eqNullSafe(F.col("t_source"))).select(
        F.col("source").alias("s_source"), F.col("slot").alias("s_slot"), "slot_before", "source_size", "target", "schedule"
    )
    inside = W.partitionBy("source", "slot").orderBy("digest", "id", "size").rowsBetween(W.unboundedPreceding, -1)
    spot = (
        each.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
        .join(slots, F.col("source").eqNullSafe(F.col("s_source")) & (F.col("slot") == F.col("s_slot")))
        .withColumn("place", F.col("slot_before") + F.col("inside"))
        .withColumn("words", F.floor("target").cast("long"))
        .withColumn("full", F.coalesce(F.expr("words div nullif(source_size, 0)"), F.lit(0)))
        .withColumn("rest", F.col("words") - F.col("full") * F.col("source_size"))
    )
    part = F.least(F.greatest(F.col("rest") - F.col("place"), F.lit(0)), F.col("size"))
    if whole_documents:
        part = F.when(F.col("rest") - F.col("place") >= F.col("size") / 2, F.col("size")).otherwise(F.lit(0))
    time = F.lit(None).cast("double")
    share = lambda k: F.coalesce(F.try_divide((k * F.col("source_size") + F.col("place")).cast("double"), F.col("target")), F.lit(0.0))

    def position(k: Column) -> Column:
        out = time
        for i, knots in enumerate(schedules):
            out = F.when(F.col("schedule") == i, training_time(share(k), knots)).otherwise(out)
        return out

    def one(k: int) -> Column:
        words = F.when(F.lit(k) < F.col("full"), F.col("size")).when(F.lit(k) == F.col("full"), F.col("part")).otherwise(F.lit(0))
        return F.struct(F.lit(k).alias("pass"), words.cast("long").alias("words"), position(F.lit(k)).alias("position"))

    passes = F.filter(F.array(*[one(k) for k in range(max_passes)]), lambda p: p["words"] > 0)
    out = spot.withColumn("part", part).withColumn("passes", passes)
    taken = F.aggregate("passes", F.lit(0).cast("long"), lambda a, p: a + p["words"])
    report = F.struct("size", "source_size", "target", taken.alias("taken"), "passes")
    return out.select(F.col("id").alias("doc_id"), report.alias("mix"), *more)


def in_training_order(mixed: DataFrame, partitions: int | None = None) -> DataFrame:
    """One row for each time that a document is taken, range-sorted by position; `mix` becomes pass, words, position.

    Rows of one position are ordered by doc_id and pass.
    """
    rows = mixed.withColumn("mix", F.explode("mix.passes"))
    keys = ["mix.position", "doc_id", "mix.pass"]
    rows = rows.repartitionByRange(partitions, *keys) if partitions else rows.repartitionByRange(*keys)
    return rows.sortWithinPartitions(*keys)
