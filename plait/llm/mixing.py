"""Mixing sources to target weights.

Sizes are summed per source, a target is derived per source by sharing out a
total in proportion to the weights with a ceiling per source, and each
document is taken floor(rate) times plus once more when a number hashed from
the seed and its id falls below the fraction of the rate.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, global_rank, n_words, unit_hash

#: Source tables up to this many rows are broadcast; larger ones are joined by shuffle.
BROADCAST_SOURCES = 50_000


def source_targets(docs: DataFrame, *, text: str = "text", source: str = "source",
                   weights: tuple[int, ...] = (3, 1, 2), share: Fraction = Fraction(3, 2),
                   ceiling: int = 2) -> DataFrame:
    """One row per source: ``source, source_size, weight, target``.

    Sources are numbered by code point, null last, and weighed by the
    repeating ``weights``.  ``share`` times all sizes is shared by weight; a
    target stops at ``ceiling`` times its source's size and the excess is
    shared again among the rest until none is above.  The driver holds two
    numbers, the amount left and the weight left; each round is one
    aggregate over the sources.
    """
    sized = docs.select(F.col(source).alias("source"), n_words(F.col(text)).alias("size")) \
        .groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = global_rank(sized, [F.col("source").asc_nulls_last()], "_pl_rank")
    cycle = F.element_at(F.array(*[F.lit(w) for w in weights]),
                         (F.pmod(F.col("_pl_rank") - 1, F.lit(len(weights))) + 1).cast("int"))
    sources = cut(ranked.withColumn("weight", cycle.cast("long")).drop("_pl_rank"))

    num, den = share.numerator, share.denominator
    size, weight = (F.col(c).cast("decimal(38,0)") for c in ("source_size", "weight"))
    total, left = sources.agg(F.sum(size), F.sum(weight)).first()
    amount, left = num * int(total or 0), int(left or 0)

    def above(amount: int, left: int):
        """Whether the ceiling lies below the source's part of the level."""
        return (size * F.lit(ceiling * den * left).cast("decimal(38,0)")
                < weight * F.lit(amount).cast("decimal(38,0)"))

    while left:
        capped = above(amount, left)
        closed, rest = sources.agg(F.sum(F.when(capped, size)), F.sum(F.when(~capped, weight))).first()
        nxt = num * int(total or 0) - den * ceiling * int(closed or 0), int(rest or 0)
        if nxt == (amount, left):
            break
        amount, left = nxt
    part = (F.col("weight") * F.lit(amount)).cast("double") / F.lit(float(den * max(left, 1)))
    target = F.when(above(amount, left), (F.col("source_size") * ceiling).cast("double")).otherwise(part)
    return sources.withColumn("target", target)


def mixing_plan(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", source: str = "source",
                weights: tuple[int, ...] = (3, 1, 2), share: Fraction = Fraction(3, 2),
                ceiling: int = 2, seed: str = "mix-1") -> DataFrame:
    """The input rows with ``size`` (words), ``source_size``, ``target``,
    ``rate`` (target over source size) and ``copies``.

    A null text has size 0; null sources form one source; a source without
    words has rate 0.  Rows that repeat an id take the same decision.  An
    input column with the name of an output column is replaced.  Independent
    draws keep a source near its target within the spread of its own
    document sizes.
    """
    targets = source_targets(docs, text=text, source=source, weights=weights, share=share, ceiling=ceiling)
    small = targets.count() <= BROADCAST_SOURCES
    side = targets.select(F.col("source").alias("_pl_source"), F.col("source_size").alias("_pl_total"),
                          F.col("target").alias("_pl_target"))
    sized = docs.drop(*(set(docs.columns) & {"source_size", "target", "rate", "copies"})) \
        .withColumn("size", n_words(F.col(text)))
    out = sized.join(F.broadcast(side) if small else side,
                     F.col(source).eqNullSafe(F.col("_pl_source")), "left")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    whole = F.floor(F.col("rate"))
    extra = (unit_hash(seed, F.col(doc_id)) < F.col("rate") - whole).cast("long")
    return out.withColumnsRenamed({"_pl_total": "source_size", "_pl_target": "target"}) \
        .drop("_pl_source").withColumn("rate", rate).withColumn("copies", whole + extra)


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixture itself: every row ``copies`` times, with ``copy_no`` from 1."""
    plan = mixing_plan(docs, **options).filter("copies > 0")
    return plan.withColumn("copy_no", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
