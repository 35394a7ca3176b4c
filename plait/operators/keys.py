"""Key semantics: uniqueness report, guard, and latest-row deduplication.

All of them are aggregations with a map-side partial step, so a key that
holds a third of all rows is pre-aggregated inside every task before the
shuffle; no group is ever gathered in one place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.names import quote


class DuplicateKeyError(ValueError):
    pass


def _keys(key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def key_report(df: DataFrame, key) -> DataFrame:
    """One row per key value that occurs more than once: key columns and
    ``n_rows``.  NULL keys group together, as in SQL."""
    ks = _keys(key)
    return (df.groupBy(*[F.col(quote(k)) for k in ks])
            .agg(F.count(F.lit(1)).alias("n_rows"))
            .where(F.col("n_rows") > 1))


def key_summary(df: DataFrame, key) -> DataFrame:
    """One row: rows, distinct keys, rows with a NULL key part, duplicated keys."""
    ks = _keys(key)
    any_null = F.lit(False)
    for k in ks:
        any_null = any_null | F.col(quote(k)).isNull()
    per_key = (df.groupBy(*[F.col(quote(k)) for k in ks])
               .agg(F.count(F.lit(1)).alias("n"), F.max(any_null.cast("int")).alias("has_null")))
    return per_key.agg(
        F.sum("n").alias("n_rows"),
        F.count(F.lit(1)).alias("n_keys"),
        F.sum(F.when(F.col("has_null") == 1, F.col("n")).otherwise(0)).alias("n_null_key_rows"),
        F.sum(F.when(F.col("n") > 1, 1).otherwise(0)).alias("n_duplicated_keys"))


def assert_unique(df: DataFrame, key) -> None:
    """Raise DuplicateKeyError when a non-NULL key occurs twice (one job; only
    up to five offending keys reach the driver, for the message)."""
    ks = _keys(key)
    complete = F.lit(True)
    for k in ks:  # a key with a NULL part never matches, so it cannot clash
        complete = complete & F.col(quote(k)).isNotNull()
    dup = key_report(df.where(complete), ks)
    sample = dup.limit(5).collect()
    if sample:
        raise DuplicateKeyError(f"duplicate keys on {ks}: {[tuple(r) for r in sample]}")


def dedupe_latest(df: DataFrame, key, order: list[str | Column]) -> DataFrame:
    """Keep one row per key: the greatest by ``order`` (latest first), ties
    broken by the remaining columns so the result is deterministic.

    Implemented as ``max(struct(order..., rest...))`` per key: a partial
    aggregate that combines inside each task before the shuffle, unlike a
    ``row_number()`` window that sorts a whole key in one task.
    """
    ks = _keys(key)
    order_cols = [F.col(quote(o)) if isinstance(o, str) else o for o in order]
    order_names = [f"_o{i}" for i in range(len(order_cols))]
    rest = [c for c in df.columns if c not in ks]
    packed = F.struct(*[c.alias(n) for c, n in zip(order_cols, order_names)],
                      *[F.col(quote(c)).alias(c) for c in rest])
    best = (df.groupBy(*[F.col(quote(k)) for k in ks]).agg(F.max(packed).alias("_best")))
    return best.select(*[F.col(quote(c)) if c in ks else F.col(f"_best.{quote(c)}").alias(c)
                         for c in df.columns])
