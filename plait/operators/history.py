"""Type-2 slowly changing dimension history.

A new version of a key starts at every row whose tracked values differ from
the previous row of the same key (in ``order``); a version is valid until
the next version of its key starts.

Per-key windows would sort all rows of a key in one task.  Here the key is
split by a coarse, order-preserving ``bucket`` (e.g. the day of the first
order column): the neighbour of a row is found inside its (key, bucket)
group, and only the first / last row of each group looks across buckets,
through a per-(key, bucket) summary that is a partial aggregate.  A key that
holds a third of all rows is thus spread over its buckets.  Where a key has a
day of more than ``BUCKET_ROWS`` rows, the buckets are range partitions of key
and order instead, and the edge state is carried between them: a key with all
its rows in one second is spread as well.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.names import quote
from ..session import shared_dir

#: Rows of a key in one bucket, about; fuller days are cut into several.
BUCKET_ROWS = 1_000_000


def null_safe_join(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """Left join on columns of equal names where NULL equals NULL; every name
    of ``on`` appears once, from the left."""
    other = right.withColumnsRenamed({c: f"_on_{c}" for c in on})
    same = F.lit(True)
    for c in on:
        same = same & F.col(quote(c)).eqNullSafe(F.col(quote(f"_on_{c}")))
    return left.join(other, same, "left").drop(*[f"_on_{c}" for c in on])


def day_buckets(rows: DataFrame, ks: list[str], order: list[str], bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``rows`` with ``_b``: the day of the first order column, or, when some
    key has a day of more than ``bucket_rows`` rows, the range partition of
    the row (``range_buckets``).  Full days are only looked for in inputs
    of more than ``bucket_rows`` rows, by one aggregate over key and day."""
    day = F.date_trunc("day", F.col(quote(order[0])).cast("timestamp"))
    if rows.count() > bucket_rows:
        full = rows.groupBy(*[F.col(quote(k)) for k in ks], day.alias("_day")).count().where(F.col("count") > bucket_rows)
        if not full.isEmpty():
            return range_buckets(rows, ks, order, bucket_rows)
    return rows.withColumn("_b", day)


def range_buckets(rows: DataFrame, ks: list[str], order: list[str], bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``rows`` range-partitioned by key and the whole order, with ``_b``, the
    number of the partition: neighbours of a key lie in one partition or in
    consecutive ones, however many of its rows share a day or a second.  The
    rows are written once, so the numbers stay what they are when a task is
    run again."""
    spark = rows.sparkSession
    shared_dir(spark)
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // max(1, bucket_rows)))
    by = [F.col(quote(c)) for c in [*ks, *order]]
    # equal orders are told apart by the rest of the row, so that they may part too
    rest = F.xxhash64(*[F.col(quote(f.name)) for f in rows.schema.fields if "map<" not in f.dataType.simpleString()])
    return rows.repartitionByRange(n, *by, rest).withColumn("_b", F.spark_partition_id()).checkpoint()


def scd2_history(df: DataFrame, key, order: list[str], tracked: list[str],
                 carry: dict[str, str] | None = None, bucket: Column | None = None,
                 materialize: bool = True, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Columns: key..., tracked..., carry aliases..., ``valid_from`` (the first
    order column of the version's first row), ``valid_to`` (the next
    version's ``valid_from``, NULL for the current one), ``is_current``.

    NULL keys are one key; a NULL in the order sorts first, and the last
    version of a key is current whatever its times are.

    ``bucket`` must never decrease along ``order`` within a key; default:
    ``day_buckets`` of the first order column.

    Plan: one shuffle of the rows, on (key, bucket), after full days are counted
    (inputs of over ``bucket_rows`` rows only).  Every window over
    (key, bucket) and the per-bucket edge values (last state, first version
    start) come from that one partitioning; only the edge tables (one row
    per key and bucket) are shuffled again, by key.  The windowed rows and
    the version starts each feed two branches; ``materialize`` writes them
    once with ``checkpoint()`` (the shared checkpoint folder, survives lost
    executors), so the input is scanned once instead of once per branch,
    beside the count of full days.
    """
    ks = [key] if isinstance(key, str) else list(key)
    carry = carry or {}
    oc = [F.col(quote(o)) for o in order]
    state = F.struct(*[F.col(quote(t)) for t in tracked])
    rows = df.select(*[F.col(quote(k)) for k in ks], *oc,
                     *[F.col(quote(t)) for t in tracked],
                     *[F.col(quote(src)) for src in dict.fromkeys(carry.values())
                       if src not in ks + order + tracked],
                     *([] if bucket is None else [bucket.alias("_b")]))
    if bucket is None:
        rows = day_buckets(rows, ks, order, bucket_rows)

    in_bucket = Window.partitionBy(*ks, "_b").orderBy(*oc)
    whole_bucket = in_bucket.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    per_key = Window.partitionBy(*ks).orderBy("_b")
    rows = (rows.withColumn("_state", state)
            .withColumn("_prev", F.lag("_state").over(in_bucket))
            .withColumn("_last", F.last("_state").over(whole_bucket)))
    if materialize:
        shared_dir(df.sparkSession)          # make sure a checkpoint folder is set
        rows = rows.checkpoint(eager=True)

    # the last state of the bucket before (edges: one row per key and bucket)
    edges = (rows.select(*ks, "_b", "_last").distinct()
             .select(*ks, "_b", F.lag("_last").over(per_key).alias("_prev_bucket")))
    rows = null_safe_join(rows, edges, ks + ["_b"])
    prev = F.coalesce(F.col("_prev"), F.col("_prev_bucket"))
    starts = rows.where(prev.isNull() | ~prev.eqNullSafe(F.col("_state")))

    # the version after each start, within the bucket or from a later bucket
    # (a struct, so that a next version that starts at NULL is still seen)
    at = F.struct(oc[0].alias("at"))
    starts = (starts.withColumn("_next", F.lead(at).over(in_bucket))
              .withColumn("_first", F.first(at).over(whole_bucket)))
    if materialize:
        starts = starts.checkpoint(eager=True)
    nexts = (starts.select(*ks, "_b", "_first").distinct()
             .select(*ks, "_b", F.lead("_first").over(per_key).alias("_next_bucket")))
    starts = null_safe_join(starts, nexts, ks + ["_b"])
    following = F.coalesce(F.col("_next"), F.col("_next_bucket"))
    carried = [F.col(quote(src)).alias(dst) for dst, src in carry.items()]
    return starts.select(*[F.col(quote(k)) for k in ks], *[F.col(quote(t)) for t in tracked],
                         *carried, oc[0].alias("valid_from"), following["at"].alias("valid_to"),
                         following.isNull().alias("is_current"))


def scd2_merge(history: DataFrame, batch: DataFrame, key, order: list[str],
               tracked: list[str], observation=None) -> DataFrame:
    """Merge a batch into a history built by ``scd2_history`` with
    ``carry={o: o for o in order[1:]}`` (``valid_from`` holds ``order[0]``).

    Only keys present in the batch are touched: their version starts are
    taken as rows next to the batch's and their history is rebuilt; every
    other row is kept as is.  A late row (not newer than its key's current
    version) thus starts a version at its own time unless the version in
    force has the same state; a replayed row always finds its own state in
    force and changes nothing.  A history keeps no rows between two version
    starts, so a late row's state holds until the next known start.
    NULL keys are one key like any other.  Late and replayed rows are counted
    as ``late_rows`` in ``observation`` (if given) by the job that writes.
    """
    ks = [key] if isinstance(key, str) else list(key)
    names = ks + order + tracked
    touched = batch.select(*[F.col(quote(k)) for k in ks]).distinct().withColumn("_touched", F.lit(True))
    tagged = null_safe_join(history, touched, ks)
    versions = tagged.where("_touched").select(
        *[F.col(quote(k)) for k in ks], F.col("valid_from").alias(order[0]),
        *[F.col(quote(o)) for o in order[1:]], *[F.col(quote(t)) for t in tracked], "is_current")
    rows = batch.select(*[F.col(quote(c)) for c in names])
    if observation is not None:
        at = F.struct(*[F.col(quote(o)) for o in order])
        current = versions.where("is_current").select(*[F.col(quote(k)) for k in ks], at.alias("_seed"))
        rows = (null_safe_join(rows, current, ks)
                .observe(observation, F.sum(F.when(at <= F.col("_seed"), 1).otherwise(0)).alias("late_rows"))
                .drop("_seed"))
    rebuilt = scd2_history(rows.unionByName(versions.drop("is_current")), ks, order, tracked,
                           carry={o: o for o in order[1:]})
    untouched = tagged.where(F.col("_touched").isNull()).drop("_touched")
    return untouched.unionByName(rebuilt.select(history.columns))
