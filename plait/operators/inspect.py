"""Inspection as DataFrames (testable), not printing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.names import quote
from ..functions.schema import all_paths


def schema_rows(df: DataFrame) -> DataFrame:
    """printSchema as rows ``path, type, nullable`` (built from the schema, on
    the driver; its size is the schema's, not the data's)."""
    rows = [(p, t, n) for p, t, n in all_paths(df.schema)]
    return df.sparkSession.createDataFrame(rows, "path string, type string, nullable boolean")


def first_rows(df: DataFrame, order: list[str | Column], n: int = 1) -> DataFrame:
    """First ``n`` rows by an explicit order (a top-k, planned as
    TakeOrderedAndProject: each task keeps only n rows)."""
    cols = [F.col(quote(o)) if isinstance(o, str) else o for o in order]
    return df.orderBy(*cols).limit(n)


def _text(c: Column, dt: T.DataType) -> Column:
    if isinstance(dt, (T.ArrayType, T.MapType, T.StructType)):
        return F.to_json(c)
    return c.cast("string")


def profile(df: DataFrame, exact_distinct: bool | list[str] = False) -> DataFrame:
    """One row per top-level column: ``column_name, n_rows, n_nulls,
    n_distinct, min_value, max_value`` (min/max as text, NULL for nested).

    All statistics come from a single aggregation over the data; the wide
    result row is unpivoted with ``inline``.  Distinct counts are HyperLogLog
    estimates, but for the columns named in ``exact_distinct`` (``True``:
    all).  Each of those is counted by an aggregate of its own over that one
    column (repeats are combined before the shuffle), so rows are never
    multiplied by the number of columns.
    """
    aggs = [F.count(F.lit(1)).alias("__n")]
    orderable = {}
    names = [f.name for f in df.schema.fields]
    exact = names if exact_distinct is True else [n for n in names if n in (exact_distinct or ())]
    for i, f in enumerate(df.schema.fields):
        c = F.col(quote(f.name))
        aggs.append(F.count(c).alias(f"nn{i}"))
        aggs.append((F.lit(None) if f.name in exact else F.approx_count_distinct(c)).cast("bigint").alias(f"nd{i}"))
        orderable[i] = not isinstance(f.dataType, (T.MapType,))
        if orderable[i]:
            aggs.append(F.min(c).alias(f"mn{i}"))
            aggs.append(F.max(c).alias(f"mx{i}"))
    wide = df.agg(*aggs)
    parts = []
    for i, f in enumerate(df.schema.fields):
        mn = _text(F.col(f"mn{i}"), f.dataType) if orderable[i] else F.lit(None).cast("string")
        mx = _text(F.col(f"mx{i}"), f.dataType) if orderable[i] else F.lit(None).cast("string")
        parts.append(F.struct(F.lit(f.name).alias("column_name"),
                              F.col("__n").alias("n_rows"),
                              (F.col("__n") - F.col(f"nn{i}")).alias("n_nulls"),
                              F.col(f"nd{i}").cast("bigint").alias("n_distinct"),
                              mn.alias("min_value"), mx.alias("max_value")))
    rows = wide.select(F.inline(F.array(*parts)))
    if not exact:
        return rows
    counts = None
    for n in exact:
        one = df.select(F.col(quote(n)).alias("v")).where("v IS NOT NULL").distinct() \
            .agg(F.count(F.lit(1)).alias("exact")).select(F.lit(n).alias("column_name"), "exact")
        counts = one if counts is None else counts.unionAll(one)
    return rows.join(F.broadcast(counts), "column_name", "left") \
        .select("column_name", "n_rows", "n_nulls", F.coalesce("exact", "n_distinct").alias("n_distinct"), "min_value", "max_value")


def _numeric(dt: T.DataType) -> bool:
    return isinstance(dt, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType))


def _as_double(c: Column, dt: T.DataType) -> Column:
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(c.cast("timestamp")).cast("double")
    return F.unix_date(c).cast("double") if isinstance(dt, T.DateType) else c.cast("double")


def profile_sketch(df: DataFrame) -> DataFrame:
    """The profile of one batch in a form that can be stored and united: per
    column ``column_name, n_rows, n_nulls, distinct_sketch`` (HyperLogLog)
    and, of numbers, dates and times, ``quantile_sketch`` (KLL over doubles;
    times as microseconds, dates as days), ``low`` and ``high``.

    One aggregation over the data; a sketch has a few kilobytes whatever the
    size of the batch.  Nested columns are counted by their JSON text.  NaN
    and NULL take no part in quantiles, NULL none in distinct counts."""
    aggs = [F.count(F.lit(1)).alias("__n")]
    parts = []
    for i, f in enumerate(df.schema.fields):
        c = F.col(quote(f.name))
        aggs.append(F.count(c).alias(f"nn{i}"))
        aggs.append(F.hll_sketch_agg(_text(c, f.dataType)).alias(f"hs{i}"))
        if _numeric(f.dataType):
            x = _as_double(c, f.dataType)
            x = F.when(~F.isnan(x), x)
            aggs += [F.kll_sketch_agg_double(x).alias(f"qs{i}"), F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}")]
        of = (lambda n, t, i=i, f=f: F.col(f"{n}{i}").cast(t) if _numeric(f.dataType) else F.lit(None).cast(t))
        parts.append(F.struct(F.lit(f.name).alias("column_name"), F.col("__n").alias("n_rows"),
                              (F.col("__n") - F.col(f"nn{i}")).alias("n_nulls"), F.col(f"hs{i}").alias("distinct_sketch"),
                              of("qs", "binary").alias("quantile_sketch"), of("lo", "double").alias("low"), of("hi", "double").alias("high")))
    return df.agg(*aggs).select(F.inline(F.array(*parts)))


def unite_profiles(sketches: DataFrame) -> DataFrame:
    """The sketches of several batches as those of all their rows, a row per column."""
    return sketches.groupBy("column_name").agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n_nulls").alias("n_nulls"),
        F.hll_union_agg("distinct_sketch").alias("distinct_sketch"),
        F.kll_merge_agg_double("quantile_sketch").alias("quantile_sketch"), F.min("low").alias("low"), F.max("high").alias("high"))


def read_profile(sketches: DataFrame, quantiles: tuple[float, ...] = (0.25, 0.5, 0.75)) -> DataFrame:
    """``column_name, n_rows, n_nulls, n_distinct, low, high, quantiles``
    (of numeric columns that have values) from sketches, united or not."""
    has_values = F.col("low").isNotNull()
    values = F.array(*[F.kll_sketch_get_quantile_double("quantile_sketch", F.lit(float(q))) for q in quantiles])
    return sketches.select("column_name", "n_rows", "n_nulls", F.hll_sketch_estimate("distinct_sketch").alias("n_distinct"),
                           "low", "high", F.when(has_values, values).alias("quantiles"))
