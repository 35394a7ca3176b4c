"""File layout: compaction plus clustering (the open-source stand-in for
OPTIMIZE / Z-ORDER)."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.names import quote
from .tables import TableSpec, _publish, _version


def cluster(df: DataFrame, cols: list[str], partitions: int | None = None) -> DataFrame:
    """Range-partition on ``cols`` (sampled bounds, no global sort on one
    task) and sort inside each partition, so every output file covers a
    narrow, mostly disjoint range and Parquet min/max statistics prune.
    Without ``partitions`` the ranges are sized by AQE: it joins neighbouring
    ones up to ``spark.sql.adaptive.advisoryPartitionSizeInBytes``."""
    keys = [F.col(quote(c)) for c in cols]
    return _by_range(df, keys, partitions).sortWithinPartitions(*keys)


def _by_range(df: DataFrame, keys: list[Column], partitions: int | None) -> DataFrame:
    return df.repartitionByRange(partitions, *keys) if partitions else df.repartitionByRange(*keys)


def _as_number(c: Column, dt: T.DataType) -> Column:
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(c.cast("timestamp")).cast("double")
    if isinstance(dt, T.DateType):
        return F.unix_date(c).cast("double")
    if not isinstance(dt, (T.NumericType, T.BooleanType)):
        raise TypeError(f"a Z-order column must be a number, date or timestamp, not {dt.simpleString()}")
    return c.cast("double")


def zorder_key(df: DataFrame, cols: list[str], bits: int = 16) -> Column:
    """Morton (Z-order) code of numeric / date / timestamp columns.

    Each column is scaled to ``[0, 2^bits)`` with its min and max (one small
    aggregate; two values per column reach the driver) and the bits are
    interleaved with built-in expressions, so the key stays JVM-side.  The
    code has 62 bits at most: over three columns get fewer ``bits`` each."""
    bits = min(bits, 62 // len(cols))
    dts = {f.name: f.dataType for f in df.schema.fields}
    nums = [_as_number(F.col(quote(c)), dts[c]) for c in cols]
    stats = df.agg(*[F.min(x).alias(f"mn{i}") for i, x in enumerate(nums)],
                   *[F.max(x).alias(f"mx{i}") for i, x in enumerate(nums)]).first()
    top = (1 << bits) - 1
    scaled = []
    for i, x in enumerate(nums):
        lo, hi = stats[f"mn{i}"], stats[f"mx{i}"]
        if lo is None or hi is None or hi == lo:
            scaled.append(F.lit(0).cast("long"))
        else:
            scaled.append(F.least(F.greatest(F.floor((x - F.lit(lo)) / F.lit(hi - lo) * F.lit(top)),
                                              F.lit(0)), F.lit(top)).cast("long"))
    z = F.lit(0).cast("long")
    k = len(scaled)
    for b in range(bits):
        for j, s in enumerate(scaled):
            bit = F.shiftright(s, b).bitwiseAND(F.lit(1))
            z = z.bitwiseOR(F.shiftleft(bit, b * k + j))
    return z


def zorder(df: DataFrame, cols: list[str], partitions: int | None = None, bits: int = 16) -> DataFrame:
    """Cluster by the Z-order code of ``cols`` (good for filters on either)."""
    coded = df.withColumn("__z", zorder_key(df, cols, bits))
    return _by_range(coded, [F.col("__z")], partitions).sortWithinPartitions("__z").drop("__z")


def declared_clustering(spec: TableSpec) -> list[str]:
    """The columns the catalog names as the table's clustering (``CLUSTER BY``)."""
    spark = SparkSession.getActiveSession()
    found = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {spec.qualified}").collect()}
    return [".".join(path) for path in json.loads(found.get("clusteringColumns", "[]"))]


def cluster_table(spec: TableSpec, cols: list[str] | None = None, method: str = "range",
                  partitions: int | None = None) -> dict:
    """Rewrite a table clustered on ``cols`` as a new version; fails when
    another writer changes the table meanwhile.  The columns are declared in
    the catalog (``CLUSTER BY``, of tables without partitions and buckets);
    without ``cols`` the declared ones are used, so that a table is clustered
    again after appends."""
    spark = SparkSession.getActiveSession()
    cols = cols or declared_clustering(spec)
    if not cols:
        raise ValueError(f"{spec.qualified} has no declared clustering; name the columns")
    before = _version(spark, spec)
    df = spark.table(spec.qualified)
    laid = zorder(df, cols, partitions) if method == "zorder" else cluster(df, cols, partitions)
    metrics: dict = {}
    _publish(spark, laid, spec, metrics, expect=before)
    if not (spec.partition_by or spec.buckets):
        spark.sql(f"ALTER TABLE {spec.qualified} CLUSTER BY ({', '.join(quote(c) for c in cols)})")
    return metrics


def compact(spec: TableSpec) -> dict:
    """Rewrite a table's files to about ``spark.sql.adaptive.
    advisoryPartitionSizeInBytes`` each (compaction after many small
    appends or merges).  The REBALANCE hint lets AQE merge small partitions
    and split oversized ones (by partition columns for partitioned tables);
    the result is published as a new version, readers are never blocked; a
    table changed meanwhile by another writer makes it fail.
    Bucketed tables already get one file per bucket on every write."""
    spark = SparkSession.getActiveSession()
    before = _version(spark, spec)
    df = spark.table(spec.qualified)
    if spec.buckets:
        laid = df                          # the bucketed write sizes files itself
    elif spec.partition_by:
        laid = df.hint("rebalance", *spec.partition_by)
    else:
        laid = df.hint("rebalance")
    metrics: dict = {}
    _publish(spark, laid, spec, metrics, expect=before)
    return metrics


def file_ranges(df: DataFrame, cols: list[str]) -> DataFrame:
    """What the files of a table or path hold: ``file, n_rows`` and the least
    and greatest value of every column (``<col>_min``, ``<col>_max``), the
    ranges by which a reader skips files."""
    bounds = [f(quote(c)).alias(f"{c}_{n}") for c in cols for n, f in (("min", F.min), ("max", F.max))]
    return df.select(F.col("_metadata.file_path").alias("file"), *[F.col(quote(c)) for c in cols]) \
        .groupBy("file").agg(F.count(F.lit(1)).alias("n_rows"), *bounds)


def pruning(df: DataFrame, col: str, ranges: list[tuple]) -> DataFrame:
    """Proof of layout: for every ``(low, high)`` of ``ranges`` the files whose
    values of ``col`` overlap it (``files_read``) of all ``files``, and the rows
    they hold (``rows_read``).  One aggregate over the files' ranges."""
    files = file_ranges(df, [col])
    typed = df.schema[col].dataType
    lows, highs = zip(*[(F.lit(lo).cast(typed), F.lit(hi).cast(typed)) for lo, hi in ranges])
    hits = [(F.col(f"{col}_min") <= hi) & (F.col(f"{col}_max") >= lo) for lo, hi in zip(lows, highs)]
    wide = files.agg(F.count(F.lit(1)).alias("files"), *[F.count_if(h).alias(f"f{i}") for i, h in enumerate(hits)],
                     *[F.coalesce(F.sum(F.when(h, F.col("n_rows"))), F.lit(0)).alias(f"r{i}") for i, h in enumerate(hits)])
    rows = [F.struct(lo.alias("low"), hi.alias("high"), F.col(f"f{i}").alias("files_read"), F.col(f"r{i}").alias("rows_read"), "files")
            for i, (lo, hi) in enumerate(zip(lows, highs))]
    return wide.select(F.inline(F.array(*rows)))
