"""File inputs: reading tables with enough parallelism, and landing derived
data once in the shared folder."""

from __future__ import annotations

import hashlib
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Rows of a Parquet input that one task reads while data is landed.
SPLIT_ROWS = 2_000_000


def read_table(spark: SparkSession, path: str, min_splits: int | None = None) -> DataFrame:
    """``spark.read.parquet`` plus one planning-time check: an input that
    yields fewer splits than the cluster has cores (a single row group, an
    unsplittable file) is spread round-robin, so the work before the first
    shuffle is not done by one task.  Inputs of real size (many files or row
    groups) are returned untouched: no extra shuffle."""
    df = spark.read.parquet(path)
    try:
        want = min_splits or spark.sparkContext.defaultParallelism
        splits = df.rdd.getNumPartitions()
    except Exception:        # no RDD access (e.g. a remote session): read as is
        return df
    if splits < want:
        df = df.repartition(want)
    return df


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def input_signature(spark: SparkSession, paths: list[str]) -> str:
    """Digest of the paths, sizes and modification times of the inputs."""
    parts = []
    for path in paths:
        p, fs = _fs(spark, path)
        for st in fs.listStatus(p):
            parts.append(f"{st.getPath()}:{st.getLen()}:{st.getModificationTime()}")
    return hashlib.sha256("\n".join(sorted(parts)).encode()).hexdigest()[:16]


@contextmanager
def split_rows(spark: SparkSession, paths: list[str]):
    """Within it, a task reads about ``SPLIT_ROWS`` rows of the Parquet inputs
    ``paths`` (whole row groups; rows are counted from the footers).

    Splits are cut by bytes, and a well compressed table holds very many rows
    in one: a task that shuffles them to more than a few hundred partitions,
    or counts their keys, buffers them all and spills."""
    setting = "spark.sql.files.maxPartitionBytes"
    limit = whole = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    for path in paths:
        rows = spark.read.parquet(path).count()
        if rows > SPLIT_ROWS:
            p, fs = _fs(spark, path)
            limit = min(limit, max(1, fs.getContentSummary(p).getLength() * SPLIT_ROWS // rows))
    if limit == whole:
        yield
        return
    held = spark.conf.get(setting)
    spark.conf.set(setting, str(limit))
    try:
        yield
    finally:
        spark.conf.set(setting, held)


def land_once(spark: SparkSession, build, target: str, fmt: str = "parquet",
              compression: str | None = None, inputs: list[str] = ()) -> str:
    """Write ``build()`` to ``target`` unless a complete copy is there; its
    Parquet ``inputs`` are read in tasks of bounded rows (``split_rows``).

    The data goes to a fresh sibling directory first and is renamed into
    place, so readers never see a partial landing and a job that dies
    midway leaves nothing behind under ``target``."""
    p, fs = _fs(spark, target)
    if fs.exists(p.suffix("/_SUCCESS")):
        return target
    staging = f"{target}.staging-{uuid.uuid4().hex[:8]}"
    with split_rows(spark, inputs):
        writer = build().write.format(fmt).mode("errorifexists")
        (writer.option("compression", compression) if compression else writer).save(staging)
    sp, _ = _fs(spark, staging)
    if not fs.rename(sp, p) and not fs.exists(p.suffix("/_SUCCESS")):
        raise IOError(f"could not land {target}")
    return target
