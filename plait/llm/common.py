"""Helpers the operators of this subpackage share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import shared_dir

#: A word is a run of anything but space and the controls tab to carriage return.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = r"[\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder and cut its lineage."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(c, UPPER, LOWER)


def n_words(c: Column) -> Column:
    """Number of words of a text; 0 for a null text."""
    return F.coalesce(F.regexp_count(c, F.lit(WORD)), F.lit(0)).cast("long")


def word_array(c: Column) -> Column:
    """Words of a text in order; no words for a null text."""
    parts = F.split(F.coalesce(c, F.lit("")), SPACES)
    return F.filter(parts, lambda w: w != "")


def unit_hash(seed: str, c: Column) -> Column:
    """A number in [0, 1) that only depends on the seed and the value."""
    text = F.concat(F.lit(seed + ":"), F.coalesce(c.cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") / F.lit(4294967296.0)


def global_rank(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Adds the 1-based position of each row in a total order, without
    bringing all rows into one task: a range sort, then per-partition counts.
    The result is materialised, so the positions are fixed."""
    ranked = cut(df.orderBy(*order).withColumn("_pl_mid", F.monotonically_increasing_id()))
    part = F.shiftright("_pl_mid", 33)
    before = Window.orderBy("_pl_part").rowsBetween(Window.unboundedPreceding, -1)
    # one row per partition of the sorted table
    sizes = ranked.groupBy(part.alias("_pl_part")).agg(F.count("*").alias("_pl_n")) \
        .select("_pl_part", F.coalesce(F.sum("_pl_n").over(before), F.lit(0)).alias("_pl_before"))
    row = F.col("_pl_mid").bitwiseAND(F.lit((1 << 33) - 1))
    return ranked.join(F.broadcast(sizes), part == F.col("_pl_part")) \
        .withColumn(name, F.col("_pl_before") + row + 1).drop("_pl_mid", "_pl_part", "_pl_before")
