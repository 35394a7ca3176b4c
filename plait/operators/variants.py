"""Documents whose shape is not known beforehand, opened level by level over VARIANT.

Every level is one lateral ``variant_explode`` in the same pass over the
documents: values that hold nothing more pass through, so no level is written
or shuffled.  The number of levels is measured first, by one aggregate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.names import quote
from ..session import shared_dir


def _variant(df: DataFrame, col: str) -> Column:
    c = F.col(quote(col))
    return c if df.schema[col].dataType.simpleString() == "variant" else F.try_parse_json(c)


#: Levels opened in one pass; deeper documents are written in between, so that no plan grows without end.
LEVELS_A_PASS = 16


def _opened(df: DataFrame, keep: list[Column], value: Column, step: Column) -> DataFrame:
    """One row per entry of ``value``, with ``path`` grown by ``step``; a row
    whose ``value`` has no entries stays as it is."""
    found = df.lateralJoin(df.sparkSession.tvf.variant_explode_outer(value.outer()))
    entry = F.col("pos").isNotNull()
    return found.select(*keep, F.when(entry, step).otherwise(F.col("path")).alias("path"),
                        F.when(entry, F.col("value")).otherwise(F.col("_v")).alias("_v"))


def _depth(value: Column) -> Column:
    """How deep the objects and arrays of a VARIANT lie in each other, empty
    ones not counted: the deepest bracket of its JSON outside strings."""
    text = F.regexp_replace(F.regexp_replace(value.cast("string"), r"(?s)\\.", ""), '"[^"]*"', "s")
    brackets = F.regexp_replace(F.regexp_replace(text, r"\[\]|\{\}", ""), r"[^\[\]{}]+", "")
    start = F.struct(F.lit(0).alias("now"), F.lit(0).alias("most"))

    def walk(at: Column, c: Column) -> Column:
        now = at["now"] + F.when(c.isin("[", "{"), 1).when(c.isin("]", "}"), -1).otherwise(0)
        return F.struct(now.alias("now"), F.greatest(at["most"], now).alias("most"))

    return F.aggregate(F.split(brackets, ""), start, walk, lambda at: at["most"])


def path_values(df: DataFrame, col: str, keep: list[str]) -> DataFrame:
    """``keep`` columns, ``path``, ``kind`` and ``value``: one row per scalar of
    the JSON text or VARIANT ``col``, at any depth and without a declared schema.

    Paths are like ``features[0].properties.line-key``; names that hold other
    characters than letters, digits, ``_`` and ``-`` are back-quoted.  ``kind`` is
    the VARIANT type (VOID: a JSON null, whose value is NULL).  Empty objects
    and arrays are values of their own (``{}``, ``[]``).  A NULL or a text that
    does not parse is one row with an empty path and NULL kind and value.
    ``keep`` columns must not be called path, kind or value.  ``df`` is read
    twice, for the depth and for the values, and must give the same rows.
    """
    kept = [F.col(quote(k)) for k in keep]
    level = df.select(*kept, F.lit("").alias("path"), _variant(df, col).alias("_v"))
    depth = level.agg(F.max(_depth(F.col("_v")))).first()[0] or 0
    name = F.when(F.col("key").rlike(r"^[\p{L}\p{N}_-]+$"), F.col("key")).otherwise(
        F.concat(F.lit("`"), F.replace("key", F.lit("`"), F.lit("``")), F.lit("`")))
    step = F.when(F.col("key").isNull(), F.concat("path", F.lit("["), F.col("pos").cast("string"), F.lit("]"))) \
        .when(F.col("path") == "", name).otherwise(F.concat("path", F.lit("."), name))
    for n in range(depth):
        level = _opened(_written(level, n), kept, F.col("_v"), step)
    return level.select(*kept, "path", F.regexp_extract(F.schema_of_variant("_v"), r"^\w+", 0).alias("kind"),
                        F.col("_v").cast("string").alias("value"))


def _written(level: DataFrame, n: int) -> DataFrame:
    if n == 0 or n % LEVELS_A_PASS:
        return level
    shared_dir(level.sparkSession)
    return level.checkpoint()


def geometry_parts(df: DataFrame, col: str, keep: list[str]) -> DataFrame:
    """``keep`` columns, ``path``, ``kind`` and ``coordinates``: one row per
    simple geometry of the GeoJSON geometry ``col`` (JSON text or VARIANT).

    The members of a GeometryCollection, and of collections inside it, become
    rows of their own; ``path`` is their place (``0``, ``1.0``; empty for a
    geometry that is no collection).  ``coordinates`` is the raw JSON, so no
    shape is lost; ``geometry_columns`` gives it types.  An empty collection
    is a row of kind GeometryCollection without coordinates; NULL or a text
    that does not parse is a row without kind.
    """
    kept = [F.col(quote(k)) for k in keep]
    level = df.select(*kept, F.lit("").alias("path"), _variant(df, col).alias("_v"))
    step = F.concat_ws(".", F.when(F.col("path") != "", F.col("path")), F.col("pos").cast("string"))
    kind = F.try_variant_get("_v", "$.type", "string")
    members = F.when(kind == "GeometryCollection", F.try_variant_get("_v", "$.geometries", "variant"))
    n = 0
    while not level.where(F.try_variant_get(members, "$[0]", "variant").isNotNull()).isEmpty():
        level = _written(level, n).withColumn("_members", members)
        level, n = _opened(level, kept, F.col("_members"), step), n + 1
    return level.select(*kept, "path", kind.alias("kind"),
                        F.try_variant_get("_v", "$.coordinates", "variant").cast("string").alias("coordinates"))
