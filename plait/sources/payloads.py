"""Reading JSON payloads: declared-schema parse, explicit inference, corrupt
record capture and the valid / quarantine split."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.names import quote
from ..functions.schema import ddl_from_variant_schema

CORRUPT = "_corrupt_record"


def _as_struct(schema) -> T.StructType:
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    if not isinstance(schema, T.StructType):
        raise TypeError("a payload schema must be a StructType or DDL text")
    return schema


def with_corrupt_field(schema, name: str = CORRUPT) -> T.StructType:
    schema = _as_struct(schema)
    if name in schema.fieldNames():
        return schema
    return T.StructType(schema.fields + [T.StructField(name, T.StringType(), True)])


def read_payloads(spark: SparkSession, path: str | list[str], schema,
                  multi_line: bool = False, corrupt: str = CORRUPT,
                  file_name: str | None = None) -> DataFrame:
    """Landed payload files -> one row per JSON document.

    ``multi_line=True`` reads pretty-printed documents (one file is one task);
    JSON Lines files (the default) are split across tasks.  The schema is
    declared, so reading needs no inference pass and malformed documents go
    to ``corrupt``.
    """
    reader = (spark.read.schema(with_corrupt_field(schema, corrupt))
              .option("mode", "PERMISSIVE")
              .option("columnNameOfCorruptRecord", corrupt)
              .option("multiLine", str(bool(multi_line)).lower()))
    df = reader.json(path)
    if file_name:
        df = df.withColumn(file_name, F.col("_metadata.file_path"))
    return df


def unroll_arrays(df: DataFrame, col: str) -> DataFrame:
    """One row per item of a text that is a JSON array, as reading such a file
    gives; any other text (NULL, blank, malformed) stays one row, an empty
    array gives none.  Items keep their own JSON text."""
    text = F.col(quote(col))
    items = F.when(F.ltrim(text).startswith("["), F.from_json(text, "array<string>"))
    out = [F.col(quote(c)) for c in df.columns if c != col]
    return (df.withColumn(col, F.coalesce(items, F.array(text)))
            .select(*out, F.explode(quote(col)).alias(col)).select(*[F.col(quote(c)) for c in df.columns]))


def parse_json(df: DataFrame, col: str, schema, alias: str | None = None,
               corrupt: str = CORRUPT, keep: bool = True, items: bool = False) -> DataFrame:
    """Parse a JSON text column with a declared schema (PERMISSIVE).

    Adds ``alias`` (default: the column name) as the parsed struct, without
    the corrupt field, and a top-level ``corrupt`` column that holds the raw
    text of rows that did not parse.  ``keep=False`` drops the text column.
    ``items=True`` first gives every item of a top-level array its own row
    (``unroll_arrays``); without it such a text counts as malformed.
    """
    if items:
        df = unroll_arrays(df, col)
    target = alias or col
    full = with_corrupt_field(schema, corrupt)
    blank = F.col(col).isNull() | (F.trim(F.col(col)) == "")
    parsed = F.from_json(F.when(blank, F.lit("{}")).otherwise(F.col(col)), full, {"mode": "PERMISSIVE",
                                            "columnNameOfCorruptRecord": corrupt})
    tmp = f"__parsed_{target}"
    out = df.withColumn(tmp, parsed)
    fields = [F.col(f"{tmp}.{f.name}" if re.fullmatch(r"\w+", f.name) else f"{tmp}.`{f.name}`")
              .alias(f.name) for f in _as_struct(schema).fields]
    out = out.withColumn(target, F.struct(*fields)).withColumn(
        corrupt, F.when(blank, F.lit("")).otherwise(F.col(f"{tmp}.{corrupt}")))
    out = out.drop(tmp)
    if not keep and target != col:
        out = out.drop(col)
    return out


def split_valid(df: DataFrame, corrupt: str = CORRUPT,
                status: str | None = None, ok: tuple[int, ...] = (200,)):
    """(valid, quarantine): rows whose text did not parse or is null or blank, or whose response
    status is not in ``ok``, go to quarantine with a ``reason``."""
    bad = F.col(corrupt).isNotNull()
    reason = F.when(F.trim(corrupt) == "", F.lit("empty")).when(bad, F.lit("malformed"))
    if status is not None:
        bad_status = F.col(status).isNull() | ~F.col(status).isin(*ok)
        reason = F.when(bad_status, F.concat(F.lit("status "), F.coalesce(F.col(status).cast("string"), F.lit("null")))).otherwise(reason)
        bad = bad | bad_status
    valid = df.where(~bad).drop(corrupt)
    quarantine = df.where(bad).withColumn("reason", reason)
    return valid, quarantine


# How number types printed by variant inference are mapped so
# that the result equals what JSON file inference gives (fractions -> double).
_DECIMAL_WITH_SCALE = re.compile(r"DECIMAL\((\d+),\s*([1-9]\d*)\)")
_DECIMAL_NO_SCALE = re.compile(r"DECIMAL\((\d+),\s*0\)")


def infer_schema(df: DataFrame, col: str, sample_ratio: float = 1.0,
                 seed: int = 17) -> T.DataType:
    """Schema of a JSON text column as an explicit, separate step.

    One aggregate (``schema_of_variant_agg``, merged map-side) runs over the
    column or over a sample of it; only the schema text reaches the driver.
    Unparseable texts are ignored.
    """
    src = df.select(F.col(col).alias("j"))
    if sample_ratio < 1.0:
        src = src.sample(withReplacement=False, fraction=sample_ratio, seed=seed)
    text = src.select(F.schema_of_variant_agg(F.try_parse_json("j")).alias("s")).first()["s"]
    if text is None:
        return T.StructType([])
    text = _DECIMAL_WITH_SCALE.sub("DOUBLE", text)
    text = _DECIMAL_NO_SCALE.sub(lambda m: "BIGINT" if int(m.group(1)) <= 18 else m.group(0), text)
    return ddl_from_variant_schema(text)


def infer_file_schema(spark: SparkSession, path, sample_ratio: float = 1.0,
                      multi_line: bool = False) -> T.StructType:
    """Schema of landed JSON files, with Spark's JSON inference (sampled)."""
    return (spark.read.option("samplingRatio", sample_ratio)
            .option("multiLine", str(bool(multi_line)).lower()).json(path).schema)


# GeoJSON geometry types and the array depth of their
# coordinates (RFC 7946).
GEOMETRY_DEPTH = {
    "Point": 1,
    "LineString": 2,
    "MultiPoint": 2,
    "Polygon": 3,
    "MultiLineString": 3,
    "MultiPolygon": 4,
}


def geometry_columns(df: DataFrame, geometry: str = "geometry",
                     kinds: tuple[str, ...] = ("Polygon", "MultiPolygon")) -> DataFrame:
    """Keep mixed geometry shapes lossless.

    The read schema declares ``<geometry>.coordinates`` as a string, which
    keeps the raw JSON of any depth; each wanted kind then gets its own typed
    column, parsed only for rows of that kind.
    """
    gtype = F.col(f"{geometry}.type")
    raw = F.col(f"{geometry}.coordinates")
    out = df
    for kind in kinds:
        depth = GEOMETRY_DEPTH[kind]
        dt: T.DataType = T.DoubleType()
        for _ in range(depth):
            dt = T.ArrayType(dt)
        out = out.withColumn(f"{kind.lower()}_coordinates",
                             F.when(gtype == kind, F.from_json(raw, dt)))
    return out
