"""Schema conformance of a source to a target table (drift guard).

Conformance is by *name* at every depth: nested struct fields may arrive
reordered, missing or extra (API payloads drift that way).  Structs are
rebuilt field by field, arrays and map values through ``transform`` /
``transform_values``, so everything stays in JVM expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.names import quote
from ..functions.schema import widen


class SchemaDriftError(TypeError):
    pass


def _kind(source: T.DataType, target: T.DataType) -> str:
    if source == target:
        return "same"
    if isinstance(source, T.StructType) and isinstance(target, T.StructType):
        return "nested"
    if isinstance(source, T.ArrayType) and isinstance(target, T.ArrayType):
        inner = _kind(source.elementType, target.elementType)
        return "nested" if inner in ("same", "nested", "widen") else inner
    if isinstance(source, T.MapType) and isinstance(target, T.MapType) and source.keyType == target.keyType:
        inner = _kind(source.valueType, target.valueType)
        return "nested" if inner in ("same", "nested", "widen") else inner
    if widen(source, target):
        return "widen"
    return "refuse"


def drift(source: T.StructType, target: T.StructType, prefix: str = ""):
    """(path, source type, target type, action) for every field of either
    side, nested ones as ``a.b`` / ``a[].b`` / ``a{}.b``; action is
    same / widen / missing / extra / refuse (a struct that only differs
    inside is reported through its fields)."""
    src = {f.name.lower(): f for f in source.fields}
    tgt = {f.name.lower(): f for f in target.fields}
    rows = []
    for k, f in tgt.items():
        path = f"{prefix}{f.name}"
        s = src.get(k)
        if s is None:
            rows.append((path, None, f.dataType.simpleString(), "missing"))
            continue
        kind = _kind(s.dataType, f.dataType)
        if kind == "nested":
            rows += _drift_inside(s.dataType, f.dataType, path)
        else:
            rows.append((path, s.dataType.simpleString(), f.dataType.simpleString(), kind))
    for k, s in src.items():
        if k not in tgt:
            rows.append((f"{prefix}{s.name}", s.dataType.simpleString(), None, "extra"))
    return rows


def _drift_inside(s: T.DataType, t: T.DataType, path: str):
    if isinstance(s, T.StructType):
        return drift(s, t, path + ".")
    if isinstance(s, T.ArrayType):
        return _drift_inside(s.elementType, t.elementType, path + "[]")
    if isinstance(s, T.MapType):
        return _drift_inside(s.valueType, t.valueType, path + "{}")
    kind = _kind(s, t)
    return [(path, s.simpleString(), t.simpleString(), kind)]


def drift_report(spark: SparkSession, source: T.StructType, target: T.StructType) -> DataFrame:
    return spark.createDataFrame(
        drift(source, target),
        "column_name string, source_type string, target_type string, action string")


def _conform_value(c: Column, s: T.DataType, t: T.DataType) -> Column:
    if s == t:
        return c
    if isinstance(s, T.StructType) and isinstance(t, T.StructType):
        by_lower = {f.name.lower(): f for f in s.fields}
        fields = []
        for f in t.fields:
            sf = by_lower.get(f.name.lower())
            if sf is None:
                fields.append(F.lit(None).cast(f.dataType).alias(f.name))
            else:
                fields.append(_conform_value(c.getField(sf.name), sf.dataType, f.dataType).alias(f.name))
        return F.when(c.isNull(), F.lit(None).cast(t)).otherwise(F.struct(*fields))
    if isinstance(s, T.ArrayType) and isinstance(t, T.ArrayType):
        return F.transform(c, lambda x: _conform_value(x, s.elementType, t.elementType))
    if isinstance(s, T.MapType) and isinstance(t, T.MapType):
        return F.transform_values(c, lambda _k, v: _conform_value(v, s.valueType, t.valueType))
    return c.cast(t)


def conform(df: DataFrame, target: T.StructType, extra: str = "drop") -> DataFrame:
    """Reshape ``df`` to ``target``: same columns, order and types at every
    depth; missing columns or fields become typed NULLs; lossless widenings
    are cast; anything else raises before a row is read.
    ``extra`` (top-level columns not in the target): drop | keep | fail;
    extra nested fields are always dropped."""
    rows = drift(df.schema, target)
    refused = [r for r in rows if r[3] == "refuse"]
    if refused:
        raise SchemaDriftError(f"cannot conform without loss: {refused}")
    top_extra = [f.name for f in df.schema.fields
                 if f.name.lower() not in {t.name.lower() for t in target.fields}]
    if top_extra and extra == "fail":
        raise SchemaDriftError(f"columns not in the target: {top_extra}")
    by_lower = {f.name.lower(): f for f in df.schema.fields}
    cols = []
    for f in target.fields:
        sf = by_lower.get(f.name.lower())
        if sf is None:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
        else:
            cols.append(_conform_value(F.col(quote(sf.name)), sf.dataType, f.dataType).alias(f.name))
    if extra == "keep":
        cols += [F.col(quote(c)) for c in top_extra]
    return df.select(*cols)


def merge_types(target: T.DataType, source: T.DataType, path: str = "") -> T.DataType:
    """``target`` with everything ``source`` has beyond it, at every depth:
    new struct fields go last and are nullable, arrays and maps are merged
    through their elements; elsewhere the target's type stays and must take
    the source's without loss."""
    if isinstance(target, T.StructType) and isinstance(source, T.StructType):
        theirs = {f.name.lower(): f for f in source.fields}
        fields = []
        for f in target.fields:
            s = theirs.pop(f.name.lower(), None)
            fields.append(f if s is None else T.StructField(f.name, merge_types(f.dataType, s.dataType, f"{path}.{f.name}"), f.nullable, f.metadata))
        return T.StructType(fields + [T.StructField(f.name, f.dataType, True) for f in theirs.values()])
    if isinstance(target, T.ArrayType) and isinstance(source, T.ArrayType):
        return T.ArrayType(merge_types(target.elementType, source.elementType, f"{path}[]"), target.containsNull)
    if isinstance(target, T.MapType) and isinstance(source, T.MapType) and target.keyType == source.keyType:
        return T.MapType(target.keyType, merge_types(target.valueType, source.valueType, f"{path}{{}}"), target.valueContainsNull)
    if not widen(source, target):
        raise SchemaDriftError(f"{path.lstrip('.')}: {source.simpleString()} does not fit {target.simpleString()}")
    return target
