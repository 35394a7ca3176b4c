"""Schema helpers: walking a StructType and reading inferred schema text."""

from __future__ import annotations

import re

from pyspark.sql import types as T


def leaf_paths(schema: T.StructType, prefix: tuple[str, ...] = ()):
    """Yield (path tuple, data type, nullable) for every non-struct field."""
    for f in schema.fields:
        path = prefix + (f.name,)
        if isinstance(f.dataType, T.StructType) and f.dataType.fields:
            yield from leaf_paths(f.dataType, path)
        else:
            yield path, f.dataType, f.nullable


def all_paths(dt: T.DataType, prefix: str = "", nullable: bool = True):
    """Yield (dotted path, type string, nullable) for every node, depth first.
    Array elements appear as ``path[]`` and map values as ``path{}``."""
    if isinstance(dt, T.StructType):
        for f in dt.fields:
            p = f"{prefix}.{f.name}" if prefix else f.name
            yield p, f.dataType.simpleString(), f.nullable
            yield from all_paths(f.dataType, p, f.nullable)
    elif isinstance(dt, T.ArrayType):
        p = prefix + "[]"
        yield p, dt.elementType.simpleString(), dt.containsNull
        yield from all_paths(dt.elementType, p, dt.containsNull)
    elif isinstance(dt, T.MapType):
        p = prefix + "{}"
        yield p, dt.valueType.simpleString(), dt.valueContainsNull
        yield from all_paths(dt.valueType, p, dt.valueContainsNull)


_VARIANT_WORDS = [
    # Type names as printed by schema_of_variant(_agg), mapped
    # to the Spark DDL they stand for.
    (r"\bOBJECT<", "STRUCT<"),
    (r"\bVARIANT\b(?!\s*:)", "STRING"),  # a field of that name is followed by a colon
]


def ddl_from_variant_schema(text: str) -> T.DataType:
    """Turn the text of ``schema_of_variant_agg`` into a Spark type.

    Field names are re-quoted with back-ticks so names such as ``h3-index``
    survive the DDL parser.
    """
    out = text
    for pat, rep in _VARIANT_WORDS:
        out = re.sub(pat, rep, out)
    # quote field names:  <name: TYPE  or , name: TYPE
    out = re.sub(r"([<,]\s*)(?!`)([^<>,:`\s][^<>,:`]*?)(\s*:)",
                 lambda m: f"{m.group(1)}`{m.group(2).strip()}`{m.group(3)}", out)
    return T._parse_datatype_string(out)


def widen(source: T.DataType, target: T.DataType) -> bool:
    """True when a value of ``source`` fits ``target`` without loss."""
    if source == target:
        return True
    order = [T.ByteType, T.ShortType, T.IntegerType, T.LongType]
    s = next((i for i, t in enumerate(order) if isinstance(source, t)), None)
    t = next((i for i, t in enumerate(order) if isinstance(target, t)), None)
    if s is not None and t is not None:
        return s <= t
    if isinstance(target, T.DoubleType) and (s is not None and s <= 2 or isinstance(source, T.FloatType)):
        return True
    if isinstance(target, T.StringType) and isinstance(source, T.StringType):
        return True
    if isinstance(target, T.TimestampType) and isinstance(source, T.DateType):
        return True
    if isinstance(target, T.TimestampNTZType) and isinstance(source, T.DateType):
        return True
    if isinstance(source, T.NullType):
        return True
    if isinstance(source, T.StructType) and isinstance(target, T.StructType):
        tf = {f.name.lower(): f for f in target.fields}
        return all(f.name.lower() in tf and widen(f.dataType, tf[f.name.lower()].dataType)
                   for f in source.fields)
    if isinstance(source, T.ArrayType) and isinstance(target, T.ArrayType):
        return widen(source.elementType, target.elementType)
    return False


def to_ddl(dt: T.DataType, top: bool = True) -> str:
    """Spark DDL text for a type; every field name is back-quoted, so names
    such as ``h3-index`` survive a round trip through the parser."""
    q = lambda n: "`" + n.replace("`", "``") + "`"
    if isinstance(dt, T.StructType):
        inner = ", ".join(f"{q(f.name)}{' ' if top else ': '}{to_ddl(f.dataType, False)}"
                          + ("" if f.nullable else " NOT NULL") for f in dt.fields)
        return inner if top else f"STRUCT<{inner}>"
    if isinstance(dt, T.ArrayType):
        return f"ARRAY<{to_ddl(dt.elementType, False)}>"
    if isinstance(dt, T.MapType):
        return f"MAP<{to_ddl(dt.keyType, False)}, {to_ddl(dt.valueType, False)}>"
    return dt.simpleString()
