"""Column-name rules: SQL-safe names and the nested rename they drive."""

from __future__ import annotations

import re

from pyspark.sql import types as T

# Characters kept as they are in a SQL-safe identifier; every
# other character is removed, so "h3-index" becomes "h3index".
_UNSAFE = re.compile(r"[^0-9A-Za-z_]+")


class NameCollisionError(ValueError):
    """Two different source names map to the same (case-insensitive) name."""


def safe_name(name: str, replacement: str = "") -> str:
    out = _UNSAFE.sub(replacement, name)
    if not out:
        out = "_"
    if out[0].isdigit():
        out = "_" + out
    return out


def check_unique(names, where: str = "") -> None:
    """Raise if names collide once case is ignored (as Spark resolves them)."""
    seen: dict[str, str] = {}
    for n in names:
        k = n.lower()
        if k in seen:
            raise NameCollisionError(
                f"column names {seen[k]!r} and {n!r} collide{(' in ' + where) if where else ''}")
        seen[k] = n


def rename_type(dt: T.DataType, rule, path: str = "") -> T.DataType:
    """Apply ``rule`` to every struct field name, at any depth (also inside
    arrays and map values).  Positions and types are kept, so
    ``col.cast(rename_type(col_type, rule))`` renames nested fields."""
    if isinstance(dt, T.StructType):
        fields = []
        for f in dt.fields:
            fields.append(T.StructField(rule(f.name), rename_type(f.dataType, rule, f"{path}.{f.name}"),
                                        f.nullable, f.metadata))
        check_unique([f.name for f in fields], path or "root")
        return T.StructType(fields)
    if isinstance(dt, T.ArrayType):
        return T.ArrayType(rename_type(dt.elementType, rule, path + "[]"), dt.containsNull)
    if isinstance(dt, T.MapType):
        return T.MapType(dt.keyType, rename_type(dt.valueType, rule, path + "{}"),
                         dt.valueContainsNull)
    return dt


def quote(name: str) -> str:
    """Back-tick a single name for use inside a column path."""
    return "`" + name.replace("`", "``") + "`"
