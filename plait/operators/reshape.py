"""Projections of nested data: star expansion, flattening, SQL-safe names,
and the vertical split of one record into narrow tables sharing a key."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.names import check_unique, quote, rename_type, safe_name


def field(path: str) -> Column:
    """A struct field by dotted path; parts may hold dashes (``properties.h3-index``)."""
    return F.col(".".join(quote(p) for p in path.split(".")))


def expand_struct(df: DataFrame, column: str, keep: bool = True) -> DataFrame:
    """``select("s.*", "*")`` minus ``s``: the struct's fields become columns;
    with ``keep`` the other columns follow.  Name clashes raise."""
    dt = df.schema[column].dataType
    if not isinstance(dt, T.StructType):
        raise TypeError(f"{column!r} is {dt.simpleString()}, not a struct; nothing to expand")
    inner = [F.col(f"{quote(column)}.{quote(f.name)}").alias(f.name) for f in dt.fields]
    names = [f.name for f in dt.fields]
    rest = [c for c in df.columns if c != column] if keep else []
    check_unique(names + rest, f"expansion of {column}")
    return df.select(*inner, *[F.col(quote(c)) for c in rest])


def rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Rename top-level columns; names that are absent are ignored."""
    present = {k: v for k, v in mapping.items() if k in df.columns}
    return df.withColumnsRenamed(present) if present else df


def sanitize_names(df: DataFrame, replacement: str = "") -> DataFrame:
    """SQL-safe names at every depth, in one projection.

    Nested fields are renamed by casting each column to the same type with
    new field names (a cast by position); case-insensitive collisions raise
    before anything runs.
    """
    rule = lambda n: safe_name(n, replacement)
    cols, names = [], []
    for f in df.schema.fields:
        new_name = rule(f.name)
        new_type = rename_type(f.dataType, rule, f.name)
        c = F.col(quote(f.name))
        if new_type != f.dataType:
            c = c.cast(new_type)
        cols.append(c.alias(new_name))
        names.append(new_name)
    check_unique(names, "root")
    return df.select(*cols)


def flatten(df: DataFrame, explode: tuple[str, ...] | list[str] = (), sep: str = "_",
            outer: bool = True, sanitize: bool = True, pairs: bool = False) -> DataFrame:
    """Flatten structs of any depth to columns named ``a_b_c``.

    Arrays stay arrays unless their flattened name is listed in ``explode``;
    those are exploded (``explode_outer`` by default, so parents without
    elements are kept) and flattening continues into their elements.  Each
    round is one projection; Catalyst collapses them.

    Two arrays beside each other would give every pair of their elements:
    that raises unless ``pairs`` asks for it (flatten once per array instead,
    keeping a key).  An array inside an element of another is no such case.
    """
    pending, exploded = list(explode), []
    out = df
    while True:
        cols, names = [], []
        for path, _dt in _leaves(out.schema):
            name = sep.join(safe_name(p) if sanitize else p for p in path)
            cols.append(F.col(".".join(quote(p) for p in path)).alias(name))
            names.append(name)
        check_unique(names, "flattened table")
        out = out.select(*cols)
        todo = [n for n in pending if n in out.columns
                and isinstance(out.schema[n].dataType, (T.ArrayType, T.MapType))]
        if not todo:
            missing = [n for n in pending if n not in out.columns]
            if missing:
                raise ValueError(f"cannot explode {missing}: no such array after flattening")
            return out
        if not pairs and (len(todo) > 1 or exploded and not todo[0].startswith(exploded[-1] + sep)):
            raise ValueError(f"{(exploded + todo)[-2:]} lie beside each other: exploding both gives all pairs")
        for name in todo:
            exploded.append(name)
            # posexplode_outer (+ pos IS NOT NULL when not outer): the same rows
            # as (outer) explode, and no inferred filter that re-parses JSON
            gen = F.posexplode_outer(F.col(quote(name)))
            rest = [F.col(quote(c)) for c in out.columns if c != name]
            if isinstance(out.schema[name].dataType, T.MapType):
                out = out.select(*rest, gen.alias("__pos", f"{name}{sep}key", f"{name}{sep}value"))
            else:
                out = out.select(*rest, gen.alias("__pos", name))
            if not outer:
                out = out.where(F.col("__pos").isNotNull())
            out = out.drop("__pos")
            pending.remove(name)


def _leaves(schema: T.StructType, prefix: tuple[str, ...] = ()):
    for f in schema.fields:
        path = prefix + (f.name,)
        if isinstance(f.dataType, T.StructType) and f.dataType.fields:
            yield from _leaves(f.dataType, path)
        else:
            yield path, f.dataType


class Split(dict):
    """Narrow tables cut from one parent; ``release()`` unpersists the parent."""

    parent: DataFrame | None = None

    def release(self) -> None:
        if self.parent is not None and self.parent.is_cached:
            self.parent.unpersist()


def split(df: DataFrame, parts: dict[str, list[str]], key: dict[str, str],
          persist: bool = False) -> Split:
    """Vertical split (bifurcation) of one record into tables sharing a key.

    ``parts`` maps a table name to column paths: ``"geometry.*"`` expands a
    struct, ``"properties.n"`` takes one field.  ``key`` maps the key's output
    name to its path; it is added to every part that does not already hold
    it.  All output names are SQL-safe.  ``persist`` keeps the parent once so
    the branches do not each recompute it: the fields that any part uses, as
    plain columns (no codec shortens those of a struct), on the executors'
    disks.  A serialised block in memory takes about twice its accounted size
    of the heap (its chunks of 1 MB and their header need two regions each),
    so a parent that fills the storage memory leaves none for the tasks.
    """
    columns: dict[str, list[tuple[str, str]]] = {}
    for name, paths in parts.items():
        cols = []
        for p in paths:
            if p.endswith(".*"):
                base = p[:-2]
                dt = _type_at(df.schema, base)
                if not isinstance(dt, T.StructType):
                    raise TypeError(f"{base!r} is not a struct")
                cols += [(f"{base}.{f.name}", safe_name(f.name)) for f in dt.fields]
            else:
                cols.append((p, safe_name(p.split(".")[-1])))
        for kname, kpath in key.items():
            if kname not in [n for _, n in cols]:
                cols.insert(0, (kpath, kname))
        check_unique([n for _, n in cols], f"part {name}")
        columns[name] = cols
    out, parent, at = Split(), df, field
    if persist:
        used = dict.fromkeys(path for cols in columns.values() for path, _ in cols)
        parent = df.select(*[field(path).alias(path) for path in used]).persist(StorageLevel.DISK_ONLY)
        out.parent, at = parent, lambda path: F.col(quote(path))
    for name, cols in columns.items():
        out[name] = sanitize_names(parent.select(*[at(path).alias(n) for path, n in cols]))
    return out


def _type_at(schema: T.StructType, path: str) -> T.DataType:
    dt: T.DataType = schema
    for part in path.split("."):
        if not isinstance(dt, T.StructType):
            raise KeyError(path)
        dt = dt[part].dataType
    return dt


def recombine(parts, key: str | list[str], how: str = "inner", check_unique: bool = True) -> DataFrame:
    """Late-stage join of split tables on their key.

    The key is declared unique; if it were duplicated on both sides, each key
    group would multiply out (all pairs).  With ``check_unique`` every table
    after the first is checked first (one aggregate each; free of shuffles on
    tables bucketed by the key) and a duplicate raises DuplicateKeyError, so
    at most one row joins each row of the first table."""
    from .keys import assert_unique
    frames = list(parts.values()) if isinstance(parts, dict) else list(parts)
    keys = [key] if isinstance(key, str) else list(key)
    if check_unique:
        for f in frames[1:]:
            assert_unique(f, keys)
    out = frames[0]
    for f in frames[1:]:
        out = out.join(f, keys, how)
    return out
