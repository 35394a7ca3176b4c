"""Generators: one row per element of an array or entry of a map."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.names import quote


def explode_rows(df: DataFrame, column: str, alias: str = "col", outer: bool = False,
                 position: bool = False, keep: list[str] | None = None,
                 guard_reparse: bool = False, rebalance: bool = False) -> DataFrame:
    """explode / explode_outer / posexplode / posexplode_outer in one call.

    Arrays give ``alias`` (default ``col`` as Spark names it); maps give
    ``key, value``; ``position=True`` adds ``pos``.  ``keep`` lists the other
    columns to carry (default: every column but the exploded one, or the
    root column of a nested path, so the array is not copied onto each
    output row).

    Semantics (Spark's): a NULL or empty array gives no row, or one row of
    NULLs with ``outer``; a NULL *element* always gives a row.

    ``guard_reparse``: for a non-outer explode over an expensive input (a
    ``from_json`` result), the optimizer infers ``size(x) > 0`` from the
    generator and pushes it below the parse, so the text is parsed twice.
    posexplode_outer followed by ``pos IS NOT NULL`` has the same rows as
    (pos)explode and no inferred filter.

    ``rebalance``: one document is one row, parsed and exploded by one task;
    when single documents hold very many elements, a REBALANCE after the
    generator lets AQE split the oversized partitions (one extra shuffle).
    """
    # default carry: every column but the one holding the array (for a nested
    # path such as ``doc.features`` that is its root column ``doc``)
    root = column if column in df.columns else column.split(".")[0].strip("`")
    carry = [c for c in df.columns if c != root] if keep is None else list(keep)
    target: Column = F.col(quote(column)) if column in df.columns else F.expr(column)
    is_map = isinstance(df.select(target).schema[0].dataType, T.MapType)
    names = (["key", "value"] if is_map else [alias])
    guard = guard_reparse and not outer
    if position or guard:
        gen = (F.posexplode_outer if (outer or guard) else F.posexplode)(target)
        at = "pos" if position else "_pl_pos"       # a kept column may be called pos
        out = df.select(*carry, gen.alias(at, *names))
        if guard:
            out = out.where(F.col(at).isNotNull())
            if not position:
                out = out.drop(at)
        return out.hint("rebalance") if rebalance else out
    gen = (F.explode_outer if outer else F.explode)(target)
    out = df.select(*carry, gen.alias(*names))
    return out.hint("rebalance") if rebalance else out
