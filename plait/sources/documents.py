"""Nested JSON documents built from flat tables.

An API reply is one JSON document holding an array of ``features``.  The
driver's tables are flat, so the catalogue derives such documents from them
with Spark: child rows are grouped under their parent key into arrays and
the result is serialised with ``to_json``.

A parent may own any number of children (assume one key holds a third of
all rows), so a document holds about ``page_size`` features: a parent with n
children is spread over ceil(n / page_size) pages by a deterministic salt,
like a paged API.  Children that share a salt beyond a page, equal ones
included, are spread by a hash, so every group that is collected is bounded.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT_PAGE_SIZE = 500
#: Child rows that one task groups.
DEFAULT_TASK_ROWS = 250_000


def nest(parent: DataFrame, child: DataFrame, key: str, child_key: str,
         properties: Column, feature: Column, order: list[Column], salt: Column | None = None,
         page_size: int = DEFAULT_PAGE_SIZE, doc_type: str = "FeatureCollection",
         max_broadcast_keys: int = 1_000_000, task_rows: int = DEFAULT_TASK_ROWS) -> DataFrame:
    """One row per document: ``doc_key, <key>, page, doc`` (doc is a struct
    ``type, properties, features``).  Parents without children get one
    document with an empty ``features`` array.

    ``parent`` must hold one row per key (duplicates would repeat every page).
    ``order`` fixes the order of features inside a document.  ``salt``, a
    deterministic bigint of the child row (default: a hash of ``order`` and the
    feature), names the page of a child; where more than ``page_size``
    children of a key share a salt, they are spread by a hash of order and
    feature instead, and equal ones in lots of a tenth of a page.

    Plan: only keys with more than ``page_size`` children need pages.  They
    are counted first (one aggregate over the key column): with none, no
    join is planned for them; with at most ``max_broadcast_keys`` (a measured
    bound, ~16 bytes each) they are broadcast; beyond that they are joined
    by key with a shuffle.  The children of all other keys are shuffled once,
    by key and as the plain columns they come in; structs are built after it,
    so no nested row is written to a shuffle.  The same count gives the number
    of tasks, about ``task_rows`` rows each, so the rows that one task sorts
    stay bounded and are not spilled.  Grouping the other children on
    (key, page) hashes on both, so the pages of a hot key are collected by
    different tasks.  Parents are left joined on (key, page) too: the
    grouping's partitioning is reused, and the pages of a hot key stay spread.
    """
    # a child without a parent key belongs to no document (the parent join
    # would drop it); dropping it first keeps NULL from becoming one huge group
    if salt is None:
        salt = F.xxhash64(F.struct(*order), feature)
    child = child.where(F.col(child_key).isNotNull())
    packed = [F.col(child_key).alias("_k"), F.struct(*order).alias("_o"), feature.alias("_f")]
    p = parent.select(F.col(key).alias("_k"), properties.alias("properties"))
    counts = child.groupBy(F.col(child_key).alias("_k")).agg(F.count(F.lit(1)).alias("_n"))
    is_hot = F.col("_n") > F.lit(page_size)
    n_hot, n_rows = counts.agg(F.count_if(is_hot), F.coalesce(F.sum("_n"), F.lit(0))).first()
    tasks = max(child.sparkSession.sparkContext.defaultParallelism, math.ceil(n_rows / task_rows))
    whole, pages = child, p
    if n_hot:
        hot = counts.where(is_hot).select("_k", F.ceil(F.col("_n") / F.lit(page_size)).alias("_pages"))
        side = F.broadcast(hot) if n_hot <= max_broadcast_keys else hot
        whole = child.join(side, F.col(child_key) == side["_k"], "left_anti")
        pages = p.join(side, "_k", "left_anti")
    # the literal page keeps both branches alike; it costs no shuffle
    one = whole.repartition(tasks, child_key).select(*packed)
    docs = _documents(pages.withColumn("_page", F.lit(0)), one.withColumn("_page", F.lit(0)), many=False)
    if n_hot:
        marked = child.select(*packed, salt.alias("_s")).join(side, "_k")
        distinct = marked.groupBy("_k", "_s", "_o", "_f", "_pages").agg(F.count(F.lit(1)).alias("_n"))
        crowded = (distinct.groupBy("_k", "_s").agg(F.sum("_n").alias("_sn"))
                   .where(F.col("_sn") > F.lit(page_size)).select("_k", "_s", F.lit(True).alias("_crowded")))
        lot = F.when(F.col("_crowded"), F.lit(max(1, page_size // 10)).cast("bigint")).otherwise(F.col("_n"))
        lots = (distinct.join(crowded, ["_k", "_s"], "left").withColumn("_size", lot)
                .withColumn("_lot", F.explode(F.sequence(F.lit(0).cast("bigint"),
                                                         F.floor((F.col("_n") - 1) / F.col("_size"))))))
        number = F.when(F.col("_crowded"), F.xxhash64("_s", "_o", "_f", "_lot")).otherwise(F.col("_s"))
        spread = lots.select(
            "_k", "_o", "_f", F.pmod(number, F.col("_pages")).cast("int").alias("_page"),
            F.least("_size", F.col("_n") - F.col("_lot") * F.col("_size")).cast("int").alias("_copies"))
        pages = p.join(side, "_k").select(
            "_k", "properties", F.explode(F.sequence(F.lit(0), F.col("_pages").cast("int") - 1)).alias("_page"))
        paged = _documents(pages, spread.repartition(tasks, "_k", "_page"), many=True)
        docs = docs.unionByName(paged.where(F.size("features") > 0))         # a hashed page may stay empty
    return docs.select(
        F.concat_ws("/", F.col("_k").cast("string"), F.col("_page").cast("string")).alias("doc_key"),
        F.col("_k").alias(key),
        F.col("_page").alias("page"),
        F.struct(F.lit(doc_type).alias("type"), F.col("properties"), F.col("features")).alias("doc"))


def _documents(pages: DataFrame, children: DataFrame, many: bool) -> DataFrame:
    """``pages`` with the sorted ``features`` of their children (empty for
    none); with ``many`` a child counts ``_copies`` times."""
    items = ["_o", "_f"] + (["_copies"] if many else [])
    grouped = (children.groupBy("_k", "_page")
               .agg(F.sort_array(F.collect_list(F.struct(*items))).alias("_items")))
    if many:
        features = F.flatten(F.transform("_items", lambda x: F.array_repeat(x["_f"], x["_copies"])))
    else:
        features = F.transform("_items", lambda x: x["_f"])
    grouped = grouped.select("_k", "_page", features.alias("features"))
    none = F.array().cast(grouped.schema["features"].dataType)
    return (pages.join(grouped, ["_k", "_page"], "left")
            .select("_k", "_page", "properties", F.coalesce("features", none).alias("features")))


def to_bodies(docs: DataFrame, doc: str = "doc") -> DataFrame:
    """Serialise the document struct to JSON text: ``doc_key, body``."""
    return docs.select("doc_key", F.to_json(F.col(doc)).alias("body"))


# ---------------------------------------------------------------------------
# The order documents of the catalogue: one reply per order (page), with the
# order as document properties and its lines as features.  Names carry
# dashes on purpose, as the original payload's ``h3-index`` does.

ORDER_DOCUMENT_DDL = (
    "type string, "
    "properties struct<`order-key`: bigint, `cust-key`: bigint, `order-status`: string, "
    "`total-price`: double, `order-date`: string, `order-priority`: string>, "
    "features array<struct<type: string, "
    "measures: struct<quantity: double, `extended-price`: double, discount: double, tax: double>, "
    "properties: struct<`line-key`: string, `order-key`: bigint, `line-no`: int, `part-key`: bigint, "
    "`supp-key`: bigint, `return-flag`: string, `line-status`: string, `ship-date`: string>>>"
)


def line_key(orderkey, linenumber, partkey, suppkey) -> Column:
    """Feature identifier (the role ``h3-index`` plays in the original payload)."""
    return F.concat_ws("-", *[F.col(c).cast("string") if isinstance(c, str) else c.cast("string")
                              for c in (orderkey, linenumber, partkey, suppkey)])


def line_salt() -> Column:
    """Deterministic page salt of a line (plain arithmetic, so SQL engines
    can recompute the page of a line)."""
    return (F.col("l_partkey") * F.lit(1000003) + F.col("l_suppkey") * F.lit(1009)
            + F.col("l_linenumber")).cast("bigint")


def order_documents(orders: DataFrame, lineitem: DataFrame,
                    page_size: int = DEFAULT_PAGE_SIZE) -> DataFrame:
    props = F.struct(
        F.col("o_orderkey").alias("order-key"),
        F.col("o_custkey").alias("cust-key"),
        F.col("o_orderstatus").alias("order-status"),
        F.col("o_totalprice").alias("total-price"),
        F.to_date("o_orderdate").cast("string").alias("order-date"),
        F.col("o_orderpriority").alias("order-priority"))
    feature = F.struct(
        F.lit("Feature").alias("type"),
        F.struct(F.col("l_quantity").alias("quantity"),
                 F.col("l_extendedprice").alias("extended-price"),
                 F.col("l_discount").alias("discount"),
                 F.col("l_tax").alias("tax")).alias("measures"),
        F.struct(line_key("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("line-key"),
                 F.col("l_orderkey").alias("order-key"),
                 F.col("l_linenumber").alias("line-no"),
                 F.col("l_partkey").alias("part-key"),
                 F.col("l_suppkey").alias("supp-key"),
                 F.col("l_returnflag").alias("return-flag"),
                 F.col("l_linestatus").alias("line-status"),
                 F.to_date("l_shipdate").cast("string").alias("ship-date")).alias("properties"))
    return nest(orders, lineitem, "o_orderkey", "l_orderkey", props, feature,
                order=[F.col("l_linenumber"), F.col("l_partkey"), F.col("l_suppkey")],
                salt=line_salt(), page_size=page_size)


def order_bodies(orders: DataFrame, lineitem: DataFrame, page_size: int = DEFAULT_PAGE_SIZE) -> DataFrame:
    return to_bodies(order_documents(orders, lineitem, page_size))
