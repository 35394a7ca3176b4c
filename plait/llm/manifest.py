"""Merkle dataset manifest over bitmap ranks.

The ids of a group are kept as bitmaps of 64 ids a word, merged across tasks,
with popcount directories above them (512 entries each).  The rank of an id
is the directories' counts before its word plus the set bits before its own,
so leaves get their coordinates without a sort of the table.  Leaves are then
gathered into keyed slot arrays of 256, each reduced by up to eight levels,
and what is left is gathered again until one node a group remains.  The
groups' roots are the leaves of one more tree of the same kind.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import cut, global_rank

#: Bits of an id below a bitmap word, of a directory entry, and of a slot in a slot array.
WORD, ENTRY, SLOT = 6, 9, 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def netstring(c: Column) -> Column:
    """``-`` for a null, else the UTF-8 byte count, a colon and the value."""
    value = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf_hash(fields: dict[str, Column]) -> Column:
    return F.sha2(F.concat(*[netstring(fields[f]) for f in FIELDS]), 256)


def is_tampered(doc_id: Column, every: int = 7) -> Column:
    """Rows that the tampering check changes: ``every`` divides the crc32 of the decimal id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % every == 0, F.lit(False))


def _shift(c: str, bits: int) -> Column:
    return F.shiftright(F.col(c), bits)


def word_index(ids: DataFrame) -> DataFrame:
    """``g, word, bits, extras, base, total`` from rows ``g, id``: a row per
    bitmap word.  ``base`` is the number of rows of the group before the word,
    ``extras`` lists the repeats of its ids beyond the first (null: none) and
    ``total`` is the number of rows of the group.  Null ids come first."""
    bit = F.expr("shiftleft(1L, cast(id & 63 as int))")
    words = cut(ids.filter("id IS NOT NULL").groupBy("g", _shift("id", WORD).alias("word"))
                .agg(F.bit_or(bit).alias("bits"), F.count("*").alias("n")))
    low, high, repeats = words.agg(F.min("word"), F.max("word"), F.max(F.col("n") - F.bit_count("bits"))).first()
    if low is None:
        return words.selectExpr("g", "word", "bits", "cast(null as array<struct<at:int,more:bigint>>) AS extras",
                                "0L AS base", "0L AS total")
    # popcount directories: counts before an entry, level by level
    levels, step, rows = [], 0, words.select("g", F.col("word").alias("key"), "n")
    while (high >> step) - (low >> step) >= 1 << ENTRY:
        up = Window.partitionBy("g", "up").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
        level = rows.withColumn("up", _shift("key", ENTRY)) \
            .withColumn("before", F.coalesce(F.sum("n").over(up), F.lit(0)))
        levels.append(level.select("g", "key", "up", "before"))
        rows = level.groupBy("g", "up").agg(F.sum("n").alias("n")).withColumnRenamed("up", "key")
        step += ENTRY
    whole = Window.partitionBy("g")  # at most 512 entries a group
    top = rows.withColumn("base", F.coalesce(F.sum("n").over(
        whole.orderBy("key").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))) \
        .withColumn("total", F.sum("n").over(whole)).drop("n")
    for level in reversed(levels):
        above = top.withColumnsRenamed({"key": "up", "base": "over"})
        top = level.join(above, ["g", "up"]).select("g", "key", (F.col("over") + F.col("before")).alias("base"), "total")
    index = words.join(top.withColumnRenamed("key", "word"), ["g", "word"])
    if not repeats:
        return index.withColumn("extras", F.lit(None).cast("array<struct<at:int,more:bigint>>")).drop("n")
    crowded = index.filter(F.col("n") > F.bit_count("bits")).select("g", "word")
    more = ids.withColumn("word", _shift("id", WORD)).join(crowded, ["g", "word"], "left_semi") \
        .groupBy("g", "word", "id").agg((F.count("*") - 1).alias("more")).filter("more > 0") \
        .groupBy("g", "word").agg(F.collect_list(F.struct(F.expr("cast(id & 63 as int)").alias("at"), "more")).alias("extras"))
    return index.join(more, ["g", "word"], "left").drop("n")


def _before(at: Column) -> Column:
    """Rows of a word before bit ``at``."""
    mask = F.expr("~shiftleft(-1L, cast(id & 63 as int))")
    later = F.aggregate(F.filter(F.coalesce("extras", F.array()), lambda e: e["at"] < at), F.lit(0).cast("long"),
                        lambda a, e: a + e["more"])
    return F.bit_count(F.col("bits").bitwiseAND(mask)) + F.when(F.col("extras").isNull(), F.lit(0).cast("long")).otherwise(later)


def ranked(leaves: DataFrame) -> DataFrame:
    """Rows ``g, id, leaf, ...`` with ``at``, the rank in the group by id from
    0, and ``total``, the rows of the group.  Null ids come first; rows of one
    id are ordered by leaf."""
    ids = leaves.select("g", "id")
    index = word_index(ids)
    at = F.expr("cast(id & 63 as int)")
    blank, repeated = ids.filter("id IS NULL").groupBy("g").agg(F.count("*").alias("blanks")), index.filter("extras IS NOT NULL")
    has_blanks, has_repeats = not blank.isEmpty(), not repeated.isEmpty()
    rows = leaves.join(index.withColumnRenamed("g", "_g"), (F.col("g") == F.col("_g")) & (_shift("id", WORD) == F.col("word"))) \
        .withColumn("tied", F.exists(F.coalesce("extras", F.array()), lambda e: e["at"] == at)) \
        .withColumn("at", F.col("base") + _before(at)).select(*leaves.columns, "tied", "at", "total")
    if not has_blanks and not has_repeats:
        return rows.drop("tied")
    # the few tables with repeated or missing ids: those rows get their place by a distributed sort
    lone = leaves.filter("id IS NULL").withColumn("tied", F.lit(True)).withColumn("at", F.lit(0).cast("long")) \
        .withColumn("total", F.lit(0).cast("long"))
    rows = rows.union(lone).join(blank.withColumnRenamed("g", "_g"), F.col("g") == F.col("_g"), "left") \
        .withColumn("blanks", F.coalesce("blanks", F.lit(0).cast("long"))) \
        .withColumn("at", F.when(F.col("id").isNull(), F.lit(0).cast("long")).otherwise(F.col("at") + F.col("blanks"))).drop("_g")
    totals = ids.groupBy(F.col("g").alias("_g")).agg(F.count("*").alias("all"))
    rows = cut(rows.join(totals, F.col("g") == F.col("_g")).withColumn("total", F.col("all")).drop("_g", "all", "blanks")
               .withColumn("row", F.monotonically_increasing_id()))
    sorted_ties = global_rank(rows.filter("tied"), [F.col("g"), F.col("at"), F.col("leaf"), F.col("row")], "place")
    first = sorted_ties.groupBy(F.col("g").alias("_g"), F.col("at").alias("_at")).agg(F.min("place").alias("low"))
    placed = sorted_ties.join(first, (F.col("g") == F.col("_g")) & (F.col("at") == F.col("_at"))) \
        .withColumn("at", F.col("at") + F.col("place") - F.col("low"))
    columns = [*leaves.columns, "at", "total"]
    return rows.filter("NOT tied").select(*columns).union(placed.select(*columns))


def _depth(total: Column) -> Column:
    """Levels of a binary tree over ``total`` leaves."""
    return F.when(total > 1, F.length(F.bin(total - 1))).otherwise(F.lit(0))


def _levels(hashes: Column, n: Column) -> Column:
    """The levels of a slot array, the array itself first: every two
    consecutive nodes, or the last one alone, become the hash of both."""
    def above(levels: Column, _step: Column) -> Column:
        under = F.element_at(levels, -1)
        pairs = F.sequence(F.lit(0), F.shiftright(F.size(under) - 1, 1))
        node = F.transform(pairs, lambda i: F.sha2(F.concat(F.get(under, 2 * i), F.coalesce(F.get(under, 2 * i + 1), F.lit(""))), 256))
        return F.concat(levels, F.array(node))
    steps = F.slice(F.array(*[F.lit(i) for i in range(SLOT)]), F.lit(1), n)
    return F.aggregate(steps, F.array(hashes), above)


class Forest:
    """The trees of all groups over rows ``g, at, hash, total`` and payload
    columns: one written table of slot arrays a round, then ``roots``
    (``g, hash``), one row a group."""

    def __init__(self, rows: DataFrame, payload: list[str]) -> None:
        spark = rows.sparkSession
        self.rounds: list[DataFrame] = []
        self.payload = payload
        while True:
            done = SLOT * len(self.rounds)
            kept = ["hash", *(payload if not self.rounds else [])]
            slot = F.struct(F.expr(f"cast(at & {(1 << SLOT) - 1} as int)").alias("slot"), *kept)
            blocks = rows.groupBy("g", F.shiftright("at", SLOT).alias("block")) \
                .agg(F.max("total").alias("total"), F.array_sort(F.collect_list(slot)).alias("slots"))
            n = F.greatest(F.lit(0), F.least(F.lit(SLOT), _depth(F.col("total")) - done))
            path = scratch_path(spark, "merkle", str(len(self.rounds)))
            blocks.withColumn("n", n.cast("int")) \
                .withColumn("node", F.element_at(F.element_at(_levels(F.col("slots.hash"), F.col("n")), -1), 1)) \
                .write.parquet(path)
            table = spark.read.parquet(path)
            self.rounds.append(table)
            rows = table.select("g", F.col("block").alias("at"), F.col("node").alias("hash"), "total")
            if (table.agg(F.max("block")).first()[0] or 0) == 0:
                break
        self.roots = self.rounds[-1].select("g", F.col("node").alias("hash"))

    def paths(self, above: DataFrame | None = None) -> DataFrame:
        """``g, hash``, the payload and ``path`` of every leaf: the siblings
        from the leaf up, then those that ``above`` (``g, path, ...``) has for
        its group, if given.  A sibling is ``left`` (whether it stands left)
        and ``hash`` (null where a node is alone)."""
        if above is None:
            above = self.rounds[-1].select("g", F.expr("cast(array() as array<struct<left:boolean,hash:string>>)").alias("path"))
        over = above.withColumn("at", F.lit(0).cast("long"))
        carried = [c for c in above.columns if c not in ("g", "path")]
        for k in reversed(range(len(self.rounds))):
            kept = ["hash", *(self.payload if k == 0 else [])]

            def sibling(levels: Column, slot: Column, step: Column) -> Column:
                place = F.call_function("shiftright", slot, step)
                return F.struct((place % 2 == 1).alias("left"), F.get(F.get(levels, step), place.bitwiseXOR(F.lit(1))).alias("hash"))

            def entries(levels: Column) -> Column:
                steps = F.slice(F.array(*[F.lit(i) for i in range(SLOT)]), F.lit(1), F.col("n"))
                return F.transform("slots", lambda s: F.struct(
                    s.alias("s"), F.transform(steps, lambda j: sibling(levels, s["slot"], j)).alias("own")))

            # the levels are bound once a slot array, not once a slot
            found = F.element_at(F.transform(F.array(_levels(F.col("slots.hash"), F.col("n"))), entries), 1)
            up = over.withColumnsRenamed({"at": "block", "path": "rest"}).select("g", "block", "rest", *carried)
            rows = self.rounds[k].join(up, ["g", "block"]).select("g", "block", "rest", *carried, F.explode(found).alias("e"))
            over = rows.select("g", (F.shiftleft("block", SLOT) + F.col("e.s.slot")).alias("at"),
                               *[F.col(f"e.s.{c}").alias(c) for c in kept],
                               F.concat("e.own", "rest").alias("path"), *carried)
            if k:
                over = over.drop("hash")
        return over.drop("at")


def fold(start: Column, path: Column) -> Column:
    """The root that a leaf hash and its siblings lead to."""
    def up(node: Column, s: Column) -> Column:
        pair = F.when(s["hash"].isNull(), node).when(s["left"], F.concat(s["hash"], node)).otherwise(F.concat(node, s["hash"]))
        return F.sha2(pair, 256)
    return F.aggregate(path, start, up)


def manifest(docs: DataFrame) -> DataFrame:
    """``doc_id, lang, leaf, changed, subroot, root, path`` of every row.

    A leaf is the sha256 of the row's five fields as netstrings; leaves of
    one language ascend by id, and every two consecutive nodes become one
    until a single one, the ``subroot``, is left; the subroots, by language
    (null first, bytewise), lead to ``root``.  ``path`` holds the siblings
    from leaf to root, ``changed`` the leaf hash of a tampered row, else null.

    Null ids come before all others of their language and rows of one id are
    ordered by leaf hash; null fields count as ``-``, empty texts as ``0:``.
    An empty table gives an empty result; other columns are not read.
    """
    field = {f: F.col(f) for f in FIELDS}
    altered = field | {"n_chars": F.col("n_chars") + 1}
    leaves = docs.select(F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit("-")).alias("g"),
                         F.col("doc_id").cast("long").alias("id"), leaf_hash(field).alias("leaf"),
                         F.when(is_tampered(F.col("doc_id")), leaf_hash(altered)).alias("changed"))
    rows = ranked(leaves).select("g", "at", F.col("leaf").alias("hash"), "total", "id", "changed")
    groups = Forest(rows, ["id", "changed"])
    tops = global_rank(groups.roots, [F.col("g")], "rank")
    n_groups = tops.count()
    crown = Forest(tops.select(F.lit("").alias("g"), (F.col("rank") - 1).alias("at"), "hash",
                               F.lit(n_groups).cast("long").alias("total"), F.col("g").alias("group")), ["group"])
    root = crown.roots.agg(F.max("hash")).first()[0]  # one row
    above = crown.paths().select(F.col("group").alias("g"), "path", F.col("hash").alias("subroot"))
    found = groups.paths(above)
    return found.select(F.col("id").alias("doc_id"), F.expr("CASE WHEN g = '-' THEN NULL ELSE substring(g, 2) END").alias("lang"),
                        F.col("hash").alias("leaf"), "changed", "subroot", F.lit(root).cast("string").alias("root"), "path")


def proofs(entries: DataFrame) -> DataFrame:
    """Rows of ``manifest`` with ``proof_sha256`` (of the siblings, leaf to
    root), ``folded_root`` (from the tampered leaf where there is one) and
    ``verified``."""
    proof = F.sha2(F.array_join(F.transform("path", lambda s: s["hash"]), ""), 256)
    folded = fold(F.coalesce("changed", "leaf"), F.col("path"))
    return entries.withColumn("proof_sha256", proof).withColumn("folded_root", folded) \
        .withColumn("verified", F.col("folded_root") == F.col("root"))
