"""Chat formatting: quotations are linked to the messages they quote.

Lines are parsed into quote levels.  Quoted passages and the messages' own
text are normalised and hashed in units (whole text, paragraph, line) and
joined, passage by passage at every level: a message replies to the earlier
message of its conversation that holds most of what it quotes at the
shallowest level found, else to the message before.
The result is each conversation in reply order, without quotes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, global_rank

#: Quote signs at the start of a line; each is a level.
MARKS = r"^[\x20\t]{0,3}((?:>[\x20\t]?)+)"
#: A line that introduces a quotation.
INTRODUCES = r"(?i)^[\x20\t]*(?:on|am|le|el)\b.{0,200}(?:wrote|schrieb|écrit|escribió)[\x20\t]*:[\x20\t]*$"
#: Turns of a conversation that are scanned together; longer ones are scanned in blocks.
BLOCK = 1024


def parsed_lines(text: Column) -> Column:
    """Array of ``depth, content`` of the lines of a text."""
    def line(x: Column) -> Column:
        x = F.regexp_replace(x, r"\r$", "")
        marks = F.regexp_extract(x, MARKS, 1)
        depth = F.length(F.regexp_replace(marks, r"[^>]", ""))
        return F.struct(depth.alias("depth"), F.when(depth > 0, F.regexp_replace(x, MARKS, "")).otherwise(x).alias("content"))
    return F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), line)


def own_lines(lines: Column) -> Column:
    """Lines outside quotations, without those that introduce one."""
    own = F.filter(lines, lambda x, i: (x["depth"] == 0) & ~(
        x["content"].rlike(INTRODUCES) & F.coalesce(F.get(lines, i + 1)["depth"] > 0, F.lit(False))))
    return F.transform(own, lambda x: x["content"])


def with_passages(messages: DataFrame) -> DataFrame:
    """Adds ``passages`` from ``lines``: ``depth, lines`` of every run of lines
    of one level, without lines that introduce a quotation; none for a
    message that quotes nothing."""
    lines = F.col("lines")
    quotes = F.exists(lines, lambda x: x["depth"] > 0)
    kept = F.filter(lines, lambda x, i: ~(x["content"].rlike(INTRODUCES) & F.coalesce(F.get(lines, i + 1)["depth"] > x["depth"], F.lit(False))))
    made = messages.withColumn("kept", F.when(quotes, kept))
    kept = F.col("kept")
    made = made.withColumn("starts", F.filter(F.sequence(F.lit(0), F.size(kept) - 1), lambda i: (i == 0) | (
        F.get(kept, i)["depth"] != F.get(kept, i - 1)["depth"])))
    end = lambda k: F.coalesce(F.get("starts", k + 1), F.size(kept))
    passages = F.transform("starts", lambda s, k: F.struct(F.get(kept, s)["depth"].alias("depth"), F.transform(
        F.slice(kept, s + 1, end(k) - s), lambda x: x["content"]).alias("lines")))
    return made.withColumn("passages", F.when(kept.isNotNull(), passages)).drop("kept", "starts")


def normal(c: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(c, r"\s+", " ")))


def _units(lines: Column) -> Column:
    """Normalised whole text, paragraphs and lines of an array of lines."""
    whole = F.array_join(lines, "\n")
    parts = F.concat(F.array(whole), F.split(whole, r"\n[\x20\t]*\n"), lines)
    return F.array_distinct(F.filter(F.transform(parts, normal), lambda x: x != ""))


def latest_before(rows: DataFrame, keys: list[str], turn: str, source: Column) -> DataFrame:
    """Adds ``before``: the largest turn below a row's own among rows of the
    same keys for which ``source`` holds.

    Turns are scanned in blocks of BLOCK, and blocks by their largest, so a
    key with very many rows is not scanned in one task.
    """
    made = rows.withColumn("_pl_src", F.when(source, F.col(turn))).withColumn("_pl_b", F.floor(F.col(turn) / BLOCK))
    inside = Window.partitionBy(*keys, "_pl_b").orderBy(turn).rangeBetween(Window.unboundedPreceding, -1)
    tops = made.groupBy(*keys, "_pl_b").agg(F.max("_pl_src").alias("_pl_top"))
    blocks = Window.partitionBy(*keys).orderBy("_pl_b").rowsBetween(Window.unboundedPreceding, -1)
    carried = tops.withColumn("_pl_carry", F.max("_pl_top").over(blocks)).drop("_pl_top")
    return made.withColumn("_pl_in", F.max("_pl_src").over(inside)).join(carried, [*keys, "_pl_b"]) \
        .withColumn("before", F.coalesce("_pl_in", "_pl_carry")).drop("_pl_src", "_pl_b", "_pl_in", "_pl_carry")


def _chains(nodes: DataFrame) -> DataFrame:
    """Adds ``end`` (turn where the chain of ``up`` turns from a row ends) and
    ``steps`` (turns on the way there) to ``c, turn, up``, by pointer doubling."""
    state = cut(nodes.select("c", "turn", "up", F.when(F.col("up").isNull(), 0).otherwise(1).cast("long").alias("steps"),
                             F.coalesce("up", "turn").alias("end")))
    while not state.filter("up is not null").isEmpty():
        above = state.select(F.col("c").alias("c2"), F.col("turn").alias("t2"), F.col("up").alias("up2"),
                             F.col("steps").alias("steps2"), F.col("end").alias("end2"))
        # only messages whose chain is not followed to its end yet
        further = state.filter("up is not null").join(above, (F.col("c") == F.col("c2")) & (F.col("up") == F.col("t2"))).select(
            "c", "turn", F.col("up2").alias("up"), (F.col("steps") + F.col("steps2")).alias("steps"), F.col("end2").alias("end"))
        state = cut(state.filter("up is null").union(further))
    return state.drop("up")


def _tree_order(nodes: DataFrame) -> DataFrame:
    """``c, turn, thread, level, position`` of ``c, turn, reply_to`` in reply
    order: a message, then its replies by turn, each with its own replies.

    The order is a list in which every message points to the one before it:
    its elder sibling's last descendant, else the message it answers.  Last
    descendants and positions are found by pointer doubling, so neither a deep
    nor a wide tree is walked in one task."""
    level = _chains(nodes.withColumnRenamed("reply_to", "up")).withColumnsRenamed({"end": "thread", "steps": "level"})
    # replies to one message in blocks of turns, so that very many are not sorted by one task
    answers = nodes.filter("reply_to is not null")
    elder = latest_before(answers, ["c", "reply_to"], "turn", F.lit(True)).select("c", "turn", "reply_to", F.col("before").alias("elder"))
    youngest = answers.groupBy("c", F.col("reply_to").alias("turn")).agg(F.max("turn").alias("up"))
    tails = _chains(nodes.select("c", "turn").join(youngest, ["c", "turn"], "left")) \
        .select("c", F.col("turn").alias("elder"), F.col("end").alias("tail"))
    listed = nodes.select("c", "turn").join(elder, ["c", "turn"], "left").join(tails, ["c", "elder"], "left") \
        .select("c", "turn", F.coalesce("tail", "reply_to").alias("up"))
    places = _chains(listed).select("c", "turn", (F.col("steps") + 1).alias("position"))
    return level.join(places, ["c", "turn"])


def reply_ordered(messages: DataFrame, *, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
                  text: str = "text") -> DataFrame:
    """One row per message: ``conv_id, turn, role, content, n_quotes,
    reply_to, thread, level, position``.

    ``content`` is the text without quotations, ``n_quotes`` the quoted units
    of any level that were found in an earlier message, ``reply_to``
    the turn answered, ``thread`` and ``level`` the reply chain, and
    ``position`` counts the turns of a conversation from 1 in reply order: a
    message, then its replies by turn, each followed by its own replies.

    A null conversation id is a conversation of its own kind; messages with a
    null turn answer nothing and have no thread, level or position.
    Messages that repeat conversation and turn share these.  A null text
    has empty content.  Ties go to the later message.  Other columns are not read.
    """
    key = F.coalesce(F.concat(F.lit("c"), F.col(conv_id).cast("string")), F.lit("none"))
    lines = messages.select(F.col(conv_id).alias("conv_id"), F.col(turn).cast("long").alias("turn"), F.col(role).alias("role"),
                            key.alias("c"), parsed_lines(F.col(text)).alias("lines"),
                            F.contains(F.coalesce(F.col(text), F.lit("")), F.lit(">")).alias("marked")) \
        .withColumn("own", own_lines(F.col("lines")))
    content = F.trim(F.regexp_replace(F.array_join("own", "\n"), r"\n{3,}", "\n\n"))
    content = F.regexp_replace(content, r"^\n+|\n+$", "")

    dated = lines.filter("turn is not null")

    def hashed(lines: Column, level: Column) -> Column:
        return F.transform(_units(lines), lambda u: F.struct(F.xxhash64(u).alias("h"), F.length(u).alias("size"), level.alias("q")))

    # every passage, and all lines of a level together
    levels = F.array_distinct(F.filter(F.transform("lines", lambda x: x["depth"]), lambda d: d > 0))
    together = F.flatten(F.transform(levels, lambda d: hashed(
        F.transform(F.filter("lines", lambda x: x["depth"] == d), lambda x: x["content"]), d)))
    apart = F.flatten(F.transform("passages", lambda p: hashed(p["lines"], p["depth"])))
    none = F.array().cast("array<struct<h:bigint,size:int,q:int>>")

    def exploded(made: DataFrame, units: Column) -> DataFrame:
        return made.select("c", "turn", F.explode(units).alias("u")).select("c", "turn", "u.*")

    # what is quoted is read from messages with a quote sign alone; only then is all own text hashed
    wanted = exploded(with_passages(dated.filter("marked")).filter("passages is not null"), F.concat(together, apart)) \
        .select("c", "h").distinct()
    units = exploded(with_passages(dated), F.concat(
        hashed(F.col("own"), F.lit(0)), F.when(F.col("passages").isNotNull(), F.concat(together, apart)).otherwise(none)))
    relevant = cut(units.join(wanted, ["c", "h"], "left_semi").groupBy("c", "h", "turn")
                   .agg(F.max("size").alias("size"), F.min("q").alias("low"), F.min(F.when(F.col("q") > 0, F.col("q"))).alias("depth")))
    linked = latest_before(relevant, ["c", "h"], "turn", F.col("low") == 0).filter("depth is not null and before is not null")
    chosen = linked.groupBy("c", "turn", "depth", "before").agg(F.sum("size").alias("size"), F.count("*").alias("n")) \
        .groupBy("c", "turn").agg(F.max(F.struct(-F.col("depth"), "size", "before")).alias("best"), F.sum("n").alias("n_quotes")) \
        .select("c", "turn", F.col("best.before").alias("quoted"), "n_quotes")
    turns = dated.select("c", "turn").distinct()
    nodes = latest_before(turns, ["c"], "turn", F.lit(True)).join(chosen, ["c", "turn"], "left") \
        .select("c", "turn", "before", F.coalesce("quoted", "before").alias("reply_to"), F.coalesce("n_quotes", F.lit(0)).cast("long").alias("n_quotes"))
    nodes = cut(nodes)
    # most conversations answer turn by turn and are in order as they are; the rest are walked as trees
    jumps = cut(nodes.filter(~F.col("reply_to").eqNullSafe(F.col("before"))).select("c").distinct())
    plain = global_rank(nodes.join(jumps, "c", "left_anti"), [F.col("c"), F.col("turn")], "rank")
    first = plain.groupBy("c").agg((F.min("rank") - 1).alias("first"), F.min("turn").alias("thread"))
    order = plain.join(first, "c").withColumn("position", F.col("rank") - F.col("first")) \
        .select("c", "turn", "thread", (F.col("position") - 1).alias("level"), "position")
    if not jumps.isEmpty():
        walked = _tree_order(cut(nodes.join(jumps, "c", "left_semi").select("c", "turn", "reply_to")))
        order = order.union(walked.select("c", "turn", "thread", "level", "position"))
    placed = order.join(nodes, ["c", "turn"]).select("c", "turn", "reply_to", "n_quotes", "thread", "level", "position")
    return lines.withColumn("content", content).drop("lines", "own", "marked").join(placed, ["c", "turn"], "left").select(
        "conv_id", "turn", "role", "content", F.coalesce("n_quotes", F.lit(0)).cast("long").alias("n_quotes"),
        "reply_to", "thread", "level", "position")
