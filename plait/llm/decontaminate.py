"""Benchmark decontamination by template windows.

Numbers, units and names become typed placeholders that keep the replaced
value, so a question asked again with other numbers or names has the same
template.  Windows of template words are hash-joined with those of the
benchmark; where a document covers enough of an item's windows, the slots of
the aligned stretch are compared: a window counts if it has the item's values
or each of them stands for one value in the document.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut

WINDOW = 8
#: Share of an item's windows a document must have.
COVERAGE = 0.5
#: Consecutive words, plain or with the item's values, that tell whatever their share of the item.
RUN = 13
#: Placeholders in a window joined by its template, at most; windows of little else
#: are joined by their values and by longer templates of up to LONGEST words.
MAX_SLOTS, LONGEST = 4, 32
#: Benchmark window tables up to this many rows are broadcast; larger ones are joined by shuffle.
BROADCAST_WINDOWS = 200_000

MARK = "\x01"
#: Patterns look at the character itself before they look back: most places fail at once.
NUMBER = r"(?=[+$€£\p{N}-])(?<![\p{L}\p{N}_.,-])[+-]?[$€£]?(\p{N}+(?:[.,:/]\p{N}+)*)(?![\p{N}_])"
#: Fixed unit words, after a number only.
UNITS = ("%|percent|kg|g|mg|lbs?|oz|km|m|cm|mm|mi|miles?|feet|ft|inch(?:es)?|l|ml|lit(?:er|re)s?|hours?|hrs?|h|minutes?|mins?|"
         "seconds?|secs?|s|days?|weeks?|months?|years?|mph|km/h|°[CF]|dollars?|euros?|cents?|USD|EUR")
UNIT = rf"({MARK}n\S*?)[\x20-]?({UNITS})(?![\p{{L}}\p{{N}}])"
#: A capitalised word that does not start a sentence.
NAME = r"(\p{Lu}(?<=[\p{Ll}\p{N},;][\x20\t\n]\p{Lu})[\p{L}'’-]*)"
#: Punctuation, but for that of a number.
PUNCTUATION = rf"(?=[^\p{{L}}\p{{N}}\s{MARK}])(?<!{MARK}n\p{{N}}{{0,30}})[^\p{{L}}\p{{N}}\s{MARK}]+"


def template_words(text: Column) -> Column:
    """Words of a text in lower case without punctuation; slots are words
    that start with a mark and n, u or p, followed by the value."""
    t = F.replace(F.coalesce(text, F.lit("")), F.lit(MARK), F.lit(""))
    t = F.regexp_replace(t, NAME, f" {MARK}p$1 ")
    t = F.regexp_replace(t, NUMBER, f" {MARK}n$1 ")
    t = F.regexp_replace(t, UNIT, f"$1 {MARK}u$2 ")
    t = F.regexp_replace(F.lower(t), PUNCTUATION, "")
    return F.filter(F.split(t, r"\s+"), lambda w: w != "")


def _hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(F.when(w.startswith(MARK), F.substring(w, 1, 2)).otherwise(w)))


def _windows(hashes: str, window: int) -> Column:
    """Array of window hashes in order; empty for a text of fewer words."""
    parts = ", ".join(f"get({hashes}, i + {j})" for j in range(window))
    return F.expr(f"if(size({hashes}) >= {window}, transform(sequence(0, size({hashes}) - {window}), i -> xxhash64({parts})), "
                  "cast(array() as array<bigint>))")


def _slots(words: str, window: int) -> str:
    """SQL of the number of placeholders in the window at ``i``."""
    return f"size(filter(slice({words}, i + 1, {window}), w -> startswith(w, '{MARK}')))"


def _valued(length: int) -> str:
    """SQL of the hash of the words at ``i`` with their values."""
    return f"xxhash64('v', array_join(slice(words, i + 1, {length}), ' '))"


def _starts(length: int) -> str:
    return f"if(size(words) >= {length}, sequence(0, size(words) - {length}), cast(array() as array<int>))"


def _entry(length: str, digest: str) -> str:
    return f"named_struct('pos', i, 'len', cast({length} as int), 'hash', {digest})"


def _dense(window: int) -> str:
    """SQL array of ``pos, len, hash`` of the windows of more than MAX_SLOTS
    placeholders: by their values, and by the template of the shortest longer
    window (of LONGEST words at most) with as many plain words as others have."""
    last = (f"get(filter(sequence(i, least(i + {LONGEST}, size(words)) - 1), j -> not startswith(get(words, j), '{MARK}')), "
            f"{window - MAX_SLOTS - 1})")
    longer = _entry(f"{last} - i + 1", f"xxhash64('t', slice(_pl_h, i + 1, {last} - i + 1))")
    return (f"filter(flatten(transform(filter({_starts(window)}, i -> {_slots('words', window)} > {MAX_SLOTS}), "
            f"i -> array({_entry(str(window), _valued(window))}, {longer}))), e -> e.len is not null)")


def _short(length: int, by_value: bool) -> str:
    """SQL array of ``pos, len, hash`` of all stretches of a few words."""
    return f"transform({_starts(length)}, i -> {_entry(str(length), _valued(length) if by_value else f'xxhash64({chr(39)}t{chr(39)}, slice(_pl_h, i + 1, {length}))')})"


def _exploded(df: DataFrame, keep: list[str], window: int, more: list[str] = ()) -> DataFrame:
    """A row per window, and per entry of the SQL arrays of ``more``."""
    hashed = df.withColumn("_pl_h", _hashes(F.col("words")))
    # exploded as an expression: from a column Spark would infer a filter that hashes the text once per window
    if not more:
        return hashed.select(*keep, F.posexplode(_windows("_pl_h", window)).alias("pos", "hash")).withColumn("len", F.lit(window))
    plain = F.transform(_windows("_pl_h", window), lambda h, i: F.struct(i.alias("pos"), F.lit(window).alias("len"), h.alias("hash")))
    return hashed.select(*keep, F.explode(F.concat(plain, *map(F.expr, more))).alias("e")).select(*keep, "e.pos", "e.hash", "e.len")


def _index(items: DataFrame, window: int) -> DataFrame:
    """``hash, item_id, at, len, slots, short, by_value``: every window of every item.

    Windows of few placeholders are joined by their template, the others as
    ``_dense`` says.  An item shorter than a window is one entry, joined by
    its values if over half of its words are placeholders.
    """
    placed = F.expr(f"size(filter(slice(words, pos + 1, len), w -> startswith(w, '{MARK}')))")
    rows = _exploded(items, ["item_id", "words"], window).withColumn("slots", placed).filter(F.col("slots") <= MAX_SLOTS) \
        .select("hash", "item_id", F.col("pos").alias("at"), "len", "slots", F.lit(False).alias("short"), F.lit(False).alias("by_value"))
    dense = items.withColumn("_pl_h", _hashes(F.col("words"))).select("item_id", "words", F.explode(F.expr(_dense(window))).alias("e")) \
        .select("item_id", "words", "e.*").withColumn("slots", placed) \
        .select("hash", "item_id", F.col("pos").alias("at"), "len", "slots", F.lit(False).alias("short"), F.lit(True).alias("by_value"))
    # an item of little but placeholders, so that no window tells it by template, is one entry by its whole template
    told = rows.select("item_id").union(dense.filter(F.col("len") > window).select("item_id")).distinct()
    whole = items.filter(F.size("words") >= window).join(told, "item_id", "left_anti").withColumn("_pl_h", _hashes(F.col("words"))) \
        .select(F.expr("xxhash64('t', _pl_h)").alias("hash"), "item_id", F.lit(0).alias("at"), F.size("words").alias("len"),
                F.expr(f"size(filter(words, w -> startswith(w, '{MARK}')))").alias("slots"), F.lit(True).alias("short"), F.lit(False).alias("by_value"))
    few = items.filter(F.size("words").between(1, window - 1)).withColumn("_pl_h", _hashes(F.col("words"))) \
        .withColumn("slots", F.expr(f"size(filter(words, w -> startswith(w, '{MARK}')))")).withColumn("by_value", F.expr("slots * 2 > size(words)"))
    few = few.select(F.expr("if(by_value, xxhash64('v', array_join(words, ' ')), xxhash64('t', _pl_h))").alias("hash"), "item_id",
                     F.lit(0).alias("at"), F.size("words").alias("len"), "slots", F.lit(True).alias("short"), "by_value")
    return rows.union(dense).union(few).union(whole)


def _longest(same_words: Callable[[Column, Column], Column]) -> Column:
    """Most words in a run of ``windows`` that overlap or touch, in order of
    ``at``; ``same_words`` counts those to count from a place to another."""
    def step(state: Column, w: Column) -> Column:
        end = w["at"] + w["len"]
        start = F.greatest(state["end"], w["at"])
        run = F.when(w["at"] <= state["end"], state["run"]).otherwise(0) + F.when(end > start, same_words(start, end)).otherwise(0)
        return F.struct(F.greatest(state["end"], end).alias("end"), run.alias("run"), F.greatest(state["best"], run).alias("best"))
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).alias("run"), F.lit(0).alias("best"))
    return F.aggregate("windows", zero, step, lambda state: state["best"])


def _coverage(stretches: DataFrame, size: DataFrame) -> DataFrame:
    """``doc_id, item_id, coverage, same, run``: the share of an item's windows
    that the stretches of a document have, from their ``windows`` (all of it
    where one window is the whole item), and the longest run."""
    if "same" not in stretches.columns:
        stretches = stretches.withColumn("same", F.lit(None).cast("boolean"))
    each = stretches.select("doc_id", "item_id", "same", "run", F.explode("windows").alias("w")) \
        .groupBy("doc_id", "item_id", F.col("w.at").alias("at")) \
        .agg(F.max("same").alias("same"), F.max("run").alias("run"), F.max("w.len").alias("len"))
    share = F.when(F.col("len") >= F.col("n_words"), F.lit(1.0)).otherwise(F.col("n") / F.col("total"))
    return each.groupBy("doc_id", "item_id").agg(F.count("*").alias("n"), F.min("same").alias("same"), F.max("run").alias("run"), F.max("len").alias("len")) \
        .join(size, "item_id").withColumn("coverage", share).select("doc_id", "item_id", "coverage", "same", "run")


def matches(docs: DataFrame, benchmark: DataFrame, *, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
            item_text: str = "text", window: int = WINDOW, coverage: float = COVERAGE) -> DataFrame:
    """``doc_id, item_id, coverage, kind`` for every document that holds a
    benchmark item: ``kind`` is ``exact`` if the slots have the item's
    values, else ``reparameterised``.  Windows with the item's values always
    count towards ``coverage``, others if each of their values stands for one
    value over the aligned stretch.  A document is also reported, whatever its
    coverage, if windows that count give RUN words in a row.

    Texts are judged, each once, whatever rows hold them: an id with several
    texts is reported with the best of them, an item counting for each text
    on its own.  Rows with a null id, document or item, are not reported.
    Items of fewer words than a window are found whole; identical items are
    all reported.  Empty tables give an empty result.
    """
    rows = docs.select(F.col(doc_id).alias("id"), _key(F.col(text)).alias("doc_id")).filter("id is not null")
    found = _text_matches(docs.select(_key(F.col(text)).alias("doc_id"), F.col(text).alias("text")), benchmark, item_id, item_text, window, coverage)
    return rows.join(found, "doc_id").groupBy(F.col("id").alias("doc_id"), "item_id") \
        .agg(F.max(F.struct("coverage", (F.col("kind") == "exact").alias("same"))).alias("best")) \
        .select("doc_id", "item_id", "best.coverage", F.when(F.col("best.same"), "exact").otherwise("reparameterised").alias("kind"))


def _key(text: Column) -> Column:
    """Names a text by 96 bits of hashes; null and empty texts alike."""
    body = F.coalesce(text, F.lit(""))
    return F.struct(F.xxhash64(body).alias("k1"), F.hash(body).alias("k2"))


def _text_matches(texts: DataFrame, benchmark: DataFrame, item_id: str, item_text: str, window: int, coverage: float) -> DataFrame:
    """``matches`` of ``doc_id, text``, where rows of one id have one text."""
    items = benchmark.select(F.col(item_id).alias("item_id"), template_words(F.col(item_text)).alias("words")).dropna()
    index = cut(_index(items, window))
    size = index.groupBy("item_id").agg(F.countDistinct("at").alias("total")) \
        .join(items.groupBy("item_id").agg(F.max(F.size("words")).alias("n_words")), "item_id")
    side = index.select("hash", "item_id", "at", "len", "slots")
    if side.count() <= BROADCAST_WINDOWS:
        side = F.broadcast(side)
    # documents give other entries than plain windows only where the benchmark has such
    kinds = index.filter("short or by_value").select(F.when(F.col("short"), F.col("len")).alias("length"), "by_value").distinct().collect()
    more = [_short(k.length, k.by_value) if k.length else _dense(window) for k in kinds]

    def worded(df: DataFrame) -> DataFrame:
        return df.select("doc_id", template_words(F.col("text")).alias("words"))

    found = _exploded(worded(texts), ["doc_id"], window, more).join(side, ["hash", "len"]) \
        .groupBy("doc_id", "item_id", (F.col("pos") - F.col("at")).alias("shift")) \
        .agg(F.sort_array(F.collect_set(F.struct("at", "len"))).alias("windows"), F.max("slots").alias("slots"))
    found = cut(found)  # one row per stretch of a document aligned with an item
    enough = (F.col("coverage") >= coverage) | (F.col("run") >= RUN)
    # enough windows or words, whatever their slots; only these documents are read again
    found = found.withColumn("run", _longest(lambda start, end: end - start))
    likely = cut(_coverage(found, size).filter(enough).select("doc_id", "item_id"))
    stretches = found.join(likely, ["doc_id", "item_id"], "left_semi")
    consistent = stretches.filter("slots = 0").select("doc_id", "item_id", "windows", F.lit(True).alias("same"), "run")
    slotted = cut(stretches.filter("slots > 0").drop("slots", "run"))
    if not slotted.isEmpty():
        again = texts.join(slotted.select("doc_id").distinct(), "doc_id", "left_semi").dropDuplicates(["doc_id"])
        pairs = slotted.join(items.withColumnRenamed("words", "theirs"), "item_id").join(worded(again), "doc_id")

        def aligned(w: Column) -> Column:
            return F.arrays_zip(F.slice("theirs", w["at"] + 1, w["len"]).alias("a"),
                                F.slice("words", F.col("shift") + w["at"] + 1, w["len"]).alias("b"))

        def slots_of(w: Column) -> Column:
            return F.filter(aligned(w), lambda p: p["a"].startswith(MARK))

        # equal hashes of other words do not count
        fits = lambda p: (p["a"] == p["b"]) | (p["a"].startswith(MARK) & (F.substring(p["a"], 1, 2) == F.substring(p["b"], 1, 2)))
        pairs = pairs.withColumn("windows", F.filter("windows", lambda w: F.forall(aligned(w), fits)))
        pairs = pairs.withColumn("p", F.array_distinct(F.flatten(F.transform("windows", slots_of))))
        # a value of the item that stands for several in the document clashes wherever it is not itself
        several = lambda p: (p["a"] != p["b"]) & F.exists("p", lambda q: (q["a"] == p["a"]) & (q["b"] != p["b"]))
        pairs = cut(pairs.withColumn("clash", F.filter("p", several)))
        pairs = pairs.withColumn("windows", F.filter("windows", lambda w: ~F.arrays_overlap(slots_of(w), F.col("clash"))))
        told = lambda p: ~p["a"].startswith(MARK) | (p["a"] == p["b"])
        run = _longest(lambda start, end: F.size(F.filter(aligned(F.struct(start.alias("at"), (end - start).alias("len"))), told)))
        pairs = cut(pairs.withColumn("run", run))
        same = lambda w: F.forall(slots_of(w), lambda p: p["a"] == p["b"])
        for verbatim in (True, False):
            consistent = consistent.union(pairs.select(
                "doc_id", "item_id", F.filter("windows", lambda w: same(w) if verbatim else ~same(w)).alias("windows"), F.lit(verbatim).alias("same"), "run"))
    # a window with other slots counts for nothing, nor against the rest of the document
    return _coverage(consistent, size).filter(enough) \
        .select("doc_id", "item_id", "coverage", F.when(F.col("same"), "exact").otherwise("reparameterised").alias("kind"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
                  item_text: str = "text", window: int = WINDOW, coverage: float = COVERAGE) -> DataFrame:
    """The input rows whose text holds no benchmark item.  Ids play no part:
    rows without an id, or with one that repeats, go or stay by their own text."""
    found = _text_matches(docs.select(_key(F.col(text)).alias("doc_id"), F.col(text).alias("text")), benchmark, item_id, item_text, window, coverage) \
        .select(F.col("doc_id").alias("_pl_key")).distinct()
    return docs.join(found, _key(F.col(text)) == F.col("_pl_key"), "left_anti")
