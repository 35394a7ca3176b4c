"""Quality rules as a short-circuit cascade.

Every rule is a condition that rejects a text.  On a bounded sample the cost
of each rule (time over the sample) and its selectivity (share it rejects)
are estimated; rules are then tried in order of rejection per cost, and a
text that one rule rejects is not shown to the next.  The order changes the
cost and which rule is named, never the verdict.
"""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE_CHARS, cut, word_array

#: Texts the order of the rules is estimated on, about.
SAMPLE_ROWS = 1000
SYMBOLS = "#*$%&|<>"
#: Bits of a packed window that hold its position: texts of up to 2 ** 26 words.
_POS = 26


def _count(c: Column, chars: str) -> Column:
    return F.length(c) - F.length(F.translate(c, chars, ""))


def measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """The input rows with ``n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words``.

    ``n_repeat_words`` counts words in 3-word windows found twice or more in
    the text: windows are hashed, packed with their position and sorted, and
    neighbours with equal hash are verified word by word.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    out = docs.withColumn("_pl_w", word_array(F.col(text))) \
        .withColumn("n_words", F.size("_pl_w").cast("long")) \
        .withColumn("word_chars", F.length(F.translate(t, SPACE_CHARS, "")).cast("long")) \
        .withColumn("n_symbols", _count(t, SYMBOLS).cast("long"))
    lines = F.filter(F.split(t, "\n"), lambda x: F.length(F.translate(x, SPACE_CHARS, "")) > 0)
    out = out.withColumn("_pl_lines", lines) \
        .withColumn("n_dup_lines", (F.size("_pl_lines") - F.size(F.array_distinct("_pl_lines"))).cast("long")) \
        .withColumn("_pl_h", F.transform("_pl_w", lambda w: F.xxhash64(w))).drop("_pl_w", "_pl_lines")
    too_long = f"raise_error('a text of over {1 << _POS} words')"

    mask = (1 << _POS) - 1
    empty = "cast(array() as array<bigint>)"
    out = out.withColumn("_pl_s", F.expr(
        f"if(size(_pl_h) between 3 and {1 << _POS}, sort_array(transform(sequence(0, size(_pl_h) - 3), i -> "
        f"(xxhash64(get(_pl_h, i), get(_pl_h, i + 1), get(_pl_h, i + 2)) & {~mask}L) | i)), "
        f"if(size(_pl_h) > {1 << _POS}, {too_long}, {empty}))"))
    same = " or ".join(f"coalesce((x ^ get(_pl_s, i + {d})) & {~mask}L = 0, false)" for d in (-1, 1))
    out = out.withColumn("_pl_c", F.expr(f"filter(_pl_s, (x, i) -> {same})"))

    def equal(d: int) -> str:
        p, q = f"cast(x & {mask}L as int)", f"cast(get(_pl_c, i + {d}) & {mask}L as int)"
        return "coalesce(" + " and ".join(f"get(_pl_h, {p} + {j}) = get(_pl_h, {q} + {j})" for j in range(3)) + ", false)"
    found = " or ".join(equal(d) for d in (-1, 1, -2, 2))
    out = out.withColumn("_pl_p", F.expr(
        f"sort_array(transform(filter(_pl_c, (x, i) -> {found}), x -> x & {mask}L))"))
    return out.withColumn("n_repeat_words", F.expr(
        "aggregate(transform(_pl_p, (p, i) -> least(3L, coalesce(get(_pl_p, i + 1) - p, 3L))), 0L, (a, b) -> a + b)")) \
        .drop("_pl_h", "_pl_s", "_pl_c", "_pl_p")


def rules(text: str = "text") -> dict[str, Column]:
    """Rules over the measures and the text; each is true for a text it rejects."""
    t, words = F.coalesce(F.col(text), F.lit("")), F.col("n_words")
    plain = F.regexp_count(t, F.lit(r"(?<![^\x20\x09-\x0D])[^\p{L}\x20\x09-\x0D]+(?![^\x20\x09-\x0D])"))
    lines = F.regexp_count(t, F.lit(r"(?m)^.*[^\x20\x09-\x0D].*$"))
    return {
        "symbols": F.col("n_symbols") * 10 > words,
        "short_words": F.col("word_chars") < 3 * words,
        "long_words": F.col("word_chars") > 12 * words,
        "no_letters": plain * 10 > 4 * words,
        "exclamations": _count(t, "!") * 2 > words,
        "capitals": (F.length(t) - F.length(F.regexp_replace(t, r"\p{Lu}", ""))) * 2 > F.col("word_chars"),
        "repeated_lines": F.col("n_dup_lines") * 2 > lines,
        "bullets": F.regexp_count(t, F.lit(r"(?m)^[\x20\t]*[-*•]\x20")) * 10 > 9 * lines,
        "ellipses": F.regexp_count(t, F.lit(r"(?m)(\.\.\.|…)[\x20\t]*$")) * 10 > 3 * lines,
    }


def base_fails() -> Column:
    """Whether a measured text is too short or too repetitive to be shown to the rules."""
    return (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)


def order_rules(docs: DataFrame, checks: dict[str, Column], text: str = "text",
                sample_rows: int = SAMPLE_ROWS) -> list[str]:
    """Rule names by rejection per cost, estimated on about ``sample_rows``
    texts chosen by hash; those that fail the base never reach the cascade
    and are left out."""
    every = max(1, docs.count() // max(1, sample_rows))
    drawn = docs.select(text).filter(F.pmod(F.xxhash64(text), F.lit(every)) == 0).limit(2 * sample_rows)
    # measured before the filter, which Spark would else push below the measures
    some = cut(measures(drawn, text)).filter(~base_fails())

    def seconds(c: Column) -> float:
        times = []
        for _ in range(2):
            began = time.perf_counter()
            some.agg(F.count(F.when(c, 1))).collect()
            times.append(time.perf_counter() - began)
        return min(times)

    scan = seconds(F.length(text) >= 0)
    n, *rejected = some.agg(F.count("*"), *[F.count(F.when(c, 1)) for c in checks.values()]).first()
    value = {name: (hits + 0.5) / (n + 1) / max(seconds(c) - scan, 1e-4)
             for (name, c), hits in zip(checks.items(), rejected)}
    return sorted(checks, key=lambda name: (-value[name], name))


def cascade(order: list[str], checks: dict[str, Column]) -> Column:
    """Name of the first rule that rejects, null if none does; later rules are not evaluated."""
    out = F
    for name in order:
        out = out.when(checks[name], F.lit(name))
    return out.otherwise(F.lit(None).cast("string"))


def judge(docs: DataFrame, *, text: str = "text", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The input rows with the measures, ``base_failed`` (fewer than 50
    words, or over half the words in repeated 3-word windows), ``rejected_by``
    and ``kept``.

    A null or empty text has no words and fails the base; a text of over
    2 ** 26 words raises.  Repeated rows are
    judged alike.  An input column with the name of an output column is
    replaced.
    """
    ours = {"n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "rejected_by", "kept"}
    base = docs.drop(*(set(docs.columns) & ours))
    checks = rules(text)
    order = order_rules(base, checks, text, sample_rows)
    return measures(base, text).withColumn("base_failed", base_fails()) \
        .withColumn("rejected_by", F.when(F.col("base_failed"), F.lit("base")).otherwise(cascade(order, checks))) \
        .withColumn("kept", F.col("rejected_by").isNull())
