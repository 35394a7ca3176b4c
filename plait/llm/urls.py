"""URL filter over a tree of path templates.

Per host, path segments that vary (numbers, hashes) become typed wildcards,
and sibling branches become one wildcard, unless a branch's share of bad pages
differs significantly from that of the rest.  Each
template's share of bad labelled pages is smoothed towards its parent's, the
host's towards that of all; templates with a high share are rejected.
Explicit rules go before templates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, cut

#: |z| under which a branch is similar to its siblings.
SIMILAR = 1.96
#: Labelled pages a single number or hash needs to be told from the others of its kind.
SUPPORT = 5
#: Weight of the parent's share, in pages, and the share from which a template is rejected.
PRIOR, REJECT = 4.0, 0.5


def host_of(url: Column) -> Column:
    return F.coalesce(ascii_lower(F.regexp_extract(url, r"://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def longest_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """Rule string and verdict of the longest ``(verdict, rule)`` that fits
    the host or a parent domain and the start of the path; null if none."""
    found, verdict = F, F
    for what, rule in sorted(rules, key=lambda r: (-len(r[1]), r)):
        domain, slash, rest = rule.partition("/")
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith(slash + rest)
        found, verdict = found.when(fits, F.lit(rule)), verdict.when(fits, F.lit(what))
    if not rules:
        return F.lit(None).cast("string"), F.lit(None).cast("string")
    return found.otherwise(F.lit(None).cast("string")), verdict.otherwise(F.lit(None).cast("string"))


def path_segments(path: Column) -> Column:
    return F.filter(F.split(path, "/"), lambda s: s != "")


def typed(segment: Column) -> Column:
    """The wildcard of a variable segment: numbers as ``{n}``, hashes (16 or
    more hexadecimal digits, at least one of them 0-9) as ``{h}``."""
    number = F.regexp_replace(segment, r"[0-9]+", "{n}")
    return F.when(segment.rlike(r"^(?=.*[0-9])[0-9a-fA-F-]{16,}$"), F.lit("{h}")).otherwise(number)


def _differs(labelled: str, wrong: str, all_l: str, all_w: str) -> Column:
    """Whether a branch's share of bad pages differs from that of the rest: two shares, pooled."""
    n, w, rest_l, rest_w = F.col(labelled), F.col(wrong), F.col(all_l) - F.col(labelled), F.col(all_w) - F.col(wrong)
    known = (n > 0) & (rest_l > 0) & (F.col(all_w) > 0) & (F.col(all_w) < F.col(all_l))
    pooled = F.col(all_w) / F.col(all_l)
    z = (w / n - rest_w / rest_l) / F.sqrt(pooled * (1 - pooled) * (1 / n + 1 / rest_l))
    return F.when(known, F.abs(z) >= SIMILAR).otherwise(F.lit(False))


def _merged(branch: DataFrame, group: list[str], node: Column) -> DataFrame:
    """``branch`` with the sums and the number of its siblings (``all_l, all_w,
    width``) and, from them, its ``node``."""
    whole = branch.groupBy(*group).agg(F.count("*").alias("width"), F.sum("labelled").alias("all_l"), F.sum("wrong").alias("all_w"))
    return branch.join(whole, group).withColumn("node", node).drop("all_l", "all_w", "width")


def template_verdicts(pages: DataFrame) -> DataFrame:
    """``host, segments, template, purity`` from rows of ``host, segments,
    bad`` (1 bad, 0 good, null without label); ``purity`` is the smoothed
    share of bad pages of the template.

    All statistics are sums over paths, so their number does not grow with
    the pages of a path.  The tree is built level by level; a branch with a
    single path left needs no test and is closed at once, so there are as many
    levels as paths share segments, however long a path is.
    """
    paths = cut(pages.groupBy("host", "segments").agg(
        F.count("bad").alias("labelled"),
        F.coalesce(F.sum("bad"), F.lit(0)).cast("long").alias("wrong")))
    total, wrong = paths.agg(F.sum("labelled"), F.sum("wrong")).first()
    prior = (wrong or 0) / ((total or 0) + 1.0)  # 0 without labels: nothing is rejected

    def smoothed(labelled: str, bad: str, parent: Column) -> Column:
        return (F.col(bad) + PRIOR * parent) / (F.col(labelled) + PRIOR)

    hosts = paths.groupBy("host").agg(F.sum("labelled").alias("l"), F.sum("wrong").alias("w")) \
        .select("host", smoothed("l", "w", F.lit(prior)).alias("purity"))
    paths = cut(paths.join(hosts, "host").withColumn("template", F.lit("")))
    done = paths.filter(F.size("segments") == 0)  # paths without further segments leave the loop
    paths, d = paths.filter(F.size("segments") > 0), 0
    while not paths.isEmpty():
        alone = paths.groupBy("host", "template").agg(F.count("*").alias("here")).filter("here = 1").select("host", "template", F.lit(True).alias("alone"))
        marked = paths.join(alone, ["host", "template"], "left")
        # one path left: the rest of it is the template, each of its levels smoothed towards the one above
        rest = F.slice("segments", d + 1, F.greatest(F.size("segments") - d, F.lit(0)))
        share = F.when(F.col("labelled") > 0, F.col("wrong") / F.col("labelled")).otherwise(F.col("purity"))
        last = share + F.pow(PRIOR / (F.col("labelled") + PRIOR), F.size(rest)) * (F.col("purity") - share)
        closed = marked.filter("alone").withColumn("template", F.concat("template", F.lit("/"), F.array_join(F.transform(rest, typed), "/"))) \
            .withColumn("purity", last).drop("alone")
        here = marked.filter("alone IS NULL").drop("alone").withColumn("seg", F.get("segments", F.lit(d))).withColumn("kind", typed(F.col("seg")))
        branch = here.groupBy("host", "template", "kind", "seg").agg(*[F.sum(c).alias(c) for c in ("labelled", "wrong")])
        # variable segments become their wildcard, unless enough pages tell one from the rest of its kind
        told = (F.col("seg") != F.col("kind")) & (F.col("labelled") >= SUPPORT) & _differs("labelled", "wrong", "all_l", "all_w")
        kinds = cut(_merged(branch, ["host", "template", "kind"], F.when(told, F.col("seg")).otherwise(F.col("kind")))
                    .withColumnRenamed("node", "part"))
        # siblings that do not differ are one wildcard, however many they are
        part = kinds.groupBy("host", "template", "part").agg(*[F.sum(c).alias(c) for c in ("labelled", "wrong")])
        own = (F.col("width") == 1) | _differs("labelled", "wrong", "all_l", "all_w")
        nodes = _merged(part, ["host", "template"], F.when(own, F.col("part")).otherwise(F.lit("*")))
        sums = nodes.groupBy("host", "template", "node").agg(F.sum("labelled").alias("l"), F.sum("wrong").alias("w"))
        choice = kinds.select("host", "template", "seg", "part").join(nodes.select("host", "template", "part", "node"), ["host", "template", "part"]) \
            .join(sums, ["host", "template", "node"]).select("host", "template", "seg", "node", "l", "w")
        stepped = here.join(choice, ["host", "template", "seg"]).withColumn("purity", smoothed("l", "w", F.col("purity"))) \
            .withColumn("template", F.concat("template", F.lit("/"), "node")).drop("seg", "kind", "node", "l", "w")
        d += 1
        made = cut(closed.withColumn("open", F.lit(False)).unionByName(stepped.withColumn("open", F.size("segments") > d)))
        done = done.unionByName(made.filter("NOT open").drop("open"))
        paths = made.filter("open").drop("open")
    return done.select("host", "segments", "template", "purity")


def judge_urls(pages: DataFrame, labels: DataFrame, rules: list[tuple[str, str]], *, page_id: str = "page_id",
               url: str = "url") -> DataFrame:
    """The input rows with ``host, path, rule, template, verdict``.

    ``labels`` has ``page_id`` and ``bad`` (0 or 1); rows without either are
    left out, and a page with several labels is bad if one is.  A null url
    has empty host and path and is judged by the template of no path; pages
    that repeat an id each get their verdict.  An input column with the name
    of an output column is replaced.
    """
    base = pages.drop(*(set(pages.columns) & {"host", "path", "rule", "template", "verdict"}))
    parsed = base.withColumn("host", host_of(F.col(url))).withColumn("path", path_of(F.col(url)))
    parsed = parsed.withColumn("_pl_seg", path_segments(F.col("path")))
    marks = labels.select(F.col(page_id).alias("_pl_id"), F.col("bad").cast("int").alias("_pl_bad")).dropna() \
        .groupBy("_pl_id").agg(F.max("_pl_bad").alias("_pl_bad"))
    known = parsed.join(marks, F.col(page_id) == F.col("_pl_id"), "left")
    stats = template_verdicts(known.select("host", F.col("_pl_seg").alias("segments"), F.col("_pl_bad").alias("bad")))
    side = stats.select(F.col("host").alias("_pl_host"), F.col("segments").alias("_pl_segments"),
                        F.col("template").alias("_pl_template"), F.col("purity").alias("_pl_purity"))
    rule, verdict = longest_rule(F.col("host"), F.col("path"), rules)
    own = F.when(F.col("_pl_purity") >= REJECT, F.lit("block")).otherwise(F.lit("allow"))
    return parsed.join(side, (F.col("host") == F.col("_pl_host")) & (F.col("_pl_seg") == F.col("_pl_segments"))) \
        .withColumn("rule", rule).withColumn("verdict", F.coalesce(verdict, own)) \
        .select(*base.columns, "host", "path", "rule", F.col("_pl_template").alias("template"), "verdict")
