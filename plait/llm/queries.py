"""The registered queries: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import pii, toxicity
from .common import read
from .decontaminate import matches
from .html import extract_text
from .lexical import ranked_search
from .lines import apply_bitmaps, keep_bitmaps
from .manifest import manifest, proofs
from .mixing import mixing_plan
from .quotes import reply_ordered
from .repeats import remove_repeats
from .quality import judge
from .simhash import hex_fingerprint, near_duplicates
from .urls import judge_urls, path_of


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per contaminated document and the benchmark item it holds."""
    found = matches(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.withColumn("contaminated", F.lit(True))


def op2_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reply_ordered(read(spark, sf_dir, "conversations"))


#: Fixed rules of the query.
URL_RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"),
             ("block", "com/de/")]


def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page is labelled through the document its path numbers: bad if that
    document's quality is 0."""
    pages = read(spark, sf_dir, "pages").select("page_id", "url")
    number = F.regexp_extract(path_of(F.col("url")), r"([0-9]{1,18})(?:\.[a-z]+)?/?$", 1)
    quality = read(spark, sf_dir, "labels").select("doc_id", (1 - F.col("quality")).alias("bad"))
    labels = pages.withColumn("doc_id", F.when(number != "", number).cast("long")).join(quality, "doc_id")
    return judge_urls(pages, labels, URL_RULES).select("page_id", "host", "path", "rule", "verdict", "template")


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(read(spark, sf_dir, "documents"), shingle=3, bits=3)
    return found.select("doc_id", hex_fingerprint(F.col("fp")).alias("fingerprint"), "component_id")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = judge(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = extract_text(read(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return rows.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    rows = pii.find_pii(docs, pii.fit(docs))
    counts = [pii.count_kind(F.col("base"), k).alias(f"n_{k}") for k in pii.BASE_KINDS]
    return rows.select("doc_id", *counts, F.sha2(pii.span_text(F.col("base")), 256).alias("base_sha256"),
                       pii.span_text(F.col("spans")).alias("spans"))


#: Categories in the order of the chain; both come from the labels.
TOXIC_CHAIN = ("low_quality", "toxic")


def toxic_labels(labels: DataFrame) -> DataFrame:
    return labels.select("doc_id", (1 - F.col("quality")).alias("low_quality"), "toxic")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents the chain rejects, with the probabilities of all categories."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    chain = toxicity.fit(docs, toxic_labels(read(spark, sf_dir, "labels")), TOXIC_CHAIN)
    return toxicity.score(docs, chain).filter("is_toxic") \
        .select("doc_id", "p_low_quality", "p_toxic", F.col("is_toxic").alias("toxic"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = remove_repeats(read(spark, sf_dir, "documents").select("doc_id", "text"), window=35)
    return rows.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing_plan(read(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return plan.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    rows = apply_bitmaps(docs, keep_bitmaps(docs, least=40, documents=5))
    return rows.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), k=20)


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = proofs(manifest(read(spark, sf_dir, "documents")))
    return rows.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


QUERIES = {
    "op1_decontamination": op1_decontamination,
    "op2_chat_formatting": op2_chat_formatting,
    "op3_url_filters": op3_url_filters,
    "op4_simhash_near_dedup": op4_simhash_near_dedup,
    "op5_quality_rules": op5_quality_rules,
    "op6_html_extraction": op6_html_extraction,
    "op7_pii": op7_pii,
    "op8_toxicity": op8_toxicity,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_mixing": op10_mixing,
    "op11_line_dedup": op11_line_dedup,
    "op12_lexical_search": op12_lexical_search,
    "op13_merkle_manifest": op13_merkle_manifest,
}

_OP10 = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source ASC NULLS LAST) AS r
  FROM d GROUP BY source
), w AS (
  SELECT *, ([3, 1, 2])[((r - 1) % 3 + 1)::INT]::HUGEINT AS weight FROM s
), o AS (
  SELECT *, row_number() OVER (ORDER BY source_size * (6 // weight), r) AS k FROM w
), p AS (
  SELECT *,
    3 * sum(source_size) OVER () - 4 * coalesce(sum(source_size) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS amount,
    sum(weight) OVER () - coalesce(sum(weight) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest
  FROM o
), level AS (
  SELECT amount::HUGEINT AS amount, rest::HUGEINT AS rest FROM p
  WHERE source_size * 4 * rest >= weight * amount ORDER BY k LIMIT 1
), t AS (
  SELECT w.source, w.source_size, CASE WHEN source_size * 4 * rest < weight * amount THEN (2 * source_size)::DOUBLE
    ELSE (weight * amount)::DOUBLE / (2 * rest)::DOUBLE END AS target
  FROM w, level
), r AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
    CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0::DOUBLE END AS rate
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
  size * (floor(rate)::BIGINT + CASE WHEN
    ('0x' || substr(md5('mix-1:' || coalesce(doc_id::VARCHAR, 'null')), 1, 8))::BIGINT / 4294967296.0::DOUBLE
    < rate - floor(rate) THEN 1 ELSE 0 END)::BIGINT AS taken
FROM r
"""

_OP11 = r"""
WITH l AS (
  SELECT doc_id, generate_subscripts(a, 1) AS pos, unnest(a) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS a FROM documents)
), k AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l
), c AS (
  SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), j AS (
  SELECT k.doc_id, k.pos, k.line, c.key IS NOT NULL AND k.doc_id <> c.keeper AS gone FROM k LEFT JOIN c ON k.key = c.key
)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (WHERE gone)::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM j GROUP BY doc_id
"""

_OP12 = r"""
WITH d AS (
  SELECT doc_id, list_transform(regexp_extract_all(coalesce(text, ''), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'),
    lambda t: translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS terms FROM documents
), q AS (
  SELECT item_id, unnest(list_transform(regexp_extract_all(coalesce(text, ''), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'),
    lambda t: translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'))) AS term FROM benchmark
), s AS (
  SELECT count(*)::BIGINT AS n_docs, sum(len(terms))::BIGINT AS n_terms FROM d WHERE len(terms) > 0
), p AS (
  SELECT doc_id, n, term, count(*)::BIGINT AS tf FROM (SELECT doc_id, len(terms)::BIGINT AS n, unnest(terms) AS term FROM d)
  GROUP BY doc_id, n, term
), f AS (
  SELECT term, count(*)::BIGINT AS df FROM p GROUP BY term
), w AS (
  SELECT f.term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS weight, n_docs, n_terms FROM f, s
), r AS (
  SELECT q.item_id, p.doc_id,
    sum(w.weight * ((1000000000 * p.tf) // (1000 * p.tf + 12 * (75 + (25 * p.n * w.n_docs) // w.n_terms))))::BIGINT AS score
  FROM q JOIN w ON q.term = w.term JOIN p ON p.term = q.term GROUP BY q.item_id, p.doc_id
), o AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
  FROM r WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM o WHERE rank <= 20
"""

_OP13 = r"""
WITH RECURSIVE f AS (
  SELECT doc_id, lang,
    CASE WHEN doc_id IS NULL THEN '-' ELSE strlen(doc_id::VARCHAR) || ':' || doc_id END
    || CASE WHEN source IS NULL THEN '-' ELSE strlen(source) || ':' || source END
    || CASE WHEN lang IS NULL THEN '-' ELSE strlen(lang) || ':' || lang END AS head,
    n_chars, CASE WHEN text IS NULL THEN '-' ELSE strlen(text) || ':' || text END AS tail,
    list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
      lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0],
        lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384::BIGINT) ELSE x // 2 END)) AS crc
  FROM documents
), leaf AS (
  SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS idx,
    sha256(head || CASE WHEN n_chars IS NULL THEN '-' ELSE strlen(n_chars::VARCHAR) || ':' || n_chars END || tail) AS leaf,
    CASE WHEN xor(crc, 4294967295::BIGINT) % 7 = 0 THEN
      sha256(head || CASE WHEN n_chars IS NULL THEN '-' ELSE strlen((n_chars + 1)::VARCHAR) || ':' || (n_chars + 1) END || tail) END AS changed
  FROM f
), tree AS (
  SELECT lang, 0 AS level, idx, leaf AS h FROM leaf
  UNION ALL
  SELECT lang, max(level) + 1, idx // 2, sha256(string_agg(h, '' ORDER BY idx))
  FROM (SELECT *, count(*) OVER (PARTITION BY lang) AS n FROM tree) WHERE n > 1 GROUP BY lang, idx // 2
), sub AS (
  SELECT lang, h AS subroot, level AS height, row_number() OVER (ORDER BY encode(lang) NULLS FIRST) - 1 AS idx
  FROM (SELECT *, max(level) OVER (PARTITION BY lang) AS top FROM tree) WHERE level = top
), crown AS (
  SELECT 0 AS level, idx, subroot AS h FROM sub
  UNION ALL
  SELECT max(level) + 1, idx // 2, sha256(string_agg(h, '' ORDER BY idx))
  FROM (SELECT *, count(*) OVER () AS n FROM crown) WHERE n > 1 GROUP BY idx // 2
), root AS (
  SELECT h AS root, level AS height FROM crown ORDER BY level DESC LIMIT 1
), step AS (
  SELECT l.doc_id, t.level, (l.idx >> t.level) % 2 = 1 AS is_left, s.h
  FROM leaf l JOIN sub ON l.lang IS NOT DISTINCT FROM sub.lang
  JOIN tree t ON t.lang IS NOT DISTINCT FROM l.lang AND t.level < sub.height AND t.idx = l.idx >> t.level
  LEFT JOIN tree s ON s.lang IS NOT DISTINCT FROM l.lang AND s.level = t.level AND s.idx = xor(t.idx, 1)
  UNION ALL
  SELECT l.doc_id, 1000 + t.level, (sub.idx >> t.level) % 2 = 1, s.h
  FROM leaf l JOIN sub ON l.lang IS NOT DISTINCT FROM sub.lang CROSS JOIN root
  JOIN crown t ON t.level < root.height AND t.idx = sub.idx >> t.level
  LEFT JOIN crown s ON s.level = t.level AND s.idx = xor(t.idx, 1)
), path AS (
  SELECT doc_id, list({'is_left': is_left, 'h': h} ORDER BY level) AS path, coalesce(string_agg(h, '' ORDER BY level), '') AS siblings
  FROM step GROUP BY doc_id
), fold AS (
  SELECT l.doc_id, 1 AS i, coalesce(changed, leaf) AS h, coalesce(path, []) AS path
  FROM leaf l LEFT JOIN path p ON l.doc_id = p.doc_id
  UNION ALL
  SELECT doc_id, i + 1, sha256(CASE WHEN path[i].h IS NULL THEN h WHEN path[i].is_left THEN path[i].h || h ELSE h || path[i].h END), path
  FROM fold WHERE i <= len(path)
)
SELECT l.doc_id, l.leaf, sub.subroot, root.root, sha256(coalesce(p.siblings, '')) AS proof_sha256, fold.h AS folded_root,
  fold.h = root.root AS verified
FROM leaf l JOIN sub ON l.lang IS NOT DISTINCT FROM sub.lang CROSS JOIN root
LEFT JOIN path p ON p.doc_id = l.doc_id JOIN fold ON fold.doc_id = l.doc_id AND fold.i = len(fold.path) + 1
"""

ORACLE = {"op10_mixing": _OP10, "op11_line_dedup": _OP11, "op12_lexical_search": _OP12, "op13_merkle_manifest": _OP13}
