"""Ranked lexical search over norm buckets.

A document is the vector of its impacts on the items' terms.  Vectors are
ordered by length and cut into buckets.  A bucket whose longest vector times
the item's length stays below the item's threshold holds no result
(Cauchy-Schwarz) and is skipped.  Inside a bucket the item's heaviest
coordinates are multiplied out and the rest is bounded by the lengths that
remain; what may still reach the threshold is scored exactly in integers.
Thresholds start from a hashed sample of a few thousand documents and rise with
the results a task has found.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path, ship_package
from .common import global_rank

#: Items searched in one pass over the texts; more are searched block by block.
ITEMS = 256
#: Coordinates of an item multiplied out before its rest is bounded.
FOCUS = 8
#: Documents, about, whose scores give the first thresholds, and numbers held by a bucket's matrix.
SEEDS, CELLS = 4096, 4_000_000
#: Bytes of a text handled at a time.
PIECE = 1 << 20
#: Every byte as a term has it: A-Z lower-cased, other ASCII but 0-9a-z a space.
AS_TERM = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
SALTS = 64


def term_counts(text: bytes | None) -> Counter:
    """Terms of a UTF-8 text and how often each occurs."""
    data, counts, at = text or b"", Counter(), 0
    while at < len(data):
        end = at + PIECE
        while end < len(data) and AS_TERM[data[end]] != 32:
            end += 1
        counts.update(data[at:end].translate(AS_TERM).split())
        at = end
    return counts


def _vectors(docs: DataFrame, doc_id: str, text: str, vocabulary: dict[bytes, int]) -> DataFrame:
    """``doc_id, n, terms, tfs``: the number of all terms of a document, and
    those of the vocabulary with their counts; documents without terms are left out."""
    ship_package(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.keys()
        for batch in batches:
            ids, n, terms, tfs = [], [], [], []
            for doc, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                counts = term_counts(body.as_py())
                if counts:
                    shared = counts.keys() & known
                    ids.append(doc)
                    n.append(counts.total())
                    terms.append([vocabulary[t] for t in shared])
                    tfs.append([counts[t] for t in shared])
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(n, pa.int64()), pa.array(terms, pa.list_(pa.int32())),
                                              pa.array(tfs, pa.list_(pa.int64()))], ["doc_id", "n", "terms", "tfs"])

    return docs.select(F.col(doc_id).cast("long"), F.col(text).cast("binary")) \
        .mapInArrow(count, "doc_id long, n long, terms array<int>, tfs array<long>")


def _impacts(vectors: DataFrame, weights: np.ndarray, n_docs: int, n_terms: int) -> DataFrame:
    """``doc_id, length, terms, impacts``: integer impacts (weight times
    saturated count) and the length of the vector of impacts over the root of
    the weights; vectors without a term of the items are left out."""
    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms, tf = batch.column("terms"), batch.column("tfs").flatten().to_numpy()
            sizes = np.diff(terms.offsets.to_numpy())
            n = batch.column("n").to_numpy()
            m = 75 + (25 * n * n_docs) // n_terms
            saturated = (1_000_000_000 * tf) // (1000 * tf + 12 * np.repeat(m, sizes))
            weight = weights[terms.flatten().to_numpy()]
            row = np.repeat(np.arange(len(n)), sizes)
            length = np.sqrt(np.bincount(row, weight * saturated.astype(float) ** 2, len(n)))
            impacts = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(weight * saturated))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(length), terms, impacts], ["doc_id", "length", "terms", "impacts"])

    return vectors.filter(F.size("terms") > 0).select("doc_id", "n", "terms", "tfs") \
        .mapInArrow(weigh, "doc_id long, length double, terms array<int>, impacts array<long>").filter("length > 0")


class Items:
    """The vectors of a block of items over a vocabulary, as a bucket search needs them."""

    def __init__(self, counts: list[Counter], vocabulary: dict[bytes, int], weights: np.ndarray) -> None:
        self.width = len(vocabulary)
        self.parts = []
        for c in counts:
            terms = np.array([vocabulary[t] for t in c], np.int64)
            times = np.array(list(c.values()), np.int64)
            heavy = np.argsort(-times * np.sqrt(weights[terms]), kind="stable") if len(terms) else terms
            terms, times = terms[heavy], times[heavy]
            root = np.sqrt(weights[terms].astype(float))
            square = (times * root) ** 2
            self.parts.append((terms, times, root[:FOCUS], math.sqrt(square.sum()), math.sqrt(square[FOCUS:].sum())))


class Best:
    """The ``k`` best documents of each item so far, and the score to reach."""

    def __init__(self, k: int, least: list[int]) -> None:
        self.k, self.least = k, list(least)
        self.score = [np.empty(0, np.int64) for _ in least]
        self.doc = [np.empty(0, np.int64) for _ in least]
        self.null = [np.empty(0, bool) for _ in least]

    def add(self, i: int, score: np.ndarray, doc: np.ndarray, null: np.ndarray) -> None:
        score, doc, null = (np.concatenate(x) for x in ((self.score[i], score), (self.doc[i], doc), (self.null[i], null)))
        top = np.lexsort((doc, null, -score))[:self.k]
        self.score[i], self.doc[i], self.null[i] = score[top], doc[top], null[top]
        if len(top) == self.k:
            self.least[i] = max(self.least[i], int(self.score[i][-1]))


def search_bucket(items: Items, best: Best, doc: np.ndarray, null: np.ndarray, length: np.ndarray, row: np.ndarray,
                  term: np.ndarray, impact: np.ndarray) -> int:
    """Adds the results of one bucket; returns the number of exact scores.
    ``row, term, impact`` are the bucket's entries, ``length`` its vectors' lengths."""
    slack = 1 + 1e-9  # rounding of the bounds; scores themselves are integers
    alive = [i for i, p in enumerate(items.parts) if len(p[0]) and p[3] * length.max() * slack >= best.least[i]]
    if not alive:
        return 0
    matrix = np.zeros((items.width, len(length)), np.int64)
    matrix[term, row] = impact
    scored = 0
    for i in alive:
        terms, times, root, _, rest = items.parts[i]
        focus = matrix[terms[:FOCUS]].astype(float)
        part = times[:FOCUS] @ focus
        with np.errstate(divide="ignore", invalid="ignore"):
            spread = np.where(root[:, None] > 0, focus / root[:, None], 0.0)
        left = np.sqrt(np.maximum(length ** 2 * slack - (spread ** 2).sum(axis=0), 0))
        near = np.flatnonzero((part + rest * left) * slack >= best.least[i])
        score = times @ matrix[terms][:, near]
        scored += len(near)
        good = score >= best.least[i]
        if good.any():
            best.add(i, score[good], doc[near[good]], null[near[good]])
    return scored


def _search(impacts: DataFrame, items: Items, k: int, least: list[int]) -> DataFrame:
    """``item, doc_id, score``: of each task the best ``k`` documents of each item."""
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(k, least)
        high = max(16, min(1024, CELLS // max(1, items.width)))
        for batch in batches:
            for at in range(0, batch.num_rows, high):
                part = batch.slice(at, high)
                terms = part.column("terms")
                ids = part.column("doc_id")
                row = np.repeat(np.arange(part.num_rows), np.diff(terms.offsets.to_numpy()))
                search_bucket(items, best, ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False),
                              part.column("length").to_numpy(), row, terms.flatten().to_numpy(), part.column("impacts").flatten().to_numpy())
        sizes = [len(s) for s in best.score]
        doc, null = np.concatenate(best.doc), np.concatenate(best.null)
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(len(sizes)), sizes), pa.int32()),
                                          pa.array(doc, pa.int64(), mask=null), pa.array(np.concatenate(best.score))],
                                         ["item", "doc_id", "score"])

    return impacts.mapInArrow(search, "item int, doc_id long, score long")


def _top(found: DataFrame, k: int) -> DataFrame:
    """The best ``k`` of each item with their ``rank``; salted first, so that no task holds an item's results of all tasks."""
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    part = found.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)))
    part = part.withColumn("rank", F.row_number().over(Window.partitionBy("item", "salt").orderBy(*order))).filter(F.col("rank") <= k)
    return part.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))) \
        .filter(F.col("rank") <= k).drop("salt")


RESULT = "item_id long, rank int, doc_id long, score long"


def ranked_search(docs: DataFrame, items: DataFrame, *, k: int = 20, doc_id: str = "doc_id", text: str = "text",
                  item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best documents of every item.

    Scores are those of the contract of the query: 64-bit integers over the
    item's terms with repeats.  Equal scores rank by ascending id, a null id
    last.  Null and empty texts have no terms: such a document is no result
    and does not count, such an item has no results.  Every row is a document
    or an item of its own, repeated rows too.  An empty table gives an empty
    result; other columns are not read.  Items are held by the driver block by
    block, at most ITEMS at once.
    """
    spark = docs.sparkSession
    asked = global_rank(items.select(F.col(item_id).cast("long").alias("item_id"), F.col(item_text).alias("body")), ["item_id", "body"], "at")
    results = spark.createDataFrame([], RESULT)
    for start in range(0, asked.count(), ITEMS):
        block = asked.filter((F.col("at") > start) & (F.col("at") <= start + ITEMS)).orderBy("at").collect()
        results = results.union(_search_block(docs, block, k, doc_id, text))
    return results


def _search_block(docs: DataFrame, block: list, k: int, doc_id: str, text: str) -> DataFrame:
    spark = docs.sparkSession
    counts = [term_counts((r["body"] or "").encode("utf-8", "surrogatepass")) for r in block]
    vocabulary = {t: i for i, t in enumerate(sorted(set().union(*counts)))}
    path = scratch_path(spark, "vectors")
    _vectors(docs, doc_id, text, vocabulary).write.parquet(path)
    vectors = spark.read.parquet(path)
    n_docs, n_terms = vectors.agg(F.count("*"), F.sum("n")).first()
    if not n_docs or not vocabulary:
        return spark.createDataFrame([], RESULT)
    # one row per term of the items
    held = dict(vectors.select(F.explode("terms").alias("t")).groupBy("t").count().collect())
    weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * held.get(i, 0) + 1))) for i in range(len(vocabulary))], np.int64)
    asked = Items(counts, vocabulary, weights)
    impacts = _impacts(vectors, weights, n_docs, n_terms)
    order = [F.col("length").desc(), F.col("doc_id")]

    # a hashed sample of about SEEDS documents: what it reaches, the whole table reaches too
    share = F.lit(max(1, n_docs // SEEDS))
    sample = _impacts(vectors.filter(F.pmod(F.xxhash64("doc_id"), share) == 0), weights, n_docs, n_terms)
    seeds = _top(_search(sample, asked, k, [1] * len(block)), k)
    last = seeds.groupBy("item").agg(F.count("*").alias("n"), F.min("score").alias("low")).filter(F.col("n") == k)
    reached = {r["item"]: r["low"] for r in last.collect()}  # one row per item of the block
    least = [reached.get(i, 1) for i in range(len(block))]
    by_length = impacts.repartitionByRange(*order).sortWithinPartitions(*order)
    names = spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(block)], "item int, item_id long")
    return _top(_search(by_length, asked, k, least), k).join(F.broadcast(names), "item") \
        .select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
