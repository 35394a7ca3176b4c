"""Line dedup by streaming sorted line hashes.

Every long line becomes a small record (128-bit hash of its key, block of its
document, document, position).  The records are range-partitioned by hash and
block and sorted by document and position behind them; one streaming pass
finds the first record of each document under a key.  A key's blocks lie side
by side, so an ordinary key stays in one partition, and a key that holds a
third of all lines spreads over many.  What goes is written down as one
compressed keep bitmap per document; texts are not moved for the decision.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import SPACE_CHARS, ascii_lower

#: Parts a key's documents are dealt into, so that one key spreads over tasks.
BLOCKS = 256
WORD_BITS = 64


def line_array(text: Column) -> Column:
    """The lines of a text; a null or empty text is one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n")


def line_key(line: Column) -> Column:
    """The line without white space at both ends, A-Z lower-cased."""
    bare = F.btrim(line, F.lit(SPACE_CHARS))
    ascii_only = F.length(bare) == F.octet_length(bare)
    return F.when(ascii_only, F.lower(bare)).otherwise(ascii_lower(bare))


def line_records(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", least: int = 40) -> DataFrame:
    """``h1, h2, block, doc, body, pos`` of every line whose key has at least
    ``least`` code points; ``body`` is a hash of the text and tells rows of one
    id apart."""
    rows = docs.select(F.col(doc_id).alias("doc"), F.xxhash64(text).alias("body"),
                       F.posexplode(line_array(F.col(text))).alias("pos", "line")) \
        .withColumn("key", line_key(F.col("line"))).filter(F.length("key") >= least)
    return rows.select(F.xxhash64("key").alias("h1"), F.xxhash64(F.lit("second"), "key").alias("h2"),
                       F.pmod(F.xxhash64("doc"), F.lit(BLOCKS)).cast("int").alias("block"), "doc", "body", "pos")


def common_keys(records: DataFrame, *, documents: int = 5) -> DataFrame:
    """``h1, h2, block, keeper`` for the keys found in at least ``documents``
    documents, a row per block that holds the key; ``keeper`` is the largest
    document id."""
    place = ["h1", "h2", "block"]
    order = [F.col("doc").desc_nulls_last(), F.col("body"), F.col("pos")]
    sorted_rows = records.repartitionByRange(*place).sortWithinPartitions(*place, *order)
    # range partitioning by the same columns: the window needs no further shuffle
    before = F.lag(F.struct("doc")).over(Window.partitionBy(*place).orderBy(*order))
    first = before.isNull() | ~before["doc"].eqNullSafe(F.col("doc"))
    blocks = sorted_rows.withColumn("first", first).groupBy(*place) \
        .agg(F.sum(F.col("first").cast("long")).alias("n"), F.max("doc").alias("top"))
    keys = blocks.groupBy("h1", "h2").agg(F.sum("n").alias("n"), F.max("top").alias("keeper"),
                                          F.collect_list("block").alias("blocks"))
    return keys.filter(F.col("n") >= documents).select("h1", "h2", F.explode("blocks").alias("block"), "keeper")


def keep_bitmaps(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", least: int = 40,
                 documents: int = 5) -> DataFrame:
    """``doc_id, body, n_dropped, keep``: a row for every document that loses lines.

    ``keep`` is the document's bitmap of kept lines, compressed: of its words
    of 64 lines only those with a line dropped are listed (``word``, ``bits``,
    bit set: line stays); all others keep every line.  ``body`` is the
    xxhash64 of the text the bitmap belongs to.

    Keys (white space stripped, A-Z lower-cased) of at least ``least`` code
    points found in at least ``documents`` documents lose all lines but those
    of the largest id.  All rows of one id are one document; rows without id
    are one document smaller than all others.  Null and empty texts have one
    empty line, which stays; an empty table gives an empty result.
    """
    path = scratch_path(docs.sparkSession, "lines")
    line_records(docs, doc_id=doc_id, text=text, least=least).write.parquet(path)
    records = docs.sparkSession.read.parquet(path)
    common = common_keys(records, documents=documents)
    gone = records.join(common, ["h1", "h2", "block"]).filter(~F.col("doc").eqNullSafe(F.col("keeper")))
    bit = F.expr(f"shiftleft(1L, pmod(pos, {WORD_BITS}))")
    words = gone.groupBy("doc", "body", F.expr(f"pos div {WORD_BITS}").cast("int").alias("word")) \
        .agg(F.bit_or(bit).alias("out"))
    return words.groupBy("doc", "body").agg(
        F.sum(F.bit_count("out")).cast("long").alias("n_dropped"),
        F.array_sort(F.collect_list(F.struct("word", F.bitwise_not("out").alias("bits")))).alias("keep")) \
        .withColumnRenamed("doc", "doc_id")


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The input rows with ``n_lines`` (before dropping), ``n_dropped`` and
    ``kept_text``; the one place where texts are shuffled.  Input columns of
    these names are replaced."""
    last = F.element_at("keep", -1)["word"]
    listed = F.map_from_entries("keep")
    # one entry a word up to the last listed one, so that a line finds its bit by position
    dense = F.transform(F.sequence(F.lit(0), last), lambda w: F.coalesce(F.try_element_at(listed, w), F.lit(-1).cast("long")))
    side = bitmaps.select(F.col("doc_id").alias("_pl_id"), F.col("body").alias("_pl_body"),
                          F.col("n_dropped").alias("_pl_dropped"), dense.alias("_pl_keep"))
    rows = docs.drop(*(set(docs.columns) & {"n_lines", "n_dropped", "kept_text"}))
    joined = rows.join(side, F.col(doc_id).eqNullSafe(F.col("_pl_id")) & (F.xxhash64(text) == F.col("_pl_body")), "left")

    def stays(_line: Column, at: Column) -> Column:
        word = F.coalesce(F.get("_pl_keep", F.shiftright(at, 6)), F.lit(-1).cast("long"))
        return F.getbit(word, F.pmod(at, F.lit(WORD_BITS))) == 1

    kept = F.array_join(F.filter(line_array(F.col(text)), stays), "\n")
    return joined.withColumn("n_lines", F.size(line_array(F.col(text))).cast("long")) \
        .withColumn("n_dropped", F.coalesce("_pl_dropped", F.lit(0).cast("long"))) \
        .withColumn("kept_text", F.when(F.col("_pl_keep").isNull(), F.coalesce(F.col(text), F.lit(""))).otherwise(kept)) \
        .drop("_pl_id", "_pl_body", "_pl_dropped", "_pl_keep")
