"""SimHash near-duplicates through a byte-position inverted index.

A fingerprint is eight positional bytes.  Two fingerprints at most ``bits``
(up to 3) bits apart differ in at most ``bits`` bytes, so they share at least
``8 - bits`` positional bytes.  One of their two halves then has at most one
differing byte, so both stand under one of the eight index entries that join
three positional bytes of a half.  (Entries of a single positional byte would
hold 1/256 of all fingerprints each.)  For pairs that meet under an entry the
shared positional bytes are tallied, pairs below the guaranteed number are
dropped, and the rest are verified by their bit distance.
"""

from __future__ import annotations

from itertools import accumulate

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ship_package
from .common import cut
from .components import components

#: Entries with up to so many fingerprints are joined in SQL; larger ones are compared in blocks of about BLOCK.
SMALL_ENTRY, BLOCK = 64, 2048
#: Shingles hashed at a time, so that a very long text needs no more memory.
CHUNK = 1 << 16


def fingerprint_of(text: str | None, shingle: int = 3) -> int:
    """64-bit SimHash of a text: bit i is set if it is set in more than half
    of the XXH64 (seed 42) values of the word shingles."""
    data = (text or "").encode("utf-8", "surrogatepass").lower()  # on bytes: A-Z only
    words = data.split()  # on bytes: space and tab to carriage return
    n = len(words)
    if not n:
        return 0
    joined = b" ".join(words)
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends[:-1]]
    last = ends[shingle - 1:] if n >= shingle else ends[-1:]
    xx, total, counts = xxhash.xxh64_intdigest, len(last), np.zeros(64, np.int64)
    for at in range(0, total, CHUNK):
        part = [xx(joined[a:b - 1], 42) for a, b in zip(starts[at:at + CHUNK], last[at:at + CHUNK])]
        bits = np.unpackbits(np.array(part, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    set_bits = np.packbits(2 * counts > total, bitorder="little")
    return int(set_bits.view("<i8")[0])


def fingerprint(text: Column, shingle: int = 3) -> Column:
    """SimHash of a text column as a long; 0 for a text without words."""
    @F.arrow_udf("long")
    def simhash(texts: pa.Array) -> pa.Array:
        return pa.array([fingerprint_of(t.as_py(), shingle) for t in texts], pa.int64())
    return simhash(text)


def hex_fingerprint(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def _masks() -> list[int]:
    """The eight joined entries: three positional bytes of one half."""
    out = []
    for left_out in range(8):
        half = range(4) if left_out < 4 else range(4, 8)
        mask = sum(0xFF << (8 * j) for j in half if j != left_out)
        out.append(mask - (1 << 64) if mask >= 1 << 63 else mask)
    return out


MASKS = _masks()


def _shared_bytes(x: Column) -> Column:
    """Positional bytes two fingerprints share, from their XOR."""
    same = [F.when(x.bitwiseAND(F.shiftleft(F.lit(255).cast("long"), 8 * j)) == 0, 1).otherwise(0) for j in range(8)]
    return sum(same[1:], same[0])


def spanning_links(fps: np.ndarray, bits: int) -> list[tuple[int, int]]:
    """Links of a spanning forest of the graph that joins fingerprints at
    most ``bits`` apart: each is compared with those not reached yet."""
    rest, links = np.unique(fps).view(np.uint64), []
    while len(rest):
        front, rest = [rest[0]], rest[1:]
        while front and len(rest):
            x = front.pop()
            diff = rest ^ x
            tally = sum((((diff >> np.uint64(8 * j)) & np.uint64(255)) == 0).astype(np.int8) for j in range(8))
            near = tally >= 8 - bits
            near[near] = np.bitwise_count(diff[near]) <= bits
            links += [(int(x.view(np.int64)), int(y)) for y in rest[near].view(np.int64)]
            front += list(rest[near])
            rest = rest[~near]
    return links


def links(fps: DataFrame, bits: int = 3) -> DataFrame:
    """Links ``a, b`` between distinct fingerprints (column ``fp``) at most
    ``bits`` apart: all of them under small index entries, and under larger
    ones those of a spanning forest of each pair of blocks.  The
    components are those of all links."""
    if not 0 <= bits <= 3:
        raise ValueError("bits must be 0 to 3")
    fp = F.col("fp")
    entries = F.array(*[F.struct(F.lit(i).alias("o"), fp.bitwiseAND(F.lit(m)).alias("k")) for i, m in enumerate(MASKS)])
    index = fps.select("fp").distinct().select("fp", F.explode(entries).alias("e")).select("fp", "e.o", "e.k")
    sizes = index.groupBy("o", "k").agg(F.count("*").alias("n")).filter("n > 1")
    shared = cut(index.join(sizes, ["o", "k"]))

    small = shared.filter(F.col("n") <= SMALL_ENTRY)
    x = F.col("a").bitwiseXOR(F.col("b"))
    earlier = [x.bitwiseAND(F.lit(m)) == 0 for m in MASKS]
    first = F.coalesce(*[F.when(e, F.lit(i)) for i, e in enumerate(earlier)])
    pairs = small.select("o", "k", F.col("fp").alias("a")) \
        .join(small.select("o", "k", F.col("fp").alias("b")), ["o", "k"]).filter("a < b") \
        .filter(_shared_bytes(x) >= 8 - bits).filter(F.bit_count(x) <= bits) \
        .filter(F.col("o") == first).select("a", "b")

    ship_package(fps.sparkSession)
    blocks = F.ceil(F.col("n") / F.lit(BLOCK)).cast("int")
    large = shared.filter(F.col("n") > SMALL_ENTRY) \
        .withColumn("own", F.pmod(F.xxhash64("fp"), blocks).cast("int")) \
        .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1))) \
        .select("o", "k", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "fp")

    def forest(group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(spanning_links(group["fp"].to_numpy(), bits), columns=["a", "b"], dtype="int64")

    return pairs.union(large.groupBy("o", "k", "i", "j").applyInPandas(forest, "a long, b long"))


def link_fingerprints(rows: DataFrame, *, doc_id: str = "doc_id", fp: str = "fp", bits: int = 3) -> DataFrame:
    """Adds ``component_id`` to rows that carry a fingerprint column: the
    smallest id reachable over links of at most ``bits`` differing bits.

    Rows with equal fingerprints are linked.  Null ids do not count for the
    smallest; a component of null ids only has a null component id.
    """
    distinct = cut(rows.groupBy(F.col(fp).alias("fp")).agg(F.min(doc_id).alias("low")))
    member = components(links(distinct, bits), "a", "b")
    linked = distinct.join(member, F.col("fp") == F.col("node")).drop("node")
    lowest = linked.groupBy("root").agg(F.min("low").alias("lowest"))
    labels = linked.join(lowest, "root").select("fp", "lowest")
    component = distinct.join(labels, "fp", "left") \
        .select(F.col("fp").alias("_pl_fp"), F.coalesce("lowest", "low").alias("component_id"))
    return rows.drop("component_id").join(component, F.col(fp) == F.col("_pl_fp")).drop("_pl_fp")


def near_duplicates(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", shingle: int = 3,
                    bits: int = 3) -> DataFrame:
    """``doc_id, fp, component_id`` for every input row.

    Null, empty and blank texts have fingerprint zero and are linked like any
    other.  Repeated rows stay; each gets its row.  An empty table gives an
    empty result; other columns are not read.
    """
    ship_package(docs.sparkSession)
    rows = cut(docs.select(F.col(doc_id).alias("doc_id"), fingerprint(F.col(text), shingle).alias("fp")))
    return link_fingerprints(rows, bits=bits)


def drop_near_duplicates(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", shingle: int = 3,
                         bits: int = 3) -> DataFrame:
    """The input rows without near-copies: one row of each component stays,
    that of the smallest id (null after all others), of equal ids that of the
    smallest hash of its text, and of rows equal in both one, chosen by a hash
    of the whole row.  Ids need not be unique: texts count, not ids."""
    ship_package(docs.sparkSession)
    body = F.xxhash64(F.coalesce(F.col(text), F.lit("")))
    rows = cut(docs.select(F.col(doc_id).alias("id"), body.alias("body"), fingerprint(F.col(text), shingle).alias("fp")))
    # the best row of each fingerprint, then of each component: sums that combine before they are shuffled
    first = cut(rows.groupBy("fp", "id", "body").agg(F.count("*").alias("n")).groupBy("fp")
                .agg(F.min(F.struct(F.col("id").isNull().alias("blank"), "id", "body", "n")).alias("best")))
    member = components(links(first, bits), "a", "b")
    best = first.join(member, F.col("fp") == F.col("node"), "left").groupBy(F.coalesce("root", "fp").alias("group")) \
        .agg(F.min("best").alias("best")).select(F.col("best.id").alias("_pl_id"), F.col("best.body").alias("_pl_body"), F.col("best.n").alias("_pl_n"))
    kept = docs.join(best, (body == F.col("_pl_body")) & F.col(doc_id).eqNullSafe(F.col("_pl_id")))
    once = kept.filter("_pl_n = 1").select(docs.columns)
    hashable = [c for c, t in docs.dtypes if "map<" not in t]
    repeated = kept.filter("_pl_n > 1").groupBy("_pl_id", "_pl_body") \
        .agg(F.min_by(F.struct(*docs.columns), F.xxhash64(*hashable)).alias("row")).select("row.*")
    return once.union(repeated)
