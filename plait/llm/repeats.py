"""Substring dedup: greedy relative Lempel-Ziv factors against reference blocks.

The reference is the whole corpus, in blocks.  In every window of ``window``
words the sequence (of BLOCK_WORDS) with the smallest hash names the window's
reference block, so equal windows name equal blocks.  A document is read in
pieces, a piece being the run of windows under one occurrence of a name; a
reference block is a distinct piece and is indexed by its name.  The joins keep
only pieces whose name occurs again somewhere.

A piece that occurs again as a whole is one factor.  Every other piece is
factored greedily against every reference block indexed under its name: from
the first window that one of them holds, the factor takes the longest stretch
that any of them holds on from there.  The windows across the factor's end
are checked in turn, and each that some block holds starts a further factor.
Factors of at least ``window`` words are the duplicate spans; shorter ones are
literals.  Pieces of one name lie alike around it, so the longest stretch
is the common beginning with a neighbour in sorted order, and no two pieces
are compared that are not neighbours.

A name with over CROWDED different blocks is not brought into one task: there
every window is checked like one at a factor's end, by joins on its hash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import shared_dir, ship_package
from .common import cut

#: Words of a reference block, at most; half a window for short windows.
BLOCK_WORDS = 12
#: Windows of a text that are parsed at a time.
CHUNK = 1 << 17
#: Bits of the filter in front of the exact join; a fixed size, whatever the corpus.
FILTER_BITS = 1 << 27
#: Reference blocks of one name that one task takes; the windows of more are joined one by one.
CROWDED = 1024
#: Names of crowded blocks that are broadcast (8 bytes each); more are joined by a shuffle.
BROADCAST_NAMES = 100_000

_BASE = 0x9E3779B97F4A7C15
_powers: dict[str, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base ** 0..n-1 modulo 2 ** 64."""
    key = str(base)
    if key not in _powers or len(_powers[key]) < n:
        a = np.full(max(n, 4096), base, np.uint64)
        a[0] = 1
        _powers[key] = np.cumprod(a)
    return _powers[key][:n]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Sequence:
    """Hashes of word sequences of one stretch of words."""

    def __init__(self, words: list[bytes]):
        n = len(words)
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, n)
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * _power(_BASE, n))])
        self.back = _power(pow(_BASE, -1, 1 << 64), n)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mix((self.sums[end] - self.sums[start]) * self.back[start])


def smallest(values: np.ndarray, width: int) -> np.ndarray:
    """Index of the leftmost smallest value in each run of ``width``."""
    at, span = np.arange(len(values)), 1
    while span < width:
        step = min(span, width - span)
        left, right = at[:-step], at[step:]
        at = np.where(values[right] < values[left], right, left)
        span += step
    return at


def pieces(words: list[bytes], window: int) -> Iterator[dict[str, np.ndarray]]:
    """Pieces of a text: start (first word), m (windows), off (words before
    the block in the first window), block and content hash, hashes of the windows."""
    size = min(BLOCK_WORDS, (window + 1) // 2)
    for at in range(0, len(words) - window + 1, CHUNK):
        part = words[at:at + CHUNK + window - 1]
        seq, count = Sequence(part), len(part) - window + 1
        first = np.arange(len(part) - size + 1)
        blocks = seq.of(first, first + size)
        which = smallest(blocks, window - size + 1)
        start = np.flatnonzero(np.concatenate([[True], which[1:] != which[:-1]]))
        m = np.diff(np.append(start, count))
        p = np.arange(count)
        yield {"start": start + at, "m": m, "off": which[start] - start, "block": blocks[which[start]],
               "content": seq.of(start, start + m + window - 1), "windows": seq.of(p, p + window), "local": start}


def _words(text) -> list[bytes]:
    return (text.as_py() or "").encode("utf-8", "surrogatepass").split()


def _blocks(texts: DataFrame, window: int) -> DataFrame:
    """``block, n``: occurrences of the names of reference blocks."""
    def count(batches):
        for batch in batches:
            found = [f["block"] for t in batch.column(0) for f in pieces(_words(t), window)]
            if found:
                block, n = np.unique(np.concatenate(found), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(block.view(np.int64)), pa.array(n)], ["block", "n"])
    return texts.select("text").mapInArrow(count, "block long, n long") \
        .groupBy("block").agg(F.sum("n").alias("n"))


def _filter(repeated: DataFrame) -> np.ndarray:
    """A bitmap of FILTER_BITS bits that has every repeated block's bit."""
    slot = F.col("block").bitwiseAND(F.lit(FILTER_BITS - 1))
    words = repeated.groupBy(F.shiftright(slot, 6).alias("w")) \
        .agg(F.expr("bit_or(shiftleft(1L, cast(block & 63 as int)))").alias("b"))
    got = words.toArrow()  # at most FILTER_BITS / 64 rows
    out = np.zeros(FILTER_BITS // 64, np.int64)
    out[got["w"].to_numpy()] = got["b"].to_numpy()
    return out.view(np.uint64)


def _occurrences(texts: DataFrame, window: int, bitmap, with_windows: bool) -> DataFrame:
    """Pieces whose block passes the filter, keyed by two hashes of their text."""
    def parse(batches):
        bits = bitmap.value
        for batch in batches:
            k1, k2, text = (batch.column(i) for i in range(3))
            rows: list[list] = [[] for _ in range(7)]
            blobs: list[bytes] = []
            for i in range(batch.num_rows):
                for f in pieces(_words(text[i]), window):
                    slot = f["block"] & np.uint64(FILTER_BITS - 1)
                    keep = (bits[slot >> np.uint64(6)] >> (slot & np.uint64(63))) & np.uint64(1) == 1
                    if not keep.any():
                        continue
                    n = int(keep.sum())
                    for col, v in zip(rows, (np.full(n, k1[i].as_py()), np.full(n, k2[i].as_py()), f["start"][keep],
                                             f["m"][keep], f["off"][keep], f["block"][keep].view(np.int64),
                                             f["content"][keep].view(np.int64))):
                        col.append(v)
                    if not with_windows:
                        blobs += [b""] * n
                        continue
                    data = f["windows"].astype("<u8").tobytes()
                    blobs += [data[8 * a:8 * (a + m)] for a, m in zip(f["local"][keep].tolist(), f["m"][keep].tolist())]
            if blobs:
                types = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]
                cols = [pa.array(np.concatenate(c), t) for c, t in zip(rows, types)]
                yield pa.RecordBatch.from_arrays([*cols, pa.array(blobs, pa.binary())], SCHEMA_NAMES)
    return texts.mapInArrow(parse, SCHEMA)


SCHEMA = "k1 long, k2 int, start int, m int, off int, block long, content long, windows binary"
SCHEMA_NAMES = [c.split()[0] for c in SCHEMA.split(", ")]


def duplicate_spans(texts: DataFrame, window: int = 35) -> DataFrame:
    """``k1, k2, spans``: word spans [start, end) of each distinct text (named
    by two hashes of it) that lie in a window whose words also start anywhere
    else.  Spans of a text are unordered and may overlap."""
    spark = texts.sparkSession
    shared_dir(spark)
    ship_package(spark)
    repeated = cut(_blocks(texts, window).filter("n > 1").select("block"))
    bitmap = spark.sparkContext.broadcast(_filter(repeated))

    # the reference blocks, each once; their occurrences are parsed again below rather than stored
    blocks = cut(_occurrences(texts, window, bitmap, True).groupBy("block", "content").agg(
        F.count("*").alias("n"), *[F.any_value(c).alias(c) for c in ("k1", "k2", "start", "m", "off", "windows")]))
    again = blocks.filter("n > 1").select("block", "content")
    whole = _occurrences(texts, window, bitmap, False).join(again, ["block", "content"], "left_semi") \
        .select("k1", "k2", "start", (F.col("start") + F.col("m") - 1 + window).alias("end"))
    spans = whole.union(_factored(blocks, window)).distinct()
    return spans.groupBy("k1", "k2").agg(F.collect_list(F.struct("start", "end")).alias("spans"))


def _factored(blocks: DataFrame, window: int) -> DataFrame:
    """``k1, k2, start, end`` of the factors of pieces that occur once as a whole."""
    crowded = cut(blocks.groupBy("block").agg(F.count("*").alias("c")).filter(F.col("c") > CROWDED).select("block"))
    names = crowded.count()
    small = F.broadcast(crowded) if names <= BROADCAST_NAMES else crowded
    columns = blocks.select("block", "k1", "k2", "n", "start", "m", "off", "windows")

    def parse(batches):
        for group in _whole_groups(batches):
            yield from _factor_rows(group, window)
    few = columns.join(small, "block", "left_anti") if names else columns
    found = few.repartition("block").sortWithinPartitions("block") \
        .mapInArrow(parse, "k1 long, k2 int, start int, end int")
    if not names:
        return found

    # one row per window, named by its block, its place relative to the block and its hash
    one = F.expr("transform(sequence(0, m - 1), i -> named_struct('off', off - i, "
                 "'hash', substring(windows, 8 * i + 1, 8), 'at', start + i))")
    windows = columns.join(small, "block", "left_semi") \
        .select("k1", "k2", "n", "block", F.explode(one).alias("w")) \
        .select("k1", "k2", "n", "block", "w.off", "w.hash", "w.at")
    twice = windows.groupBy("block", "off", "hash").agg(F.count("*").alias("c")).filter("c > 1").drop("c")
    edge = windows.filter("n = 1").join(twice, ["block", "off", "hash"], "left_semi") \
        .select("k1", "k2", F.col("at").alias("start"), (F.col("at") + window).alias("end"))
    return found.union(edge)


def _whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows, sorted by block, in tables that never part the rows of a block."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        block = batch.column(0).to_numpy()
        last = int(np.searchsorted(block, block[-1]))
        if last or (held and held[-1].column(0)[0].as_py() != block[0]):
            yield pa.Table.from_batches([*held, batch.slice(0, last)], batch.schema)
            held = []
        held.append(batch.slice(last))
    if held:
        yield pa.Table.from_batches(held)


def _factor_rows(rows: pa.Table, window: int) -> Iterator[pa.RecordBatch]:
    """Factors of the pieces in ``rows`` against the other pieces of their block."""
    block = rows.column("block").to_numpy()
    alone = np.concatenate([[True], block[1:] != block[:-1], [True]])
    rows = rows.filter(pa.array(~(alone[:-1] & alone[1:])))
    if not rows.num_rows:
        return
    block, n, m, off = (rows.column(c).to_numpy() for c in ("block", "n", "m", "off"))
    # windows side by side: one column per place relative to the block, in reading order
    first = off.max() - off
    width = int((first + m).max())
    row = np.repeat(np.arange(len(m)), m)
    column = np.arange(len(row)) - np.repeat(np.cumsum(m) - m, m) + np.repeat(first, m)
    hashes, there = np.zeros((len(m), width), np.uint64), np.zeros((len(m), width), bool)
    hashes[row, column] = np.frombuffer(b"".join(rows.column("windows").to_pylist()), "<u8")
    there[row, column] = True
    found = greedy(longest(block, hashes, there))
    at, place, length = (np.concatenate(c) if c else np.zeros(0, np.int64) for c in zip(*found))
    once = n[at] == 1
    at, place, length = at[once], place[once], length[once]
    start = rows.column("start").to_numpy()[at] + place - first[at]
    yield pa.RecordBatch.from_arrays([
        rows.column("k1").combine_chunks().take(pa.array(at)), rows.column("k2").combine_chunks().take(pa.array(at)),
        pa.array(start, pa.int32()), pa.array(start + length - 1 + window, pa.int32())], ["k1", "k2", "start", "end"])


def longest(block: np.ndarray, hashes: np.ndarray, there: np.ndarray) -> np.ndarray:
    """For each row and column, how many columns on from there the row agrees
    with the row of its block that agrees longest.  From the last column to
    the first, rows are sorted by what follows; the longest common beginning of a
    row is the one with the row before or after it."""
    count, width = hashes.shape
    out, rank = np.zeros((count, width), np.int32), np.zeros(count, np.int64)
    for c in range(width - 1, -1, -1):
        rows = np.flatnonzero(there[:, c])
        rows = rows[np.lexsort((rank[rows], hashes[rows, c], block[rows]))]
        a, b = rows[:-1], rows[1:]
        same = (block[a] == block[b]) & (hashes[a, c] == hashes[b, c])
        new = ~same | (rank[a] != rank[b])
        rank = np.zeros(count, np.int64)
        rank[rows] = np.cumsum(np.concatenate([[1], new]))[:len(rows)]
        a, b = a[same], b[same]
        agree = (hashes[a, c:] == hashes[b, c:]) & there[a, c:] & there[b, c:]
        common = np.where(agree.all(1), width - c, agree.argmin(1)).astype(np.int32)
        np.maximum.at(out[:, c], a, common)
        np.maximum.at(out[:, c], b, common)
    return out


def greedy(lengths: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Greedy factors of all rows as (rows, columns, lengths): each row takes
    the longest stretch at the first column it can and goes on behind it."""
    until, out = np.zeros(len(lengths), np.int64), []
    for c in range(lengths.shape[1]):
        rows = np.flatnonzero((until <= c) & (lengths[:, c] > 0))
        until[rows] = c + lengths[rows, c]
        out.append((rows, np.full(len(rows), c), lengths[rows, c].astype(np.int64)))
    return out


def _keys(text):
    return F.xxhash64(text), F.hash(text)


def remove_repeats(docs: DataFrame, *, text: str = "text", window: int = 35) -> DataFrame:
    """The input rows with ``n_words``, ``n_removed`` and ``kept_text``: the
    words, joined by one space, that no repeated window of ``window`` words
    covers.  All occurrences go, the first included.

    A null text has no words and kept_text is empty; texts of fewer words
    than a window keep all.  Repeated rows count as copies of each other, so
    their windows are repeats.  An input column with the name of an output
    column is replaced.
    """
    k1, k2 = _keys(F.col(text))
    spans = duplicate_spans(docs.select(k1.alias("k1"), k2.alias("k2"), F.col(text).alias("text")), window)
    spans = spans.withColumnsRenamed({"k1": "_pl_k1", "k2": "_pl_k2", "spans": "_pl_spans"})
    base = docs.drop(*(set(docs.columns) & {"n_words", "n_removed", "kept_text"}))
    joined = base.join(spans, (k1 == F.col("_pl_k1")) & (k2 == F.col("_pl_k2")), "left")

    @F.arrow_udf("struct<n_words:long,n_removed:long,kept_text:string>")
    def apply(texts: pa.Array, spans: pa.Array) -> pa.Array:
        n_words, n_removed, kept = [], [], []
        offsets, flat = spans.offsets.to_numpy(), spans.values
        start, end = flat.field("start").to_numpy(), flat.field("end").to_numpy()
        for i, t in enumerate(texts):
            words = (t.as_py() or "").encode("utf-8", "surrogatepass").split()
            a, b = offsets[i], offsets[i + 1]
            if b > a:
                depth = np.zeros(len(words) + 1, np.int64)
                np.add.at(depth, start[a:b], 1)
                np.add.at(depth, end[a:b], -1)
                stay = np.cumsum(depth[:-1]) == 0
                kept_words = [w for w, s in zip(words, stay.tolist()) if s]
            else:
                kept_words = words
            n_words.append(len(words))
            n_removed.append(len(words) - len(kept_words))
            kept.append(b" ".join(kept_words).decode("utf-8", "surrogatepass"))
        return pa.StructArray.from_arrays([pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                                           pa.array(kept, pa.string())], ["n_words", "n_removed", "kept_text"])

    return joined.withColumn("_pl_out", apply(F.col(text), F.col("_pl_spans"))) \
        .select(*base.columns, "_pl_out.n_words", "_pl_out.n_removed", "_pl_out.kept_text")


def remove_repeats_plain(texts: list[str | None], window: int = 35) -> list[tuple[int, int, str]]:
    """Brute force over a small list, for tests."""
    split = [(t or "").encode().split() for t in texts]
    seen: dict[tuple, int] = {}
    for w in split:
        for p in range(len(w) - window + 1):
            seen[tuple(w[p:p + window])] = seen.get(tuple(w[p:p + window]), 0) + 1
    out = []
    for w in split:
        gone = {q for p in range(len(w) - window + 1) if seen[tuple(w[p:p + window])] > 1 for q in range(p, p + window)}
        kept = b" ".join(x for q, x in enumerate(w) if q not in gone)
        out.append((len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return out
