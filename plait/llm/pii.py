"""Personal data: fixed patterns, and a semi-Markov conditional random field.

The patterns of the four base kinds are always kept.  The random field scores
whole candidate segments of a few tokens with features of the entire span
(its shape, digit count, checksum, the cue word before it) and chooses
boundaries and kinds jointly: a dynamic programme over token positions with
entities of at most ``MAX_TOKENS`` tokens.  It adds spans such as numbers
without a country code, credentials and national ids.

The field is fitted by likelihood on regions of a bounded sample of
documents, labelled by the base patterns and two seed patterns, and on
variants made by rule: phone numbers without the prefix or with other
separators, and numbers that are no personal data.
"""

from __future__ import annotations

import math
import random
import re
from collections import defaultdict
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ship_package

#: Base kinds in their order of listing, then the kinds only the method adds.
BASE_KINDS = ("email", "ip", "card", "phone")
ADDED_KINDS = ("national_id", "secret")
KINDS = BASE_KINDS + ADDED_KINDS

# Fixed patterns of the base kinds (email is found from its @ sign, see emails()).
LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
# Seed patterns that label training regions.
SEED_SECRET = re.compile(r"(?i)\b(?:password|passwd|token|secret|api_?key)\s?[=:]\s?[\"']?([0-9A-Za-z_-]{8,})")
SEED_ID = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")

INTERESTING = re.compile(r"[0-9@=]+")
WORD_END, NEXT_WORD = re.compile(r"\s|\Z"), re.compile(r"[^\S\n]+\S+")
TOKEN = re.compile(r"\w(?:[\w.@%+-]*\w)?|[^\w\s]")
MAX_TOKENS = 9
#: Documents and regions the field is fitted on, at most.
SAMPLE_DOCS, SAMPLE_REGIONS, REGIONS_PER_DOC = 600, 800, 4
#: Longer regions are not fitted on; none is cut, and all are searched.
SAMPLE_REGION_CHARS = 2000

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, ch in enumerate(reversed(digits)):
        d = ord(ch) - 48
        if i % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def emails(text: str) -> list[Span]:
    """Leftmost addresses: the local part is the run of its characters before
    an @ sign, back to the last address."""
    out, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL_CHARS:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append(("email", start, m.end()))
            end = m.end()
        at = text.find("@", at + 1)
    return out


def base_spans(text: str) -> list[Span]:
    """Spans of the base kinds by kind, then start."""
    out = emails(text)
    out += [("ip", *m.span()) for m in IP.finditer(text)
            if all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) < 256 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 13 and 13 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return out


def regions(text: str) -> list[tuple[int, int]]:
    """Stretches around digits, @ and = signs that lie close together, from
    two words before to the end of the word, and to that of the next one
    after = or :.  Words are never cut.  Outside them nothing can be a candidate."""
    out: list[list[int]] = []
    for m in INTERESTING.finditer(text):
        if out and m.start() - out[-1][1] <= 12 and "\n" not in text[out[-1][1]:m.start()]:
            out[-1][1] = m.end()
        else:
            out.append([m.start(), m.end()])
    found: list[tuple[int, int]] = []
    for first, b in out:
        floor, a, words = found[-1][1] if found else 0, first, 0
        if b <= floor:
            continue
        while a > floor and not text[a - 1].isspace():
            a -= 1
        least = max(floor, a - 40)
        while a > least and words < 3:
            a -= 1
            words += text[a].isspace()
        while words < 3 and a > floor and not text[a - 1].isspace():
            a -= 1
        b = WORD_END.search(text, b).start()
        while text[first:b].rstrip("\"'([")[-1:] in ("=", ":") and (m := NEXT_WORD.match(text, b)):
            b = m.end()
        if first < floor:  # starts in the last word of the one before
            found[-1] = (found[-1][0], b)
        else:
            found.append((a, b))
    return found


SHAPES = [(re.compile(r"[0-9]+"), "9"), (re.compile(r"[^\W\d_]+"), "a"), (re.compile(r"\s+"), " ")]


def shape(s: str) -> str:
    for pattern, to in SHAPES:
        s = pattern.sub(to, s)
    return s[:24]


def segment_features(span: str, before: str, n_tokens: int) -> list[str]:
    """Features of a whole candidate segment."""
    digits, letters = _digits(span), sum(c.isalpha() for c in span)
    parts = span.split(".")
    out = ["bias", f"shape={shape(span)}", f"digits={min(len(digits), 20)}", f"tokens={n_tokens}", f"before={before}"]
    if "@" in span:
        out.append("at=" + ("address" if DOMAIN.fullmatch(span.rpartition("@")[2]) and span.count("@") == 1 else "other"))
    if len(parts) == 4 and all(p.isdigit() and len(p) < 4 and int(p) < 256 for p in parts):
        out.append("octets")
    if not letters and 13 <= len(digits) <= 19:
        out.append(f"checksum={luhn(digits)}")
    if not letters and 9 <= len(digits) <= 15:
        out.append("dialable=" + ("+" if span[0] == "+" else "grouped" if len(digits) < len(span) else "plain"))
    if span.isalnum() and len(span) >= 8:
        out.append(f"mixed={bool(digits) and letters > 0}")
    return out


def candidates(text: str) -> list[tuple[int, int, int, int, list[str]]]:
    """Candidate segments of a region: first and last token, start, end, features."""
    tokens = [(m.start(), m.end()) for m in TOKEN.finditer(text)]
    out = []
    for i, (a, _) in enumerate(tokens):
        if not (text[a].isalnum() or text[a] in "+("):
            continue
        back = [text[x:y].lower() for x, y in tokens[max(0, i - 3):i]]
        cue = [w for w in back if w not in "\"'("][-2:]
        before = " ".join("#" if any(c.isdigit() for c in w) else w if len(w) > 1 or w in "=:#+-/" else "." for w in cue[-2:]
                          if cue and cue[-1] in ("=", ":")) or ("#" if cue and cue[-1][-1:].isdigit() else cue[-1] if cue and cue[-1] in "+-/=:" else "word")
        signal = False
        for j in range(i, min(i + MAX_TOKENS, len(tokens))):
            b = tokens[j][1]
            piece = text[tokens[j][0]:b]
            if j > i and piece[0].isalpha():
                break  # several tokens only for numbers
            signal |= any(c in "0123456789@" for c in piece) or ("=" in before and len(piece) >= 8)
            if signal and text[b - 1].isalnum() and "\n" not in text[a:b]:
                out.append((i, j, a, b, segment_features(text[a:b], before, j - i + 1)))
    return out


class Field:
    """Weights of a semi-Markov random field: feature and kind to a number."""

    def __init__(self) -> None:
        self.weights: dict[str, list[float]] = {}

    def scores(self, feats: list[str]) -> list[float]:
        total = [0.0] * len(KINDS)
        for f in feats:
            w = self.weights.get(f)
            if w:
                for k in range(len(KINDS)):
                    total[k] += w[k]
        return total

    def decode(self, text: str) -> list[Span]:
        """The best segmentation of a region; tokens outside entities score 0."""
        found = candidates(text)
        n = max((c[1] for c in found), default=-1) + 1
        ending: dict[int, list] = defaultdict(list)
        for i, j, a, b, feats in found:
            s = self.scores(feats)
            k = max(range(len(KINDS)), key=s.__getitem__)
            if s[k] > 0:
                ending[j].append((i, s[k], (KINDS[k], a, b)))
        best, step = [0.0] * (n + 1), [None] * (n + 1)
        for j in range(n):
            best[j + 1], step[j + 1] = best[j], None
            for i, s, span in ending.get(j, ()):
                if best[i] + s > best[j + 1]:
                    best[j + 1], step[j + 1] = best[i] + s, (i, span)
        out, j = [], n
        while j > 0:
            if step[j]:
                out.append(step[j][1])
                j = step[j][0]
            else:
                j -= 1
        return out[::-1]


def _log_add(values: list[float]) -> float:
    top = max(values)
    return top + math.log(sum(math.exp(v - top) for v in values))


def fit_field(data: list[tuple[str, list[Span]]], epochs: int = 6, rate: float = 0.3, decay: float = 1e-4) -> Field:
    """Maximum likelihood by stochastic steps; expectations come from the
    forward and backward sums over all segmentations of a region."""
    field, order, dice = Field(), [], random.Random(7)
    for text, spans in data:
        found = candidates(text)
        where = {(a, b): x for x, (_, _, a, b, _) in enumerate(found)}
        gold = {where[a, b]: KINDS.index(k) for k, a, b in spans if (a, b) in where}
        n = max((c[1] for c in found), default=-1) + 1
        if n:
            order.append((found, gold, n))
    for epoch in range(epochs):
        dice.shuffle(order)
        step = rate / (1 + epoch)
        for found, gold, n in order:
            s = [field.scores(c[4]) for c in found]
            into, out_of = defaultdict(list), defaultdict(list)
            for x, c in enumerate(found):
                total = _log_add(s[x])
                into[c[1] + 1].append((c[0], total))
                out_of[c[0]].append((c[1] + 1, total))
            ahead = [0.0] * (n + 1)
            for j in range(1, n + 1):
                ahead[j] = _log_add([ahead[j - 1], *(ahead[i] + v for i, v in into[j])])
            back = [0.0] * (n + 1)
            for i in range(n - 1, -1, -1):
                back[i] = _log_add([back[i + 1], *(back[j] + v for j, v in out_of[i])])
            for x, (i, j, _, _, feats) in enumerate(found):
                push = [-math.exp(min(0.0, ahead[i] + v + back[j + 1] - ahead[n])) for v in s[x]]
                if x in gold:
                    push[gold[x]] += 1
                if max(map(abs, push)) < 1e-4:
                    continue
                for f in feats:
                    w = field.weights.setdefault(f, [0.0] * len(KINDS))
                    for k, g in enumerate(push):
                        w[k] += step * (g - decay * w[k])
    return field


def label_region(text: str) -> list[Span]:
    """Training labels of a region: base spans, then seeds that do not overlap them."""
    spans = base_spans(text)
    for kind, pattern, group in (("secret", SEED_SECRET, 1), ("national_id", SEED_ID, 0)):
        for m in pattern.finditer(text):
            if all(m.end(group) <= a or b <= m.start(group) for _, a, b in spans):
                spans.append((kind, *m.span(group)))
    return spans


def variants(seed: int = 11, n: int = 60) -> list[tuple[str, list[Span]]]:
    """Regions made by rule: forms the base patterns do not have, and numbers that are not personal."""
    dice, out = random.Random(seed), []
    d = lambda k: "".join(dice.choice("0123456789") for _ in range(k))
    for _ in range(n):
        before = dice.choice(["the only ", "call ", "at ", "and then "])
        for number in (f"({dice.randint(2, 9)}{d(2)}) {d(3)}-{d(4)}", f"{dice.randint(2, 9)}{d(2)}-{d(3)}-{d(4)}",
                       f"{dice.randint(2, 9)}{d(2)}.{d(3)}.{d(4)}"):
            at = len(before)
            out.append((before + number, [("phone", at, at + len(number))]))
        number = f"{d(3)}-{d(2)}-{d(4)}"
        out.append((before + number, [("national_id", len(before), len(before) + len(number))]))
        cue = dice.choice(["password=", "token = \"", "secret: ", "api_key="])
        value = "".join(dice.choice("0123456789abcdef") for _ in range(dice.choice((12, 16, 24, 32))))
        out.append((before + cue + value, [("secret", len(before + cue), len(before + cue + value))]))
        for number in (f"20{d(2)}-0{dice.randint(1, 9)}-1{d(1)}", f"{dice.randint(1, 99)}", f"{d(1)}.{d(2)}", f"{d(4)}", f"{d(7)}",
                       f"{d(1)}.{d(1)}.{d(2)}", f"1{d(1)}:{d(2)}:{d(2)}", f"{d(2)} {d(3)} {d(3)}", f"{d(9)}", f"{d(10)}",
                       f"{d(4)}-{d(4)}", f"item={d(3)}", f"page=2 of {d(2)}", f"{d(12)}", f"{d(2)}%", f"v{d(1)}.{d(1)}", f"(19{d(2)})",
                       f"x={d(8)}", f"30{d(1)}.{d(3)}.2{d(2)}.{d(1)}00", f"{d(3)},{d(3)},{d(3)}", f"abc{d(6)}def{d(3)}"):
            out.append((before + number, []))
    return out


def fit(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", sample_docs: int = SAMPLE_DOCS,
        sample_regions: int = SAMPLE_REGIONS) -> Field:
    """Fit the field on regions of the ``sample_docs`` documents with the
    smallest hashed ids among those that have digits or signs; without any,
    on the variants alone.  Regions of over SAMPLE_REGION_CHARS characters
    are not fitted on; the others are taken whole."""
    ship_package(docs.sparkSession)
    some = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).filter("id is not null") \
        .filter(F.col("text").rlike("[0-9@=]"))
    ids = some.select("id").distinct().orderBy(F.xxhash64("id"), "id").limit(sample_docs)

    def cut_out(batches):
        for b in batches:
            ids, at = [], []
            for i, t in zip(b.column("id"), b.column("text")):
                s = t.as_py()
                part = [s[x:y] for x, y in regions(s) if y - x <= SAMPLE_REGION_CHARS][:REGIONS_PER_DOC]
                ids += [i] * len(part)
                at += part
            yield pa.RecordBatch.from_arrays([pa.array(ids, b.column("id").type), pa.array(at, pa.string())], ["id", "region"])
    kind = dict(some.dtypes)["id"]
    found = some.join(F.broadcast(ids), "id").mapInArrow(cut_out, f"id {kind}, region string") \
        .orderBy(F.xxhash64("region"), "region").limit(sample_regions).select("region").collect()
    return fit_field([(r[0], label_region(r[0])) for r in found] + variants())


def added_spans(text: str, base: list[Span], field: Field) -> list[Span]:
    """Spans the field finds that do not overlap a base span, by kind, then start."""
    taken, out = sorted((a, b) for _, a, b in base), []
    for x, y in regions(text):
        for kind, a, b in field.decode(text[x:y]):
            if not any(a + x < e and s < b + x for s, e in taken):
                out.append((kind, a + x, b + x))
    return sorted(out, key=lambda s: (KINDS.index(s[0]), s[1]))


SPANS = "array<struct<kind:string,start:int,end:int>>"
_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])


def _span_udf(f: Callable[[str], tuple[list[Span], list[Span]]]):
    @F.arrow_udf(f"struct<base:{SPANS},added:{SPANS}>")
    def find(texts: pa.Array) -> pa.Array:
        both = [f(t.as_py() or "") for t in texts]
        cols = [pa.array([[dict(zip(("kind", "start", "end"), s)) for s in row[i]] for row in both], pa.list_(_SPAN))
                for i in range(2)]
        return pa.StructArray.from_arrays(cols, ["base", "added"])
    return find


def find_pii(docs: DataFrame, field: Field, *, text: str = "text") -> DataFrame:
    """The input rows with ``base`` and ``spans``: arrays of kind, start and
    end (code points, end exclusive) by kind as listed in KINDS, then start.
    ``spans`` has the base spans and those the method adds.

    A null or empty text has none.  An input column with the name of an
    output column is replaced.
    """
    ship_package(docs.sparkSession)

    def both(t: str) -> tuple[list[Span], list[Span]]:
        base = base_spans(t)
        added = added_spans(t, base, field)
        return base, sorted(base + added, key=lambda s: (KINDS.index(s[0]), s[1]))

    rest = docs.drop(*(set(docs.columns) & {"base", "spans"}))
    return rest.withColumn("_pl_found", _span_udf(both)(F.col(text))) \
        .select(*rest.columns, F.col("_pl_found.base").alias("base"), F.col("_pl_found.added").alias("spans"))


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def count_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def redact(docs: DataFrame, field: Field, *, text: str = "text") -> DataFrame:
    """The input rows with every span replaced by its kind in angle brackets;
    overlapping spans are replaced as one, under the first one's kind.  A
    null text stays null."""
    ship_package(docs.sparkSession)

    def clean(t: str) -> str:
        base = base_spans(t)
        out, end = [], 0
        for kind, a, b in sorted(base + added_spans(t, base, field), key=lambda s: (s[1], -s[2])):
            if a >= end:
                out += [t[end:a], f"<{kind}>"]
            end = max(end, b)
        return "".join(out) + t[end:]

    @F.arrow_udf("string")
    def replace(texts: pa.Array) -> pa.Array:
        return pa.array([None if t is None else clean(t) for t in texts.to_pylist()], pa.string())
    return docs.withColumn(text, replace(F.col(text)))
