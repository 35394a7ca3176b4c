"""Line dedup, ranked lexical search and the Merkle manifest against brute force, and odd input."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from plait.llm import lexical, lines, manifest

#: Documents with extra columns whose names clash with the operators' own.
DOCS = "doc_id long, text string, lang string, source string, n_chars long, body string, keep string, path string, rank int, g string"


def table(spark, rows):
    return spark.createDataFrame([(i, t, la, s, n, "x", "y", "z", 1, "w") for i, t, la, s, n in rows], DOCS)


def row(i, text, lang="en", source="a"):
    return i, text, lang, source, len(text or "")


LONG = "This line is a common passage of more than forty characters"
ODD = [row(1, None), row(2, ""), row(3, "\n\n"), row(4, "one"), row(4, "one"), row(None, "one two", None, None), row(None, "three", None),
       row(5, "x" * 30000), row(6, "\n".join([LONG, "short", LONG.upper() + "\t"])), row(-7, "é ß 😀 Ünï É", "dé", None)]


def random_docs(seed, n):
    dice = random.Random(seed)
    passages = [" ".join(dice.choice("alpha beta gamma delta épsilon zeta".split()) for _ in range(12)) for _ in range(9)]
    out = []
    for i in range(n):
        body = [dice.choice(passages) if dice.random() < 0.4 else f"own line {i} {dice.random()} of some length or other" for _ in range(dice.randint(0, 90))]
        out.append(row(dice.choice([i, i * 1000, -i]), "\n".join(dice.choice([x, x.upper(), f" {x}\t"]) for x in body), dice.choice(["en", "fr", None])))
    return out


def kept_lines(rows, least=40, documents=5):
    def key(line):
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))
    held = defaultdict(set)
    for i, t, *_ in rows:
        for line in (t or "").split("\n"):
            held[key(line)].add(i)
    out = []
    for i, t, *_ in rows:
        body = (t or "").split("\n")
        stay = [x for x in body if len(key(x)) < least or len(held[key(x)]) < documents
                or i == max(held[key(x)], key=lambda d: (d is not None, d or 0))]
        out.append((str(i), len(body), len(body) - len(stay), "\n".join(stay)))
    return sorted(out)


@pytest.mark.parametrize("rows", [ODD, random_docs(1, 60) + ODD, [row(i, LONG + f"\nown {i}") for i in range(300)] + ODD, []])
def test_line_dedup_equals_brute_force(spark, rows):
    docs = table(spark, rows)
    got = lines.apply_bitmaps(docs, lines.keep_bitmaps(docs)).collect()
    assert sorted((str(r.doc_id), r.n_lines, r.n_dropped, r.kept_text) for r in got) == kept_lines(rows)


def test_keep_bitmaps_list_only_words_that_lose_lines(spark):
    rows = [row(i, "\n".join([f"own line {i} {k} that is long enough to be a key of its own" for k in range(200)] + [LONG])) for i in range(6)]
    got = lines.keep_bitmaps(table(spark, rows)).collect()
    assert sorted(r.doc_id for r in got) == [0, 1, 2, 3, 4]
    assert all([(w.word, w.bits) for w in r.keep] == [(3, ~(1 << 8))] and r.n_dropped == 1 for r in got)


def terms(text):
    return ["".join(c.lower() if "A" <= c <= "Z" else c for c in t)
            for t in re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text or "")]


def ranking(docs, items, k):
    held = [(i, Counter(terms(t))) for i, t, *_ in docs]
    held = [(i, c) for i, c in held if c]
    n_docs, n_terms = len(held), sum(c.total() for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        found = []
        for i, c in held:
            m = 75 + (25 * c.total() * n_docs) // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10 ** 9 * c[t]) // (1000 * c[t] + 12 * m))
                        for t in terms(text) if t in c)
            if score > 0:
                found.append((-score, i is None, i))
        found.sort(key=lambda f: (f[0], f[1], f[2] or 0))
        out += [(str(item), r + 1, str(i), -s) for r, (s, _, i) in enumerate(found[:k])]
    return sorted(out)


def lexical_docs(seed, n):
    dice = random.Random(seed)
    words = [f"W{int(dice.paretovariate(0.7)) % 400}é" for _ in range(4000)]
    docs = [row(i, ", ".join(dice.choice(words) for _ in range(dice.randint(0, 60)))) for i in range(n)]
    docs += [row(1000 + i, docs[3][1]) for i in range(40)]  # ties
    items = [(j, "_".join(dice.choice(words) for _ in range(dice.randint(1, 30)))) for j in range(25)]
    return docs, items + [(None, "one"), (90, None), (91, ""), (92, "--"), (93, "absent"), (3, "w1é w1é"), (3, "w1é w1é")]


@pytest.mark.parametrize("k", [1, 20])
def test_ranked_search_equals_brute_force(spark, monkeypatch, k):
    monkeypatch.setattr(lexical, "SEEDS", 30)
    monkeypatch.setattr(lexical, "ITEMS", 20)  # more than one block of items
    docs, items = lexical_docs(4, 500)
    docs = docs + ODD
    asked = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, doc_id string")
    got = lexical.ranked_search(table(spark, docs), asked, k=k).collect()
    assert sorted((str(r.item_id), r["rank"], str(r.doc_id), r.score) for r in got) == ranking(docs, items, k)


def test_ranked_search_of_empty_tables(spark):
    items = spark.createDataFrame([(1, "one")], "item_id long, text string")
    assert lexical.ranked_search(table(spark, []), items).collect() == []
    assert lexical.ranked_search(table(spark, ODD), items.limit(0)).collect() == []
    assert lexical.ranked_search(table(spark, [row(1, None), row(2, "  ")]), items).collect() == []


def test_buckets_and_coordinates_prune(spark):
    """With a threshold known, short vectors are skipped and few survivors are scored."""
    import numpy as np
    weights = np.array([9000, 10, 10], np.int64)
    items = lexical.Items([Counter({b"a": 1, b"b": 1, b"c": 1})], {b"a": 0, b"b": 1, b"c": 2}, weights)
    best = lexical.Best(1, [5_000_000])
    n = 50
    length = np.full(n, 3000.0)
    assert lexical.search_bucket(items, best, np.arange(n), np.zeros(n, bool), length, np.arange(n), np.ones(n, int), np.full(n, 9000)) == 0
    length = np.sqrt(np.where(np.arange(n) == 7, 9000 * 900.0 ** 2, 10 * 900.0 ** 2))
    impact = np.where(np.arange(n) == 7, 9000 * 900, 10 * 900)
    scored = lexical.search_bucket(items, best, np.arange(n), np.zeros(n, bool), length, np.arange(n), np.where(np.arange(n) == 7, 0, 1), impact)
    assert scored == 1 and best.doc[0].tolist() == [7] and best.score[0].tolist() == [9000 * 900]


def test_long_text_is_counted_in_pieces(monkeypatch):
    monkeypatch.setattr(lexical, "PIECE", 7)
    text = "Alpha beta-GAMMA élan; alpha 12x " * 20
    assert lexical.term_counts(text.encode()) == Counter(t.encode() for t in terms(text))


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def grow(nodes):
    """All levels of a tree."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i:i + 2]) for i in range(0, len(levels[-1]), 2)])
    return levels


def climb(levels, at):
    out = []
    for level in levels[:-1]:
        out.append((at % 2 == 1, level[at ^ 1] if (at ^ 1) < len(level) else None))
        at //= 2
    return out


def merkle(rows):
    groups = defaultdict(list)
    for i, t, la, s, n in rows:
        leaf = h(*(field(v) for v in (i, s, la, n, t)))
        odd = i is not None and zlib.crc32(str(i).encode()) % 7 == 0
        groups[la].append((i is not None, i or 0, leaf, h(*(field(v) for v in (i, s, la, None if n is None else n + 1, t))) if odd else leaf, i))
    langs = sorted(groups, key=lambda la: (la is not None, (la or "").encode()))
    trees = {la: grow([r[2] for r in sorted(groups[la])]) for la in langs}
    crown = grow([trees[la][-1][0] for la in langs])
    out = []
    for g, la in enumerate(langs):
        for at, (_, _, leaf, start, i) in enumerate(sorted(groups[la])):
            path = climb(trees[la], at) + climb(crown, g)
            node = start
            for left, s in path:
                node = h(*([node] if s is None else [s, node] if left else [node, s]))
            out.append((str(i), leaf, trees[la][-1][0], crown[-1][0], h(*(s for _, s in path if s)), node, node == crown[-1][0]))
    return sorted(out)


def merkle_rows(spark, rows):
    got = manifest.proofs(manifest.manifest(table(spark, rows))).collect()
    return sorted((str(r.doc_id), r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified) for r in got)


MANY = [row(i * 37 - 5000, f"text {i}", ["en", "fr", None, ""][(i * i) % 4 if i % 3 else 0], str(i)) for i in range(1500)]


@pytest.mark.parametrize("rows", [[row(9, "a")], [row(i, str(i)) for i in range(257)], MANY,
                                  [(i, t, la, None, None) for i, t, la, *_ in MANY[:40]],
                                  [row(i << 40, "wide") for i in range(-3, 30)] + [row(2 ** 63 - 1, "last"), row(-2 ** 63, "first")]])
def test_manifest_equals_brute_force(spark, rows):
    got = merkle_rows(spark, rows)
    assert got == merkle(rows)


def test_manifest_with_repeated_and_missing_ids(spark):
    rows = ODD + [row(4, "other"), row(4, "one")] + [row(None, f"n{i}") for i in range(5)] + [row(64 + i % 9, f"r{i % 4}") for i in range(60)]
    got, expected = merkle_rows(spark, rows), merkle(rows)
    # rows that are equal in every field may take each other's place
    assert [r[:4] for r in got] == [r[:4] for r in expected]
    assert got == expected
    assert merkle_rows(spark, []) == []


def test_tampered_rows_fail(spark):
    got = manifest.proofs(manifest.manifest(table(spark, MANY))).collect()
    assert all(r.verified == (zlib.crc32(str(r.doc_id).encode()) % 7 != 0) for r in got)
    assert {r.verified for r in got} == {True, False}
