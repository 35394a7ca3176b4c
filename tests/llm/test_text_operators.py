"""Operators over documents: brute force on small tables, and odd input."""

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from plait.llm import decontaminate, mixing, pii, quality, repeats, simhash, toxicity
from plait.llm.components import components

DOCS = "doc_id long, text string, lang string, source string, n_chars long, fp string, k1 string, size string, base string"


def docs(spark, rows):
    """Documents with extra columns whose names clash with the operators' own."""
    return spark.createDataFrame([(i, t, "en", s, len(t or ""), "x", "y", "z", "b") for i, t, s in rows], DOCS)


def prose(seed, n):
    dice = random.Random(seed)
    return " ".join(dice.choice("alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi".split())
                    + str(dice.randint(0, 40)) for _ in range(n))


ODD = [(1, None, None), (2, "", "a"), (3, " \t\n", "a"), (4, "one", "b"), (4, "one", "b"), (None, "one two", None),
       (5, "x" * 30000, "b"), (6, prose(1, 4000), "b"), (7, prose(1, 4000), "a"), (8, "a b é 😀 <p> & >", "c")]


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] if len(words) > 2 else [b" ".join(words)] * bool(words)
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash_components_equal_brute_force(spark):
    base = prose(3, 300).split()
    rows = list(ODD) + [(20, " ".join(base), "a"), (21, " ".join(base[:-1]), "a"), (22, " ".join(base).upper(), "a")]
    got = simhash.near_duplicates(docs(spark, rows)).collect()
    prints = {t: plain_fingerprint(t) for _, t, _ in rows}
    assert sorted((str(r.doc_id), r.fp & (2 ** 64 - 1)) for r in got) == sorted((str(i), prints[t]) for i, t, _ in rows)
    near = {t: {u for u in prints if (prints[t] ^ prints[u]).bit_count() <= 3} for t in prints}
    for text in prints:  # closure
        seen, todo = {text}, [text]
        while todo:
            new = near[todo.pop()] - seen
            seen |= new
            todo += new
        low = min((i for i, t, _ in rows if t in seen and i is not None), default=None)
        assert {r.component_id for r in got if r.fp & (2 ** 64 - 1) == prints[text]} == {low}


def test_links_under_large_entries_keep_components(spark):
    dice = random.Random(5)
    center = dice.getrandbits(64)
    fps = {center}
    while len(fps) < 400:
        fps.add(center ^ sum(1 << b for b in dice.sample(range(40), dice.randint(1, 4))))
    signed = [int(np.uint64(f).astype(np.int64)) for f in fps]
    got = components(simhash.links(spark.createDataFrame([(f,) for f in signed], "fp long")), "a", "b").collect()
    groups = {}
    for r in got:
        groups.setdefault(r.root, set()).add(r.node)
    values, expected = set(signed), []
    while values:
        todo = [values.pop()]
        seen = set(todo)
        while todo:
            x = todo.pop()
            new = {y for y in values if ((x ^ y) & (2 ** 64 - 1)).bit_count() <= 3}
            values -= new
            seen |= new
            todo += new
        if len(seen) > 1:
            expected.append(frozenset(seen))
    assert set(map(frozenset, groups.values())) == set(expected)


def test_components_of_a_long_chain(spark):
    chain = spark.range(400).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    got = components(chain, "a", "b")
    assert got.count() == 401 and got.agg(F.max("root")).first()[0] == 0


def test_drop_near_duplicates_keeps_one_of_each(spark):
    kept = simhash.drop_near_duplicates(docs(spark, ODD))
    assert kept.columns == DOCS.replace(" long", "").replace(" string", "").split(", ")
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == [1, 4, 5, 6, 8]


def test_drop_near_duplicates_goes_by_texts_where_ids_repeat(spark):
    a, b, c, d = (prose(s, 200) for s in (11, 12, 13, 14))
    rows = [(6, a, "a"), (6, b, "a"), (2, c, "a"), (4, c + " end", "a"), (4, d, "a"), (4, d, "a"), (None, a, "b"), (None, prose(15, 200), "b"),
            (None, prose(15, 200), "c")]
    kept = simhash.drop_near_duplicates(docs(spark, rows))
    assert sorted((str(r.doc_id), r.text) for r in kept.collect()) == sorted([("6", a), ("6", b), ("2", c), ("4", d), ("None", prose(15, 200))])
    assert simhash.drop_near_duplicates(docs(spark, [])).count() == 0


@pytest.mark.parametrize("window", [5, 14])
def test_repeats_equal_brute_force(spark, window):
    shared, dice = prose(9, 60).split(), random.Random(2)
    rows = list(ODD)
    for i in range(30):
        own = prose(100 + i, dice.randint(0, 60)).split()
        a = dice.randint(0, 50)
        own[len(own) // 2:len(own) // 2] = shared[a:a + dice.randint(0, 50)]
        rows.append((100 + i, " ".join(own), "a"))
    rows.append((200, " ".join(shared[:20] * 3), "a"))
    keyed = docs(spark, rows).select(F.xxhash64("text").alias("k1"), F.hash("text").alias("k2"), "text")
    got = repeats.duplicate_spans(keyed, window).collect()
    covered = {r.k1: {q for s in r.spans for q in range(s.start, s.end)} for r in got}
    keys = {r.text: r.k for r in docs(spark, rows).select("text", F.xxhash64("text").alias("k")).collect()}
    for (n, gone, _), (_, t, _) in zip(repeats.remove_repeats_plain([t for _, t, _ in rows], window), rows):
        assert len(covered.get(keys[t], ())) == gone, t


def _shared_pieces(spark):
    """Texts around parts of one passage, so that most pieces of a name differ."""
    shared, dice = prose(9, 40).split(), random.Random(5)
    rows = [(i, " ".join(prose(300 + i, 8).split() + shared[dice.randint(0, 12):dice.randint(24, 40)] + prose(400 + i, 8).split()), "a")
            for i in range(40)]
    return rows, docs(spark, rows + ODD)


@pytest.mark.parametrize("crowded, batch", [(1024, 10000), (1024, 3), (2, 10000), (0, 10)])
def test_factors_equal_brute_force(spark, monkeypatch, crowded, batch):
    monkeypatch.setattr(repeats, "CROWDED", crowded)
    rows, table = _shared_pieces(spark)
    size = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(size)
    spark.conf.set(size, str(batch))
    try:
        got = {(r.doc_id, r.text): r for r in repeats.remove_repeats(table, window=12).collect()}
    finally:
        spark.conf.set(size, before)
    wanted = repeats.remove_repeats_plain([t for _, t, _ in rows + ODD], 12)
    assert sum(gone for _, gone, _ in wanted) > 500
    for (n, gone, digest), (i, t, _) in zip(wanted, rows + ODD):
        r = got[i, t]
        assert (r.n_words, r.n_removed, hashlib.sha256(r.kept_text.encode()).hexdigest()) == (n, gone, digest)


def test_a_factor_is_the_longest_stretch_of_any_reference_block():
    dice = np.random.default_rng(3)
    count, width = 60, 9
    block = np.sort(dice.integers(0, 6, count))
    hashes = dice.integers(0, 2, (count, width)).astype(np.uint64)
    first, last = dice.integers(0, 4, count), dice.integers(5, width + 1, count)
    there = (np.arange(width) >= first[:, None]) & (np.arange(width) < last[:, None])
    got = repeats.longest(block, hashes, there)
    for r in range(count):
        others = [o for o in range(count) if o != r and block[o] == block[r]]
        for c in range(width):
            best = 0
            for o in others:
                k = c
                while k < width and there[r, k] and there[o, k] and hashes[r, k] == hashes[o, k]:
                    k += 1
                best = max(best, k - c)
            assert got[r, c] == best
    parsed = {}
    for at, place, length in repeats.greedy(got):
        for r, c, k in zip(at.tolist(), place.tolist(), length.tolist()):
            parsed.setdefault(r, []).append((c, k))
    for r in range(count):
        c, wanted = 0, []
        while c < width:
            if got[r, c]:
                wanted.append((c, int(got[r, c])))
            c += max(int(got[r, c]), 1)
        assert parsed.get(r, []) == wanted


def test_remove_repeats_rows(spark):
    out = {(r.doc_id, r.source): r for r in repeats.remove_repeats(docs(spark, ODD)).collect()}
    assert out[6, "b"].n_removed == out[6, "b"].n_words == 4000 and out[7, "a"].kept_text == ""
    assert out[1, None].n_words == 0 and out[1, None].kept_text == ""
    assert repeats.remove_repeats(docs(spark, [])).count() == 0


def test_quality_measures_equal_brute_force(spark):
    rows = ODD + [(30, "a b c a b c\nq\nq\n \nq # $", "a"), (31, " ".join(["w x y z"] * 40), "b"), (32, "a a a a", "b")]
    for r in quality.judge(docs(spark, rows), sample_rows=10).collect():
        words = (r.text or "").encode().split()
        grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
        covered = {q for i, g in enumerate(grams) if grams.count(g) > 1 for q in (i, i + 1, i + 2)} if len(grams) < 500 else None
        lines = [x for x in (r.text or "").split("\n") if x.encode().split()]
        assert r.n_words == len(words) and r.n_dup_lines == len(lines) - len(set(lines))
        assert r.word_chars == sum(len(w.decode()) for w in words)
        if covered is not None:
            assert r.n_repeat_words == len(covered)
            assert r.base_failed == (len(words) < 50 or 2 * len(covered) > len(words))
        assert r.kept == (r.rejected_by is None)
    assert quality.judge(docs(spark, [])).count() == 0


def test_quality_verdict_does_not_depend_on_the_order(spark):
    rows = [(i, t * 60, "a") for i, t in enumerate(["word here ", "### $$ ", "LOUD! ", "1 2 3 "])]
    measured = quality.measures(docs(spark, rows))
    checks = quality.rules()
    names = list(checks)
    first, second = (measured.select("doc_id", quality.cascade(o, checks).isNull().alias("k")).collect() for o in (names, names[::-1]))
    assert sorted(first) == sorted(second) == [(0, True), (1, False), (2, False), (3, False)]


def test_mixing_targets_and_copies(spark):
    rows = [(i, "w " * (i % 7 + 1), s) for i, s in enumerate(["a"] * 300 + ["b"] * 100 + ["c"] * 20 + [None] * 50)] + ODD
    plan = mixing.mixing_plan(docs(spark, rows)).collect()
    total = sum(r.size for r in plan)
    by = {r.source: (r.source_size, r.target) for r in plan}
    assert abs(sum(t for _, t in by.values()) - 1.5 * total) < 1e-6
    assert all(t <= 2 * s + 1e-9 for s, t in by.values()) and all(0 <= r.copies <= 2 for r in plan)
    open_ = {s: t for s, (n, t) in by.items() if t < 2 * n - 1e-9}
    weight = dict(zip(["a", "b", "c", None], (3, 1, 2, 3)))
    assert len({round(t / weight[s], 6) for s, t in open_.items()}) <= 1  # those below the ceiling share by weight
    assert sorted(map(str, plan)) == sorted(map(str, mixing.mixing_plan(docs(spark, rows).repartition(7)).collect()))
    assert mixing.mix(docs(spark, rows)).count() == sum(r.copies for r in plan)
    assert mixing.mix(docs(spark, [])).count() == 0


BASE_CASES = ["a@b.c x.y+z@mail-1.example.org. @no a@b a@b.c@d.e", "1.2.3.4 256.1.1.1 1.2.3.4.5 01.002.3.4",
              "4111 1111 1111 1111, 4111-1111-1111-1112, 42", "+1 (415) 555-2671 +12 +1-2.3 4 5 6 7 8 9",
              "é a.b@ü.com +49 30 123456, 79927398713; 5555555555554444", "9" * 5000 + "." + "1" * 5000]


def test_pii_base_and_added(spark):
    field = pii.fit(docs(spark, [(1, "no data", "a")]))
    rows = docs(spark, [(i, t, "a") for i, t in enumerate(BASE_CASES)] + ODD
                + [(90, "my secret token = \"0641917ea4e9feb9cda83477b57ac265\" is here", "a"),
                   (91, "please call (415) 555-2671 at noon", "a"), (92, "in 2024-05-17 we sold 31 of 4.50 each", "a")])
    got = {r.doc_id: r for r in pii.find_pii(rows, field).collect()}
    spans = {i: [(s.kind, r.text[s.start:s.end]) for s in r.base] for i, r in got.items() if i is not None and i < 6 and r.text in BASE_CASES}
    assert spans.get(0, [("email", "a@b.c")])[0] == ("email", "a@b.c")
    assert pii.base_spans(BASE_CASES[1]) == [("ip", 0, 7), ("ip", 18, 25), ("ip", 28, 38)]
    assert [k for k, *_ in pii.base_spans(BASE_CASES[2])] == ["card"]
    assert [k for k, *_ in pii.base_spans(BASE_CASES[3])] == ["phone", "phone"]
    assert [k for k, *_ in pii.base_spans(BASE_CASES[4])] == ["card", "phone"]
    assert pii.base_spans(BASE_CASES[5]) == []
    assert [s.kind for s in got[90].spans] == ["secret"] and [s.kind for s in got[91].spans] == ["phone"]
    assert got[92].spans == [] and got[1].base is not None
    masked = {r.doc_id: r.text for r in pii.redact(rows, field).collect()}
    assert masked[91] == "please call <phone> at noon" and masked[92] == got[92].text


LITERAL = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
           "card": r"[0-9](?:[\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def literal_spans(text):
    """Leftmost matches of the patterns as they are written, checked by their rules."""
    out = []
    for kind, pattern in LITERAL.items():
        for m in re.finditer(pattern, text):
            digits = [int(c) for c in m[0] if c.isdigit()]
            doubled = [x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(digits[::-1])]
            if {"email": True, "ip": all(int(x) <= 255 for x in m[0].split(".")) if kind == "ip" else True,
                    "card": 13 <= len(digits) <= 19 and sum(doubled) % 10 == 0, "phone": 9 <= len(digits) <= 15}[kind]:
                out.append((kind, *m.span()))
    return out


def test_pii_base_spans_equal_the_literal_patterns():
    dice = random.Random(8)
    parts = ["a@b.c", "x-1.y@", "@", ".", "-", "+", "+1", "(", ")", " ", "\n", "é", "_%", "255", "256", "0", "1.2.3.4", "4111", "1111", "79927398713",
             "5555 5555 5555 4444", "415", "555-26", "71", "word"]
    found = 0
    for _ in range(20000):
        text = "".join(dice.choice(parts) for _ in range(dice.randint(1, 14)))
        assert pii.base_spans(text) == literal_spans(text), text
        found += len(literal_spans(text))
    assert found > 5000


def test_pii_fits_on_whole_regions(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(pii, "fit_field", lambda made: seen.extend(t for t, _ in made))
    long = "token=" + "a1" * 200
    pii.fit(docs(spark, [(1, f"see {long} there", "a"), (2, "see " + "9" * 5000 + " and then, well after all of it, at 12:30 there", "a")]))
    assert any(long in t for t in seen) and any("12:30" in t for t in seen) and max(map(len, seen)) <= pii.SAMPLE_REGION_CHARS


def test_pii_field_finds_held_out_variants(spark):
    field = pii.fit_field(pii.variants(seed=1))
    right = sum(sorted(field.decode(t)) == sorted(s) for t, s in pii.variants(seed=99))
    assert right / len(pii.variants(seed=99)) > 0.97


def test_toxicity_chain(spark):
    dice = random.Random(3)
    rows, marks = list(ODD), []
    for i in range(100, 400):
        bad, junk = i % 5 == 0, i % 7 == 0
        words = prose(i, 40).split() + ["nastyword"] * bad + ["zzjunk"] * junk
        dice.shuffle(words)
        rows.append((i, " ".join(words), "a"))
        marks.append((i, int(junk), int(bad)))
    labels = spark.createDataFrame(marks + [(None, 1, 1), (1, None, 1), (100, 0, 1)], "doc_id long, junk int, toxic int")
    chain = toxicity.fit(docs(spark, rows), labels, ("junk", "toxic"))
    assert chain.f1[1] > 0.95
    got = {r.doc_id: r.is_toxic for r in toxicity.score(docs(spark, rows), chain).collect()}
    assert sum(got[i] == bool(t) for i, _, t in marks) / len(marks) > 0.97
    assert len(chain.weights[1]) == len(chain.weights[0]) + 1  # the later model reads the earlier probability
    kept = toxicity.drop_flagged(docs(spark, rows), chain, "toxic")
    assert kept.count() == len(rows) - sum(1 for i, t, _ in rows if got[i])
    none = toxicity.fit(docs(spark, rows), labels.limit(0), ("junk", "toxic"))
    assert toxicity.drop_flagged(docs(spark, rows), none, "toxic").count() == len(rows)


def test_toxicity_fit_does_not_depend_on_the_order_of_repeated_rows(spark):
    rows = [(i, prose(i, 20) + " nastyword" * (i % 3 == 0), "a") for i in range(90)]
    rows += [(i, prose(500 + i, 20), "b") for i in range(0, 90, 2)]
    marks = [(i, int(i % 3 == 0)) for i in range(90)] + [(i, int(i % 5 == 0)) for i in range(90)]
    first, second = (toxicity.fit(docs(spark, r), spark.createDataFrame(m, "doc_id long, toxic int").repartition(n), ("toxic",))
                     for r, m, n in ((rows, marks, 1), (rows[::-1], marks[::-1], 3)))
    assert first.vocabulary.keys() == second.vocabulary.keys() and first.f1 == pytest.approx(second.f1)
    for w, at in first.vocabulary.items():
        assert first.weights[0][at] == pytest.approx(second.weights[0][second.vocabulary[w]])


ITEM = "Tom has 12 apples and gives 5 apples to Ann, then Tom buys 12 kg of pears and walks 3 miles home with Ann."


def test_decontamination_templates(spark):
    again = ITEM.replace("Tom", "Bob").replace("Ann", "Sue").replace("12", "40").replace("5", "7").replace("3 miles", "9 miles")
    mixed = again.replace("40 kg", "41 kg")  # one number of the item stands for two
    rows = ODD + [(50, prose(1, 30) + "\n" + ITEM, "a"), (51, prose(2, 30) + " of it. " + again, "a"), (52, mixed, "a"),
                  (53, prose(4, 200), "a"), (50, prose(1, 30) + "\n" + ITEM, "a"), (54, ITEM + " " + prose(5, 9) + " or so. " + mixed, "a")]
    bench = spark.createDataFrame([(1, ITEM), (2, None), (3, "too short"), (None, ITEM)], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.kind for r in decontaminate.matches(docs(spark, rows), bench).collect()}
    assert got == {(50, 1): "exact", (51, 1): "reparameterised", (54, 1): "exact"}
    kept = decontaminate.decontaminate(docs(spark, rows), bench)
    assert kept.count() == len(rows) - 4
    assert decontaminate.matches(docs(spark, []), bench).count() == 0
    assert decontaminate.matches(docs(spark, rows), bench.limit(0)).count() == 0


DENSE = "Add 12 kg 7 kg 31 kg 5 kg 18 kg 44 kg and 3 kg 9 kg 26 kg 71 kg"
RECIPE = "Mix 3 kg 4 kg 5 kg flour with 6 kg 7 kg 8 kg sugar and 9 kg 2 kg 11 kg water for cold days"


def test_decontamination_goes_by_texts_where_ids_repeat_or_are_missing(spark):
    item = prose(70, 40)
    half, rest = " ".join(item.split()[:14]), " ".join(item.split()[14:27])
    clean = [prose(s, 50) for s in (71, 72, 73)]
    whole = clean[0] + " " + item
    rows = [(None, whole, "a"), (None, clean[1], "a"), (5, whole, "a"), (5, clean[2], "b"), (5, whole, "a"), (6, whole, "b"),
            (7, half[:-20] + " " + clean[1], "a"), (7, rest[20:] + " " + clean[2], "a"), (8, None, "a"), (9, "", "a")]
    bench = spark.createDataFrame([(1, item), (None, clean[1])], "item_id long, text string")
    found = decontaminate.matches(docs(spark, rows), bench).collect()
    assert sorted((r.doc_id, r.item_id, r.kind) for r in found) == [(5, 1, "exact"), (6, 1, "exact")]
    left = decontaminate.decontaminate(docs(spark, rows), bench).collect()
    assert sorted((str(r.doc_id), r.text or "") for r in left) == sorted((str(i), t or "") for i, t, _ in rows if t != whole)


def test_decontamination_keeps_dense_and_short_items(spark):
    rows = [(1, prose(1, 30) + " so " + DENSE, "a"), (2, "We said capital of this land is old", "a"), (3, prose(2, 60), "a"),
            (4, "sums 4 8 15 16 and more", "a"), (5, "sums 4 8 15 17 and more", "a"), (6, "he took 7 of the pears", "a"),
            (7, "We say " + RECIPE.translate(str.maketrans("23456789", "34567892")).replace("11 kg", "70 kg").replace("Mix", "mix"), "a")]
    bench = spark.createDataFrame([(1, DENSE), (2, "Capital of this land"), (3, "4 8 15 16"), (4, "took 5 of the pears"), (5, "?!"), (6, RECIPE)],
                                  "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.kind for r in decontaminate.matches(docs(spark, rows), bench).collect()}
    assert got == {(1, 1): "exact", (2, 2): "exact", (4, 3): "exact", (6, 4): "reparameterised", (7, 6): "reparameterised"}


def test_decontamination_finds_an_item_of_numbers_only(spark):
    item = "Work out 3 + 4 + 12 + 5 + 9 + 21 + 7 + 8 + 30 + 2 + 6 + 11 + 14 + 15 + 16 and 19"
    numbers = [w for w in item.split() if w.isdigit()]
    words = [str(40 + 3 * numbers.index(w)) if w.isdigit() else w for w in item.split()]
    rows = [(1, prose(1, 30) + ". " + " ".join(words) + " " + prose(2, 9), "a"), (2, prose(3, 20) + " " + item, "a"),
            (3, " ".join(words[:-4] + ["or", "not"]), "a"), (4, prose(4, 90), "a")]
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.kind for r in decontaminate.matches(docs(spark, rows), bench).collect()}
    assert got == {(1, 1): "reparameterised", (2, 1): "exact"}


def test_quality_rules_are_ordered_by_what_they_reject(spark):
    """Repeated lines reject half of what passes the base, so they do not go last."""
    same = "\n".join([prose(1, 12)] * 2 + [prose(i, 12) for i in range(2, 9)])
    dup = "\n".join(line for i in range(12) for line in [f"line {i} of it"] * 2 + [prose(40 + i, 6)])
    rows = [(i, dup if i % 2 else same + str(i), "a") for i in range(60)]
    checks = {"repeated_lines": quality.rules()["repeated_lines"], "never": F.length("text") < 0}
    judged = quality.judge(docs(spark, rows)).collect()
    assert {r.rejected_by for r in judged if not r.base_failed} == {None, "repeated_lines"} or any(r.n_dup_lines for r in judged if not r.base_failed)
    assert set(quality.order_rules(docs(spark, rows), checks)) == set(checks)


LONG_ITEM = ("Tom buys 12 apples at the old market near the river bridge where his aunt once sold fresh bread and honey, and after a "
             "long walk home he packs them in 12 boxes")


def test_decontamination_clash_discards_only_its_windows(spark):
    coincide = "the boy has 3 red apples and his sister has 5 green apples in the old basket"
    rows = [(1, LONG_ITEM.replace("12 boxes", "15 boxes"), "a"), (2, coincide.replace("3", "4").replace("5", "4"), "a"),
            (3, LONG_ITEM.replace("12 apples", "14 apples").replace("12 boxes", "15 boxes"), "a"), (4, LONG_ITEM, "a")]
    bench = spark.createDataFrame([(1, LONG_ITEM), (2, coincide)], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in decontaminate.matches(docs(spark, rows), bench).collect()}
    assert {k: r.kind for k, r in got.items()} == {(1, 1): "exact", (2, 2): "reparameterised", (3, 1): "exact", (4, 1): "exact"}
    assert got[4, 1].coverage == 1 and got[1, 1].coverage > 0.9 > got[3, 1].coverage > 0.5


def test_decontamination_finds_part_of_a_long_item(spark):
    words = [f"w{chr(97 + i // 20)}{chr(97 + i % 20)}" for i in range(400)]
    rows = [(1, "see " + " ".join(words[100:129]) + " there", "a"), (2, " ".join(words[50:62]), "a"),
            (3, " ".join(words[50:60] + ["other"] + words[60:70]), "a"), (4, " ".join(words), "a")]
    bench = spark.createDataFrame([(1, " ".join(words))], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.coverage for r in decontaminate.matches(docs(spark, rows), bench).collect()}
    assert got == {(1, 1): 22 / 393, (4, 1): 1.0}


def test_pii_regions_hold_whole_tokens():
    long = "7" + "abcdefghij" * 9
    cases = ["my token = \"ghp_abcdefghijkl1x9\" is here", "the password = correcthorse is old", f"key 12 = {long} end", "secret: ghp_abcdefghijklmnopqrst1x9 end",
             "x=1 and so on with nothing else until later 5 of them"]
    held = [[t[a:b] for a, b in pii.regions(t)] for t in cases]
    assert held[0] == ["my token = \"ghp_abcdefghijkl1x9\""] and held[1] == ["the password = correcthorse"]
    assert held[2] == [f"key 12 = {long}"] and held[3] == ["secret: ghp_abcdefghijklmnopqrst1x9"] and len(held[4]) == 2
    field = pii.fit_field(pii.variants(seed=1))
    assert "correcthorse" in [held[1][0][a:b] for _, _, a, b, _ in pii.candidates(held[1][0])]
    for t, secret in ((f"we set password={long}9 today", f"{long}9"), (f"we set password= {long} today", long)):
        assert secret in [t[a:b] for _, a, b in pii.added_spans(t, [], field)], t
