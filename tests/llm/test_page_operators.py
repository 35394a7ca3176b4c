"""Operators over pages and conversations."""

import itertools
import random

from pyspark.sql import functions as F

from plait.llm import html, quotes, urls

PAGE = ("<html><head><title>T</title><script>var t='</p><p>no';</script></head><body><header><a href=/>Home</a></header>"
        "<nav><ul><li><a href=/a>A</a><li><a href=/b>B</a></ul></nav><div class='cookie-notice'>We use cookies on this long page.</div>"
        "<article><h1>Title &amp; more</h1><p>First  paragraph\nof the <b>story</b>, it goes on.<br>And on.<p>Second one &eacute; here, with words."
        "<div class=ad>Buy this now, it is cheap and good.</div><form>Mail <input><button>Go</button></form></article>"
        "<aside>Other stories you may like to read.</aside><div id=comments><p>Reader says this is a fine article.</div>"
        "<footer>&copy; 2024 someone</footer></body></html>")


def test_main_text():
    assert html.main_text(PAGE) == ("Title & more\n\nFirst paragraph of the story, it goes on. And on.\n\n"
                                    "Second one é here, with words.")
    assert html.main_text(None) == html.main_text("") == html.main_text("<p>") == html.main_text("<!-- x") == ""
    bare = "<div><a href=x>One</a> <a href=y>Two</a></div><div><p>" + "A long sentence with many words. " * 8 + "</p></div>"
    assert html.main_text(bare).startswith("A long") and "Two" not in html.main_text(bare)


def test_names_are_hints_and_no_gate():
    text = "<p>" + "This is the first long paragraph of the article, with many words in it. " * 4 + "</p><p>And a second one that goes on for a while.</p>"
    plain = html.main_text(f"<body><nav><a href=/>Home</a></nav><div>{text}</div><footer>c</footer></body>")
    for shell in ("<div class='post has-comments'>%s</div>", "<div class='entry-content share-enabled'>%s</div>", "<div class='story header-fixed'>%s</div>",
                  "<div class='article-tags'>%s</div>", "<div class='content related-story'>%s</div>", "<div id='login-page'><main>%s</main></div>",
                  "<form id=aspnet><article>%s</article></form>"):
        assert html.main_text(f"<body><nav><a href=/>Home</a></nav>{shell % text}<footer>c</footer></body>") == plain != ""
    assert [b.text for b in html.blocks("<p>one <noscript>x</noscript>two<script>y</script> three</p>")] == ["one two three"]


def test_minimum_cut_is_optimal():
    dice = random.Random(4)
    for _ in range(200):
        n = dice.randint(1, 8)
        gain = [dice.uniform(-2, 2) for _ in range(n)]
        links = [(i, j, dice.uniform(0, 2)) for i in range(n) for j in range(i + 1, n) if dice.random() < 0.5]

        def cost(label):
            return sum(-g if k else 0 for g, k in zip(gain, label)) + sum(w for i, j, w in links if label[i] != label[j])
        best = min(map(cost, itertools.product((False, True), repeat=n)))
        assert abs(cost(html.minimum_cut(gain, links)) - best) < 1e-9


def test_extract_text_odd_rows(spark):
    rows = [(1, "u", PAGE, "old"), (1, "u", PAGE, "old"), (2, None, None, "x"), (None, "v", "", "x"), (3, "w", "<" * 5000, "x"),
            (4, "w", "<a \"" * 3000, None), (5, "w", "<p>" + "word " * 50000, "y")]
    out = html.extract_text(spark.createDataFrame(rows, "page_id long, url string, html string, text string")).collect()
    assert len(out) == len(rows) and all(r.text is not None for r in out)
    assert html.extract_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]


def test_url_rules_and_templates(spark):
    rows = [(1, "https://A.Example.ORG/es/1?x"), (2, "http://example.org/en/12#t"), (3, "http://notexample.org/es/1"),
            (4, "http://x.com/de/1"), (5, "http://com/fr/"), (6, None), (7, "no scheme"), (8, "http://host.org?q"), (9, "http://HÖST.net/É")]
    rows += [(100 + i, f"http://spam.net/buy/{i}") for i in range(60)] + [(200 + i, f"http://spam.net/news/{i}") for i in range(60)]
    marks = [(100 + i, 1) for i in range(40)] + [(200 + i, 0) for i in range(40)] + [(None, 1), (1, None), (100, 0)]
    pages = spark.createDataFrame([(i, u, "h", 1) for i, u in rows], "page_id long, url string, host string, purity int")
    labels = spark.createDataFrame(marks, "page_id long, bad int")
    got = {r.page_id: r for r in urls.judge_urls(pages, labels, RULES).collect()}
    assert len(got) == len(rows)
    assert [(got[i].host, got[i].path, got[i].rule, got[i].verdict) for i in range(1, 6)] == [
        ("a.example.org", "/es/1", "example.org/es/", "block"), ("example.org", "/en/12", "example.org/en/1", "block"),
        ("notexample.org", "/es/1", "org/", "allow"), ("x.com", "/de/1", "com/de/", "block"), ("com", "/fr/", "com/fr/", "allow")]
    assert (got[6].host, got[6].path, got[7].host, got[8].rule, got[9].host) == ("", "", "", None, "hÖst.net")
    assert got[155].verdict == "block" and got[255].verdict == "allow"
    assert urls.judge_urls(pages.limit(0), labels, RULES).count() == 0
    assert urls.judge_urls(pages, labels.limit(0), []).filter("verdict = 'block'").count() == 0


def plain_url(url):
    """Host, path and longest rule, letter by letter."""
    rest = (url or "").partition("://")[2]
    cut = next((i for i, c in enumerate(rest) if c in "/?#"), len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
    end = next((i for i in range(cut, len(rest)) if rest[i] in "?#"), len(rest))
    path = rest[cut:end]
    fits = []
    for verdict, rule in RULES:
        at = rule.index("/")
        if (host == rule[:at] or host.endswith("." + rule[:at])) and path.startswith(rule[at:]):
            fits.append((len(rule), rule, verdict))
    return host, path, *(max(fits)[1:] if fits else (None, None))


def test_hosts_paths_and_rules_equal_brute_force(spark):
    dice = random.Random(11)
    parts = ["http://", "https://", "://", "example.org", "EXAMPLE.org", "a.", "com", "xcom", ".", "/", "/es/", "/en/1", "/en/", "/fr/", "/de/", "1", "?q=/de/",
             "#", "É", " ", ":80"]
    rows = [(i, "".join(dice.choice(parts) for _ in range(dice.randint(0, 8)))) for i in range(3000)]
    rows += [(5000 + i, f"http://{h}{p}{q}") for i, (h, p, q) in enumerate(itertools.product(
        ["org", "example.org", "a.example.ORG", "notexample.org", "com", "x.com"], ["", "/", "/es/", "/es", "/en/12", "/fr/a", "/de/a/b"], ["", "?/de/", "#x"]))]
    pages = spark.createDataFrame(rows + [(9999, None)], "page_id long, url string")
    labels = spark.createDataFrame([], "page_id long, bad int")
    ruled = 0
    for r in urls.judge_urls(pages, labels, RULES).collect():
        host, path, rule, verdict = plain_url(r.url)
        assert (r.host, r.path, r.rule, r.verdict) == (host, path, rule, verdict or "allow"), r.url
        ruled += rule is not None
    assert ruled > 50


def test_urls_differ_below_the_fourth_segment(spark):
    rows = [(i, f"http://s.net/2024/05/17/shop/{'casino' if i % 2 else 'shoes'}/x/{i}") for i in range(120)] + [(500, "http://s.net")]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(80)], "page_id long, bad int")
    got = {r.page_id: (r.template, r.verdict) for r in urls.judge_urls(pages, labels, []).collect()}
    assert len(got) == len(rows) and got[500] == ("", "allow")
    assert got[119] == ("/{n}/{n}/{n}/shop/casino/x/{n}", "block") and got[118] == ("/{n}/{n}/{n}/shop/shoes/x/{n}", "allow")


def test_numbers_that_differ_stay_apart(spark):
    rows = [(100 * f + i, f"http://s.net/forum/{f}/t/{100 * f + i}") for f in (3, 4) for i in range(100)]
    rows += [(1000 + i, f"http://s.net/forum/{10 + i}/t/{i}") for i in range(50)]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    labels = spark.createDataFrame([(i, int(i // 100 == 3)) for i, _ in rows], "page_id long, bad int")
    got = {r.page_id: (r.template, r.verdict) for r in urls.judge_urls(pages, labels, []).collect()}
    assert {got[300 + i] for i in range(100)} == {("/forum/3/t/{n}", "block")}
    assert {v for k, v in got.items() if k // 100 != 3} <= {("/forum/4/t/{n}", "allow"), ("/forum/{n}/t/{n}", "allow")}


def test_one_very_deep_path_adds_no_level(spark, monkeypatch):
    rounds = []
    real = urls.cut
    monkeypatch.setattr(urls, "cut", lambda df: rounds.append(1) or real(df))
    rows = [(1, "http://s.net/" + "trap7/" * 2000), (2, "http://s.net/a/b"), (3, "http://s.net/a/c"), (4, "http://s.net/----------------")]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    got = {r.page_id: r for r in urls.judge_urls(pages, spark.createDataFrame([(1, 1)], "page_id long, bad int"), []).collect()}
    assert len(got) == 4 and len(rounds) < 10
    share, purity = 1.0, 1 / 2      # prior 1/2, then the host, then 2,000 levels
    assert got[1].template.count("/") == 2000 and got[1].template.endswith("/trap{n}") and got[1].verdict == "block"
    assert got[4].template != "/{h}" and share > purity


def test_bad_branch_among_many_rare_siblings(spark):
    names = [f"{chr(97 + i // 20)}{chr(97 + i % 20)}" for i in range(200)]
    rows = [(i, f"http://s.net/u/{n}/") for i, n in enumerate(names)] + [(1000 + i, f"http://s.net/u/spam/{i}") for i in range(60)]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    labels = spark.createDataFrame([(i, int(i >= 1000)) for i, _ in rows], "page_id long, bad int")
    got = {r.page_id: (r.template, r.verdict) for r in urls.judge_urls(pages, labels, []).collect()}
    assert {got[i] for i in range(200)} == {("/u/*", "allow")}
    assert {got[1000 + i] for i in range(60)} == {("/u/spam/{n}", "block")}


def test_quotes_are_linked(spark):
    rows = [(1, 0, "user", "How do I sort?\n\nAnd how do I join?"), (1, 1, "assistant", "> How do I sort?\n\nUse sort."),
            (1, 2, "assistant", "On Monday, A wrote:\n>  and HOW do I join?\nUse join."),
            (1, 3, "user", ">> How do I sort?\n> Use sort.\nThanks.\n\n"), (1, 4, "user", "New question"),
            (1, 4, "user", "New question"), (2, 0, "user", None), (2, None, "user", "lost"), (None, 0, "user", "> x\ny"),
            (None, 1, "user", "")]
    out = quotes.reply_ordered(spark.createDataFrame([(*r, 9) for r in rows], "conv_id long, turn long, role string, text string, c int"))
    got = {(r.conv_id, r.turn): r for r in out.collect()}
    assert out.count() == len(rows)
    assert [(got[1, t].reply_to, got[1, t].level, got[1, t].position) for t in range(5)] == [
        (None, 0, 1), (0, 1, 2), (0, 1, 5), (1, 2, 3), (3, 3, 4)]
    assert got[1, 2].content == "Use join." and got[1, 3].content == "Thanks." and got[1, 1].content == "Use sort."
    assert got[2, 0].content == "" and got[2, None].position is None and got[None, 1].reply_to == 0
    assert quotes.reply_ordered(out.select("conv_id", "turn", "role", F.col("content").alias("text")).limit(0)).count() == 0


def test_reply_order_walks_the_tree(spark):
    """Random reply trees, and one whose order is far from that of the turns."""
    dice = random.Random(7)
    trees = {c: {t: dice.randrange(t) for t in range(1, n)} for c, n in ((1, 40), (2, 25), (3, 1))}
    trees[4] = {t: 0 if t % 2 else t - 1 for t in range(1, 30)}     # every other message answers the first
    rows = []
    for c, parents in trees.items():
        for t in range(len(parents) + 1):
            quoted = f"> words of message {parents[t]} in {c}\n" if t else ""
            rows.append((c, t, "user", f"{quoted}words of message {t} in {c}"))
    got = {(r.conv_id, r.turn): r for r in quotes.reply_ordered(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    for c, parents in trees.items():
        order, level = [], {}

        def walk(t, depth):
            order.append(t)
            level[t] = depth
            for child in sorted(x for x, up in parents.items() if up == t):
                walk(child, depth + 1)
        walk(0, 0)
        assert [got[c, t].position for t in order] == list(range(1, len(order) + 1))
        assert all(got[c, t].reply_to == parents.get(t) and got[c, t].level == level[t] and got[c, t].thread == 0 for t in order)


def test_nested_and_rewrapped_quotes_are_linked(spark):
    rows = [(1, 0, "The first point is long enough to be wrapped.\n\nThe second point is wrapped as well, I think.\n\nA third."), (1, 1, "Other words."),
            (1, 2, "> The first point is long\n> enough to be wrapped.\nYes.\n> The second point is wrapped\n> as well, I think.\nNo."),
            (1, 3, "More."), (1, 4, ">> Other words.\nOnly nested."), (1, 5, "> Unknown.\n> On Monday, B wrote:\n>> More.\nDeep.")]
    messages = spark.createDataFrame([(c, t, "user", x) for c, t, x in rows], "conv_id long, turn long, role string, text string")
    got = {r.turn: r for r in quotes.reply_ordered(messages).collect()}
    assert [got[t].reply_to for t in range(6)] == [None, 0, 0, 2, 1, 3]
    assert got[2].n_quotes == 2 and got[4].n_quotes == 1 and got[5].n_quotes == 1
    assert got[2].content == "Yes.\nNo." and got[4].content == "Only nested."


def test_long_conversation_is_scanned_in_blocks(spark):
    n = 2500
    rows = spark.range(n).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.lit("user").alias("role"),
                                 F.when(F.col("id") % 2 == 0, "same words").otherwise("> same words\nok").alias("text"))
    got = {r.turn: r for r in quotes.reply_ordered(rows).collect()}
    assert all(got[t].reply_to == t - 1 and got[t].level == t and got[t].position == t + 1 for t in range(1, n))
