"""Property tests: round trips and idempotence."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from plait.functions import safe_name
from plait.operators import explode_rows, sanitize_names
from plait.sources import nest, parse_json, to_bodies

DOC_DDL = ("type string, properties struct<`parent-id`: bigint>, "
           "features array<struct<`child-no`: bigint, v: string>>")


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(counts=st.lists(st.integers(min_value=0, max_value=40), min_size=1, max_size=6),
       hot=st.integers(min_value=0, max_value=120))
def test_nest_parse_explode_round_trip(spark, counts, hot):
    counts = counts + [hot]                       # one key may be much larger than a page
    parents = spark.createDataFrame([(i,) for i in range(len(counts))], "pid bigint")
    kids = [(i, j, f"v{i}-{j}") for i, n in enumerate(counts) for j in range(n)]
    children = spark.createDataFrame(kids, "pid bigint, cno bigint, v string")
    docs = nest(parents, children, "pid", "pid", F.struct(F.col("pid").alias("parent-id")),
                F.struct(F.col("cno").alias("child-no"), "v"), order=[F.col("cno")], page_size=8)
    parsed = parse_json(to_bodies(docs), "body", DOC_DDL, alias="d")
    per_doc = parsed.select(F.col("d.properties.`parent-id`").alias("pid"),
                            F.size("d.features").alias("n")).collect()
    flat = explode_rows(parsed.select(F.col("d.properties.`parent-id`").alias("pid"),
                                      F.col("d.features").alias("f")), "f", alias="x")
    got = sorted((r.pid, r.x["child-no"], r.x["v"]) for r in flat.collect())
    assert got == sorted(kids)
    for i, n in enumerate(counts):                # childless parents: one empty document
        docs_of = [r.n for r in per_doc if r.pid == i]
        assert sum(docs_of) == n
        assert len(docs_of) == (1 if n == 0 else len([d for d in docs_of if d > 0]))
        assert len(docs_of) <= max(1, -(-n // 8))


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(names=st.lists(st.text(alphabet="ab-_ .9", min_size=1, max_size=6), min_size=1, max_size=4,
                      unique_by=lambda n: safe_name(n).lower()))
def test_sanitize_is_idempotent(spark, names):
    df = spark.createDataFrame([tuple(range(len(names)))], ", ".join(f"`{n}` int" for n in names))
    once = sanitize_names(df)
    assert sanitize_names(once).columns == once.columns
    assert once.first() == df.first()


def test_nest_spreads_equal_and_equally_salted_children(spark):
    """A third of all children are one repeated row, and another third share a salt."""
    kids = [(0, 1, "same")] * 400 + [(1, j, f"v{j}") for j in range(400)] + [(i, 0, "x") for i in range(2, 402)]
    parents = spark.range(403).select(F.col("id").alias("pid"))
    children = spark.createDataFrame(kids, "pid bigint, cno bigint, v string")
    docs = nest(parents, children, "pid", "pid", F.struct(F.col("pid").alias("parent-id")),
                F.struct(F.col("cno").alias("child-no"), "v"), order=[F.col("cno")],
                salt=F.when(F.col("pid") == 1, F.lit(7)).otherwise(F.col("cno")).cast("bigint"), page_size=20)
    rows = docs.select("pid", "page", "doc.features").collect()
    assert sorted((r.pid, f["child-no"], f["v"]) for r in rows for f in r.features) == sorted(kids)
    assert len({(r.pid, r.page) for r in rows}) == len(rows)
    sizes = {p: [len(r.features) for r in rows if r.pid == p] for p in (0, 1, 402)}
    assert max(sizes[0] + sizes[1]) <= 60 and len(sizes[0]) > 10 and len(sizes[1]) > 10
    assert sizes[402] == [0]


def test_nest_shuffles_plain_columns_in_bounded_tasks(spark):
    """Nested rows were shuffled, into as many tasks whatever the number of rows."""
    parents = spark.range(300).select(F.col("id").alias("pid"))
    children = spark.range(3000).select((F.col("id") % 300).alias("pid"), F.col("id").alias("cno"), F.lit("v").alias("v"))

    docs = nest(parents, children, "pid", "pid", F.struct(F.col("pid").alias("parent-id")),
                F.struct(F.col("cno").alias("child-no"), "v"), order=[F.col("cno")], task_rows=200)
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = docs._jdf.queryExecution().executedPlan().toString().split("\n")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)
    shuffles = [(line, plan[i + 1]) for i, line in enumerate(plan) if "Exchange" in line]
    assert len(shuffles) == 2 and all(", 15)" in line and "Aggregate" not in below for line, below in shuffles)
    rows = docs.select("pid", "doc.features").collect()
    assert sorted((r.pid, f["child-no"]) for r in rows for f in r.features) == sorted((i % 300, i) for i in range(3000))
    assert all([f["child-no"] for f in r.features] == sorted(f["child-no"] for f in r.features) for r in rows)


def test_nest_keeps_parents_of_every_kind(spark):
    """Parents without children, with a NULL key and given twice; children without parents; hot and other keys together."""
    parents = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,), (3,)], "pid bigint")
    kids = [(1, j) for j in range(3)] + [(3, j) for j in range(40)] + [(9, 0), (None, 1)] + [(8, j) for j in range(40)]
    docs = nest(parents, spark.createDataFrame(kids, "pid bigint, cno bigint"), "pid", "pid", F.struct(F.col("pid").alias("parent-id")),
                F.struct(F.col("cno").alias("child-no")), order=[F.col("cno")], page_size=8, max_broadcast_keys=0)
    got = [(r.pid, len(r.features)) for r in docs.select("pid", "doc.features").collect()]
    assert sorted(x for x in got if x[0] in (1, 2)) == [(1, 3), (1, 3), (2, 0)]
    assert [n for k, n in got if k is None] == [0, 0] and sum(n for k, n in got if k == 3) == 40
    assert {k for k, _ in got} == {1, 2, 3, None}
