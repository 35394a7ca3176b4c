import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from payloads import BATCH_1, BATCH_2
from plait.operators import (DuplicateKeyError, SchemaDriftError, assert_unique, conform,
                             dedupe_latest, drift_report, key_report, key_summary)
from plait.sinks import (check_specs, cluster, load, merge_frames, replace, table_spec, upsert,
                         vacuum, zorder)
from plait.sinks.tables import drop, exists
from plait.session import unique_name

DDL = "h3index string, routeId string, n bigint"


def _spec(workdir, key=("h3index",)):
    return table_spec("props", unique_name("props"), "default", workdir, key=key)


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_key_report_and_summary(spark):
    df = spark.createDataFrame([("a", 1), ("a", 5), (None, 1), (None, 2), ("b", 1)], "k string, n int")
    assert _rows(key_report(df, "k")) == [("a", 2), (None, 2)]
    s = key_summary(df, "k").first()
    assert (s.n_rows, s.n_keys, s.n_null_key_rows, s.n_duplicated_keys) == (5, 3, 2, 2)
    with pytest.raises(DuplicateKeyError):
        assert_unique(df, "k")
    assert_unique(df.where("k <> 'a' OR k IS NULL"), "k")          # NULL keys never clash


def test_dedupe_latest_equals_row_number(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 5, "y"), ("a", 5, "z"), ("b", 2, "q")],
                               "k string, ts int, v string")
    got = _rows(dedupe_latest(df, "k", ["ts"]))
    assert got == [("a", 5, "z"), ("b", 2, "q")]


def test_upsert_semantics_and_counts(spark, workdir):
    spec = _spec(workdir)
    b1 = spark.createDataFrame(BATCH_1, DDL)
    b2 = spark.createDataFrame(BATCH_2, DDL)
    m1 = load(b1, spec)
    assert exists(spark, spec) and m1["rows_written"] == 3
    m2 = load(b2, spec)
    assert (m2["inserted"], m2["updated"]) == (1, 2)
    assert _rows(spark.table(spec.qualified)) == [("88a", "R1", 1), ("88b", "R2", 20),
                                                  ("88c", "R3", 3), ("88d", "R4", 4)]   # 88c kept
    # idempotent: merging the same batch again changes nothing
    load(b2, spec)
    assert spark.table(spec.qualified).count() == 4


def test_upsert_duplicate_source_keys(spark, workdir):
    spec = _spec(workdir)
    load(spark.createDataFrame(BATCH_1, DDL), spec)
    dup = spark.createDataFrame([("88a", "R1", 7), ("88a", "R1", 9)], DDL)
    with pytest.raises(DuplicateKeyError):
        upsert(dup, spec)
    upsert(dup, spec, on_duplicate="latest", order=["n"])
    assert spark.table(spec.qualified).where("h3index = '88a'").first().n == 9


def test_null_keys_never_match(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "k int, v string")
    s = spark.createDataFrame([(2, "B"), (3, "c"), (None, "N")], "k int, v string")
    assert _rows(merge_frames(t, s, "k")) == sorted([(1, "a"), (2, "B"), (3, "c"), (None, "n"), (None, "N")], key=str)


def test_upsert_property_idempotent(spark):
    t = spark.range(0, 50).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    s = spark.range(40, 60).select(F.col("id").alias("k"), (F.col("id") * 3).alias("v"))
    once = merge_frames(t, s, "k")
    twice = merge_frames(once, s, "k")
    assert _rows(once) == _rows(twice)


def test_replace_drop_and_vacuum(spark, workdir):
    spec = _spec(workdir)
    replace(spark.createDataFrame(BATCH_1, DDL), spec)
    replace(spark.createDataFrame(BATCH_2, DDL), spec)
    assert _rows(spark.table(spec.qualified)) == _rows(spark.createDataFrame(BATCH_2, DDL))
    replace(spark.table(spec.qualified).where("n > 1"), spec)    # rewrite from itself
    assert spark.table(spec.qualified).count() == 2
    removed = vacuum(spark, spec, keep=1)
    assert len(removed) == 2
    assert spark.table(spec.qualified).count() == 2
    drop(spark, spec)
    assert not exists(spark, spec)


def test_check_specs_refuses_shared_location(workdir):
    a = table_spec("coordinates", "c", "db", workdir)
    b = table_spec("properties", "p", "db", workdir)
    with pytest.raises(ValueError):
        check_specs([a, b])
    check_specs([a, table_spec("properties", "p", "db", workdir + "/p")])


def test_conform_and_drift(spark):
    target = T.StructType.fromDDL("k bigint, n bigint, s string, d double")
    src = spark.createDataFrame([(1, 2, 1.5, "x")], "k int, n int, d float, extra string")
    out = conform(src, target)
    assert out.schema == target
    assert out.first().s is None
    actions = {r.column_name: r.action for r in drift_report(spark, src.schema, target).collect()}
    assert actions == {"k": "widen", "n": "widen", "s": "missing", "d": "widen", "extra": "extra"}
    bad = spark.createDataFrame([("1.5",)], "n string")
    with pytest.raises(SchemaDriftError):
        conform(bad, T.StructType.fromDDL("n bigint"))
    with pytest.raises(SchemaDriftError):
        conform(src, target, extra="fail")


def test_cluster_and_zorder_keep_content(spark):
    df = spark.range(0, 1000).select(F.col("id"), (F.col("id") * 7 % 101).alias("b"))
    assert _rows(cluster(df, ["b", "id"], 4)) == _rows(df)
    assert _rows(zorder(df, ["id", "b"], 4)) == _rows(df)


def test_bucketed_tables_join_and_merge_without_shuffling_the_table(spark, workdir):
    a = table_spec("a", unique_name("ba"), "default", workdir + "/a", key="k", buckets=4)
    b = table_spec("b", unique_name("bb"), "default", workdir + "/b", key="k", buckets=4)
    rows = spark.range(0, 5000).select(F.col("id").alias("k"), (F.col("id") % 7).alias("v"))
    replace(rows, a)
    replace(rows.withColumnRenamed("v", "w"), b)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.table(a.qualified).join(spark.table(b.qualified), "k")
        joined.collect()
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and joined.count() == 5000
        src = spark.range(4990, 5010).select(F.col("id").alias("k"), F.lit(100).alias("v"))
        m = upsert(src, a)
        assert (m["inserted"], m["updated"]) == (10, 10)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 * 1024 * 1024))
    got = spark.table(a.qualified)
    assert got.count() == 5010 and got.where("v = 100").count() == 20
    desc = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {a.qualified}").collect()}
    assert desc.get("Num Buckets") == "4"


def _partition_dirs(spark, spec):
    rows = spark.table(spec.qualified).select(
        "p", F.regexp_extract(F.col("_metadata.file_path"), r"/(v=[^/]+)/", 1).alias("v")).distinct().collect()
    return {r.p: r.v for r in rows}


def test_partition_scoped_upsert_rewrites_only_touched_partitions(spark, workdir):
    spec = table_spec("parts", unique_name("parts"), "default", workdir, key=("p", "k"), partition_by="p")
    base = spark.range(0, 400).select((F.col("id") % 4).alias("p"), F.col("id").alias("k"), F.lit("a").alias("v"))
    load(base, spec)
    before = _partition_dirs(spark, spec)
    assert len(set(before.values())) == 1
    batch = spark.createDataFrame([(1, 1, "B"), (1, 1001, "new"), (9, 5, "n9")], "p bigint, k bigint, v string")
    m = upsert(batch, spec)
    assert (m["inserted"], m["updated"], m["partitions_rewritten"]) == (2, 1, 2)
    after = _partition_dirs(spark, spec)
    assert after[0] == before[0] and after[2] == before[2] and after[3] == before[3]
    assert after[1] != before[1] and after[9] == after[1]
    got = spark.table(spec.qualified)
    assert got.count() == 402
    assert got.where("p = 1 AND k = 1").first().v == "B"
    assert vacuum(spark, spec, keep=0) == []            # both versions still hold live partitions
    # a key without the partition column falls back to a whole-table merge
    spec2 = table_spec("parts2", unique_name("parts2"), "default", workdir + "/2", key="k", partition_by="p")
    load(base, spec2)
    m2 = upsert(batch.select("p", "k", "v").where("p = 1"), spec2)
    assert "partitions_rewritten" not in m2 and spark.table(spec2.qualified).count() == 401


def test_conform_nested_by_name(spark):
    target = T.StructType.fromDDL(
        "id bigint, props struct<`h3-index`: string, n: bigint, route: string>, "
        "features array<struct<k: string, v: double>>")
    # drifted payload: nested fields reordered, one missing, one extra, ints narrower
    src = spark.createDataFrame(
        [(1, (7, "x", "extra"), [(2, "a")])],
        "id int, props struct<n: int, `h3-index`: string, added: string>, "
        "features array<struct<v: int, k: string>>")
    out = conform(src, target)
    assert out.schema == target
    row = out.first()
    assert row.props["h3-index"] == "x" and row.props.n == 7 and row.props.route is None
    assert row.features[0].k == "a" and row.features[0].v == 2.0
    actions = {r.column_name: r.action for r in drift_report(spark, src.schema, target).collect()}
    assert actions["props.n"] == "widen" and actions["props.route"] == "missing"
    assert actions["props.added"] == "extra" and actions["features[].v"] == "widen"
    # n arriving as a fraction cannot become bigint without loss
    bad = spark.createDataFrame([(1, [(1.5, "a")])], "id bigint, features array<struct<v: double, k: string>>")
    with pytest.raises(SchemaDriftError):
        conform(bad, T.StructType.fromDDL("id bigint, features array<struct<k: string, v: bigint>>"))


def test_load_split_and_cluster_table(spark, workdir):
    from plait.operators import split
    from plait.sinks import cluster_table, load_split
    df = spark.range(0, 300).select(F.struct(F.col("id").alias("k"), (F.col("id") % 5).alias("a")).alias("x"),
                                    F.struct((F.col("id") * 2).alias("b")).alias("y"))
    parts = split(df, {"xs": ["x.*"], "ys": ["y.*"]}, key={"k": "x.k"}, persist=True)
    specs = {n: table_spec(n, unique_name(n), "default", f"{workdir}/{n}", key="k") for n in parts}
    counts = load_split(parts, specs)
    assert counts["xs"]["rows_written"] == 300 and not parts.parent.is_cached
    again = load_split(split(df, {"xs": ["x.*"], "ys": ["y.*"]}, key={"k": "x.k"}), specs)
    assert again["ys"]["updated"] == 300 and again["ys"]["inserted"] == 0
    before = _rows(spark.table(specs["xs"].qualified))
    cluster_table(specs["xs"], ["a", "k"], method="zorder", partitions=3)
    assert _rows(spark.table(specs["xs"].qualified)) == before


def test_register_existing_files(spark, workdir):
    from plait.sinks import register
    path = workdir + "/landed"
    spark.createDataFrame(BATCH_1, DDL).write.parquet(path)
    spec = table_spec("props", unique_name("reg"), "default", path, key="h3index")
    assert register(spark, spec) is True
    assert register(spark, spec) is False                   # already there: nothing to do
    assert spark.table(spec.qualified).count() == 3
    load(spark.createDataFrame(BATCH_2, DDL), spec)          # then merges like any table
    assert spark.table(spec.qualified).count() == 4


def test_dup_and_null_key_payloads(spark):
    import json
    from payloads import BASE_DDL, DUP_KEYS, NULL_KEY
    from plait.operators import explode_rows, split
    from plait.sources import parse_json
    texts = spark.createDataFrame([(json.dumps(DUP_KEYS),), (json.dumps(NULL_KEY),)], "body string")
    feats = explode_rows(parse_json(texts, "body", BASE_DDL, alias="p").select("p.features"), "features")
    props = split(feats.select("col.*"), {"properties": ["properties.*"]},
                  key={"h3index": "properties.h3-index"})["properties"]
    assert _rows(key_report(props, "h3index")) == [("88a", 2)]
    s = key_summary(props, "h3index").first()
    assert (s.n_rows, s.n_null_key_rows, s.n_duplicated_keys) == (4, 1, 1)
    with pytest.raises(DuplicateKeyError):
        assert_unique(props, "h3index")
    latest = dedupe_latest(props, "h3index", ["n"])
    assert latest.where("h3index = '88a'").first().n == 5


def test_key_as_single_name(spark, workdir):
    spec = table_spec("props", unique_name("props"), "default", workdir)      # no key in the spec
    load(spark.createDataFrame(BATCH_1, DDL), spec, key="h3index")
    m = upsert(spark.createDataFrame(BATCH_2, DDL), spec, key="h3index")
    assert (m["inserted"], m["updated"]) == (1, 2)


def test_compact_after_many_appends(spark, workdir):
    import glob
    from plait.sinks import append, compact
    spec = table_spec("small", unique_name("small"), "default", workdir + "/small")
    replace(spark.range(0, 10).select(F.col("id").alias("k")), spec)
    for i in range(1, 6):
        append(spark.range(i * 10, i * 10 + 10).select(F.col("id").alias("k")).repartition(3), spec)
    before = _rows(spark.table(spec.qualified))
    m = compact(spec)
    files = glob.glob(m["location"].replace("file:", "") + "/*.parquet")
    assert len(files) <= 2 and _rows(spark.table(spec.qualified)) == before


def test_partition_scoped_upsert_with_null_and_very_many_partitions(spark, workdir):
    spec = table_spec("many", unique_name("many"), "default", workdir, key=("p", "k"), partition_by="p")
    load(spark.createDataFrame([("a", 1, "old"), ("z", 1, "old"), (None, 1, "old")], "p string, k bigint, v string"), spec)
    before = _partition_dirs(spark, spec)
    m = upsert(spark.createDataFrame([("a", 1, "new"), (None, 1, "new"), (None, 2, "new")], "p string, k bigint, v string"), spec)
    assert (m["inserted"], m["updated"], m["partitions_rewritten"]) == (2, 1, 2)
    after = _partition_dirs(spark, spec)
    assert after["z"] == before["z"] and after["a"] == after[None] != before["a"]
    got = sorted((r.p or "", r.k, r.v) for r in spark.table(spec.qualified).collect())
    assert got == [("", 1, "new"), ("", 1, "old"), ("", 2, "new"), ("a", 1, "new"), ("z", 1, "old")]
    # far beyond what one OR per partition could plan
    many = spark.range(5000).select(F.format_string("p%05d", "id").alias("p"), F.col("id").alias("k"), F.lit("m").alias("v"))
    m = upsert(many.coalesce(4), spec)
    assert (m["inserted"], m["updated"], m["partitions_rewritten"]) == (5000, 0, 5000)
    assert spark.table(spec.qualified).count() == 5005


def test_zorder_of_many_and_of_text_columns(spark):
    from plait.sinks import zorder
    df = spark.range(500).select("id", (F.col("id") % 7).alias("b"), (F.col("id") % 5).alias("c"), (-F.col("id")).alias("d"),
                                 F.col("id").cast("string").alias("t"))
    assert sorted(zorder(df, ["id", "b", "c", "d"]).collect()) == sorted(df.collect())
    with pytest.raises(TypeError):
        zorder(df, ["id", "t"])


def test_upsert_rewrites_only_touched_combinations_of_two_partition_columns(spark, workdir):
    ddl = "p string, n bigint, k bigint, v string"
    spec = table_spec("two", unique_name("two"), "default", workdir, key=("p", "n", "k"), partition_by=("p", "n"))
    parts = [("a", 1), ("a", 2), ("b", 1), ("b", 2), (None, 1), (None, 2)]
    load(spark.createDataFrame([(p, n, 1, "old") for p, n in parts], ddl), spec)
    # narrower types than the table's
    batch = spark.createDataFrame([("a", 1, 1, "new"), ("b", 2, 1, "new"), (None, 2, 1, "new")], "p string, n int, k int, v string")
    m = upsert(batch, spec)
    assert (m["inserted"], m["updated"], m["partitions_rewritten"]) == (1, 2, 3)
    got = sorted((r.p or "", r.n, r.v) for r in spark.table(spec.qualified).collect())
    assert got == [("", 1, "old"), ("", 2, "new"), ("", 2, "old"), ("a", 1, "new"), ("a", 2, "old"), ("b", 1, "old"), ("b", 2, "new")]
