"""Merges that must not lose rows: odd partition values, NULL keys, empty sources, concurrent writers."""

import threading

import pytest
from pyspark.sql import functions as F

import plait as pl
from plait.session import unique_name
from plait.sinks.tables import ConcurrentWriteError


def spec(workdir, **options):
    name = unique_name("lossless")
    return pl.table_spec(name, name, "lossless_db", f"{workdir}/{name}", **options)


def test_partition_values_with_special_characters(spark, workdir):
    values = ["A B", "c:d", "e%f", "g'h", "plain"]
    first = spark.createDataFrame([(i, v, 0) for i, v in enumerate(values)], "k long, p string, x int")
    t = spec(workdir, key=["k", "p"], partition_by=["p"])
    pl.load(first, t)
    again = first.withColumn("x", F.lit(1)).union(spark.createDataFrame([(9, "new one", 1)], first.schema))
    pl.upsert(again, t)
    assert sorted(map(tuple, spark.table(t.qualified).select("k", "p", "x").collect())) == sorted(map(tuple, again.collect()))


def test_null_keys_survive_latest(spark, workdir):
    rows = spark.createDataFrame([(None, 1), (None, 2), (None, 3), (1, 4), (1, 5)], "k long, x int")
    t = spec(workdir, key="k")
    pl.load(rows, t, on_duplicate="latest", order=["x"])
    assert sorted(r.x for r in spark.table(t.qualified).collect()) == [1, 2, 3, 5]
    pl.upsert(rows, t, on_duplicate="latest", order=["x"])
    assert sorted(r.x for r in spark.table(t.qualified).collect()) == [1, 1, 2, 2, 3, 3, 5]


def test_empty_source_writes_nothing(spark, workdir):
    rows = spark.createDataFrame([(1, "a", 4)], "k long, p string, x int")
    for options in ({"key": "k"}, {"key": ["k", "p"], "partition_by": ["p"]}):
        t = spec(workdir, **options)
        pl.load(rows.limit(0), t)
        assert pl.upsert(rows, t)["inserted"] == 1  # into an empty table
        before = spark.sql(f"SHOW TBLPROPERTIES {t.qualified} ('plait.version')").first()["value"]
        assert pl.upsert(rows.limit(0), t) == {"rows_written": 0, "inserted": 0, "updated": 0}
        assert spark.sql(f"SHOW TBLPROPERTIES {t.qualified} ('plait.version')").first()["value"] == before
        assert spark.table(t.qualified).count() == 1


def test_many_partitions_in_one_batch(spark, workdir):
    rows = spark.range(600).select(F.col("id").alias("k"), F.col("id").alias("p"), F.lit(0).alias("x"))
    t = spec(workdir, key=["k", "p"], partition_by=["p"])
    pl.load(rows.repartition(4), t)
    pl.upsert(rows.withColumn("x", F.lit(1)).repartition(4), t)
    assert spark.table(t.qualified).agg(F.sum("x"), F.count("*")).first() == (600, 600)


def test_concurrent_merges_fail_or_keep_all_rows(spark, workdir):
    t = spec(workdir, key="k")
    pl.load(spark.range(1).select(F.lit(-1).cast("long").alias("k")), t)
    done, failed = [], []

    def run(i):
        try:
            pl.upsert(spark.range(i * 1000, i * 1000 + 1000).select(F.col("id").alias("k")), t)
            done.append(i)
        except ConcurrentWriteError:
            failed.append(i)
    threads = [threading.Thread(target=run, args=(i,)) for i in range(3)]
    [x.start() for x in threads]
    [x.join() for x in threads]
    spark.catalog.refreshTable(t.qualified)
    assert done and len(done) + len(failed) == 3
    assert spark.table(t.qualified).count() == 1 + 1000 * len(done)


def test_blank_and_null_payloads_are_set_aside(spark):
    rows = spark.createDataFrame([(1, '{"a": 1}'), (2, ""), (3, None), (4, "  "), (5, "{oops")], "id int, body string")
    valid, bad = pl.split_valid(pl.parse_json(rows, "body", "a int", alias="doc"))
    assert [r.id for r in valid.collect()] == [1]
    assert {r.id: r.reason for r in bad.collect()} == {2: "empty", 3: "empty", 4: "empty", 5: "malformed"}


def test_field_named_like_a_type_keeps_its_name(spark):
    rows = spark.createDataFrame([('{"VARIANT": "x", "n": 1}',)], "j string")
    assert {f.name for f in pl.infer_schema(rows, "j").fields} == {"VARIANT", "n"}


def test_late_and_null_rows_of_a_history(spark, workdir):
    from plait.operators.history import scd2_history
    import datetime as dt
    at = lambda d: dt.datetime(2024, 1, d)
    ddl = "k string, ts timestamp_ntz, id int, state string"
    t = spec(workdir)
    args = dict(key="k", order=["ts", "id"], tracked=["state"])
    pl.scd2_load(spark.createDataFrame([("a", at(1), 1, "x"), ("a", at(9), 2, "y"), (None, at(2), 3, "x")], ddl), t, **args)
    m = pl.scd2_load(spark.createDataFrame([("a", at(5), 4, "z"), ("a", at(6), 5, "z"), (None, at(3), 6, "x")], ddl), t, **args)
    assert m["late_rows"] == 2
    got = {(r.k, r.valid_from.day, r.state, r.valid_to and r.valid_to.day, r.is_current)
           for r in spark.table(t.qualified).collect()}
    assert got == {("a", 1, "x", 5, False), ("a", 5, "z", 9, False), ("a", 9, "y", None, True),
                   (None, 2, "x", None, True)}
    assert pl.scd2_load(spark.createDataFrame([], ddl), t, **args)["rows_written"] == 0
    # two versions without a time: one is current
    same = scd2_history(spark.createDataFrame([("a", None, 1, "x"), ("a", None, 2, "y")], ddl), "k", ["ts", "id"], ["state"])
    assert sorted((r.state, r.is_current) for r in same.collect()) == [("x", False), ("y", True)]


def test_new_columns_are_never_dropped_unasked(spark, workdir):
    t = spec(workdir, key="k")
    pl.load(spark.createDataFrame([(1, "a")], "k int, v string"), t)
    more = spark.createDataFrame([(2, "b", 5)], "k int, v string, w int")
    with pytest.raises(TypeError):
        pl.upsert(more, t)
    assert pl.upsert(more, t, extra="drop")["ignored_columns"] == ["w"]
    assert pl.upsert(more, t, extra="add")["added_columns"] == ["w"]
    assert sorted(map(tuple, spark.table(t.qualified).collect())) == [(1, "a", None), (2, "b", 5)]


def test_corrupt_records_need_a_quarantine(spark, workdir):
    from plait.sources.payloads import CORRUPT
    from plait.streaming.incremental import CorruptRecordsError, batch_merger
    ddl = f"k int, v string, {CORRUPT} string"
    t = spec(workdir, key="k")
    aside = spec(workdir)
    pl.load(spark.createDataFrame([(1, "a")], "k int, v string"), t)
    bad = spark.createDataFrame([(None, None, "{x")], ddl)
    with pytest.raises(CorruptRecordsError):
        batch_merger(t)(bad, 0)
    merge = batch_merger(t, on_duplicate="trust", quarantine=aside)
    merge(bad, 0)                                          # a round without a valid row
    merge(spark.createDataFrame([(2, "b", None)], ddl), 1)
    assert spark.table(t.qualified).count() == 2 and spark.table(aside.qualified).count() == 1


def test_arrays_in_text_and_siblings(spark):
    from plait.operators.generate import explode_rows
    from plait.operators.reshape import flatten
    from plait.sources.payloads import CORRUPT, parse_json
    texts = ['{"k": 1}', ' [{"k": 2}, {"k": 3}]', "[]", "[{", "", None, "[null]", '[{"k": [1, {"z": "]"}]}]']
    docs = spark.createDataFrame(list(enumerate(texts)), "id int, body string")
    got = sorted((r.id, r.p.k, (r[CORRUPT] or "") != "") for r in parse_json(docs, "body", "k string", "p", items=True).collect()
                 if r.p.k or r[CORRUPT])
    assert [g[:2] for g in got if g[1]] == [(0, "1"), (1, "2"), (1, "3"), (7, '[1,{"z":"]"}]')]
    assert [g[0] for g in got if g[2]] == [3]
    two = spark.createDataFrame([([1, 2], [3, 4])], "a array<int>, b array<int>")
    with pytest.raises(ValueError):
        flatten(two, explode=["a", "b"])
    assert flatten(two, explode=["a", "b"], pairs=True).count() == 4
    nested = spark.createDataFrame([([([1, 2],)],)], "a array<struct<b: array<int>>>")
    assert flatten(nested, explode=["a", "a_b"]).count() == 2
    maps = spark.createDataFrame([(7, ({"x": 1},))], "pos int, d struct<m: map<string,int>>")
    assert [tuple(r) for r in explode_rows(maps, "d.m", guard_reparse=True).collect()] == [(7, "x", 1)]
