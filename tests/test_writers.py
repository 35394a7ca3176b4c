"""Writers that meet: every case ends in all rows or in an error."""

import pytest
from pyspark.sql import functions as F

from plait.operators.conform import SchemaDriftError
from plait.session import unique_name
from plait.sinks import tables
from plait.sinks.layout import cluster_table, compact, file_ranges, pruning
from plait.sinks.tables import KEY_BUCKET, ConcurrentWriteError, append, load, read, replace, scd2_load, table_spec, upsert


def rows(spark, ids, v="a"):
    return spark.createDataFrame([(i, v) for i in ids], "id long, v string")


def spec_of(workdir, **more):
    return table_spec("t", unique_name("t_writers"), "default", workdir, key="id", **more)


def during(monkeypatch, act):
    """Runs ``act`` once, after a writer's files are written and before the table points at them."""
    real, left = tables._expect, [act]

    def expect(*args):
        if left:
            left.pop()()
        return real(*args)

    monkeypatch.setattr(tables, "_expect", expect)


@pytest.mark.parametrize("parts", [{}, {"key_buckets": 4}, {"key_width": 5}])
def test_append_during_upsert_is_not_lost(spark, workdir, monkeypatch, parts):
    spec = spec_of(workdir, **parts)
    replace(rows(spark, range(10)), spec)
    during(monkeypatch, lambda: append(rows(spark, range(100, 110)), spec))
    with pytest.raises(ConcurrentWriteError):
        upsert(rows(spark, range(5, 15), "b"), spec)
    assert read(spark, spec).count() == 20
    upsert(rows(spark, range(5, 15), "b"), spec)
    assert sorted(r.id for r in read(spark, spec).collect()) == [*range(15), *range(100, 110)]


@pytest.mark.parametrize("rewrite", [compact, lambda s: cluster_table(s, ["id"])])
def test_upsert_during_rewrite_is_not_lost(spark, workdir, monkeypatch, rewrite):
    spec = spec_of(workdir)
    replace(rows(spark, range(10)), spec)
    during(monkeypatch, lambda: upsert(rows(spark, range(10, 15)), spec))
    with pytest.raises(ConcurrentWriteError):
        rewrite(spec)
    assert spark.table(spec.qualified).count() == 15
    rewrite(spec)
    assert spark.table(spec.qualified).count() == 15


def test_append_into_superseded_version_fails(spark, workdir, monkeypatch):
    spec = spec_of(workdir)
    replace(rows(spark, range(10)), spec)
    real, left = tables.conform, [lambda: replace(rows(spark, range(20)), spec)]

    def conform(*args):
        if left:
            left.pop()()      # a new version, after the append has looked at the table
        return real(*args)

    monkeypatch.setattr(tables, "conform", conform)
    with pytest.raises(ConcurrentWriteError):
        append(rows(spark, [100]), spec)


@pytest.mark.parametrize("parts", [{}, {"key_buckets": 4}])
def test_two_first_loads_keep_all_rows(spark, workdir, monkeypatch, parts):
    spec = spec_of(workdir, **parts)
    during(monkeypatch, lambda: load(rows(spark, range(5)), spec))
    load(rows(spark, range(3, 8), "b"), spec)
    assert {(r.id, r.v) for r in read(spark, spec).collect()} == {(i, "b" if i > 2 else "a") for i in range(8)}


def test_append_refuses_or_names_unknown_columns(spark, workdir):
    spec = spec_of(workdir)
    replace(rows(spark, range(3)), spec)
    more = rows(spark, [7]).withColumn("note", F.lit("x"))
    with pytest.raises(SchemaDriftError):
        append(more, spec)
    assert append(more, spec, extra="drop")["ignored_columns"] == ["note"]
    assert append(more, spec, extra="add")["added_columns"] == ["note"]
    assert [r.note for r in spark.table(spec.qualified).orderBy("note").collect()] == [None, None, None, None, "x"]
    nested = rows(spark, [1]).select("id", F.struct("v").alias("s"))
    other = table_spec("n", unique_name("t_nested"), "default", workdir + "-n", key="id")
    replace(nested, other)
    with pytest.raises(SchemaDriftError):
        append(rows(spark, [2]).select("id", F.struct("v", F.lit(1).alias("w")).alias("s")), other)


def files(spark, spec):
    return {r.f for r in spark.table(spec.qualified).select(F.col("_metadata.file_path").alias("f")).distinct().collect()}


def test_upsert_rewrites_touched_key_parts_only(spark, workdir):
    spec = spec_of(workdir, key_width=100)
    load(rows(spark, [*range(-150, 1000)]), spec)
    before = files(spark, spec)
    done = load(rows(spark, [-101, 5, 6, 950, 2000], "b"), spec)
    assert (done["partitions_rewritten"], done["updated"], done["inserted"]) == (4, 4, 1)
    kept = {f for f in before if not any(f"{KEY_BUCKET}={b}/" in f for b in (-200, 0, 900))}
    assert len(before) == 12 and kept <= files(spark, spec) and len(files(spark, spec)) == 13
    assert {r.id for r in read(spark, spec).where("v = 'b'").collect()} == {-101, 5, 6, 950, 2000}
    assert read(spark, spec).columns == ["id", "v"]


def test_key_buckets_keep_null_keys_and_widen_types(spark, workdir):
    spec = spec_of(workdir, key_buckets=8)
    load(rows(spark, [None, None, *range(50)]), spec)
    ints = spark.createDataFrame([(i, "b") for i in range(40, 60)] + [(None, "b")], "id int, v string")
    load(ints, spec, on_duplicate="latest", order=["v"])
    got = read(spark, spec)
    assert got.where("id IS NULL").count() == 3
    assert {(r.id, r.v) for r in got.where("id IS NOT NULL").collect()} == {(i, "b" if i >= 40 else "a") for i in range(60)}
    with pytest.raises(ValueError):
        upsert(rows(spark, [1]), spec, key="v")


def test_history_in_key_buckets_equals_plain_history(spark, workdir):
    data = [(k, t, t * 7 % 3) for k in [None, *range(20)] for t in range(12)]
    df = spark.createDataFrame(data, "id long, t long, s long").withColumn("t", F.timestamp_seconds("t"))
    results = []
    for n, parts in enumerate(({}, {"key_buckets": 4})):
        spec = table_spec("h", unique_name("t_hist"), "default", f"{workdir}-{n}", key="id", **parts)
        for part in (df.where("second(t) >= 6"), df.where("second(t) < 6")):
            scd2_load(part, spec, "id", ["t"], ["s"])
        results.append(sorted(map(str, read(spark, spec).select("id", "s", "valid_from", "valid_to", "is_current").collect())))
    assert results[0] == results[1]


def test_file_ranges_and_pruning_are_what_the_files_hold(spark, workdir):
    spark.range(0, 1000, 1, 10).select("id", (F.col("id") % 7).alias("x")).write.parquet(workdir)
    df = spark.read.parquet(workdir)
    assert sorted((r.id_min, r.id_max, r.n_rows) for r in file_ranges(df, ["id"]).collect()) == [(i * 100, i * 100 + 99, 100) for i in range(10)]
    got = pruning(df, "id", [(0, 99), (150, 250), (5000, 6000)]).collect()
    assert [(r.files_read, r.files, r.rows_read) for r in got] == [(1, 10, 100), (2, 10, 200), (0, 10, 0)]
    assert [r.files_read for r in pruning(df, "x", [(3, 3)]).collect()] == [10]
