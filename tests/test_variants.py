"""Documents of unknown shape, nested evolution, stream metrics, declared clustering."""

import json
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plait.operators.conform import SchemaDriftError, merge_types
from plait.operators.variants import geometry_parts, path_values
from plait.session import unique_name
from plait.sinks.layout import cluster_table, declared_clustering, pruning
from plait.sinks.tables import append, load, replace, table_spec
from plait.streaming.metrics import BatchMetrics, observed


def plain_paths(v, path=""):
    if isinstance(v, dict) and v:
        for k, x in v.items():
            name = k if k and all(c.isalnum() or c in "_-" for c in k) else "`" + k.replace("`", "``") + "`"
            yield from plain_paths(x, f"{path}.{name}" if path else name)
    elif isinstance(v, list) and v:
        for i, x in enumerate(v):
            yield from plain_paths(x, f"{path}[{i}]")
    else:
        yield path, "{}" if v == {} else "[]" if v == [] else None if v is None else str(v).lower() if isinstance(v, bool) else str(v)


def random_json(dice, depth):
    kind = dice.random()
    if depth and kind < 0.4:
        return {dice.choice(["a", "b-c", "d e", "x.y", "é", "q`"]): random_json(dice, depth - 1) for _ in range(dice.randint(0, 3))}
    if depth and kind < 0.7:
        return [random_json(dice, depth - 1) for _ in range(dice.randint(0, 3))]
    return dice.choice([None, True, 7, "text", "", -3])


def test_path_values_equal_brute_force(spark):
    dice = random.Random(3)
    docs = [(i, random_json(dice, i % 9)) for i in range(150)]
    df = spark.createDataFrame([(i, json.dumps(d)) for i, d in docs], "id long, body string")
    got = path_values(df, "body", ["id"]).collect()
    assert sorted((r.id, r.path, str(r.value)) for r in got) == sorted((i, p, str(v)) for i, d in docs for p, v in plain_paths(d))
    variants = path_values(df.select("id", F.parse_json("body").alias("v")), "v", ["id"])
    assert variants.count() == len(got)


def test_path_values_of_damaged_and_empty_input(spark):
    df = spark.createDataFrame([(1, None), (2, "{bad"), (3, "{}"), (4, "null"), (5, '"x"')], "id long, body string")
    got = {r.id: (r.path, r.kind, r.value) for r in path_values(df, "body", ["id"]).collect()}
    assert got == {1: ("", None, None), 2: ("", None, None), 3: ("", "OBJECT", "{}"), 4: ("", "VOID", None), 5: ("", "STRING", "x")}
    assert path_values(df.limit(0), "body", ["id"]).collect() == []


def test_levels_are_opened_without_a_write(spark):
    """Every level used to be written with the values of all later ones in it."""
    deep = {"a": [{"b": [{"c": '[{"[[\\', "d": [[]], "e": {}}] * 3}] * 3}
    df = spark.createDataFrame([(1, json.dumps(deep)), (2, "7")], "id long, body string")
    got = path_values(df, "body", ["id"])
    shape = json.dumps({"type": "GeometryCollection", "geometries": [{"type": "Point", "coordinates": [1, 2]}] * 2})
    parts = geometry_parts(df.select("id", F.lit(shape).alias("g")), "g", ["id"])
    for rows in (got, parts):
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert "Generate" in plan and "Exchange" not in plan
    assert sorted((r.path, r.value) for r in got.where("id = 1").collect()) == sorted(plain_paths(deep))
    assert parts.count() == 4


def test_paths_deeper_than_a_pass(spark):
    deep, path = "end", []
    for i in range(40):
        deep, path = ([deep], ["[0]"] + path) if i % 2 else ({"k": deep}, [".k"] + path)
    df = spark.createDataFrame([(1, json.dumps(deep))], "id long, body string")
    assert [(r.path, r.value) for r in path_values(df, "body", ["id"]).collect()] == [("".join(path), "end")]


def test_geometry_parts_keep_every_shape(spark):
    point, line = {"type": "Point", "coordinates": [1, 2]}, {"type": "LineString", "coordinates": [[1, 2], [3, 4]]}
    deep = {"type": "GeometryCollection", "geometries": [point, {"type": "GeometryCollection", "geometries": [line, {"type": "GeometryCollection", "geometries": []}]}]}
    df = spark.createDataFrame([(1, json.dumps(point)), (2, json.dumps(deep)), (3, None), (4, "{bad")], "id long, g string")
    got = sorted((r.id, r.path, r.kind, r.coordinates) for r in geometry_parts(df, "g", ["id"]).collect())
    assert got == [(1, "", "Point", "[1,2]"), (2, "0", "Point", "[1,2]"), (2, "1.0", "LineString", "[[1,2],[3,4]]"),
                   (2, "1.1", "GeometryCollection", None), (3, "", None, None), (4, "", None, None)]


def test_merge_types_grows_every_depth():
    target = T.StructType.fromDDL("a long, s struct<x: int>, l array<struct<x: long>>, m map<string, struct<x: int>>")
    source = T.StructType.fromDDL("A int, s struct<y: string, x: int>, l array<struct<z: double>>, m map<string, struct<x: int, w: int>>, n string")
    merged = merge_types(target, source)
    assert merged.simpleString() == ("struct<a:bigint,s:struct<x:int,y:string>,l:array<struct<x:bigint,z:double>>,"
                                     "m:map<string,struct<x:int,w:int>>,n:string>")
    with pytest.raises(SchemaDriftError):
        merge_types(target, T.StructType.fromDDL("s struct<x: string>"))


def test_nested_fields_are_added_and_old_rows_are_null(spark, workdir):
    spec = table_spec("t", unique_name("t_nested"), "default", workdir, key="id")
    load(spark.sql("SELECT id, named_struct('x', id) AS s, map('k', named_struct('x', id)) AS m FROM range(5)"), spec)
    more = spark.sql("SELECT id, named_struct('x', id, 'y', 'new') AS s, map('k', named_struct('x', id, 'z', 1)) AS m, id AS n FROM range(3, 7)")
    with pytest.raises(SchemaDriftError):
        load(more, spec)
    assert sorted(load(more, spec, extra="add")["added_columns"]) == ["m{}.z", "n", "s.y"]
    got = {r.id: (r.s.x, r.s.y, r.m["k"].z, r.n) for r in spark.table(spec.qualified).collect()}
    assert got == {i: (i, "new", 1, i) if i >= 3 else (i, None, None, None) for i in range(7)}
    load(more.drop("n"), spec)     # an older shape still fits
    hashed = table_spec("h", unique_name("t_hashed"), "default", workdir + "-h", key="id", key_buckets=2)
    load(spark.sql("SELECT id, named_struct('x', id) AS s FROM range(5)"), hashed)
    with pytest.raises(SchemaDriftError):
        load(more.select("id", "s"), hashed, extra="add")


def test_stream_metrics_per_batch(spark, workdir):
    source, out = workdir + "-in", workdir + "-out"
    spark.range(0, 30, 1, 3).write.parquet(source)
    with BatchMetrics(spark) as metrics:
        stream = spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(source)
        metrics.wait(observed(stream, "in", even="count_if(id % 2 = 0)", top=F.max("id")).writeStream.format("parquet")
                     .option("path", out).option("checkpointLocation", workdir + "-state").trigger(availableNow=True).start())
        rows = metrics.rows().collect()
    assert sorted((r.batch_id, r.metric, r.value) for r in rows if r.metric != "top") == [(b, m, v) for b in range(3) for m, v in (("even", 5.0), ("rows", 10.0))]
    assert sorted(r.value for r in rows if r.metric == "top") == [9.0, 19.0, 29.0]


def test_declared_clustering_is_kept_and_used_again(spark, workdir):
    spec = table_spec("c", unique_name("t_clustered"), "default", workdir, key="id")
    replace(spark.range(0, 4000, 1, 8).select("id", (F.col("id") * 37 % 4000).alias("x")), spec)
    with pytest.raises(ValueError):
        cluster_table(spec)
    assert pruning(spark.table(spec.qualified), "x", [(100, 200)]).first().files_read == 8
    cluster_table(spec, ["x"], partitions=8)
    assert declared_clustering(spec) == ["x"]
    assert pruning(spark.table(spec.qualified), "x", [(100, 200)]).first().files_read == 1
    append(spark.range(4000, 4400).select("id", (F.col("id") % 4000).alias("x")), spec)
    cluster_table(spec, partitions=8)
    proof = pruning(spark.table(spec.qualified), "x", [(100, 200), (3000, 3100)]).collect()
    assert [r.files_read <= 2 and r.files == 8 for r in proof] == [True, True] and spark.table(spec.qualified).count() == 4400
