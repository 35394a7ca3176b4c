import pytest
from pyspark.sql import functions as F

from payloads import (BASE_DDL, CASE_CLASH_TEXT, DASH_CLASH, NULL_ELEMENT_TEXT, NULL_FEATURES_TEXT,
                      OK_TEXT)
from plait.functions import NameCollisionError, safe_name
from plait.operators import (expand_struct, explode_rows, field, flatten, recombine, rename,
                             sanitize_names, schema_rows, split)
from plait.sources import parse_json


def _features(spark, *texts):
    df = spark.createDataFrame([(t,) for t in texts], "body string")
    parsed = parse_json(df, "body", BASE_DDL, alias="p").select("p.features")
    return explode_rows(parsed, "features")            # output named col, as Spark names it


def test_original_flow_columns(spark):
    df = _features(spark, OK_TEXT)
    assert df.columns == ["col"]
    wide = df.select("col.*", "*")
    assert wide.columns == ["type", "geometry", "properties", "col"]
    flat = wide.drop("col").drop("type")
    assert flat.columns == ["geometry", "properties"]
    coords = flat.select("geometry.*", field("properties.h3-index"))
    assert coords.columns == ["type", "coordinates", "h3-index"]   # geometry's own type survives
    coords = rename(coords, {"h3-index": "h3index", "absent": "x"})
    assert coords.columns == ["type", "coordinates", "h3index"]


def test_expand_struct_keeps_rest_and_refuses_clash(spark):
    df = _features(spark, OK_TEXT)
    out = expand_struct(df, "col")
    assert out.columns == ["type", "geometry", "properties"]
    clash = df.select("col", F.lit(1).alias("TYPE"))
    with pytest.raises(NameCollisionError):
        expand_struct(clash, "col")


def test_explode_semantics_null_and_empty(spark):
    df = spark.createDataFrame([(1, [1, 2]), (2, []), (3, None), (4, [None])], "id int, a array<int>")
    assert explode_rows(df, "a").count() == 3                      # [None] keeps its NULL element
    assert explode_rows(df, "a", outer=True).count() == 5
    pos = explode_rows(df, "a", position=True).orderBy("id", "pos").collect()
    assert [(r.id, r.pos, r.col) for r in pos] == [(1, 0, 1), (1, 1, 2), (4, 0, None)]
    po = explode_rows(df, "a", outer=True, position=True).where("id in (2, 3)").collect()
    assert all(r.pos is None and r.col is None for r in po)
    rebalanced = explode_rows(df, "a", rebalance=True)
    assert sorted(map(tuple, rebalanced.collect()), key=str) == sorted(map(tuple, explode_rows(df, "a").collect()), key=str)
    guarded = explode_rows(df, "a", guard_reparse=True)
    assert sorted(map(tuple, guarded.collect()), key=str) == sorted(map(tuple, explode_rows(df, "a").collect()), key=str)


def test_null_features_payloads(spark):
    df = _features(spark, NULL_FEATURES_TEXT, NULL_ELEMENT_TEXT)
    assert df.count() == 1 and df.first().col is None


def test_explode_map(spark):
    df = spark.createDataFrame([(1, {"a": 1, "b": 2}), (2, None)], "id int, m map<string,int>")
    assert explode_rows(df, "m").columns == ["id", "key", "value"]
    assert explode_rows(df, "m").count() == 2
    assert explode_rows(df, "m", outer=True).count() == 3
    assert explode_rows(df, "m", position=True).columns == ["id", "pos", "key", "value"]


def test_sanitize_nested_and_idempotent(spark):
    df = spark.createDataFrame([((("x", 1),),)], "`a-b` struct<`c d`: struct<`h3-index`: string, `n.m`: int>>")
    out = sanitize_names(df)
    assert out.schema.simpleString() == "struct<ab:struct<cd:struct<h3index:string,nm:int>>>"
    assert sanitize_names(out).schema == out.schema
    assert out.selectExpr("ab.cd.h3index").first()[0] == "x"


def test_sanitize_collisions_raise(spark):
    df = spark.createDataFrame([(DASH_CLASH["h3-index"], DASH_CLASH["h3index"])], "`h3-index` string, h3index string")
    with pytest.raises(NameCollisionError):
        sanitize_names(df)
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        case = spark.read.json(spark.createDataFrame([(CASE_CLASH_TEXT,)], "v string").rdd.map(lambda r: r.v))
        with pytest.raises(NameCollisionError):
            sanitize_names(case)
    finally:
        spark.conf.set("spark.sql.caseSensitive", "false")


def test_safe_name_rule():
    assert safe_name("h3-index") == "h3index"
    assert safe_name("order date") == "orderdate"
    assert safe_name("9lives") == "_9lives"


def test_flatten_explodes_named_arrays_only(spark):
    df = spark.createDataFrame([(OK_TEXT,), ('{"type": "x", "features": []}',)], "body string")
    docs = parse_json(df, "body", BASE_DDL, alias="p").select("p.*")
    flat = flatten(docs, explode=["features"])
    assert "features_properties_h3index" in flat.columns
    assert "features_geometry_coordinates" in flat.columns         # array kept, not exploded
    assert flat.count() == 3                                        # 2 features + 1 empty parent
    inner = flatten(docs, explode=["features"], outer=False)
    assert inner.count() == 2
    with pytest.raises(ValueError):
        flatten(docs, explode=["nope"])


def test_split_then_recombine_equals_unsplit(spark):
    df = _features(spark, OK_TEXT).select("col.*").drop("type")
    parts = split(df, {"coordinates": ["geometry.*"], "properties": ["properties.*"]},
                  key={"h3index": "properties.h3-index"}, persist=True)
    assert parts["coordinates"].columns == ["h3index", "type", "coordinates"]
    assert parts["properties"].columns == ["h3index", "routeId", "n"]
    joined = recombine(parts, "h3index")
    assert joined.count() == 2
    flat = df.select(field("properties.h3-index").alias("h3index"), "geometry.type", "geometry.coordinates",
                     "properties.routeId", "properties.n")
    assert sorted(map(tuple, joined.select(flat.columns).collect())) == sorted(map(tuple, flat.collect()))
    parts.release()


def test_schema_rows(spark):
    df = spark.createDataFrame([], BASE_DDL)
    rows = {r.path: r.type for r in schema_rows(df).collect()}
    assert rows["features[].properties.h3-index"] == "string"
    assert rows["features[].geometry.coordinates"].startswith("array")


def test_explode_nested_path_drops_its_root(spark):
    df = spark.createDataFrame([(1, ([1, 2], "x"))], "id int, doc struct<a: array<int>, t: string>")
    out = explode_rows(df, "doc.a", alias="v")
    assert out.columns == ["id", "v"] and out.count() == 2


def test_recombine_refuses_duplicate_keys(spark):
    import pytest as _pytest
    from plait.operators import DuplicateKeyError
    a = spark.createDataFrame([("k", 1), ("k", 2)], "key string, a int")
    b = spark.createDataFrame([("k", 3), ("k", 4)], "key string, b int")
    with _pytest.raises(DuplicateKeyError):
        recombine([a, b], "key")
    assert recombine([a, b.limit(1)], "key").count() == 2


def test_persisted_split_holds_no_executor_memory(spark):
    """Blocks in memory filled the executors once the parent outgrew them."""
    texts = [OK_TEXT.replace('"n"', f'"x{i}": 1, "n"') for i in range(200)]
    wide = _features(spark, *texts).select("col.*")
    parts = split(wide, {"coordinates": ["geometry.*"], "properties": ["properties.n", "properties.h3-index"]},
                  key={"h3index": "properties.h3-index"}, persist=True)
    held = {i.id() for i in spark.sparkContext._jsc.sc().getRDDStorageInfo()}
    assert parts.parent.count() == wide.count() == 400
    new = [i for i in spark.sparkContext._jsc.sc().getRDDStorageInfo() if i.id() not in held]
    assert sum(i.memSize() for i in new) == 0 and sum(i.diskSize() for i in new) > 0
    # only what the parts use is kept, as plain columns
    assert parts.parent.columns == ["properties.h3-index", "geometry.type", "geometry.coordinates", "properties.n"]
    plain = split(wide, {"coordinates": ["geometry.*"], "properties": ["properties.n", "properties.h3-index"]},
                  key={"h3index": "properties.h3-index"})
    for name, part in plain.items():
        assert parts[name].schema == part.schema
        assert sorted(map(str, parts[name].collect())) == sorted(map(str, part.collect()))
    parts.release()
