import json

from pyspark.sql import functions as F
from pyspark.sql import types as T

from payloads import (BASE_DDL, EMPTY_TEXT, ERROR_TEXT, MALFORMED_TEXT, MIXED_TEXT, OK_TEXT,
                      PRETTY_TEXT, RAW_GEOMETRY_DDL, TOP_ARRAY_TEXT)
from plait.operators import explode_rows
from plait.sources import (CORRUPT, CannedUserApi, fetch, geometry_columns, infer_file_schema,
                           infer_schema, parse_json, read_payloads, split_valid)


def _bodies(spark, *texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, body string")


def test_parse_declared_schema_and_corrupt_split(spark):
    df = parse_json(_bodies(spark, OK_TEXT, MALFORMED_TEXT), "body", BASE_DDL, alias="p")
    valid, bad = split_valid(df)
    assert valid.count() == 1 and bad.count() == 1
    row = bad.select(CORRUPT, "reason").first()
    assert row[CORRUPT] == MALFORMED_TEXT and row["reason"] == "malformed"
    n = explode_rows(valid.select("p.features"), "features").count()
    assert n == 2


def test_error_and_empty_payloads_give_empty_typed_result(spark):
    df = parse_json(_bodies(spark, ERROR_TEXT, EMPTY_TEXT), "body", BASE_DDL, alias="p")
    valid, bad = split_valid(df)
    assert bad.count() == 0
    out = explode_rows(valid.select("p.features"), "features")
    assert out.count() == 0
    assert out.schema["col"].dataType.simpleString().startswith("struct<type:string,geometry")


def test_read_payloads_pretty_and_top_array(spark, workdir):
    import os
    os.makedirs(workdir, exist_ok=True)
    with open(f"{workdir}/pretty.json", "w") as f:
        f.write(PRETTY_TEXT)
    with open(f"{workdir}/array.json", "w") as f:
        f.write(TOP_ARRAY_TEXT)
    one = read_payloads(spark, f"{workdir}/pretty.json", BASE_DDL, multi_line=True)
    assert one.count() == 1
    two = read_payloads(spark, f"{workdir}/array.json", BASE_DDL, multi_line=True)
    assert two.count() == 2
    # (a query that reads only the corrupt column of a raw file scan is refused by Spark)
    assert all(r[CORRUPT] is None for r in two.collect())


def test_infer_schema_from_column_and_files(spark, workdir):
    df = _bodies(spark, OK_TEXT, MALFORMED_TEXT)
    s = infer_schema(df, "body")
    feat = s["features"].dataType.elementType
    assert feat["properties"].dataType["h3-index"].dataType == T.StringType()
    assert feat["properties"].dataType["n"].dataType == T.LongType()
    coords = feat["geometry"].dataType["coordinates"].dataType
    assert coords == T.ArrayType(T.ArrayType(T.ArrayType(T.DoubleType())))
    spark.createDataFrame([(OK_TEXT,)], "value string").write.text(f"{workdir}/lines")
    fs = infer_file_schema(spark, f"{workdir}/lines")
    assert "features" in fs.fieldNames()


def test_inference_corrupts_mixed_geometry_but_raw_string_is_lossless(spark):
    df = _bodies(spark, MIXED_TEXT)
    inferred = infer_schema(df, "body")
    coords = inferred["features"].dataType.elementType["geometry"].dataType["coordinates"].dataType
    assert coords != T.ArrayType(T.ArrayType(T.ArrayType(T.DoubleType())))  # not the Polygon type
    parsed = parse_json(df, "body", RAW_GEOMETRY_DDL, alias="p")
    feats = explode_rows(parsed.select("p.features"), "features", alias="f").select("f.*")
    out = geometry_columns(feats).orderBy("properties.h3-index").collect()
    assert out[0]["polygon_coordinates"] == [[[1.5, 2.0], [3.0, 4.0]]]
    assert out[0]["multipolygon_coordinates"] is None
    assert out[1]["multipolygon_coordinates"] == [[[[5.0, 6.0], [7.5, 8.0]]], [[[9.0, 10.0]]]]


def test_fetch_with_canned_api_and_status_quarantine(spark):
    reqs = spark.createDataFrame([(k, f"/zip/{k}") for k in (1, 3, 7, 12)], "request_key int, url string")
    resp = fetch(reqs, CannedUserApi(), partitions=2)
    got = {r["request_key"]: r["status"] for r in resp.collect()}
    assert got == {"1": 200, "3": 403, "7": 500, "12": 200}
    parsed = parse_json(resp, "body", "features array<struct<properties: struct<`user-id`: bigint>>>",
                        alias="reply")
    valid, bad = split_valid(parsed, status="status")
    assert sorted(r.request_key for r in valid.collect()) == ["1", "12"]
    assert sorted(r.reason for r in bad.collect()) == ["status 403", "status 500"]


def test_fetch_failure_is_a_row_not_a_crash(spark):
    def broken(key, url):
        raise TimeoutError("slow")
    reqs = spark.createDataFrame([("a", "/x")], "request_key string, url string")
    row = fetch(reqs, broken).first()
    assert row.status is None and json.loads(row.body)["error"] == "TimeoutError"


def test_read_payloads_json_lines_with_file_name(spark, workdir):
    import os
    os.makedirs(workdir + "/jl", exist_ok=True)
    for i in range(3):
        with open(f"{workdir}/jl/part-{i}.json", "w") as f:
            f.write(OK_TEXT + "\n" + MALFORMED_TEXT + "\n")
    df = read_payloads(spark, workdir + "/jl", BASE_DDL, file_name="source_file").cache()
    valid, bad = split_valid(df)
    assert valid.count() == 3 and bad.count() == 3
    assert {r.source_file.rsplit("/", 1)[-1] for r in bad.collect()} == {f"part-{i}.json" for i in range(3)}


def test_fetch_concurrency_keeps_every_reply(spark):
    import time as _time

    def slow(key, url):
        _time.sleep(0.1)
        return 200, json.dumps({"key": key})

    reqs = spark.range(0, 40).select(F.col("id").cast("string").alias("request_key"),
                                     F.concat(F.lit("/k/"), F.col("id").cast("string")).alias("url"))

    def run(concurrency):
        t0 = _time.time()
        rows = fetch(reqs, slow, partitions=2, concurrency=concurrency).collect()
        return _time.time() - t0, rows

    sequential, _ = run(1)                       # 20 calls of 0.1 s per task
    overlapped, rows = run(8)
    assert overlapped < sequential - 1.0         # calls overlapped inside each task
    assert sorted(json.loads(r.body)["key"] for r in rows) == sorted(str(i) for i in range(40))
    assert all(r.request_key == json.loads(r.body)["key"] for r in rows)


def test_landed_lines_are_compressed_and_read_back_whole(spark):
    """Landed JSON Lines were plain text."""
    from plait.plans import catalogue
    sf = "/root/testdata/sf0.001"
    bronze = catalogue.order_bronze(spark, sf)
    files = bronze.sparkSession.read.format("binaryFile").load(
        f"{catalogue.shared_dir(spark)}/plait/replies/orders-jsonl-{catalogue._landing_key(spark, sf)}/part-*")
    assert files.where("path NOT LIKE '%.txt.gz'").isEmpty()
    assert bronze.count() == catalogue.order_replies(spark, sf).count() == files.sparkSession.read.text(
        [r.path for r in files.select("path").collect()]).count()


def test_landing_reads_in_tasks_of_bounded_rows(spark, workdir, monkeypatch):
    """Splits were cut by bytes alone: a well compressed table was read, shuffled and spilled by few tasks."""
    import os
    import pyarrow.parquet as pq
    from plait.plans import catalogue
    from plait.sources import files
    os.makedirs(workdir)
    for t in ("orders", "lineitem"):
        pq.write_table(pq.read_table(f"/root/testdata/sf0.001/{t}.parquet"), f"{workdir}/{t}.parquet", row_group_size=250)
    monkeypatch.setattr(files, "SPLIT_ROWS", 1000, raising=False)
    sizes, build = [], catalogue.order_bodies

    def recorded(orders, lineitem):
        sizes.append(lineitem.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect())
        return build(orders, lineitem)

    monkeypatch.setattr(catalogue, "order_bodies", recorded)
    held = spark.conf.get("spark.sql.files.maxPartitionBytes")
    replies = catalogue.order_replies(spark, workdir)
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == held
    rows = spark.read.parquet(f"{workdir}/lineitem.parquet").count()
    assert sum(sizes[0]) == rows and max(sizes[0]) <= 2 * 1000 < rows
    monkeypatch.undo()
    whole = catalogue.order_replies(spark, "/root/testdata/sf0.001")
    assert replies.exceptAll(whole).isEmpty() and whole.exceptAll(replies).isEmpty()
