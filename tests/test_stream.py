from pyspark.sql import types as T

from plait.session import scratch_path, unique_name
from plait.sinks import table_spec
from plait.streaming import ingest_incremental

DDL = "event_id bigint, user_id bigint, value double"


def _land(spark, path, rows):
    spark.createDataFrame(rows, DDL).coalesce(1).write.mode("append").json(path)


def test_incremental_rounds_and_restart(spark):
    landing = scratch_path(spark, "landing")
    cp = scratch_path(spark, "cp")
    spec = table_spec("events", unique_name("ev"), "default", scratch_path(spark, "tbl"), key="event_id")
    schema = T.StructType.fromDDL(DDL)
    _land(spark, landing, [(i, i % 3, float(i)) for i in range(6)])
    ingest_incremental(spark, landing, schema, spec, cp, order=["value"], wait=True)
    assert spark.table(spec.qualified).count() == 6
    # second round: one new key and one changed key; only the new files are
    # read, in bounded batches of one file
    _land(spark, landing, [(6, 0, 6.0)])
    _land(spark, landing, [(2, 2, 20.0)])
    q = ingest_incremental(spark, landing, schema, spec, cp, order=["value"], wait=True,
                           max_files_per_trigger=1)
    assert len([p for p in q.recentProgress if p["numInputRows"] > 0]) == 2
    got = {r.event_id: r.value for r in spark.table(spec.qualified).collect()}
    assert len(got) == 7 and got[2] == 20.0
    # restart with nothing new: the table is unchanged
    ingest_incremental(spark, landing, schema, spec, cp, order=["value"], wait=True)
    assert spark.table(spec.qualified).count() == 7


def test_malformed_lines_go_to_quarantine(spark):
    landing = scratch_path(spark, "landing")
    import os
    os.makedirs(landing, exist_ok=True)
    with open(os.path.join(landing, "part-0.json"), "w") as f:
        f.write('{"event_id": 1, "user_id": 1, "value": 1.0}\n{bad\n')
    spec = table_spec("events", unique_name("ev"), "default", scratch_path(spark, "tbl"), key="event_id")
    q_spec = table_spec("quarantine", unique_name("q"), "default", scratch_path(spark, "tbl"))
    ingest_incremental(spark, landing, T.StructType.fromDDL(DDL), spec, scratch_path(spark, "cp"),
                       order=["value"], quarantine=q_spec, wait=True)
    assert spark.table(spec.qualified).count() == 1
    assert spark.table(q_spec.qualified).first()["_corrupt_record"] == "{bad"


def test_replayed_batch_changes_nothing(spark):
    from pyspark.sql import functions as F
    from plait.sources import CORRUPT
    from plait.streaming import batch_merger
    spec = table_spec("events", unique_name("ev"), "default", scratch_path(spark, "tbl"), key="event_id")
    merge = batch_merger(spec, order=["value"])
    batch = spark.createDataFrame([(i, i % 2, float(i)) for i in range(5)], DDL) \
        .withColumn(CORRUPT, F.lit(None).cast("string"))
    merge(batch, 0)
    first = sorted(map(tuple, spark.table(spec.qualified).collect()))
    merge(batch, 0)                                   # the same batch id again, after a failure
    spark.catalog.refreshTable(spec.qualified)
    assert sorted(map(tuple, spark.table(spec.qualified).collect())) == first


def test_many_files_two_rounds_bounded_batches(spark):
    import json
    import os
    landing = scratch_path(spark, "landing")
    os.makedirs(landing, exist_ok=True)

    def land_file(i):
        with open(os.path.join(landing, f"reply-{i:02d}.json"), "w") as f:
            for j in range(3):
                f.write(json.dumps({"event_id": i * 10 + j, "user_id": i, "value": float(j)}) + "\n")

    cp = scratch_path(spark, "cp")
    spec = table_spec("events", unique_name("ev"), "default", scratch_path(spark, "tbl"), key="event_id")
    schema = T.StructType.fromDDL(DDL)
    for i in range(10):
        land_file(i)
    ingest_incremental(spark, landing, schema, spec, cp, order=["value"], wait=True, max_files_per_trigger=4)
    assert spark.table(spec.qualified).count() == 30
    for i in range(10, 20):
        land_file(i)
    q = ingest_incremental(spark, landing, schema, spec, cp, order=["value"], wait=True, max_files_per_trigger=4)
    assert [p["numInputRows"] for p in q.recentProgress if p["numInputRows"] > 0] == [12, 12, 6]
    assert spark.table(spec.qualified).count() == 60
    q = ingest_incremental(spark, landing, schema, spec, cp, order=["value"], wait=True)   # restart
    assert all(p["numInputRows"] == 0 for p in q.recentProgress)
    assert spark.table(spec.qualified).count() == 60


def test_incremental_type2_history(spark):
    import datetime as dt
    from pyspark.sql import functions as F
    from plait.operators.history import scd2_history
    ddl = "event_id bigint, user_id bigint, ts timestamp_ntz, state string"
    rows = [(u * 100 + h, u, dt.datetime(2024, 1, 1, h), "ab"[(h // 4 + u) % 2]) for u in range(5) for h in range(24)]
    df = spark.createDataFrame(rows, ddl)
    landing, cp = scratch_path(spark, "landing"), scratch_path(spark, "cp")
    spec = table_spec("hist", unique_name("hist"), "default", scratch_path(spark, "tbl"))
    for part in (df.where("hour(ts) < 12"), df.where("hour(ts) >= 12")):
        part.coalesce(1).write.mode("append").option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss").json(landing)
        ingest_incremental(spark, landing, T.StructType.fromDDL(ddl), spec, cp, key="user_id",
                           history=(["ts", "event_id"], ["state"]), wait=True)
    expected = scd2_history(df, "user_id", ["ts", "event_id"], ["state"], carry={"event_id": "event_id"})
    got = spark.table(spec.qualified).select(expected.columns)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, expected.collect()), key=str)
