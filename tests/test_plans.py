"""Plan shape checks: the properties the design relies on at scale."""

from pyspark.sql import functions as F

from payloads import BASE_DDL, OK_TEXT
from plait.operators import explode_rows, split
from plait.sinks import merge_frames
from plait.sources import parse_json


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_guarded_explode_parses_once(spark):
    df = spark.createDataFrame([(OK_TEXT,)], "body string")
    parsed = parse_json(df, "body", BASE_DDL, alias="p").select(F.col("p.features").alias("f"))
    plain = explode_rows(parsed, "f")
    guarded = explode_rows(parsed, "f", guard_reparse=True)
    assert _optimized(plain).count("from_json") >= 2        # the pitfall: filter + project
    assert _optimized(guarded).count("from_json") == 1


def test_parquet_scan_prunes_nested_columns_through_explode(spark, workdir):
    df = spark.createDataFrame([(OK_TEXT,)], "body string")
    bronze = parse_json(df, "body", BASE_DDL, alias="p").select("p.*")
    bronze.write.parquet(workdir + "/bronze")
    back = spark.read.parquet(workdir + "/bronze")
    out = explode_rows(back.select("features"), "features", alias="f").select("f.properties.n")
    plan = _plan(out)
    assert "ReadSchema: struct<features:array<struct<properties:struct<n:bigint>>>>" in plan


def test_small_source_anti_join_is_broadcast(spark):
    big = spark.range(0, 200000).select(F.col("id").alias("k"), F.lit(1).alias("v"))
    small = spark.range(0, 10).select(F.col("id").alias("k"), F.lit(2).alias("v"))
    plan = _plan(merge_frames(big, small, "k"))
    assert "BroadcastHashJoin" in plan and "LeftAnti" in plan


def test_persisted_split_scans_once(spark):
    df = spark.createDataFrame([(OK_TEXT,)], "body string")
    feats = explode_rows(parse_json(df, "body", BASE_DDL, alias="p").select("p.features"), "features") \
        .select("col.*")
    parts = split(feats, {"a": ["geometry.*"], "b": ["properties.*"]}, key={"h3index": "properties.h3-index"},
                  persist=True)
    joined = parts["a"].join(parts["b"], "h3index")
    assert joined.count() == 2
    plan = _plan(joined)
    # both branches read the one cached parent (the text repeats its lineage
    # under each scan, but it is computed once)
    assert plan.count("InMemoryTableScan") == 2
    parts.release()


def test_upsert_and_history_scan_their_input_once(spark, workdir):
    import datetime as dt
    from plait.operators.history import scd2_history
    spark.range(0, 1000).select(F.col("id").alias("k"), F.when(F.col("id") % 3 == 0, None)
                                .otherwise(F.col("id")).alias("nk"), F.lit("a").alias("v")) \
        .write.parquet(workdir + "/target")
    target = spark.read.parquet(workdir + "/target")
    source = spark.range(990, 1010).select(F.col("id").alias("nk"), F.col("id").alias("k"), F.lit("b").alias("v"))
    merged = merge_frames(target, source, "nk")
    assert _plan(merged).count("FileScan parquet") == 1          # target read once, NULL keys salted
    assert merged.count() == 1000 - 6 + 20                         # 6 of 990..999 have non-NULL keys
    rows = [(u, dt.datetime(2024, 1, 1 + d % 20, d % 24), d, "ab"[d % 2]) for u in range(3) for d in range(60)]
    spark.createDataFrame(rows, "user_id bigint, ts timestamp_ntz, event_id bigint, state string") \
        .write.parquet(workdir + "/events")
    events = spark.read.parquet(workdir + "/events")
    hist = scd2_history(events, "user_id", ["ts", "event_id"], ["state"])
    hist.collect()
    assert _plan(hist).count("FileScan parquet") == 0               # reads its checkpoints only


def test_buckets_grow_with_the_rows(spark):
    """One bucket a core made every task sort a share that grew with the table."""
    from plait.plans import catalogue
    cores = spark.sparkContext.defaultParallelism
    assert catalogue._buckets(spark, 100) == cores
    assert catalogue._buckets(spark, 40 * catalogue.BUCKET_ROWS + 1) == 41
