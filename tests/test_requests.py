"""The request source, the call ledger, hot seconds in histories, and sketches."""

import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from plait.operators.history import scd2_history
from plait.operators.inspect import profile, profile_sketch, read_profile, unite_profiles
from plait.sources.fetch import CannedUserApi, fetch
from plait.sources.requests import RequestStreamReader, call_due, due_calls, ledger, read_requests, request_stream, write_round

CANNED = "plait.sources.fetch:CannedUserApi"


def asked(spark, keys):
    return spark.createDataFrame([(str(k), f"/u/{k}") for k in keys], "request_key string, url string")


def replies(df):
    return sorted((r.request_key, r.url, r.status, r.body) for r in df.collect())


def test_request_source_equals_fetch(spark, workdir):
    requests = asked(spark, range(600))
    write_round(requests, workdir, "0001", files=3)
    got = read_requests(spark, workdir, CANNED, concurrency="8")
    assert got.rdd.getNumPartitions() == 3
    assert replies(got) == replies(fetch(requests, CannedUserApi()))


def test_request_source_without_rounds_and_with_failing_calls(spark, workdir):
    assert read_requests(spark, workdir + "-none", CANNED).collect() == []
    write_round(asked(spark, ["x", 1]), workdir, "0001", files=1)
    got = {r.request_key: (r.status, r.body) for r in read_requests(spark, workdir, CANNED).collect()}
    assert got["x"][0] is None and "ValueError" in got["x"][1] and got["1"][0] == 200
    with pytest.raises(Exception, match="already exists|PATH_ALREADY_EXISTS"):
        write_round(asked(spark, [2]), workdir, "0001", files=1)


def test_request_stream_takes_only_new_rounds(spark, workdir):
    out, state = workdir + "-out", workdir + "-state"

    def run():
        query = request_stream(spark, workdir, CANNED).writeStream.format("parquet").option("path", out) \
            .option("checkpointLocation", state).trigger(availableNow=True).start()
        query.awaitTermination()
        return spark.read.parquet(out).count()

    write_round(asked(spark, range(10)), workdir, "0001", files=2)
    assert run() == 10
    assert run() == 10
    write_round(asked(spark, range(10, 14)), workdir, "0002", files=2)
    assert run() == 14


def test_stream_offsets_name_the_same_files_again(spark, workdir):
    for n in ("0001", "0002", "0003"):
        write_round(asked(spark, range(4)), workdir, n, files=2)
    reader = RequestStreamReader({"path": workdir, "fetcher": CANNED})
    assert reader.latestOffset() == {"round": "0003"}
    part = [f.uri for f in reader.partitions({"round": "0001"}, {"round": "0002"})]
    assert part and all("round=0002" in f for f in part)
    write_round(asked(spark, range(4)), workdir, "0004", files=2)
    assert part == [f.uri for f in reader.partitions({"round": "0001"}, {"round": "0002"})]


def test_ledger_calls_each_answered_key_once(spark, workdir):
    requests = asked(spark, [*range(20), 5]).union(spark.createDataFrame([(None, "/none")], "request_key string, url string"))
    monday, tuesday = date(2024, 1, 1), date(2024, 1, 2)
    assert call_due(requests, CannedUserApi(), workdir, monday, budget=12) == {"called": 12, "answered_keys": 10}
    assert call_due(requests, CannedUserApi(), workdir, monday, budget=12)["called"] == 0
    assert call_due(requests, CannedUserApi(), workdir, tuesday, budget=50) == {"called": 10, "answered_keys": 16}
    later = [call_due(requests, CannedUserApi(), workdir, date(2024, 1, d), budget=50)["called"] for d in (3, 4, 5, 6)]
    assert later == [4, 4, 2, 0]  # failed keys only, three times beyond the first
    calls = {r.request_key: r["count"] for r in ledger(spark, workdir).groupBy("request_key").count().collect()}
    assert calls == {str(k): 4 if k % 10 in (3, 7) else 1 for k in range(20)}


def test_new_keys_go_before_failed_ones(spark, workdir):
    call_due(asked(spark, [3, 13]), CannedUserApi(), workdir, date(2024, 1, 1))
    due = due_calls(asked(spark, [3, 13, 50, 60]), ledger(spark, workdir), date(2024, 1, 2), budget=3).collect()
    assert [r.request_key for r in due] == ["50", "60", "13"]


def plain_history(data):
    out = []
    for key in {k for k, *_ in data}:
        mine = sorted(r for r in data if r[0] == key)
        starts = [r for i, r in enumerate(mine) if i == 0 or mine[i - 1][3] != r[3]]
        out += [(key, r[3], r[2], i == len(starts) - 1) for i, r in enumerate(starts)]
    return sorted(out)


def test_history_of_one_key_in_one_second_is_spread(spark):
    dice = random.Random(2)
    data = [("hot", 1, i, dice.randint(0, 2)) for i in range(20000)] + [(f"k{i % 50}", i % 3, i, dice.randint(0, 2)) for i in range(2000)]
    df = spark.createDataFrame(data, "k string, sec long, id long, s long").withColumn("at", F.timestamp_seconds("sec"))
    got = scd2_history(df, "k", ["at", "id"], ["s"], carry={"start": "id"}, bucket_rows=1000)
    assert sorted((r.k, r.s, r.start, r.is_current) for r in got.collect()) == plain_history(data)
    from plait.operators.history import range_buckets
    sizes = [r["count"] for r in range_buckets(df, ["k"], ["at", "id"], 1000).groupBy("_b").count().collect()]
    assert len(sizes) > 15 and max(sizes) < 3 * sum(sizes) / len(sizes)


def test_united_sketches_equal_the_whole(spark):
    df = spark.range(0, 30000, 1, 4).select(
        "id", (F.col("id") % 900).cast("int").alias("few"), F.when(F.col("id") % 4 > 0, F.col("id") / 3).alias("x"),
        F.timestamp_seconds("id").alias("at"), F.array("id").alias("nested"), F.lit(None).cast("double").alias("none"))
    whole = {r.column_name: r for r in read_profile(unite_profiles(profile_sketch(df))).collect()}
    parts = profile_sketch(df.where("id < 9000")).union(profile_sketch(df.where("id >= 9000 AND id < 9001"))) \
        .union(profile_sketch(df.where("id > 9000"))).union(profile_sketch(df.where("false")))
    got = {r.column_name: r for r in read_profile(unite_profiles(parts)).collect()}
    assert set(got) == set(df.columns)
    for name, r in got.items():
        w = whole[name]
        assert (r.n_rows, r.n_nulls, r.n_distinct, r.low, r.high) == (w.n_rows, w.n_nulls, w.n_distinct, w.low, w.high)
    assert abs(got["id"].n_distinct - 30000) < 1500 and abs(got["few"].n_distinct - 900) < 45
    assert all(abs(q - e) < 600 for q, e in zip(got["id"].quantiles, (7500, 15000, 22500)))
    assert got["none"].quantiles is None and got["nested"].low is None


def test_exact_distinct_of_named_columns_multiplies_no_rows(spark):
    df = spark.range(1000).select("id", (F.col("id") % 7).alias("a"), F.when(F.col("id") > 900, F.col("id")).alias("b"))
    got = profile(df, exact_distinct=["a", "b"])
    assert {r.column_name: r.n_distinct for r in got.where("column_name <> 'id'").collect()} == {"a": 7, "b": 99}
    assert "Expand" not in got._jdf.queryExecution().executedPlan().toString()
