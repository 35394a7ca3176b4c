import datetime as dt
import random

from pyspark.sql import functions as F

from plait.operators.history import scd2_history


def brute_force(rows):
    """Versions per key by walking each key's rows in order (plain Python)."""
    out = []
    by_key = {}
    for r in rows:
        by_key.setdefault(r[0], []).append(r)
    for k, rs in by_key.items():
        rs.sort(key=lambda r: (r[1], r[2]))
        starts = [r for i, r in enumerate(rs) if i == 0 or rs[i - 1][3] != r[3]]
        for i, r in enumerate(starts):
            nxt = starts[i + 1][1] if i + 1 < len(starts) else None
            out.append((k, r[3], r[2], r[1], nxt, nxt is None))
    return sorted(out, key=str)


def test_scd2_matches_brute_force_with_a_hot_key(spark):
    rnd = random.Random(7)
    base = dt.datetime(2024, 1, 1)
    rows = []
    for eid in range(3000):
        user = 1 if rnd.random() < 0.4 else rnd.randint(2, 30)       # user 1 holds ~40% of rows
        ts = base + dt.timedelta(minutes=rnd.randint(0, 60 * 24 * 20))
        rows.append((user, ts, eid, rnd.choice(["a", "b", "c"])))
    df = spark.createDataFrame(rows, "user_id bigint, ts timestamp_ntz, event_id bigint, state string")
    got = scd2_history(df, "user_id", ["ts", "event_id"], ["state"], carry={"start_event_id": "event_id"})
    assert got.columns == ["user_id", "state", "start_event_id", "valid_from", "valid_to", "is_current"]
    assert sorted(map(tuple, got.collect()), key=str) == brute_force(rows)
    # hourly buckets give the same history
    hourly = scd2_history(df, "user_id", ["ts", "event_id"], ["state"], carry={"start_event_id": "event_id"},
                          bucket=F.date_trunc("hour", F.col("ts").cast("timestamp")))
    assert sorted(map(tuple, hourly.collect()), key=str) == brute_force(rows)


def test_scd2_current_rows_equal_latest_state(spark):
    rows = [(1, dt.datetime(2024, 1, d), d, s) for d, s in [(1, "a"), (2, "a"), (3, "b"), (5, "a")]]
    df = spark.createDataFrame(rows, "user_id bigint, ts timestamp_ntz, event_id bigint, state string")
    got = scd2_history(df, "user_id", ["ts", "event_id"], ["state"])
    cur = got.where("is_current").collect()
    assert len(cur) == 1 and cur[0].state == "a" and cur[0].valid_from == dt.datetime(2024, 1, 5)
    assert got.count() == 3


def test_scd2_load_in_two_batches_equals_one_pass(spark):
    from plait.session import scratch_path, unique_name
    from plait.sinks import scd2_load, table_spec
    rnd = random.Random(11)
    base = dt.datetime(2024, 1, 1)
    rows = [(rnd.randint(1, 8), base + dt.timedelta(hours=rnd.randint(0, 24 * 10)), eid,
             rnd.choice(["a", "b"])) for eid in range(400)]
    ddl = "user_id bigint, ts timestamp_ntz, event_id bigint, state string"
    df = spark.createDataFrame(rows, ddl)
    cut = base + dt.timedelta(days=5)
    spec = table_spec("hist", unique_name("hist"), "default", scratch_path(spark, "hist"))
    args = dict(key="user_id", order=["ts", "event_id"], tracked=["state"])
    scd2_load(df.where(F.col("ts") < F.lit(cut)), spec, **args)
    m = scd2_load(df.where(F.col("ts") >= F.lit(cut)), spec, **args)
    assert m["late_rows"] == 0
    one_pass = scd2_history(df, "user_id", ["ts", "event_id"], ["state"], carry={"event_id": "event_id"})
    got = spark.table(spec.qualified)
    assert sorted(map(tuple, got.select(one_pass.columns).collect()), key=str) == \
        sorted(map(tuple, one_pass.collect()), key=str)
    # replaying the second batch changes nothing (rows before the current
    # version start are reported as not applied)
    again = scd2_load(df.where(F.col("ts") >= F.lit(cut)), spec, **args)
    assert 0 < again["late_rows"] <= df.where(F.col("ts") >= F.lit(cut)).count()
    got = spark.table(spec.qualified)
    assert sorted(map(tuple, got.select(one_pass.columns).collect()), key=str) == \
        sorted(map(tuple, one_pass.collect()), key=str)


def test_current_versions_equal_latest_state(spark):
    from plait.operators import dedupe_latest
    rnd = random.Random(3)
    base = dt.datetime(2024, 1, 1)
    rows = [(rnd.randint(1, 12), base + dt.timedelta(minutes=rnd.randint(0, 9000)), eid,
             rnd.choice(["a", "b", "c"])) for eid in range(500)]
    df = spark.createDataFrame(rows, "user_id bigint, ts timestamp_ntz, event_id bigint, state string")
    current = scd2_history(df, "user_id", ["ts", "event_id"], ["state"]).where("is_current")
    latest = dedupe_latest(df, "user_id", ["ts", "event_id"])
    assert sorted(map(tuple, current.select("user_id", "state").collect())) == \
        sorted(map(tuple, latest.select("user_id", "state").collect()))


def test_scd2_load_partition_scoped(spark):
    from plait.session import scratch_path, unique_name
    from plait.sinks import scd2_load, table_spec
    base = dt.datetime(2024, 1, 1)
    rows = [(u, u % 4, base + dt.timedelta(hours=h), u * 1000 + h, "ab"[(h // 3) % 2])
            for u in range(12) for h in range(24)]
    ddl = "user_id bigint, ub int, ts timestamp_ntz, event_id bigint, state string"
    df = spark.createDataFrame(rows, ddl)
    spec = table_spec("hist", unique_name("hist"), "default", scratch_path(spark, "hist"),
                      partition_by="ub")
    args = dict(key=["ub", "user_id"], order=["ts", "event_id"], tracked=["state"])
    first, second = df.where("hour(ts) < 12"), df.where("hour(ts) >= 12 AND ub = 1")
    scd2_load(first, spec, **args)
    m = scd2_load(second, spec, **args)
    assert m["partitions_rewritten"] == 1 and m["late_rows"] == 0
    expected = scd2_history(first.unionByName(second), ["ub", "user_id"], ["ts", "event_id"], ["state"],
                            carry={"event_id": "event_id"})
    got = spark.table(spec.qualified)
    assert sorted(map(tuple, got.select(expected.columns).collect()), key=str) == \
        sorted(map(tuple, expected.collect()), key=str)


def test_scd2_cuts_a_full_day_of_one_key(spark):
    """A load of one day in which one key, and the NULL key, hold most rows."""
    from plait.operators.history import day_buckets
    rnd = random.Random(3)
    base = dt.datetime(2024, 1, 1)
    rows = [(rnd.choice([1, 1, None, rnd.randint(2, 9)]), base + dt.timedelta(seconds=rnd.randint(0, 5000)), eid,
             rnd.choice("ab")) for eid in range(3000)]
    df = spark.createDataFrame(rows, "user_id bigint, ts timestamp_ntz, event_id bigint, state string")
    got = scd2_history(df, "user_id", ["ts", "event_id"], ["state"], carry={"start_event_id": "event_id"}, bucket_rows=100)
    assert sorted(map(tuple, got.collect()), key=str) == brute_force(rows)
    sizes = [r["count"] for r in day_buckets(df, ["user_id"], "ts", 100).groupBy("user_id", "_b").count().collect()]
    assert sum(sizes) == 3000 and max(sizes) < 120


def test_scd2_without_rows(spark):
    df = spark.createDataFrame([], "user_id bigint, ts timestamp_ntz, event_id bigint, state string")
    assert scd2_history(df, "user_id", ["ts", "event_id"], ["state"], bucket_rows=1).count() == 0
