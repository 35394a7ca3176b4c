"""The query catalogue: one function per surveyed operator, each taking
``(spark, sf_dir)`` and returning a DataFrame over the driver's tables.

Every query reads whole tables.  Nested payloads are derived from the flat
tables by Spark (``sources.documents``): one JSON reply per order page, the
order as document properties and its lines as ``features``.
"""

from __future__ import annotations

import hashlib
import math
import os
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.steps import last_observation, step
from ..operators.conform import conform
from ..operators.generate import explode_rows
from ..operators.history import scd2_history
from ..operators.inspect import first_rows, profile, profile_sketch, read_profile, schema_rows, unite_profiles
from ..operators.keys import dedupe_latest, key_report
from ..operators.variants import geometry_parts, path_values
from ..operators.reshape import expand_struct, flatten, recombine, rename, sanitize_names, split
from ..session import scratch_path, shared_dir, unique_name
from ..sinks.layout import cluster_table, pruning, zorder
from ..sinks.tables import (append, drop, load, merge_frames, read, register, replace, scd2_load,
                            table_spec, upsert, write_path)
from ..sources.documents import DEFAULT_PAGE_SIZE, ORDER_DOCUMENT_DDL, order_bodies
from ..sources.fetch import CannedUserApi, fetch, land
from ..sources.requests import call_due, ledger, read_requests, request_stream, write_round
from ..sources.files import input_signature, land_once, read_table
from ..sources.payloads import (CORRUPT, geometry_columns, infer_schema, parse_json, read_payloads,
                                split_valid)
from ..streaming.incremental import ingest_incremental
from ..streaming.metrics import BatchMetrics, observed

# The cut-over dates that make an upsert batch overlap its
# target (orders) and the second landing round overlap the first (events).
TARGET_BEFORE = "1999-01-01"
SOURCE_FROM = "1998-01-01"
ROUND_ONE_BEFORE = "2024-01-16"
ROUND_TWO_FROM = "2024-01-15"
# bump when the reply builder changes, so landed replies are rebuilt
REPLY_FORMAT = 4


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, os.path.join(sf_dir, f"{name}.parquet"))


def order_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw order replies ``doc_key, body`` (JSON text), landed once per input
    version in the shared folder, as fetched replies would be."""
    target = f"{shared_dir(spark)}/plait/replies/orders-{_landing_key(spark, sf_dir)}"
    land_once(spark, lambda: _order_bodies(spark, sf_dir), target, compression="zstd", inputs=_order_inputs(sf_dir))
    return read_table(spark, target)


def _order_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the tables are read as they lie: the builder spreads them by key at once,
    # so spreading a file of few splits before would be a second shuffle
    return order_bodies(*(spark.read.parquet(path) for path in _order_inputs(sf_dir)))


def _order_inputs(sf_dir: str) -> list[str]:
    return [os.path.join(sf_dir, f"{t}.parquet") for t in ("orders", "lineitem")]


def _landing_key(spark: SparkSession, sf_dir: str) -> str:
    inputs = _order_inputs(sf_dir)
    fmt = hashlib.sha256(f"{REPLY_FORMAT}|{DEFAULT_PAGE_SIZE}|{ORDER_DOCUMENT_DDL}".encode()).hexdigest()[:8]
    return f"{fmt}-{input_signature(spark, inputs)}"


def order_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replies landed as JSON Lines files (gzip; a file holds the documents of
    one task, a bounded number), read with the declared schema (PERMISSIVE)
    and written once as typed, nested Parquet ("bronze"), so later queries
    read only the nested columns they use."""
    key = _landing_key(spark, sf_dir)
    files = f"{shared_dir(spark)}/plait/replies/orders-jsonl-{key}"
    bronze = f"{shared_dir(spark)}/plait/bronze/orders-{key}"
    land_once(spark, lambda: _order_bodies(spark, sf_dir).select("body"), files, fmt="text", compression="gzip",
              inputs=_order_inputs(sf_dir))
    land_once(spark, lambda: read_payloads(spark, files, ORDER_DOCUMENT_DDL), bronze, compression="zstd")
    return spark.read.parquet(bronze)


def order_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parsed order replies: ``doc_key, doc, _corrupt_record``."""
    return parse_json(order_replies(spark, sf_dir), "body", ORDER_DOCUMENT_DDL, alias="doc", keep=False)


def order_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The original notebook flow up to the split: explode ``features`` (output
    ``col``), star-expand it next to the rest, drop ``col`` and ``type``.

    Each feature gets ``featurekey`` = document key / position: the identity
    of a feature in its reply.  ``line-key`` is a property of the data and
    may repeat (the same line can arrive twice), so it cannot be the key the
    split tables are joined back on."""
    docs = order_docs(spark, sf_dir).select("doc_key", F.col("doc.features").alias("features"))
    exploded = explode_rows(docs, "features", alias="col", keep=["doc_key"], position=True,
                            guard_reparse=True)
    exploded = (exploded.withColumn("featurekey", F.concat_ws("/", "doc_key", F.col("pos").cast("string")))
                .drop("doc_key", "pos"))
    return expand_struct(exploded, "col", keep=True).drop("type")


def feature_split(spark: SparkSession, sf_dir: str, persist: bool = False):
    return split(order_features(spark, sf_dir),
                 {"measures": ["measures.*"], "lines": ["properties.*"]},
                 key={"featurekey": "featurekey"}, persist=persist)


# -- sources --------------------------------------------------------------

def q01_parse_json(spark, sf_dir):
    e = parse_json(table(spark, sf_dir, "events"), "props", "k int", alias="p")
    return e.select("event_id", "user_id", "event_type", F.col("p.k").alias("k"))


def q02_infer_schema(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    schema = infer_schema(e, "props")
    parsed = parse_json(e, "props", schema, alias="p")
    return parsed.select("event_id", F.col("p.k").alias("k"))


# -- generators -----------------------------------------------------------

def q03_explode(spark, sf_dir):
    v = table(spark, sf_dir, "embeddings")
    out = explode_rows(v, "embedding", alias="value", keep=["vec_id", "label"])
    return out.withColumn("value", F.col("value").cast("double"))


def q04_posexplode(spark, sf_dir):
    v = table(spark, sf_dir, "embeddings")
    out = explode_rows(v, "embedding", alias="value", position=True, keep=["vec_id"])
    return out.select("vec_id", F.col("pos").cast("bigint").alias("pos"),
                      F.col("value").cast("double").alias("value"))


def q05_explode_outer(spark, sf_dir):
    docs = order_docs(spark, sf_dir).select(
        F.col("doc.properties.`order-key`").alias("order_key"), F.col("doc.features").alias("features"))
    out = explode_rows(docs, "features", alias="f", outer=True)
    return out.select("order_key", F.col("f.properties.`line-no`").alias("line_no"),
                      F.col("f.properties.`part-key`").alias("part_key"),
                      F.col("f.measures.quantity").alias("quantity"),
                      F.col("f.properties.`ship-date`").alias("ship_date"))


def q06_posexplode_outer(spark, sf_dir):
    docs = order_docs(spark, sf_dir).select(
        F.col("doc.properties.`order-key`").alias("order_key"),
        F.split("doc_key", "/").getItem(1).cast("int").alias("page"),
        F.col("doc.features").alias("features"))
    out = explode_rows(docs, "features", alias="f", outer=True, position=True)
    return out.select("order_key", "page", F.col("pos").cast("bigint").alias("pos"),
                      F.col("f.properties.`line-no`").alias("line_no"),
                      F.col("f.properties.`part-key`").alias("part_key"),
                      F.col("f.properties.`supp-key`").alias("supp_key"))


# -- projections ----------------------------------------------------------

def q07_expand_struct(spark, sf_dir):
    docs = order_docs(spark, sf_dir).select("doc.*")
    flat = expand_struct(docs, "properties", keep=True).drop("features", "type")
    # every page of an order repeats the order's properties
    return sanitize_names(flat).dropDuplicates(["orderkey"])


def q08_flatten(spark, sf_dir):
    docs = order_docs(spark, sf_dir).select("doc.*")
    return flatten(docs, explode=["features"])


def q09_split_measures(spark, sf_dir):
    return feature_split(spark, sf_dir)["measures"]


def q10_split_lines(spark, sf_dir):
    return feature_split(spark, sf_dir)["lines"]


def q11_recombine(spark, sf_dir):
    """Split, store both narrow tables (one parse: the parent is persisted
    while both are written), then join the stored tables late."""
    parts = feature_split(spark, sf_dir, persist=True)
    specs = {}
    try:
        buckets = _buckets(spark, parts.parent.count())     # this also fills the persisted parent
        for name, part in parts.items():
            specs[name] = table_spec(name, unique_name(f"t_{name}"), "default",
                                     scratch_path(spark, "tables", name), key=("featurekey",),
                                     buckets=buckets)
            replace(part, specs[name])
    finally:
        parts.release()
    return recombine({n: spark.table(s.qualified) for n, s in specs.items()}, "featurekey", "inner")


def q12_sanitize_sql(spark, sf_dir):
    clean = sanitize_names(order_docs(spark, sf_dir).select("doc"))
    view = unique_name("vw_docs")
    clean.createOrReplaceTempView(view)
    return spark.sql(f"""
        SELECT doc.properties.orderkey AS orderkey, f.properties.linekey AS linekey,
               f.measures.extendedprice AS extendedprice, f.properties.shipdate AS shipdate
        FROM {view} LATERAL VIEW OUTER posexplode(doc.features) t AS pos, f
        WHERE pos IS NOT NULL""")  # = explode(doc.features), without a second parse


# -- keys and merge -------------------------------------------------------

def _orders_batches(spark, sf_dir, null_keys: bool = False):
    o = table(spark, sf_dir, "orders")
    if null_keys:
        o = o.withColumn("o_orderkey", F.when(F.col("o_orderpriority") == "5-LOW", F.lit(None))
                         .otherwise(F.col("o_orderkey")))
    target = o.where(F.col("o_orderdate") < F.lit(TARGET_BEFORE).cast("timestamp_ntz"))
    source = (o.where(F.col("o_orderdate") >= F.lit(SOURCE_FROM).cast("timestamp_ntz"))
              .withColumn("o_totalprice", F.col("o_totalprice") * 2))
    return target, source


def q13_upsert(spark, sf_dir):
    target, source = _orders_batches(spark, sf_dir)
    return merge_frames(target, source, "o_orderkey")


def q14_dedupe_latest(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return dedupe_latest(li, ["l_orderkey", "l_linenumber"],
                         ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"])


def q15_scd2_history(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return scd2_history(e, "user_id", ["ts", "event_id"], ["event_type"],
                        carry={"start_event_id": "event_id"})


def q16_key_report(spark, sf_dir):
    return key_report(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def q17_upsert_null_keys(spark, sf_dir):
    target, source = _orders_batches(spark, sf_dir, null_keys=True)
    return merge_frames(target, source, "o_orderkey")


# -- fetch, quarantine ----------------------------------------------------

def q18_fetch(spark, sf_dir):
    users = table(spark, sf_dir, "events").select("user_id").distinct()
    requests = users.select(F.col("user_id").alias("request_key"),
                            F.concat(F.lit("/users/"), F.col("user_id").cast("string")).alias("url"))
    responses = fetch(requests, CannedUserApi(), partitions=_parallelism(spark))
    # land the replies once: parsing (and any retry) never calls the API again
    landed = scratch_path(spark, "replies", "users")
    land(responses, landed)
    parsed = parse_json(read_table(spark, landed), "body",
                        "features array<struct<properties: struct<`user-id`: bigint>>>", alias="reply")
    accepted = F.col("status").isin(200) & F.col(CORRUPT).isNull()
    return parsed.select(F.col("request_key").cast("bigint").alias("request_key"), "status",
                         accepted.alias("accepted"),
                         F.when(accepted, F.col("reply.features").getItem(0).getField("properties")
                                .getField("user-id")).alias("body_user"))


def q19_corrupt_capture(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    damaged = e.withColumn("props", F.when(F.col("event_type") == "error", F.concat(F.lit("{bad"), F.col("props")))
                           .otherwise(F.col("props")))
    parsed = parse_json(damaged, "props", "k int", alias="p")
    return parsed.select("event_id", F.col("p.k").alias("k"), F.col(CORRUPT).isNotNull().alias("is_corrupt"))


# -- tables ---------------------------------------------------------------

def _parallelism(spark) -> int:
    """One unit of work per core of the cluster (bucket count, fetch width)."""
    try:
        return max(1, spark.sparkContext.defaultParallelism)
    except Exception:
        return int(spark.conf.get("spark.sql.shuffle.partitions"))


#: Rows that one task sorts into its bucket.
BUCKET_ROWS = 250_000


def _buckets(spark, rows: int) -> int:
    """A bucket is written and joined by one task: their number grows with the rows."""
    return max(_parallelism(spark), math.ceil(rows / BUCKET_ROWS))


def _spec(spark, label, buckets: int = 0):
    name = unique_name(f"t_{label}")
    return table_spec(label, name, "default", scratch_path(spark, "tables", label), key=("o_orderkey",),
                      buckets=buckets)


def q20_load_twice(spark, sf_dir):
    target, source = _orders_batches(spark, sf_dir)
    spec = _spec(spark, "orders", buckets=_buckets(spark, target.count()))
    load(target, spec)            # creates, bucketed by key
    load(source, spec)            # merges: only the source is shuffled
    return spark.table(spec.qualified)


def q21_replace(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    spec = _spec(spark, "orders_replace")
    replace(o.where(F.col("o_orderstatus") == "F"), spec)
    drop(spark, spec)
    replace(o, spec)
    return spark.table(spec.qualified)


EVENT_DDL = ("event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
             "value double, props string, round int")
NTZ_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def q22_incremental(spark, sf_dir):
    """Land events as JSON in two overlapping rounds; each availableNow run
    merges only new files into a day-partitioned table keyed by
    (event_date, event_id), so a batch rewrites only the days it touches."""
    e = table(spark, sf_dir, "events")
    landing = scratch_path(spark, "landing", "events")
    checkpoint = scratch_path(spark, "checkpoint", "events")
    spec = table_spec("events", unique_name("t_events"), "default",
                      scratch_path(spark, "tables", "events"), key=("event_date", "event_id"),
                      partition_by="event_date")
    round_one = e.where(F.col("ts") < F.lit(ROUND_ONE_BEFORE).cast("timestamp_ntz")).withColumn("round", F.lit(1))
    round_two = (e.where(F.col("ts") >= F.lit(ROUND_TWO_FROM).cast("timestamp_ntz"))
                 .withColumn("value", F.col("value") + 1).withColumn("round", F.lit(2)))
    import pyspark.sql.types as T
    schema = T.StructType.fromDDL(EVENT_DDL)
    with_day = lambda df: df.withColumn("event_date", F.to_date("ts"))
    for batch in (round_one, round_two):
        batch.write.mode("append").option("timestampNTZFormat", NTZ_FORMAT).json(landing)
        ingest_incremental(spark, landing, schema, spec, checkpoint, order=["round", "ts"],
                           transform=with_day, wait=True)
    return spark.table(spec.qualified).drop("round", "event_date")


# -- inspection, hooks, layout, conformance, maps --------------------------

def q23_profile(spark, sf_dir):
    return profile(table(spark, sf_dir, "orders"), exact_distinct=True)


def q24_first_rows(spark, sf_dir):
    return first_rows(table(spark, sf_dir, "orders"), [F.col("o_totalprice").desc(), "o_orderkey"], 10)


@step("explode_lines")
def explode_lines(docs: DataFrame) -> DataFrame:
    return explode_rows(docs.select(F.col("doc.features").alias("features")), "features",
                        alias="f", keep=[], guard_reparse=True)


def q25_step_observed(spark, sf_dir):
    lines = explode_lines(order_docs(spark, sf_dir))
    lines.write.format("noop").mode("overwrite").save()
    rows = last_observation("explode_lines")["rows"]
    return spark.createDataFrame([("explode_lines", rows)], "step string, n_rows bigint")


def q26_cluster(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    spec = table_spec("lineitem", unique_name("t_lineitem"), "default",
                      scratch_path(spark, "tables", "lineitem"))
    replace(zorder(li, ["l_shipdate", "l_partkey"]), spec)
    back = spark.table(spec.qualified)
    return (back.groupBy("l_returnflag", "l_linestatus")
            .agg(F.sum("l_quantity").alias("sum_qty"),
                 F.sum(F.round(F.col("l_extendedprice") * 100).cast("bigint")).alias("sum_price_cents"),
                 F.count(F.lit(1)).alias("n_rows"),
                 F.min("l_shipdate").alias("first_ship"), F.max("l_shipdate").alias("last_ship")))


def q27_conform(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    drifted = o.select("o_orderkey", F.col("o_custkey").cast("int").alias("o_custkey"), "o_orderstatus",
                       "o_totalprice", "o_orderdate", F.lit("extra").alias("o_comment"))
    return conform(drifted, o.schema)


def q28_explode_map(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", F.from_json("props", "map<string,int>").alias("m"))
    return explode_rows(e, "m", keep=["event_id"], guard_reparse=True)


def q29_scd2_load(spark, sf_dir):
    """Type-2 table load in two time-ordered batches (create, then merge)."""
    e = table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type")
    cut = F.lit(ROUND_ONE_BEFORE).cast("timestamp_ntz")
    spec = table_spec("history", unique_name("t_history"), "default",
                      scratch_path(spark, "tables", "history"))
    args = dict(key="user_id", order=["ts", "event_id"], tracked=["event_type"])
    scd2_load(e.where(F.col("ts") < cut), spec, **args)
    scd2_load(e.where(F.col("ts") >= cut), spec, **args)
    return spark.table(spec.qualified)


def q30_register_append(spark, sf_dir):
    """Files written by path first, a table registered over them, then more
    rows appended through the catalog."""
    o = table(spark, sf_dir, "orders")
    spec = table_spec("orders_path", unique_name("t_orders_path"), "default",
                      scratch_path(spark, "tables", "orders_path"))
    write_path(o.where(F.col("o_orderstatus") == "F"), spec)
    register(spark, spec)
    append(o.where((F.col("o_orderstatus") != "F") | F.col("o_orderstatus").isNull()), spec)
    return spark.table(spec.qualified)


def q31_bronze_lines(spark, sf_dir):
    """S4 over landed files, via typed bronze: the lines table read with
    nested column pruning.  Exploding the nested field ``features.properties``
    (not the whole element) lets the Parquet reader fetch only that struct."""
    bronze = order_bronze(spark, sf_dir)
    valid, _bad = split_valid(bronze)
    props = explode_rows(valid, "features.properties", alias="p", keep=[])
    return sanitize_names(props.select("p.*"))


def q32_payload_forms(spark, sf_dir):
    """S3, S4, H2: single documents, arrays of documents, NULL and blank texts
    and error replies, routed by status and by text."""
    kind = F.col("event_type")
    e = table(spark, sf_dir, "events").select(
        "event_id", F.when(kind == "error", 400).otherwise(200).alias("status"),
        F.when(kind == "view", F.col("props"))
        .when(kind == "click", F.concat(F.lit("["), F.col("props"), F.lit(', {"k": 1000}]')))
        .when(kind == "purchase", F.lit(" "))
        .when(kind == "error", F.lit('{"errors": [{"title": "bad request"}]}')).alias("body"))
    valid, bad = split_valid(parse_json(e, "body", "k int", alias="p", items=True), status="status")
    return (valid.select("event_id", F.col("p.k").alias("k"), F.lit(None).cast("string").alias("reason"))
            .unionByName(bad.select("event_id", F.lit(None).cast("int").alias("k"), "reason")))


def q33_rename(spark, sf_dir):
    return rename(table(spark, sf_dir, "orders"), {"o_orderkey": "order_id", "o_custkey": "customer", "absent": "x"})


def q34_schema_rows(spark, sf_dir):
    """I1 beside the counts of every column."""
    o = table(spark, sf_dir, "orders")
    counts = profile(o).select(F.col("column_name").alias("path"), "n_rows", "n_nulls")
    return schema_rows(o).join(counts, "path")


def q35_geometry(spark, sf_dir):
    """H4: one geometry column of three shapes; two of them get typed columns."""
    status, point = F.col("o_orderstatus"), F.concat(F.lit("["), F.col("o_custkey"), F.lit(", 1.5]"))
    kind = F.when(status == "F", "Polygon").when(status == "O", "MultiPolygon").otherwise("Point")
    shape = (F.when(status == "F", F.concat(F.lit("[["), point, F.lit("]]")))
             .when(status == "O", F.concat(F.lit("[[["), point, F.lit("]]]"))).otherwise(point))
    bodies = table(spark, sf_dir, "orders").select("o_orderkey", F.concat(
        F.lit('{"geometry": {"type": "'), kind, F.lit('", "coordinates": '), shape, F.lit("}}")).alias("body"))
    parsed = parse_json(bodies, "body", "geometry struct<type: string, coordinates: string>", alias="doc")
    typed = geometry_columns(parsed.select("o_orderkey", "doc.geometry"))
    return typed.select("o_orderkey", F.col("geometry.type").alias("kind"),
                        F.col("polygon_coordinates")[0][0][0].alias("polygon_x"),
                        F.col("multipolygon_coordinates")[0][0][0][0].alias("multipolygon_x"),
                        F.length("geometry.coordinates").cast("bigint").alias("raw_chars"))


def q36_map_outer(spark, sf_dir):
    """G5: outer generator with positions over a map inside a struct."""
    kind = F.col("event_type")
    text = F.when(kind == "purchase", F.concat(F.expr("rtrim('}', props)"), F.lit(', "j": 1}'))) \
        .when(kind != "error", F.col("props"))
    e = table(spark, sf_dir, "events").select("event_id", F.struct(F.from_json(text, "map<string,int>").alias("m")).alias("doc"))
    return explode_rows(e, "doc.m", keep=["event_id"], outer=True, position=True)


def _history(spark, batches, name):
    spec = table_spec("history", unique_name(f"t_{name}"), "default", scratch_path(spark, "tables", name))
    for batch in batches:
        scd2_load(batch, spec, key="user_id", order=["ts", "event_id"], tracked=["event_type"])
    return spark.table(spec.qualified)


def q37_scd2_late_rows(spark, sf_dir):
    """T8: the later batch arrives first, so every row of the second is late."""
    e = table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type")
    early = F.col("ts") < F.lit(ROUND_ONE_BEFORE).cast("timestamp_ntz")
    return _history(spark, [e.where(~early), e.where(early)], "late")


def q38_scd2_null_keys(spark, sf_dir):
    """T8: NULL keys are one key, with one current version."""
    e = table(spark, sf_dir, "events").select(
        F.when(F.col("user_id") > 20, F.col("user_id")).alias("user_id"), "ts", "event_id", "event_type")
    early = F.col("ts") < F.lit(ROUND_ONE_BEFORE).cast("timestamp_ntz")
    return _history(spark, [e.where(early), e.where(~early)], "null_keys")


def q39_upsert_partitioned_text(spark, sf_dir):
    """T6: partition values with a space, a colon and a percent sign."""
    spec = table_spec("orders", unique_name("t_orders_text"), "default", scratch_path(spark, "tables", "orders_text"),
                      key=("p", "o_orderkey"), partition_by="p")
    for batch in _orders_batches(spark, sf_dir):
        load(batch.withColumn("p", F.concat("o_orderpriority", F.lit(" a:b%c"))), spec)
    return spark.table(spec.qualified)


def q40_upsert_null_keys_table(spark, sf_dir):
    """T6: rows with NULL keys are all inserted, whatever happens to duplicates."""
    spec = _spec(spark, "orders_null")
    for batch in _orders_batches(spark, sf_dir, null_keys=True):
        load(batch, spec, on_duplicate="latest", order=["o_orderdate"])
    return spark.table(spec.qualified)


def q41_upsert_empty_batch(spark, sf_dir):
    """T6: an empty batch leaves the table as it is."""
    o = table(spark, sf_dir, "orders")
    spec = _spec(spark, "orders_empty")
    load(o, spec)
    load(o.where(F.col("o_orderdate") < F.lit("1900-01-01").cast("timestamp_ntz")), spec)
    return spark.table(spec.qualified)


def q42_upsert_new_column(spark, sf_dir):
    """T6, H3: a column that the table lacks is added."""
    target, source = _orders_batches(spark, sf_dir)
    spec = _spec(spark, "orders_drift")
    load(target, spec)
    upsert(source.withColumn("o_note", F.col("o_orderpriority")), spec, extra="add")
    return spark.table(spec.qualified)


def _derived_spec(spark, label, **parts):
    return table_spec(label, unique_name(f"t_{label}"), "default", scratch_path(spark, "tables", label), key="o_orderkey", **parts)


def q43_upsert_key_buckets(spark, sf_dir):
    """T6: a table without a partition column of its own, kept in parts by a
    hash of its key; NULL keys among the rows."""
    spec = _derived_spec(spark, "orders_hashed", key_buckets=2 * _parallelism(spark))
    for batch in _orders_batches(spark, sf_dir, null_keys=True):
        load(batch, spec, on_duplicate="latest", order=["o_orderdate"])
    return read(spark, spec)


#: Orders of one part of the table of q44, and the day its batch arrives.
PART_WIDTH, BATCH_DAY = 500, "1996-01-02"


def q44_upsert_touched_parts(spark, sf_dir):
    """T6: a day's orders merged into a table kept in ranges of its key: only
    the ranges that hold one of them are rewritten."""
    o = table(spark, sf_dir, "orders")
    spec = _derived_spec(spark, "orders_ranges", key_width=PART_WIDTH)
    load(o, spec)
    day = o.where(F.to_date("o_orderdate") == F.lit(BATCH_DAY).cast("date"))
    counts = load(day.withColumn("o_totalprice", F.lit(0.0)), spec)
    parts = spark.sql(f"SHOW PARTITIONS {spec.qualified}").count()
    return read(spark, spec).agg(
        F.lit(counts.get("partitions_rewritten", 0)).cast("bigint").alias("parts_rewritten"), F.lit(parts).cast("bigint").alias("parts"),
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("o_totalprice") == 0).alias("n_updated"))


CANNED = "plait.sources.fetch:CannedUserApi"


def q45_request_source(spark, sf_dir):
    """S1: the calls of q18 through the Python data source."""
    users = table(spark, sf_dir, "events").select("user_id").distinct()
    rounds = scratch_path(spark, "requests")
    write_round(users.select(F.col("user_id").alias("request_key"), F.concat(F.lit("/users/"), F.col("user_id").cast("string")).alias("url")),
                rounds, "0001", files=_parallelism(spark))
    landed = scratch_path(spark, "replies", "source")
    land(read_requests(spark, rounds, CANNED, concurrency="4"), landed)
    parsed = parse_json(read_table(spark, landed), "body",
                        "features array<struct<properties: struct<`user-id`: bigint>>>", alias="reply")
    accepted = F.col("status").isin(200) & F.col(CORRUPT).isNull()
    return parsed.select(F.col("request_key").cast("bigint").alias("request_key"), "status", accepted.alias("accepted"),
                         F.when(accepted, F.col("reply.features").getItem(0).getField("properties").getField("user-id")).alias("body_user"))


def q46_request_stream(spark, sf_dir):
    """S7: a request per user and day, in two rounds; each run calls only
    the round that is new."""
    e = table(spark, sf_dir, "events")
    early = F.col("ts") < F.lit(ROUND_ONE_BEFORE).cast("timestamp_ntz")
    rounds, landed, checkpoint = (scratch_path(spark, n, "stream") for n in ("requests", "replies", "checkpoint"))

    def land_batch(batch: DataFrame, batch_id: int) -> None:
        # a folder a batch: a replayed batch replaces its own replies
        land(batch, f"{landed}/run={batch_id}", mode="overwrite")

    for name, part in (("0001", e.where(early)), ("0002", e.where(~early))):
        keys = part.select((F.col("user_id") * 100 + F.dayofmonth("ts")).alias("request_key")).distinct()
        write_round(keys.withColumn("url", F.lit("/days")), rounds, name, files=_parallelism(spark))
        request_stream(spark, rounds, CANNED).writeStream.foreachBatch(land_batch) \
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(landed).select(F.col("request_key").cast("bigint").alias("request_key"), "status", (F.col("run") + 1).alias("run"))


#: Calls a day that the API allows.
CALL_BUDGET = 50


def q47_call_ledger(spark, sf_dir):
    """S2: the users asked under a daily budget on two days, the first day
    twice; answered keys are not asked again, failed ones are."""
    users = table(spark, sf_dir, "events").select("user_id").distinct()
    requests = users.select(F.col("user_id").cast("string").alias("request_key"), F.lit("/users").alias("url"))
    path = scratch_path(spark, "ledger", "users")
    for day in (date(2024, 2, 1), date(2024, 2, 1), date(2024, 2, 2)):
        call_due(requests, CannedUserApi(), path, day, CALL_BUDGET, partitions=2, concurrency=4)
    return ledger(spark, path).select(F.col("request_key").cast("bigint").alias("request_key"), "call_day", "status")


def q48_history_one_second(spark, sf_dir):
    """T8: all rows of a key within one second, cut by range partitions."""
    e = table(spark, sf_dir, "events").withColumn("ts", F.date_trunc("year", "ts").cast("timestamp_ntz"))
    return scd2_history(e, "event_type", ["ts", "event_id"], ["user_id"], carry={"start_event_id": "event_id"}, bucket_rows=1000)


def q49_profile_sketches(spark, sf_dir):
    """I5: sketches stored for two batches and united; distinct counts against exact ones."""
    o = table(spark, sf_dir, "orders")
    late = F.col("o_orderdate") >= F.lit(SOURCE_FROM).cast("timestamp_ntz")
    path = scratch_path(spark, "sketches", "orders")
    for part in (o.where(late), o.where(~late | late.isNull())):
        profile_sketch(part).write.mode("append").parquet(path)
    rows = read_profile(unite_profiles(spark.read.parquet(path)))
    exact = profile(o, exact_distinct=True).select("column_name", F.col("n_distinct").alias("exact"))
    middle = F.get("quantiles", F.lit(1))
    return rows.join(exact, "column_name").select(
        "column_name", "n_rows", "n_nulls", "low", "high",
        (F.abs(F.col("n_distinct") - F.col("exact")) <= 0.05 * F.col("exact")).alias("distinct_close"),
        ((F.col("low") <= middle) & (middle <= F.col("high"))).alias("median_inside"))


#: Ship dates that q50 asks for: the months of a year.
SHIP_MONTHS = [(f"1995-{m:02d}-01", f"1995-{m:02d}-28") for m in range(1, 13)]


def q50_layout_proof(spark, sf_dir):
    """T10: lines clustered by ship date; a month reads few of the files."""
    spec = table_spec("lineitem", unique_name("t_lineitem"), "default", scratch_path(spark, "tables", "lineitem_range"))
    replace(table(spark, sf_dir, "lineitem"), spec)
    cluster_table(spec, ["l_shipdate"], partitions=32)
    back = spark.table(spec.qualified)
    # the files hold what the ranges say: their rows are counted beside the pruned files
    proof = pruning(back, "l_shipdate", SHIP_MONTHS)
    month = F.date_trunc("month", "l_shipdate").cast("timestamp_ntz")
    counted = back.where(F.dayofmonth("l_shipdate") < 28).groupBy(month.alias("low")).agg(F.count(F.lit(1)).alias("n_rows"))
    return proof.join(counted, "low").select("low", "n_rows", (F.col("files_read") * 4 <= F.col("files")).alias("pruned"),
                                             (F.col("rows_read") >= F.col("n_rows")).alias("complete"))


def q51_paths_unknown_depth(spark, sf_dir):
    """P7: the scalars of the order replies by path, without a declared schema."""
    rows = path_values(order_replies(spark, sf_dir), "body", keep=["doc_key"])
    path = F.regexp_replace("path", r"\[[0-9]+\]", "[]")
    return rows.where("path LIKE '%properties.%'").groupBy(path.alias("path")) \
        .agg(F.count("value").alias("n_values"), F.countDistinct("doc_key").alias("n_documents"))


def q52_geometry_collection(spark, sf_dir):
    """H4: collections of geometries, one inside another, as simple parts."""
    point = F.concat(F.lit('{"type": "Point", "coordinates": ['), F.col("o_custkey"), F.lit(", 1.5]}"))
    inner = F.concat(F.lit('{"type": "GeometryCollection", "geometries": ['), point, F.lit(', {"type": "LineString", "coordinates": [['),
                     F.col("o_custkey"), F.lit(", 2], [3, 4]]}]}"))
    outer = F.concat(F.lit('{"type": "GeometryCollection", "geometries": ['), inner, F.lit(", "), point, F.lit("]}"))
    shape = F.when(F.col("o_orderstatus") == "F", outer).when(F.col("o_orderstatus") == "O", inner).otherwise(point)
    parts = geometry_parts(table(spark, sf_dir, "orders").select("o_orderkey", shape.alias("geometry")), "geometry", ["o_orderkey"])
    x = F.coalesce(F.from_json("coordinates", "array<array<double>>")[0][0], F.from_json("coordinates", "array<double>")[0])
    return parts.select("o_orderkey", "path", "kind", x.alias("x"))


def q53_stream_metrics(spark, sf_dir):
    """U1: counts of every micro-batch of a stream that ran twice."""
    e = table(spark, sf_dir, "events")
    early = F.col("ts") < F.lit(ROUND_ONE_BEFORE).cast("timestamp_ntz")
    landing, landed, checkpoint = (scratch_path(spark, n, "metrics") for n in ("landing", "landed", "checkpoint"))
    with BatchMetrics(spark) as metrics:
        for part in (e.where(early), e.where(~early)):
            part.select("event_id", "event_type", "value").write.mode("append").parquet(landing)
            stream = spark.readStream.schema("event_id bigint, event_type string, value double").parquet(landing)
            stream = observed(stream, "landed", errors="count_if(event_type = 'error')", users="count(value)")
            metrics.wait(stream.writeStream.format("parquet").option("path", landed).option("checkpointLocation", checkpoint)
                         .trigger(availableNow=True).start())
        rows = metrics.rows()
    return rows.select("batch_id", "metric", F.col("value").cast("bigint").alias("value"))


def q54_nested_evolution(spark, sf_dir):
    """H3: a batch brings a new field of a struct inside an array; old rows have NULL there."""
    target, source = _orders_batches(spark, sf_dir)
    spec = _spec(spark, "orders_nested")

    def nested(df: DataFrame, *more) -> DataFrame:
        return df.select("o_orderkey", F.array(F.struct("o_totalprice", *more)).alias("parts"))

    load(nested(target), spec)
    load(nested(source, "o_orderpriority"), spec, extra="add")
    part = F.col("parts")[0]
    return spark.table(spec.qualified).select("o_orderkey", part["o_totalprice"].alias("o_totalprice"), part["o_orderpriority"].alias("o_orderpriority"))


QUERIES = {name: fn for name, fn in sorted(globals().items())
           if name[:1] == "q" and name[1:3].isdigit() and callable(fn)}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The original end-to-end flow: parse replies, explode features,
    flatten, split, and return the properties table."""
    return q10_split_lines(spark, sf_dir)
