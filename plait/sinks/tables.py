"""Tables: configuration, replace, upsert (type-1 merge), create-or-merge,
clustering.

Storage is a catalog table over a *versioned* location: every write goes to
a new directory ``<location>/v=<stamp>`` and the table is then pointed at
it (``ALTER TABLE .. SET LOCATION``).  A table can therefore be rewritten
from its own contents (Spark refuses to overwrite a path it reads), and a job
that fails before its files are complete leaves the table as it was.  A full
rewrite of a partitioned table swaps its definition, and partitions are
re-pointed one by one, so a reader can see that moment.  A merge whose table
was changed meanwhile by another writer fails (``ConcurrentWriteError``).  Old
versions are kept until ``vacuum``.  When the format supports row-level
operations (e.g. Delta, if installed) ``upsert`` uses ``DataFrame.mergeInto``
instead.
"""

from __future__ import annotations

import threading
import time
import uuid
from dataclasses import dataclass, field
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.names import quote
from ..functions.schema import to_ddl
from ..operators.conform import SchemaDriftError, conform, drift, merge_types
from ..operators.keys import assert_unique, dedupe_latest
from ..session import shared_dir

# Formats whose tables accept MERGE INTO.
ROW_LEVEL_FORMATS = ("delta", "iceberg")
#: Partition column derived from the key, of tables with ``key_buckets`` or ``key_width``.
KEY_BUCKET = "_key_bucket"


@dataclass(frozen=True)
class TableSpec:
    """Where and how one table is kept (the original six-key config)."""

    label: str
    table: str
    database: str = "default"
    location: str = ""
    format: str = "parquet"
    key: tuple[str, ...] = ()
    partition_by: tuple[str, ...] = field(default_factory=tuple)
    buckets: int = 0          # > 0: files bucketed by key (co-located joins and merges)
    key_buckets: int = 0      # > 0: partitioned by a hash of the key, a merge rewrites touched parts only
    key_width: int = 0        # > 0: partitioned by ranges of so many values of one integer key

    @property
    def qualified(self) -> str:
        return f"{quote(self.database)}.{quote(self.table)}"

    @property
    def derived(self) -> bool:
        """Whether the partition column is derived from the key."""
        return bool(self.key_buckets or self.key_width)

    @property
    def row_level(self) -> bool:
        return self.format.lower() in ROW_LEVEL_FORMATS


def table_spec(label: str = "default", table: str = "default", database: str = "default",
               location: str = "", key=(), format: str = "parquet", buckets: int = 0,
               partition_by=(), key_buckets: int = 0, key_width: int = 0) -> TableSpec:
    if not location:
        raise ValueError("a table needs a location")
    key = tuple([key] if isinstance(key, str) else key)
    if (buckets or key_buckets or key_width) and not key:
        raise ValueError("a bucketed table needs a key")
    if key_buckets or key_width:
        if partition_by or buckets or (key_buckets and key_width):
            raise ValueError("key_buckets and key_width stand alone: no partition_by, no buckets, not both")
        if key_width and len(key) != 1:
            raise ValueError("key_width needs one integer key")
        partition_by = (KEY_BUCKET,)
    return TableSpec(label=label, table=table, database=database, location=location.rstrip("/"),
                     format=format, key=key, buckets=buckets, key_buckets=key_buckets, key_width=key_width,
                     partition_by=tuple([partition_by] if isinstance(partition_by, str) else partition_by))


def check_specs(specs) -> None:
    """Refuse two tables on one location or one name (each would destroy
    the other's files or view)."""
    seen_loc, seen_name = {}, {}
    for s in specs:
        if s.location in seen_loc:
            raise ValueError(f"{s.label!r} and {seen_loc[s.location]!r} share location {s.location}")
        name = (s.database.lower(), s.table.lower())
        if name in seen_name:
            raise ValueError(f"{s.label!r} and {seen_name[name]!r} share table {s.qualified}")
        seen_loc[s.location] = s.label
        seen_name[name] = s.label


def key_list(key) -> list[str]:
    """A key given as one column name or as several."""
    return [key] if isinstance(key, str) else list(key or ())


def exists(spark: SparkSession, spec: TableSpec) -> bool:
    return spark.catalog.tableExists(f"{spec.database}.{spec.table}")


def with_key_bucket(df: DataFrame, spec: TableSpec, spread_null: bool = True) -> DataFrame:
    """``df`` with the derived partition column of ``spec`` (unchanged without
    one).  Rows with a NULL key never match; they are spread by a hash of the
    row, unless ``spread_null`` is off (NULL is then one key like any other).
    Key columns must already have the table's types: equal numbers of
    different types hash differently."""
    if not spec.derived:
        return df
    keys = [F.col(quote(k)) for k in spec.key]
    if spec.key_width:
        return df.withColumn(KEY_BUCKET, (keys[0] - F.pmod(keys[0], F.lit(spec.key_width))).cast("bigint"))
    own = F.xxhash64(*keys)
    if spread_null:
        own = F.when(_complete(list(spec.key)), own).otherwise(_row_hash(df))
    return df.withColumn(KEY_BUCKET, F.pmod(own, F.lit(spec.key_buckets)).cast("bigint"))


def read(spark: SparkSession, spec: TableSpec) -> DataFrame:
    """The table without its derived partition column."""
    df = spark.table(spec.qualified)
    return df.drop(KEY_BUCKET) if spec.derived else df


def _new_version(spec: TableSpec) -> str:
    return f"{spec.location}/v={int(time.time() * 1000):013d}-{uuid.uuid4().hex[:8]}"


class ConcurrentWriteError(RuntimeError):
    """Another writer published a version while this merge was running."""


#: Check and re-pointing happen together among the writers of one driver.
_REPOINT = threading.RLock()


#: What a first load expects of the table: that there is none.
ABSENT = ("absent", "absent")


def _version(spark: SparkSession, spec: TableSpec) -> tuple[str, str]:
    """The marks of a table: its version, set by every publish, and its last
    change, which an append sets too."""
    found = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {spec.qualified}").collect()}
    return found.get("plait.version", ""), found.get("plait.change", "")


def _expect(spark: SparkSession, spec: TableSpec, expect: tuple[str, str] | None) -> None:
    if expect is None:
        return
    now = _version(spark, spec) if exists(spark, spec) else ABSENT
    if now != expect:
        raise ConcurrentWriteError(f"{spec.qualified} changed meanwhile; run it again")


def _mark(spark: SparkSession, spec: TableSpec, path: str | None) -> None:
    """Marks a change; with a path, a new version too."""
    version = f"'plait.version' = '{path.rsplit('/', 1)[-1]}', " if path else ""
    spark.sql(f"ALTER TABLE {spec.qualified} SET TBLPROPERTIES ({version}'plait.change' = '{uuid.uuid4().hex}')")


def _rows(obs: Observation, name: str = "rows") -> int:
    """An observed count; an input that Spark found empty reports no metrics."""
    try:
        return obs.get[name] or 0
    except (AssertionError, Py4JJavaError) as none:
        if "assertion failed" not in str(none) and not isinstance(none, AssertionError):
            raise
        return 0


def _publish(spark: SparkSession, df: DataFrame, spec: TableSpec, metrics: dict,
             prepartitioned: bool = False, expect: tuple[str, str] | None = None) -> str:
    """Write ``df`` as a new version and point the table at it.

    Bucketed tables are written through a staging external table (bucket
    metadata lives in the catalog); rows are hash-partitioned on the key
    into exactly ``buckets`` tasks first, so each bucket gets one file,
    unless the caller says ``df`` is already partitioned that way."""
    path = _new_version(spec)
    if spec.buckets:
        keys = [F.col(quote(k)) for k in spec.key]
        data = df if prepartitioned else df.repartition(spec.buckets, *keys)
        staging = f"{spec.table}__v{uuid.uuid4().hex[:10]}"
        writer = (data.write.format(spec.format).mode("errorifexists")
                  .bucketBy(spec.buckets, *spec.key).sortBy(*spec.key).option("path", path))
        if spec.partition_by:
            writer = writer.partitionBy(*spec.partition_by)
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {quote(spec.database)}")
        writer.saveAsTable(f"{quote(spec.database)}.{quote(staging)}")
    else:
        # a derived partition gets files of AQE's advisory size, not one per task
        data = df.hint("rebalance", KEY_BUCKET) if spec.derived else df
        staging, writer = None, data.write.format(spec.format).mode("errorifexists")
        if spec.partition_by:
            writer = writer.partitionBy(*spec.partition_by)
        writer.save(path)
    with _REPOINT:
        _expect(spark, spec, expect)
        _point(spark, df, spec, path, staging)
        _mark(spark, spec, path)
    spark.sql(f"REFRESH TABLE {spec.qualified}")
    metrics["location"] = path
    return path


def _point(spark: SparkSession, df: DataFrame, spec: TableSpec, path: str, staging: str | None) -> None:
    """Point the table at a written version (of a bucketed table: by its staging table)."""
    if staging:
        if exists(spark, spec) and not spec.partition_by:
            spark.sql(f"ALTER TABLE {spec.qualified} SET LOCATION '{path}'")
            spark.sql(f"DROP TABLE {quote(spec.database)}.{quote(staging)}")   # external: files stay
        else:
            # partition locations live per partition: a full rewrite of a
            # partitioned table swaps the whole definition (short window)
            spark.sql(f"DROP TABLE IF EXISTS {spec.qualified}")
            spark.sql(f"ALTER TABLE {quote(spec.database)}.{quote(staging)} RENAME TO {spec.qualified}")
    else:
        if spec.partition_by:
            # declared schema: partition types are not re-inferred from paths
            spark.sql(f"DROP TABLE IF EXISTS {spec.qualified}")     # see above; files stay
            spark.sql(f"CREATE DATABASE IF NOT EXISTS {quote(spec.database)}")
            spark.sql(f"CREATE TABLE {spec.qualified} ({to_ddl(df.schema)}) USING {spec.format} "
                      f"PARTITIONED BY ({', '.join(quote(c) for c in spec.partition_by)}) LOCATION '{path}'")
        elif exists(spark, spec):
            spark.sql(f"ALTER TABLE {spec.qualified} SET LOCATION '{path}'")
        else:
            spark.sql(f"CREATE DATABASE IF NOT EXISTS {quote(spec.database)}")
            spark.sql(f"CREATE TABLE {spec.qualified} USING {spec.format} LOCATION '{path}'")
    if spec.partition_by:
        spark.sql(f"ALTER TABLE {spec.qualified} RECOVER PARTITIONS")


def _sql_literal(v) -> str:
    if v is None:
        return "null"
    if isinstance(v, bool):
        return "true" if v else "false"
    if isinstance(v, (int, float)):
        return repr(v)
    return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"


def _publish_partitions(spark: SparkSession, df: DataFrame, spec: TableSpec, metrics: dict,
                        prepartitioned: bool = False, expect: tuple[str, str] | None = None) -> str:
    """Write only the partitions present in ``df`` as a new version and
    re-point (or add) exactly those partitions; the others keep their files."""
    path = _new_version(spec)
    cols = list(spec.partition_by)
    if spec.buckets:
        keys = [F.col(quote(k)) for k in spec.key]
        data = df if prepartitioned else df.repartition(spec.buckets, *keys)
        staging = f"{spec.table}__p{uuid.uuid4().hex[:10]}"
        (data.write.format(spec.format).bucketBy(spec.buckets, *spec.key).sortBy(*spec.key)
         .partitionBy(*cols).option("path", path).saveAsTable(f"{quote(spec.database)}.{quote(staging)}"))
        spark.sql(f"DROP TABLE {quote(spec.database)}.{quote(staging)}")      # external: files stay
    else:
        data = df.hint("rebalance", KEY_BUCKET) if spec.derived else df
        data.write.format(spec.format).partitionBy(*cols).mode("errorifexists").save(path)
    written = (spark.read.schema(df.schema).format(spec.format).load(path)
               .select(*[F.col(quote(c)) for c in cols],
                       F.regexp_extract(F.col("_metadata.file_path"), r"^(.*)/[^/]+$", 1).alias("_dir"))
               .distinct().collect())          # one row per written partition (bounded)
    # file paths are URI-encoded once on top of the directory's own name
    dirs = [unquote(row["_dir"]) for row in written]
    specs = [(", ".join(f"{quote(c)}={_sql_literal(row[c])}" for c in cols), _sql_literal(d))
             for row, d in zip(written, dirs)]
    with _REPOINT:
        _expect(spark, spec, expect)
        known = {r["partition"] for r in spark.sql(f"SHOW PARTITIONS {spec.qualified}").collect()}
        depth = len(cols)
        fresh = ["/".join(d.rsplit("/", depth)[1:]) not in known for d in dirs]
        added = [s for s, new in zip(specs, fresh) if new]
        moved = [s for s, new in zip(specs, fresh) if not new]
        for i in range(0, len(added), 500):      # new partitions: one statement per 500
            lot = added[i:i + 500]
            adds = " ".join(f"PARTITION ({part}) LOCATION {d}" for part, d in lot)
            try:
                spark.sql(f"ALTER TABLE {spec.qualified} ADD {adds}")
            except AnalysisException as exists_already:
                if "PARTITIONS_ALREADY_EXIST" not in str(exists_already.getCondition()):
                    raise
                # the catalog names one of them differently: add what is missing, re-point all
                spark.sql(f"ALTER TABLE {spec.qualified} ADD IF NOT EXISTS {adds}")
                moved += lot
        for part, d in moved:                    # existing ones are re-pointed one by one
            spark.sql(f"ALTER TABLE {spec.qualified} PARTITION ({part}) SET LOCATION {d}")
        _mark(spark, spec, path)
    spark.sql(f"REFRESH TABLE {spec.qualified}")
    metrics.update(location=path, partitions_rewritten=len(written))
    return path


def replace(df: DataFrame, spec: TableSpec, expect: tuple[str, str] | None = None) -> dict:
    """Full replacement (create when absent).  Returns counts.  With
    ``expect`` it fails when the table's marks are others by then."""
    spark = df.sparkSession
    obs = Observation(f"replace_{uuid.uuid4().hex[:8]}")
    metrics: dict = {}
    whole = with_key_bucket(df, spec).observe(obs, F.count(F.lit(1)).alias("rows"))
    _publish(spark, whole, spec, metrics, expect=expect)
    metrics.update(rows_written=_rows(obs), inserted=_rows(obs), updated=0)
    return metrics


def append(df: DataFrame, spec: TableSpec, extra: str = "fail") -> dict:
    """Add rows (create when absent).  New files are committed into the live
    location by Spark's commit protocol, so a failed job adds nothing.

    ``extra``: as in ``upsert``, for columns and nested fields the table
    lacks.  Every append marks the table, so that a merge running meanwhile
    fails instead of publishing a version without these rows; an append whose
    table got a new version meanwhile fails too, as its files are in the old
    one."""
    spark = df.sparkSession
    if not exists(spark, spec):
        return replace(df, spec, expect=ABSENT)
    obs = Observation(f"append_{uuid.uuid4().hex[:8]}")
    ignored = _take_extra(df, spec, read(spark, spec).schema, extra)
    before = _version(spark, spec)
    rows = with_key_bucket(conform(df, read(spark, spec).schema), spec)
    rows.select(*[F.col(quote(c)) for c in spark.table(spec.qualified).columns]) \
        .observe(obs, F.count(F.lit(1)).alias("rows")).write.insertInto(spec.qualified)
    with _REPOINT:
        if _version(spark, spec)[0] != before[0]:
            raise ConcurrentWriteError(f"{spec.qualified} was rewritten during the append; its rows are not in the table")
        _mark(spark, spec, None)
    spark.sql(f"REFRESH TABLE {spec.qualified}")
    return {"rows_written": _rows(obs), "inserted": _rows(obs), "updated": 0} | ignored


def write_path(df: DataFrame, spec: TableSpec, mode: str = "overwrite") -> str:
    """Write ``df`` straight to the spec's location (no catalog, no version
    directory): the plain path write that ``register`` can later expose as
    a table.  Do not overwrite the location of a live table this way (a
    reader could see a half-written directory); ``replace`` is the safe
    variant."""
    writer = df.write.format(spec.format).mode(mode)
    if spec.partition_by:
        writer = writer.partitionBy(*spec.partition_by)
    writer.save(spec.location)
    return spec.location


def register(spark: SparkSession, spec: TableSpec, path: str | None = None) -> bool:
    """Register an external table over files already at ``path`` (default:
    the spec's location), if no table of that name exists.  Partitions are
    discovered from the directory layout.  Returns True when it registered."""
    if exists(spark, spec):
        return False
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quote(spec.database)}")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {spec.qualified} USING {spec.format} "
              f"LOCATION '{path or spec.location}'")
    if spec.partition_by:
        spark.sql(f"ALTER TABLE {spec.qualified} RECOVER PARTITIONS")
    return True


def drop(spark: SparkSession, spec: TableSpec) -> None:
    """DROP TABLE IF EXISTS; files stay (external table)."""
    spark.sql(f"DROP TABLE IF EXISTS {spec.qualified}")


def prepare_source(df: DataFrame, key, on_duplicate: str = "fail", order=None) -> DataFrame:
    """Guard the merge source: duplicate keys fail, or the latest row wins."""
    if on_duplicate == "fail":
        assert_unique(df, key)
        return df
    if on_duplicate == "latest":
        if not order:
            raise ValueError("on_duplicate='latest' needs an order")
        # a NULL key never matches, so such rows are no duplicates of each other
        whole = _complete(key_list(key))
        return dedupe_latest(df.where(whole), key, order).unionByName(df.where(~whole))
    if on_duplicate == "trust":
        return df
    raise ValueError(f"unknown on_duplicate {on_duplicate!r}")


def merge_frames(target: DataFrame, source: DataFrame, key) -> DataFrame:
    """Type-1 upsert of two DataFrames by name: target rows whose key is not
    in the source, plus every source row (update-all + insert-all).  Keys
    compare with ``=``: a NULL key never matches, so such rows are kept and
    inserted, as MERGE does.  The anti join is a broadcast when the source
    is small, a sort-merge join otherwise (AQE decides on real sizes)."""
    ks = [key] if isinstance(key, str) else list(key)
    return _anti_by_key(target, source, ks).unionByName(source)


def _complete(ks: list[str]):
    cond = F.lit(True)
    for k in ks:
        cond = cond & F.col(quote(k)).isNotNull()
    return cond


def _row_hash(df: DataFrame):
    """A hash of the whole row but its maps, which have none."""
    hashable = [F.col(quote(f.name)) for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    return F.xxhash64(*hashable) if hashable else F.lit(1).cast("bigint")


def _anti_by_key(target: DataFrame, source: DataFrame, ks: list[str]) -> DataFrame:
    """Target rows whose key is not in the source, in one scan of the target.

    Rows with a NULL key part can never match, but they would all hash to one
    partition (assume they are a third of the table): they get a salt as an
    extra join key (0 for every other row and for the source), which spreads
    them over all partitions and changes no result.  The salt is a hash of
    the row itself, so it is deterministic and a retried stage after a lost
    executor sees the same partitioning; identical copies still meet in one
    partition, which AQE's skew-join split handles."""
    whole = _complete(ks)
    salted = target.withColumn("_nk_salt", F.when(whole, F.lit(0).cast("bigint")).otherwise(_row_hash(target)))
    probe = (source.where(whole).select(*[F.col(quote(k)) for k in ks])
             # always 0, but no literal: a literal would drop the salt from the join keys
             .withColumn("_nk_salt", F.pmod(F.xxhash64(*[F.col(quote(k)) for k in ks]), F.lit(1).cast("bigint"))))
    return salted.join(probe, ks + ["_nk_salt"], "left_anti").drop("_nk_salt")


def _touched_partitions(source: DataFrame, spec: TableSpec, ks: list[str], target: DataFrame):
    """When every partition column is part of the key, a source row can only
    match target rows of its own partition: return a predicate selecting the
    partitions present in the source (one small distinct job; the list has a
    row per partition, as the catalog has), or None when the whole table must
    be merged.  Rows without a partition value live in the NULL partition."""
    cols = list(spec.partition_by)
    if not cols or not set(cols) <= set(ks):
        return None
    types = {f.name: f.dataType for f in target.schema.fields}
    typed = source.select(*[F.col(quote(c)).cast(types[c]).alias(c) for c in cols])
    code = F.xxhash64(*[F.col(quote(c)) for c in cols])
    values = typed.withColumn("_code", code).distinct().collect()
    cond = F.lit(True)
    for c in cols:                         # a list per column, for the catalog's own pruning
        present = {r[c] for r in values}
        one = F.col(quote(c)).isin(sorted(present - {None}))
        cond = cond & (one | F.col(quote(c)).isNull() if None in present else one)
    if len(cols) > 1:                      # of their combinations, those of the source
        cond = cond & code.isin([r["_code"] for r in values])
    return cond


def _take_extra(df: DataFrame, spec: TableSpec, target, extra: str) -> dict:
    """Settles what the source has and the table lacks; returns what to report."""
    new = [path for path, _s, _t, action in drift(df.schema, target) if action == "extra"]
    if extra not in ("fail", "add", "drop"):
        raise ValueError(f"unknown extra {extra!r}")
    if not new:
        return {}
    if extra == "drop":
        return {"ignored_columns": new}
    if extra == "fail":
        raise SchemaDriftError(f"{spec.qualified} has no {new}")
    top = {f.name: f for f in df.schema.fields}
    if all(c in top for c in new):
        columns = to_ddl(T.StructType([T.StructField(c, top[c].dataType, True) for c in new]))
        df.sparkSession.sql(f"ALTER TABLE {spec.qualified} ADD COLUMNS ({columns})")
    else:
        _evolve(df.sparkSession, spec, merge_types(target, df.schema))
    return {"added_columns": new}


def _evolve(spark: SparkSession, spec: TableSpec, schema: T.StructType) -> None:
    """Give a table a schema with more nested fields: its definition is made
    anew over the same files, which read as NULL where they lack a field.
    The catalog has no statement for nested fields of file tables, so this
    leaves a short window without the table, as a rewrite of a partitioned
    table does."""
    if spec.partition_by or spec.buckets:
        raise SchemaDriftError(f"{spec.qualified} is partitioned or bucketed: nested fields cannot be added to it")
    with _REPOINT:
        marks = _version(spark, spec)
        at = next(r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {spec.qualified}").collect() if r["col_name"] == "Location")
        spark.sql(f"DROP TABLE {spec.qualified}")     # external: files stay
        spark.sql(f"CREATE TABLE {spec.qualified} ({to_ddl(schema)}) USING {spec.format} LOCATION '{at}'")
        _mark(spark, spec, marks[0])


def upsert(df: DataFrame, spec: TableSpec, key=None, on_duplicate: str = "fail",
           order=None, extra: str = "fail") -> dict:
    """Merge ``df`` into an existing table on ``key`` (update all columns when
    matched, insert otherwise).  The source is first conformed to the table
    schema (missing columns NULL, safe widening) and guarded for duplicate
    keys.  Returns counts of inserted and updated rows.

    ``extra``: columns or nested fields the table lacks raise (``fail``),
    become part of the table (``add``; old rows have NULL there, nested fields
    need a table without partitions) or are left out and named in the counts
    (``drop``).

    Tables with ``key_buckets`` or ``key_width``, and partitioned tables
    whose partition columns are part of the key, are merged partition by
    partition: only partitions present in the source
    are read, rewritten and re-pointed, however many they are."""
    spark = df.sparkSession
    ks = key_list(key or spec.key)
    if not ks:
        raise ValueError("upsert needs a key")
    ignored = _take_extra(df, spec, read(spark, spec).schema, extra)
    before = _version(spark, spec)
    target = spark.table(spec.qualified)
    # evaluated once: the guard, the partition list, the anti join and the union read the same rows
    shared_dir(spark)
    source = with_key_bucket(conform(df, read(spark, spec).schema), spec)
    if spec.derived:
        if ks != list(spec.key):
            raise ValueError(f"{spec.qualified} is partitioned by {spec.key}; merge it on that key")
        source, ks = source.select(*[F.col(quote(c)) for c in target.columns]), [KEY_BUCKET, *ks]
    source = prepare_source(source.checkpoint(), ks, on_duplicate, order)
    if source.isEmpty():
        return {"rows_written": 0, "inserted": 0, "updated": 0} | ignored
    if spec.row_level:
        cond = F.lit(True)
        for k in ks:
            cond = cond & (F.col(f"{quote(spec.table)}.{quote(k)}") == F.col(f"source.{quote(k)}"))
        (source.alias("source").mergeInto(spec.qualified, cond)
         .whenMatched().updateAll().whenNotMatched().insertAll().merge())
        return {"rows_written": None, "inserted": None, "updated": None} | ignored
    scoped = _touched_partitions(source, spec, ks, target)
    if scoped is not None:
        target = target.where(scoped)          # static partition filter: only touched partitions are read
    o_t, o_k = (Observation(f"{n}_{uuid.uuid4().hex[:8]}") for n in ("target", "kept"))
    t = target.observe(o_t, F.count(F.lit(1)).alias("rows"))
    kept = _anti_by_key(t, source, ks).observe(o_k, F.count(F.lit(1)).alias("rows"))
    metrics: dict = dict(ignored)
    publish = _publish if scoped is None else _publish_partitions
    if spec.buckets:
        # kept rows come from the bucketed scan, one task per bucket; only the
        # source is hash-partitioned to the same buckets, so the big side is
        # never shuffled (two files per bucket after a merge)
        fresh = source.repartition(spec.buckets, *[F.col(quote(k)) for k in ks])
        publish(spark, kept.unionByName(fresh), spec, metrics, prepartitioned=True, expect=before)
    else:
        publish(spark, kept.unionByName(source), spec, metrics, expect=before)
    n_t, n_k, n_s = _rows(o_t), _rows(o_k), source.count()
    metrics.update(rows_written=n_k + n_s, updated=n_t - n_k, inserted=n_s - (n_t - n_k))
    return metrics


def load(df: DataFrame, spec: TableSpec, key=None, on_duplicate: str = "fail", order=None,
         extra: str = "fail") -> dict:
    """Create the table from ``df`` when it does not exist, else upsert.

    Unlike an overwrite followed by a merge on the same location, keys
    absent from ``df`` are kept."""
    ks = key_list(key or spec.key)
    if not exists(df.sparkSession, spec):
        first = prepare_source(df, ks, on_duplicate, order) if ks else df
        try:
            return replace(first, spec, expect=ABSENT)
        except ConcurrentWriteError:
            pass          # another first load created the table meanwhile: merge into it
    return upsert(df, spec, ks, on_duplicate, order, extra=extra)


def vacuum(spark: SparkSession, spec: TableSpec, keep: int = 2) -> list[str]:
    """Delete version directories that no live file of the table uses,
    except the newest ``keep``.  (Partitions of a partition-scoped table may
    live in several versions.)"""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(spec.location)
    fs = root.getFileSystem(conf)
    if not fs.exists(root):
        return []
    live = {r[0] for r in spark.table(spec.qualified)
            .select(F.regexp_extract(F.col("_metadata.file_path"), r"/(v=[^/]+)/", 1)).distinct().collect()}
    versions = sorted(str(st.getPath().getName()) for st in fs.listStatus(root)
                      if st.isDirectory() and str(st.getPath().getName()).startswith("v="))
    removed = []
    for name in versions[:-keep] if keep else versions:
        if name in live:
            continue
        full = f"{spec.location}/{name}"
        fs.delete(jvm.org.apache.hadoop.fs.Path(full), True)
        removed.append(full)
    return removed


def scd2_load(df: DataFrame, spec: TableSpec, key, order: list[str], tracked: list[str]) -> dict:
    """Type-2 load: build the history table on first use, else merge the
    batch into it (``operators.history.scd2_merge``) and publish a new
    version.  When the table's partition columns are part of the key (e.g.
    a key-bucket column), only partitions holding the batch's keys are
    read, rebuilt and re-pointed; the rest of the history is not touched.
    Late rows are merged in at their own time; replayed rows change nothing.
    Returns counts, ``late_rows`` (late and replayed) among them."""
    from ..operators.history import scd2_history, scd2_merge
    spark = df.sparkSession
    ks = [key] if isinstance(key, str) else list(key)
    carry = {o: o for o in order[1:]}
    first = not exists(spark, spec)
    if spec.derived:
        if ks != list(spec.key):
            raise ValueError(f"{spec.qualified} is partitioned by {spec.key}; load it on that key")
        if not first:
            types = {f.name: f.dataType for f in spark.table(spec.qualified).schema.fields}
            df = df.withColumns({k: F.col(quote(k)).cast(types[k]) for k in ks})
        df, ks = with_key_bucket(df, spec, spread_null=False), [KEY_BUCKET, *ks]
    if first:
        built = scd2_history(df, ks, order, tracked, carry=carry)
        if spec.derived:        # the derived column again, last
            built = built.drop(KEY_BUCKET)
            built = with_key_bucket(built, spec, spread_null=False)
        obs, m = Observation(f"scd2_{uuid.uuid4().hex[:8]}"), {}
        _publish(spark, built.observe(obs, F.count(F.lit(1)).alias("rows")), spec, m, expect=ABSENT)
        return m | {"rows_written": _rows(obs), "inserted": _rows(obs), "updated": 0, "late_rows": 0}
    history = spark.table(spec.qualified)
    shared_dir(spark)
    df = df.select(*[F.col(quote(c)) for c in dict.fromkeys([*ks, *order, *tracked])]).checkpoint()
    if df.isEmpty():
        return {"rows_written": 0, "late_rows": 0}
    before = _version(spark, spec)
    scoped = _touched_partitions(df, spec, ks, history)
    if scoped is not None:
        history = history.where(scoped)
    o_late = Observation(f"scd2_late_{uuid.uuid4().hex[:8]}")
    merged = scd2_merge(history, df, ks, order, tracked, observation=o_late)
    obs = Observation(f"scd2_{uuid.uuid4().hex[:8]}")
    metrics: dict = {}
    publish = _publish if scoped is None else _publish_partitions
    publish(spark, merged.observe(obs, F.count(F.lit(1)).alias("rows")), spec, metrics, expect=before)
    metrics.update(rows_written=_rows(obs), late_rows=_rows(o_late, "late_rows"))
    return metrics


def load_split(parts, specs: dict, on_duplicate: str = "fail", order=None) -> dict:
    """Write every narrow table of a ``split`` with create-or-merge
    semantics (``load``), then release the persisted parent.  ``specs`` maps
    each part name to its TableSpec (the key comes from the spec).  Returns
    the counts per part."""
    check_specs(specs.values())
    out = {}
    try:
        for name, df in parts.items():
            out[name] = load(df, specs[name], on_duplicate=on_duplicate, order=order)
    finally:
        if hasattr(parts, "release"):
            parts.release()
    return out
