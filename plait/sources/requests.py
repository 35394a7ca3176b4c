"""Calling an API as a Spark source, with a ledger of calls.

``RequestSource`` is a Python ``DataSource``: a batch reader and a stream
reader over *rounds* of requests.  A round is a folder of small Parquet files
written by Spark (``write_round``); every file is one partition of the read,
so the request list never passes through the driver, and the number of files
bounds how many tasks call at once.  The stream's offset is the name of the
last round seen: a replayed batch reads the same files.

The ledger is the landed replies themselves.  ``due_calls`` leaves out keys
that were answered, asks failed ones again after the new ones, and keeps to a
budget of calls a day.
"""

from __future__ import annotations

import importlib
import json
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from datetime import date, datetime, timezone

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from ..session import ship_package
from .fetch import RESPONSE_DDL, fetch, land

#: Replies of one Arrow batch, at most.
BATCH = 256


def write_round(requests: DataFrame, path: str, name: str, files: int, key: str = "request_key", url: str = "url") -> str:
    """Writes requests (key, url) as the round ``name`` below ``path``: at most
    ``files`` Parquet files, a partition of the read each.  Rounds are read in
    the order of their names, which must only grow (a date, a number padded
    with zeros); a name that exists is refused."""
    target = f"{path.rstrip('/')}/round={name}"
    requests.select(F.col(key).cast("string").alias("request_key"), F.col(url).cast("string").alias("url")) \
        .repartition(files).write.mode("errorifexists").parquet(target)
    return target


class RequestFile(InputPartition):
    """One file of requests."""

    def __init__(self, uri: str) -> None:
        self.uri = uri


def _open(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


class _Rounds:
    """What both readers share: listing rounds and calling the API."""

    def __init__(self, options: dict) -> None:
        self.path = options["path"].rstrip("/")
        self.fetcher = options["fetcher"]
        self.arguments = json.loads(options.get("fetcher_arguments", "{}"))
        self.concurrency = int(options.get("concurrency", "1"))

    def rounds(self) -> list[str]:
        """Names of the complete rounds, in order."""
        files, root = _open(self.path)
        found = files.get_file_info(fs.FileSelector(root, allow_not_found=True))
        names = [f.base_name.removeprefix("round=") for f in found if f.type == fs.FileType.Directory and f.base_name.startswith("round=")]
        marks = files.get_file_info([f"{root}/round={n}/_SUCCESS" for n in names]) if names else []
        return sorted(n for n, mark in zip(names, marks) if mark.type == fs.FileType.File)

    def files(self, rounds: list[str]) -> list[RequestFile]:
        out = []
        for name in rounds:
            files, root = _open(f"{self.path}/round={name}")
            listed = files.get_file_info(fs.FileSelector(root))
            out += [RequestFile(f"{self.path}/round={name}/{f.base_name}") for f in listed if f.base_name.endswith(".parquet")]
        return sorted(out, key=lambda f: f.uri)

    def call(self, part: RequestFile) -> Iterator[pa.RecordBatch]:
        """The replies to one file's requests, in its order."""
        module, _, name = self.fetcher.partition(":")
        ask = getattr(importlib.import_module(module), name)(**self.arguments)

        def one(request: dict) -> tuple:
            try:
                status, body = ask(request["request_key"], request["url"])
            except Exception as exc:  # a failed call is data, not a crash
                status, body = None, json.dumps({"error": type(exc).__name__, "message": str(exc)})
            return request["request_key"], request["url"], status, body, datetime.now(timezone.utc)

        schema = pa.schema([("request_key", pa.string()), ("url", pa.string()), ("status", pa.int32()), ("body", pa.string()),
                            ("fetched_at", pa.timestamp("us", "UTC"))])
        files, root = _open(part.uri)
        with files.open_input_file(root) as source, ThreadPoolExecutor(self.concurrency) as pool:
            for lot in pq.ParquetFile(source).iter_batches(BATCH):
                rows = list(pool.map(one, lot.to_pylist()))
                yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), schema)], schema=schema)


class RequestReader(_Rounds, DataSourceReader):
    """All rounds, or the one that the option ``round`` names."""

    def __init__(self, options: dict) -> None:
        super().__init__(options)
        self.only = options.get("round")

    def partitions(self) -> list[RequestFile]:
        return self.files([n for n in self.rounds() if self.only in (None, n)]) or [RequestFile("")]

    def read(self, partition: RequestFile) -> Iterator[pa.RecordBatch]:
        return self.call(partition) if partition.uri else iter(())


class RequestStreamReader(_Rounds, DataSourceStreamReader):
    """Rounds as they come; the offset is the last round's name."""

    def initialOffset(self) -> dict:
        return {"round": ""}

    def latestOffset(self) -> dict:
        return {"round": max(self.rounds(), default="")}

    def partitions(self, start: dict, end: dict) -> list[RequestFile]:
        return self.files([n for n in self.rounds() if start["round"] < n <= end["round"]])

    def read(self, partition: RequestFile) -> Iterator[pa.RecordBatch]:
        return self.call(partition)

    def commit(self, end: dict) -> None:
        """Nothing to clean up: rounds stay as the record of what was asked."""


class RequestSource(DataSource):
    """``spark.read.format("plait_requests")`` with the options ``path``,
    ``fetcher`` (``module:Class``), ``fetcher_arguments`` (JSON),
    ``concurrency`` (calls in flight a task) and ``round`` (batch only)."""

    @classmethod
    def name(cls) -> str:
        return "plait_requests"

    def schema(self) -> str:
        return RESPONSE_DDL

    def reader(self, schema) -> RequestReader:
        return RequestReader(dict(self.options))

    def streamReader(self, schema) -> RequestStreamReader:
        return RequestStreamReader(dict(self.options))


def register_request_source(spark: SparkSession) -> None:
    ship_package(spark)
    spark.dataSource.register(RequestSource)


def request_stream(spark: SparkSession, path: str, fetcher: str, **options: str) -> DataFrame:
    register_request_source(spark)
    return spark.readStream.format("plait_requests").options(path=path, fetcher=fetcher, **options).load()


def read_requests(spark: SparkSession, path: str, fetcher: str, **options: str) -> DataFrame:
    """Replies to all requests below ``path``.  Every action calls anew: land
    the result before it is used twice."""
    register_request_source(spark)
    return spark.read.format("plait_requests").options(path=path, fetcher=fetcher, **options).load()


# -- ledger and budget ----------------------------------------------------

def ledger(spark: SparkSession, path: str) -> DataFrame:
    """The landed replies below ``path`` with the day of each call; empty
    where nothing has landed yet."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    there = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)
    schema = f"{RESPONSE_DDL}, call_day date"
    return spark.read.schema(schema).parquet(path) if there else spark.createDataFrame([], schema)


def due_calls(requests: DataFrame, calls: DataFrame, day: date, budget: int, ok: tuple[int, ...] = (200,),
              retries: int = 3) -> DataFrame:
    """The requests to call on ``day``: keys without an accepted reply that
    were tried at most ``retries`` times beyond the first, those never called
    first, then by number of tries and key, and of these as many as the day's
    ``budget`` leaves after the calls already in the ledger.

    Requests are one per key (repeats are dropped); a NULL key is never
    called.  The ledger is aggregated by key before the join."""
    tried = calls.groupBy("request_key").agg(
        F.count(F.lit(1)).alias("tries"), F.max(F.coalesce(F.col("status").isin(*ok), F.lit(False))).alias("answered"))
    spent = calls.where(F.col("call_day") == F.lit(day)).count()
    asked = requests.select(F.col("request_key").cast("string").alias("request_key"), "url").where("request_key IS NOT NULL") \
        .groupBy("request_key").agg(F.min("url").alias("url"))
    open_keys = asked.join(tried, "request_key", "left") \
        .where(~F.coalesce("answered", F.lit(False)) & (F.coalesce("tries", F.lit(0)) <= retries))
    return open_keys.orderBy(F.coalesce("tries", F.lit(0)), "request_key").limit(max(0, budget - spent)).select("request_key", "url")


def call_due(requests: DataFrame, fetcher, path: str, day: date, budget: int = 50, partitions: int = 1, concurrency: int = 1,
             ok: tuple[int, ...] = (200,), retries: int = 3) -> dict:
    """Calls what is due and lands the replies in the ledger; a rerun makes no
    call for a key that was answered.  The calls to make are written down
    first, so a retried stage asks for the same keys.  Returns counts.  One
    run at a time may use a ledger."""
    spark = requests.sparkSession
    due = due_calls(requests, ledger(spark, path), day, budget, ok, retries)
    from ..session import shared_dir
    shared_dir(spark)
    due = due.checkpoint()
    n = due.count()
    if n:
        land(fetch(due, fetcher, partitions=partitions, concurrency=concurrency).withColumn("call_day", F.lit(day)), path)
    landed = ledger(spark, path)
    answered = landed.where(F.col("status").isin(*ok)).select("request_key").distinct().count()
    return {"called": n, "answered_keys": answered}
