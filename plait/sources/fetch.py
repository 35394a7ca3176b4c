"""Distributed fetch of API replies.

The original makes one blocking GET on the driver.  Here the requests are a
DataFrame (one row per request key, e.g. one per ZIP code) and the calls run
inside tasks with ``mapInPandas``; the number of partitions bounds how many
calls are in flight at once (APIs are rate limited).  The fetcher is
injected: anything picklable with ``fetcher(key, url) -> (status, body)``.
Replies should be landed (``land``) before they are parsed, so a retried
stage does not call the API again.
"""

from __future__ import annotations

import json
import urllib.error
import urllib.parse
import urllib.request
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship_package

RESPONSE_DDL = "request_key string, url string, status int, body string, fetched_at timestamp"


def fetch(requests: DataFrame, fetcher, key: str = "request_key", url: str = "url",
          partitions: int | None = None, concurrency: int = 1) -> DataFrame:
    """requests(key, url) -> responses(request_key, url, status, body, fetched_at).

    Calls are latency-bound, so each task may keep ``concurrency`` calls in
    flight (a thread pool per Arrow batch); at most ``partitions x
    concurrency`` calls run at once across the cluster."""
    ship_package(requests.sparkSession)      # the fetcher may be a plait class
    src = requests.select(F.col(key).cast("string").alias("request_key"),
                          F.col(url).cast("string").alias("url"))
    if partitions:
        src = src.repartition(partitions)

    def one(k, u):
        try:
            status, body = fetcher(k, u)
        except Exception as exc:  # a failed call is data, not a crash
            status, body = None, json.dumps({"error": type(exc).__name__, "message": str(exc)})
        return status, body, pd.Timestamp.now(tz="UTC")

    def call_all(batches):
        pool = ThreadPoolExecutor(max_workers=concurrency) if concurrency > 1 else None
        try:
            for pdf in batches:
                pairs = list(zip(pdf["request_key"], pdf["url"]))
                done = (list(pool.map(lambda p: one(*p), pairs)) if pool is not None
                        else [one(k, u) for k, u in pairs])          # results keep request order
                statuses = [d[0] for d in done]
                bodies = [d[1] for d in done]
                times = [d[2] for d in done]
                yield pd.DataFrame({
                    "request_key": pdf["request_key"], "url": pdf["url"],
                    "status": pd.array(statuses, dtype="Int32"), "body": bodies,
                    "fetched_at": pd.to_datetime(times, utc=True)})
        finally:
            if pool is not None:
                pool.shutdown()

    return src.mapInPandas(call_all, RESPONSE_DDL)


def status_check(responses: DataFrame, ok: tuple[int, ...] = (200,)):
    """(accepted, rejected) by response status."""
    good = F.col("status").isin(*ok)
    return responses.where(good), responses.where(~good | F.col("status").isNull())


def land(responses: DataFrame, path: str, mode: str = "append") -> None:
    """Write replies once (Parquet), so parsing never re-calls the API."""
    responses.write.mode(mode).parquet(path)


@dataclass(frozen=True)
class HttpFetcher:
    """GET with query string and headers (urllib; credentials come from the
    caller, e.g. read from a secret store on the executor)."""

    params: dict = field(default_factory=dict)
    headers: dict = field(default_factory=dict)
    timeout: float = 30.0

    def __call__(self, key, url):
        q = urllib.parse.urlencode(self.params)
        full = f"{url}?{q}" if q else url
        req = urllib.request.Request(full, headers=dict(self.headers), method="GET")
        try:
            with urllib.request.urlopen(req, timeout=self.timeout) as r:
                return int(r.status), r.read().decode("utf-8", errors="replace")
        except urllib.error.HTTPError as e:
            return int(e.code), e.read().decode("utf-8", errors="replace")


@dataclass(frozen=True)
class CannedUserApi:
    """A stand-in API for tests and the catalogue: no network.

    Fixed values: request keys ending in 3 are refused (403), keys ending in
    7 fail (500), every other key gets a 200 reply with one feature.
    """

    def __call__(self, key, url):
        k = int(key)
        if k % 10 == 3:
            return 403, json.dumps({"message": "not subscribed"})
        if k % 10 == 7:
            return 500, "internal error"
        return 200, json.dumps({"type": "FeatureCollection",
                                "features": [{"type": "Feature",
                                              "properties": {"user-id": k, "path": url}}]})
