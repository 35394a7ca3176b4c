"""Counts of every micro-batch, gathered by the jobs that run it.

``observed`` attaches named aggregates to a streaming DataFrame; a
``BatchMetrics`` listener receives them with the progress of each batch and
gives them back as rows.
"""

from __future__ import annotations

import threading
import time
from collections import deque

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener


def observed(stream: DataFrame, name: str, **metrics: str | Column) -> DataFrame:
    """``stream`` with ``rows`` and the given aggregates (SQL text or Column)
    observed under ``name`` in every micro-batch."""
    more = [(F.expr(m) if isinstance(m, str) else m).alias(k) for k, m in metrics.items()]
    return stream.observe(name, F.count(F.lit(1)).alias("rows"), *more)


class BatchMetrics(StreamingQueryListener):
    """Keeps the observed metrics of the last ``keep`` batches of all queries
    of a session while it is registered (use it as a context manager)."""

    def __init__(self, spark: SparkSession, keep: int = 10_000) -> None:
        super().__init__()
        self.spark = spark
        self.found: deque = deque(maxlen=keep)
        self.ended: set[str] = set()
        self.lock = threading.Lock()

    def __enter__(self) -> BatchMetrics:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *exc) -> None:
        self.spark.streams.removeListener(self)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        with self.lock:
            for name, row in (p.observedMetrics or {}).items():
                for metric, value in row.asDict().items():
                    self.found.append((p.name or str(p.id), int(p.batchId), name, metric, None if value is None else float(value)))

    def onQueryTerminated(self, event) -> None:
        with self.lock:
            self.ended.add(str(event.runId))

    def wait(self, query: StreamingQuery, timeout: float = 60.0) -> None:
        """Until the query has ended and its last progress has arrived."""
        query.awaitTermination()
        until = time.monotonic() + timeout
        while str(query.runId) not in self.ended and time.monotonic() < until:
            time.sleep(0.05)

    def rows(self) -> DataFrame:
        """``query, batch_id, step, metric, value``: a row per metric and batch;
        a batch that a restarted query ran again counts once."""
        with self.lock:
            last = {r[:4]: r for r in self.found}
        return self.spark.createDataFrame(list(last.values()), "query string, batch_id bigint, step string, metric string, value double")
