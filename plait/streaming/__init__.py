from .metrics import BatchMetrics, observed
from .incremental import batch_merger, ingest_incremental, payload_stream

__all__ = ["batch_merger", "ingest_incremental", "payload_stream", "BatchMetrics", "observed"]
