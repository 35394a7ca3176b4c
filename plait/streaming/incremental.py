"""Incremental ingestion of landed payload files with Structured Streaming.

The original notebook calls its API "periodically".  Here each call lands a file;
a file-source stream picks up only files it has not seen (tracked in the
checkpoint), and every micro-batch is merged into the table by key.  The
merge is an upsert, so a batch replayed after a failure changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from pyspark.sql import functions as F

from ..sinks.tables import TableSpec, append, key_list, load, scd2_load
from ..sources.payloads import CORRUPT, with_corrupt_field


class CorruptRecordsError(ValueError):
    """Records that do not parse arrived and no quarantine table takes them."""


def payload_stream(spark: SparkSession, source_dir: str, schema, multi_line: bool = False,
                   max_files_per_trigger: int | None = None) -> DataFrame:
    reader = (spark.readStream.schema(with_corrupt_field(schema))
              .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
              .option("multiLine", str(bool(multi_line)).lower()))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.json(source_dir)


def batch_merger(spec: TableSpec, key=None, order=None, on_duplicate: str = "latest",
                 quarantine: TableSpec | None = None, transform=None, history=None):
    """The ``foreachBatch`` function: valid rows (optionally transformed) are
    upserted into ``spec``; corrupt rows are appended to ``quarantine`` with
    their batch id, and raise before anything is written when there is none.  Calling it again with the same batch (a replay after a
    failure) leaves the table as it was: the merge is an upsert by key.

    ``history=(order, tracked)`` makes ``spec`` a type-2 table instead:
    every batch goes through ``scd2_load`` (replayed rows are not applied)."""
    ks = key_list(key or spec.key)

    def merge_batch(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            valid = batch.where(batch[CORRUPT].isNull()).drop(CORRUPT)
            bad = batch.where(batch[CORRUPT].isNotNull())
            if quarantine is None:
                if not bad.isEmpty():
                    raise CorruptRecordsError(f"batch {batch_id} holds records that do not parse; name a quarantine table")
            else:
                # a replayed batch may add its corrupt rows again; batch_id tells them apart
                append(bad.select(F.lit(batch_id).alias("batch_id"), CORRUPT), quarantine)
            if transform is not None:
                valid = transform(valid)
            if history is not None:
                scd2_load(valid, spec, ks, list(history[0]), list(history[1]))
            else:
                load(valid, spec, ks, on_duplicate=on_duplicate, order=order)
        finally:
            batch.unpersist()

    return merge_batch


def ingest_incremental(spark: SparkSession, source_dir: str, schema, spec: TableSpec,
                       checkpoint: str, key=None, order=None, on_duplicate: str = "latest",
                       quarantine: TableSpec | None = None, transform=None,
                       available_now: bool = True, processing_time: str | None = None,
                       multi_line: bool = False, wait: bool = False,
                       max_files_per_trigger: int | None = None, history=None) -> StreamingQuery:
    """Start the stream; with ``available_now`` it stops once every landed
    file is merged (run it on a schedule).  ``transform(batch_df)`` may
    reshape valid rows before the merge (explode, flatten, split ...).

    Batches run on the stream's own session, whose table refresh does not
    reach the caller's cached relation; ``wait=True`` blocks until an
    ``available_now`` run ends and then refreshes the table here.
    ``max_files_per_trigger`` bounds each micro-batch (availableNow then
    runs several bounded batches instead of one that holds every file).
    ``history=(order, tracked)`` keeps a type-2 history instead of upserting."""
    stream = payload_stream(spark, source_dir, schema, multi_line, max_files_per_trigger)
    merge_batch = batch_merger(spec, key, order, on_duplicate, quarantine, transform, history)

    writer = (stream.writeStream.foreachBatch(merge_batch)
              .option("checkpointLocation", checkpoint))
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    query = writer.start()
    if wait and available_now:
        query.awaitTermination()
        for t in (spec, quarantine):
            if t is not None and spark.catalog.tableExists(f"{t.database}.{t.table}"):
                spark.catalog.refreshTable(t.qualified)
    return query
