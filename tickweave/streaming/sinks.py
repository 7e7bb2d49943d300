"""Streaming writers: routed outputs and stored tables, both safe to retry.

A batch that fails stops the query with its offsets uncommitted; a restart runs the same
batch again, and every writer overwrites its own batch folder, so nothing is lost or doubled.
"""

from __future__ import annotations

import time

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import normalize
from ..schemas import DEAD_LETTER, INVALID_EVENTS, NORMALIZED_TRADES, RAW_ENVELOPE
from ..sources.tables import TableSpec, verdicts, write_batch

# Fixed value: the sink's batching limit.
FLUSH_INTERVAL = "2 seconds"


def write_routed(envelopes: DataFrame, batch_id: int, root: str, processor_version: str) -> None:
    """One normalisation, three outputs: trades, quarantined events, dead letters."""
    routed = normalize.normalize_frames(envelopes, processor_version).persist(StorageLevel.DISK_ONLY)
    try:
        outputs = {
            NORMALIZED_TRADES: normalize.trades(routed),
            INVALID_EVENTS: normalize.invalid_events(routed),
            DEAD_LETTER: normalize.dead_letters(routed, RAW_ENVELOPE.names),
        }
        for name, rows in outputs.items():
            rows.write.mode("overwrite").parquet(f"{root}/{name}/batch={batch_id}")
    finally:
        routed.unpersist()


def start_normalizer(envelopes: DataFrame, root: str, checkpoint: str, processor_version: str,
                     **trigger) -> StreamingQuery:
    return (envelopes.writeStream
            .foreachBatch(lambda batch, batch_id: write_routed(batch, batch_id, root, processor_version))
            .option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": "2 seconds"})).start())


def write_stored(rows: DataFrame, batch_id: int, table: TableSpec, root: str) -> None:
    """Store a micro-batch and log its verdict counts and flush time beside it.

    The rows are counted while they are written, so that a batch is evaluated once.
    """
    started = time.perf_counter()
    seen = Observation()
    write_batch(rows, table, root, batch_id, seen=seen)
    flush_ms = int((time.perf_counter() - started) * 1000)
    counts = [(verdict, reason, seen.get[f"v{k}"]) for k, (verdict, reason) in enumerate(verdicts(table)) if seen.get[f"v{k}"]]
    log = rows.sparkSession.createDataFrame(counts, "verdict string, reason string, rows long")
    (log.select(F.lit(table.name).alias("table_name"), "verdict", "reason", "rows", F.lit(flush_ms).alias("flush_ms"),
                F.current_timestamp().alias("written_at"))
        .write.mode("overwrite").parquet(f"{root}/{table.name}.log/batch={batch_id}"))


def start_sink(rows: DataFrame, table: TableSpec, root: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Batches close by time here; bound their size at the source (``maxOffsetsPerTrigger``).

    Skipped and rejected rows advance the offsets too: the checkpoint follows what was read.
    """
    return (rows.writeStream.foreachBatch(lambda batch, batch_id: write_stored(batch, batch_id, table, root))
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": FLUSH_INTERVAL})).start())
