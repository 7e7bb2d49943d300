"""Streaming candles.

Two modes. *Native* uses Spark's watermark: simple, but the watermark is one clock for all
instruments and lags one batch behind, so rows near the closing edge may be counted where a
record-by-record run drops them. *Exact* (:class:`ExactCandles`) reproduces the batch result
row for row: each micro-batch runs the batch operators, with the clocks and open candles of
the batch before as carry-in, so a hot instrument is still cut into chunks and folded
map-side. Exact mode needs micro-batches to arrive in log order.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.keys import KEYS, POSITION
from ..operators import candles as ops
from ..operators.candles import DEFAULT_WINDOW, WindowSpec


def event_clock(rows: DataFrame, column: str = "event_time", fallback: str = "ingestion_time") -> DataFrame:
    """Choose the time that drives a stream's windows; a missing one falls back, the row stays."""
    return rows.withColumn(column, F.coalesce(column, fallback))


def native_candles(trades: DataFrame, spec: WindowSpec = DEFAULT_WINDOW) -> DataFrame:
    """Windowed aggregate under a watermark: append mode gives finals, update mode provisionals."""
    graced = trades.withWatermark("event_time", f"{spec.grace_ms} milliseconds")
    folded = ops.foldable(graced).groupBy(*KEYS, F.window("event_time", f"{spec.size_ms} milliseconds").alias("w")).agg(
        *ops.fold_aggregates())
    return folded.select(
        *KEYS, F.lit(spec.name).alias("window"), F.col("w.start").alias("window_start"),
        F.col("w.end").alias("window_end"), *[c for c in folded.columns if c not in (*KEYS, "w")],
    ).withColumn("vwap", ops.decimals.safe_div(F.col("quote_volume"), F.col("volume")))


def dedupe_stream(trades: DataFrame, horizon: str) -> DataFrame:
    """First row of each dedupe key within the horizon, which must cover window plus grace."""
    return trades.withWatermark("event_time", horizon).dropDuplicatesWithinWatermark(["exchange", "dedupe_key"])


def with_heartbeats(trades: DataFrame, beats: DataFrame) -> DataFrame:
    """Trades plus rows that only advance time, for instruments that fall silent.

    ``beats`` needs the scope, position and ``event_time`` columns.
    """
    marked = beats.withColumn("heartbeat", F.lit(True))
    return trades.withColumn("heartbeat", F.lit(False)).unionByName(marked, allowMissingColumns=True)


@dataclass
class ExactCandles:
    """Exact candle job over micro-batches.

    Below ``root``: ``candles/batch=N`` (provisional and final rows of batch N),
    ``late/batch=N`` and two alternating state slots. Batch N reads the slot of N-1 and
    overwrites its own, so running a batch again gives the same files.
    """

    root: str
    spec: WindowSpec = DEFAULT_WINDOW
    scope: Sequence[str] = KEYS
    chunk_rows: int = ops.CHUNK_ROWS
    processor_version: str = "dev"
    _keys: list[str] = field(init=False)

    def __post_init__(self):
        extra = [c for c in self.scope if c not in KEYS]
        self._keys = [*KEYS, *extra, "window", "window_start", "window_end"]

    def _slot(self, batch_id: int, part: str) -> str:
        return f"{self.root}/state/{batch_id % 2}/{part}"

    def process(self, batch: DataFrame, batch_id: int) -> None:
        """The ``foreachBatch`` body."""
        spark = batch.sparkSession
        rows = batch if "heartbeat" in batch.columns else batch.withColumn("heartbeat", F.lit(False))
        held = rows.persist(StorageLevel.DISK_ONLY)
        try:
            clocks = self._advance_clocks(spark, held, batch_id)
            marked = self._mark(spark, held, batch_id).persist(StorageLevel.DISK_ONLY)
            try:
                ops.late_invalid_events(marked, self.processor_version).write.mode("overwrite").parquet(
                    f"{self.root}/late/batch={batch_id}")
                self._fold(spark, marked.where(~F.col("late")), clocks, batch_id)
            finally:
                marked.unpersist()
        finally:
            held.unpersist()

    def _advance_clocks(self, spark: SparkSession, rows: DataFrame, batch_id: int) -> DataFrame:
        clocks = rows.select(*self.scope, "event_time")
        if batch_id > 0:
            clocks = clocks.unionByName(spark.read.parquet(self._slot(batch_id - 1, "clocks")))
        path = self._slot(batch_id, "clocks")
        clocks.groupBy(*self.scope).agg(F.max("event_time").alias("event_time")).write.mode("overwrite").parquet(path)
        return spark.read.parquet(path)

    def _mark(self, spark: SparkSession, rows: DataFrame, batch_id: int) -> DataFrame:
        seeded = rows
        if batch_id > 0:
            # The clock so far enters as one row per scope, ahead of every real position.
            seed = spark.read.parquet(self._slot(batch_id - 1, "clocks")).select(
                *self.scope, "event_time", F.lit(True).alias("heartbeat"),
                *[F.lit(-1).cast(rows.schema[c].dataType).alias(c) for c in POSITION if c not in self.scope])
            seeded = rows.unionByName(seed, allowMissingColumns=True)
        marked = ops.mark_late(seeded, self.spec, self.scope, self.chunk_rows)
        return marked.where(~F.col("heartbeat")).drop("heartbeat")

    def _fold(self, spark: SparkSession, on_time: DataFrame, clocks: DataFrame, batch_id: int) -> None:
        parts = ops.partial_candles(on_time, self._keys).withColumn("touched", F.lit(True))
        if batch_id > 0:
            was_open = spark.read.schema(self._open_schema(parts)).parquet(
                self._slot(batch_id - 1, "open")).where("NOT is_final").drop("is_final")
            parts = parts.unionByName(was_open.withColumn("touched", F.lit(False)))
        merged = ops.merge_candles(
            parts, self._keys, F.col("first_order"), F.col("last_order"), F.min("first_order").alias("first_order"),
            F.max("last_order").alias("last_order"), F.bool_or("touched").alias("touched"))
        judged = merged.join(clocks.withColumnRenamed("event_time", "clock"), list(self.scope)).withColumn(
            "is_final", ops.is_late(F.col("window_end"), self.spec.grace_ms, F.col("clock"))).drop("clock")
        path = self._slot(batch_id, "open")
        judged.write.mode("overwrite").partitionBy("is_final").parquet(path)
        # Written once, then read back: the emitted rows are the stored state, not a second computation.
        state = spark.read.schema(judged.schema).parquet(path)
        ops.stamp_candles(state.where("touched OR is_final"), self.processor_version, F.current_timestamp()).drop(
            "touched", "first_order", "last_order").write.mode("overwrite").parquet(
            f"{self.root}/candles/batch={batch_id}")

    def _open_schema(self, parts: DataFrame) -> T.StructType:
        fields = [f for f in parts.schema.fields if f.name != "touched"]
        return T.StructType([*fields, T.StructField("is_final", T.BooleanType())])

    def start(self, trades: DataFrame, checkpoint: str, **trigger) -> StreamingQuery:
        return (trades.writeStream.foreachBatch(self.process).option("checkpointLocation", checkpoint)
                .trigger(**(trigger or {"processingTime": "2 seconds"})).start())

    def candles(self, spark: SparkSession) -> DataFrame:
        """Everything emitted so far, with its ``batch``."""
        return spark.read.parquet(f"{self.root}/candles")

    def finals(self, spark: SparkSession) -> DataFrame:
        return self.candles(spark).where("is_final")

    def late(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.root}/late")
