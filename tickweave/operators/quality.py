"""Operational and data-quality counts as tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import KEYS
from ..functions.times import FROM_INGESTION, window_start
from .prefix import Running, running


def trades_by_instrument(trades: DataFrame) -> DataFrame:
    """Normalised trades and ingestion-time fallbacks per instrument."""
    return trades.groupBy(*KEYS).agg(
        F.count("*").alias("trades"), F.count_if(F.col("event_time_source") == FROM_INGESTION).alias("fallbacks"))


def invalid_by_reason(routed: DataFrame) -> DataFrame:
    return routed.where(F.col("route") == "invalid").groupBy("reason").agg(F.count("*").alias("rejected"))


def dead_letter_count(routed: DataFrame) -> DataFrame:
    return routed.where(F.col("route") == "dead").agg(F.count("*").alias("dead_letters"))


def route_counts(routed: DataFrame) -> DataFrame:
    return routed.groupBy("route").agg(F.count("*").alias("rows"))


def candles_by_finality(candles: DataFrame) -> DataFrame:
    return candles.groupBy(*KEYS, "is_final").agg(F.count("*").alias("candles"))


def sink_counts(judged: DataFrame, table: str) -> DataFrame:
    """Rows written, skipped and rejected by reason."""
    return judged.groupBy(F.lit(table).alias("table_name"), "verdict", "reason").agg(F.count("*").alias("rows"))


def batch_percentiles(batch_log: DataFrame) -> DataFrame:
    """Rows written, and batch-size and flush-time percentiles per table, from the sink's log."""
    stored = batch_log.where("verdict = 'store'")
    sizes = exact_percentiles(stored, ["table_name"], F.col("rows"), [0.5, 0.95]).select(
        "table_name", F.col("percentiles").alias("batch_rows"), F.col("observations").alias("batches"))
    times = exact_percentiles(stored, ["table_name"], F.col("flush_ms"), [0.5, 0.95, 0.99]).select(
        "table_name", F.col("percentiles").alias("flush_ms"))
    written = stored.groupBy("table_name").agg(F.sum("rows").alias("rows_written"))
    return sizes.join(times, "table_name").join(written, "table_name")


def exact_percentiles(df: DataFrame, keys: Sequence[str], value: Column, points: Sequence[float],
                      chunk: int = 65_536) -> DataFrame:
    """Interpolated percentiles of a whole-number measure.

    Values are counted, the counts get running totals in chunks of the value range, and each
    percentile picks the one or two values its rank falls on: no task holds a distribution.
    """
    counted = df.groupBy(*keys, value.cast("long").alias("value")).agg(F.count("*").alias("n")).where("value IS NOT NULL")
    ranked = running(counted, keys, F.expr(f"value div {chunk}"), ["value"], {"upto": Running("sum", "n")}, {"total": "n"})
    place = [(F.lit(float(p)) * (F.col("total") - 1)) for p in points]

    def at(rank: Column) -> Column:
        held = (F.col("upto") > rank) & (F.col("upto") - F.col("n") <= rank)
        return F.max(F.when(held, F.col("value"))).cast("double")
    ends = [c for i, rank in enumerate(place) for c in (
        at(F.floor(rank)).alias(f"lo{i}"), at(F.ceil(rank)).alias(f"hi{i}"), F.max(rank - F.floor(rank)).alias(f"part{i}"))]
    picked = ranked.groupBy(*keys).agg(*ends, F.max("total").alias("observations"))
    values = [F.col(f"lo{i}") + (F.col(f"hi{i}") - F.col(f"lo{i}")) * F.col(f"part{i}") for i in range(len(points))]
    return picked.select(*keys, F.array(*values).alias("percentiles"), "observations")


def latency_percentiles(final_candles: DataFrame) -> DataFrame:
    """End-to-end latency of finals: processing time minus window end, negatives ignored."""
    latency = F.unix_millis("processing_time") - F.unix_millis("window_end")
    kept = final_candles.withColumn("latency_ms", latency).where(F.col("latency_ms") >= 0)
    p = F.col("percentiles")
    return exact_percentiles(kept, [], F.col("latency_ms"), [0.5, 0.95, 0.99]).select(
        p[0].alias("p50_ms"), p[1].alias("p95_ms"), p[2].alias("p99_ms"), "observations")


def frames_by_type(classified: DataFrame) -> DataFrame:
    return classified.groupBy("frame_type").agg(F.count("*").alias("frames"))


def frames_by_target(routed: DataFrame) -> DataFrame:
    return routed.groupBy(F.coalesce("target", F.lit("observed")).alias("target")).agg(F.count("*").alias("frames"))


def unknown_by_symbol(unknown: DataFrame) -> DataFrame:
    return unknown.groupBy(F.coalesce("symbol", F.lit("none")).alias("symbol")).agg(F.count("*").alias("frames"))


#: Candle invariants; each holds for every correct candle.
INVARIANTS = {
    "high_below_low": "high < low",
    "vwap_outside_range": "trade_count > 0 AND NOT (vwap BETWEEN low AND high)",
    "sides_do_not_sum": "buy_volume + sell_volume <> volume",
    "event_time_not_window_start": "event_time <> window_start",
    "stored_not_final": "NOT is_final",
}


def invariant_violations(candles: DataFrame, checks: dict[str, str] = INVARIANTS) -> DataFrame:
    """One row per candle and violated invariant; empty when all is well."""
    failed = F.filter(F.array(*[F.when(F.expr(rule), F.lit(name)) for name, rule in checks.items()]),
                      lambda name: name.isNotNull())
    return candles.select(*KEYS, "window", "window_start", F.explode(failed).alias("violation"))


def skew_report(rows: DataFrame, keys: Sequence[str] = KEYS, hot_share: float = 0.3) -> DataFrame:
    """Rows and share of the total per key, hot keys marked, largest first."""
    counts = rows.groupBy(*keys).agg(F.count("*").alias("rows"))
    total = counts.agg(F.sum("rows").alias("total")).scalar()
    share = F.col("rows") / total
    return counts.withColumn("share", share).withColumn("hot", F.col("share") >= hot_share).orderBy(F.desc("rows"), *keys)


def event_rates(rows: DataFrame, at: str = "event_time", step_ms: int = 1_000, keys: Sequence[str] = ()) -> DataFrame:
    """Rows per time step."""
    return rows.groupBy(*keys, window_start(F.col(at), step_ms).alias("step")).agg(
        F.count("*").alias("rows"), (F.count("*") / F.lit(step_ms / 1000.0)).alias("per_second"))
