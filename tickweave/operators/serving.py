"""Read-side queries over trades, stored candles, book metrics and alerts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import KEYS, SEPARATOR, log_order
from .candles import roll_up
from .dedupe import first_n_per_key


def latest_price(trades: DataFrame) -> DataFrame:
    """Last trade in log order per instrument, and when it happened."""
    ordered = trades.withColumn("__order", log_order())
    return ordered.groupBy(*KEYS).agg(
        F.max_by("price", "__order").alias("price"), F.max_by("event_time", "__order").alias("as_of"))


def candle_history(finals: DataFrame, instrument: str, limit: int = 10, window: str | None = None,
                   exchange: str | None = None) -> DataFrame:
    """An instrument's newest candles (filter reaches the scan, then a top-n without a full sort)."""
    chosen = finals.where(F.col("instrument") == instrument)
    if window:
        chosen = chosen.where(F.col("window") == window)
    if exchange:
        chosen = chosen.where(F.col("exchange") == exchange)
    return chosen.orderBy(F.desc("window_start")).limit(limit)


def candles_query(candles: DataFrame, instrument: str, window: str, limit: int = 200) -> DataFrame:
    return candle_history(candles.where("is_final"), instrument, limit, window)


def latest_n_per_instrument(candles: DataFrame, n: int = 200) -> DataFrame:
    return first_n_per_key(candles, [*KEYS, "window"], n, F.desc("window_start"))


def metrics_range(metrics: DataFrame, instrument: str, start: Column, end: Column, at: str = "event_time",
                  day: str | None = None) -> DataFrame:
    """Rows of an instrument in ``[start, end)``; with a day column, other days are not read."""
    chosen = metrics.where((F.col("instrument") == instrument) & (F.col(at) >= start) & (F.col(at) < end))
    if day:
        chosen = chosen.where(F.col(day).between(F.to_date(start), F.to_date(end)))
    return chosen


def range_aggregates(candles: DataFrame, size_ms: int = 86_400_000, name: str = "D1") -> DataFrame:
    """Stored candles rolled up to longer ones."""
    return roll_up(candles, size_ms, name)


def spread_imbalance_now(book_current: DataFrame) -> DataFrame:
    """Current spread and imbalance, always with the book's state beside them."""
    return book_current.select(*KEYS, "book_state", "best_bid", "best_ask", "spread", "spread_bps", "imbalance",
                               F.col("event_time").alias("as_of"))


def instrument_health(trades: DataFrame, invalid: DataFrame, as_of: Column, stale_after_ms: int,
                      book_current: DataFrame | None = None) -> DataFrame:
    """Last-seen time, counts and a state per instrument.

    ``invalid`` needs ``instrument`` and ``exchange``, or the ``original_key`` that begins with it. Both sides are aggregated
    before they meet.
    """
    if "exchange" not in invalid.columns:
        invalid = invalid.withColumn("exchange", F.substring_index("original_key", SEPARATOR, 1))
    seen = trades.groupBy(*KEYS).agg(F.count("*").alias("trades"), F.max("event_time").alias("last_seen"))
    bad = invalid.where(F.col("instrument").isNotNull()).groupBy(*KEYS).agg(F.count("*").alias("rejected"))
    health = seen.join(bad, list(KEYS), "full_outer").withColumns({
        "trades": F.coalesce("trades", F.lit(0)), "rejected": F.coalesce("rejected", F.lit(0))})
    silent = F.unix_millis(as_of) - F.unix_millis("last_seen")
    state = F.when(F.col("last_seen").isNull(), "NO_TRADES").when(silent > stale_after_ms, "STALE").otherwise("ACTIVE")
    health = health.withColumn("state", state)
    if book_current is not None:
        health = health.join(book_current.select(*KEYS, "book_state"), list(KEYS), "left")
    return health


def lineage(derived: DataFrame, sources: DataFrame) -> DataFrame:
    """Derived rows with their source envelope, by ``source_event_id``; ``orphan`` marks those whose envelope is not in ``sources``."""
    origin = sources.select(F.col("event_id").alias("source_event_id"), F.col("trace_id").alias("source_trace_id"),
                            F.col("source_connection_id"), F.col("ingest_sequence"), F.lit(False).alias("orphan"))
    return derived.join(origin, "source_event_id", "left").withColumn("orphan", F.coalesce("orphan", F.lit(True)))


def trace_walk(trace_id: str, **stages: DataFrame) -> DataFrame:
    """Every row that carries one trace id, by stage."""
    parts = [df.where(F.col("trace_id") == trace_id).select(
        F.lit(stage).alias("stage"), "event_id", "trace_id") for stage, df in stages.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def version_lookup(derived: DataFrame, versions: DataFrame) -> DataFrame:
    """Derived rows with the registered build that made them; unregistered builds stay, unmatched."""
    builds = versions.groupBy("processor_version").agg(
        F.max_by("git_sha", "deployed_at").alias("git_sha"), F.max("deployed_at").alias("deployed_at"))
    return derived.join(builds, "processor_version", "left")
