"""Alert rules over trades, candles and book metrics; one row per firing, then deduplicated."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import ids
from ..functions.decimals import DECIMAL, exact_mul
from ..functions.keys import KEYS, instrument_key
from .dedupe import first_per_key
from .prefix import Running, running, sliding_sums, trailing

# Fixed values.
LARGE_TRADE, VOLUME_SPIKE, STALE_BOOK, LIQUIDITY_DROP = "LARGE_TRADE", "VOLUME_SPIKE", "STALE_BOOK", "LIQUIDITY_DROP"


def as_alerts(hits: DataFrame, kind: str, severity: str, at: Column, subject: Column, window_ref: Column,
              details: dict[str, Column], processor_version: str) -> DataFrame:
    """Rule hits in the columns of :data:`tickweave.schemas.ALERT`.

    ``subject`` names what fired within the instrument; it makes the dedupe key stable.
    """
    key = instrument_key(F.col("exchange"), F.col("instrument"))
    dedupe = F.concat(F.lit(kind + ":"), key, F.lit(":"), subject)
    pairs = [part for name, value in details.items() for part in (F.lit(name), value.cast("string"))]
    return hits.select(
        ids.uuid3(F.concat(F.lit("alert:"), dedupe, F.lit(":" + processor_version))).alias("alert_id"),
        "exchange", "instrument", F.lit(kind).alias("type"), F.lit(severity).alias("severity"),
        at.alias("triggered_at"), window_ref.cast("string").alias("window_ref"), dedupe.alias("dedupe_key"),
        F.create_map(*pairs).alias("details"), F.lit(processor_version).alias("processor_version"))


def large_trades(trades: DataFrame, threshold) -> DataFrame:
    """Trades whose notional is at least ``threshold``."""
    return trades.withColumn("notional", exact_mul(F.col("price"), F.col("quantity"))).where(
        F.col("notional") >= F.lit(threshold))


def large_trades_percentile(trades: DataFrame, percentile: float = 0.99) -> DataFrame:
    """Trades above their instrument's notional percentile: the smallest value that the share ``percentile`` of the trades does not exceed.

    Exact at any size. Equal values are counted, and the counts get running totals in chunks of the value range, so no task
    holds an instrument's trades. Chunks are about a quarter of a percent wide, whatever an instrument's prices are.
    """
    valued = trades.withColumn("notional", exact_mul(F.col("price"), F.col("quantity")))
    counted = valued.where("notional IS NOT NULL").groupBy(*KEYS, "notional").agg(F.count("*").alias("n"))
    # Logarithms of rising values do not fall, so chunks follow the order.
    chunk = F.when(F.col("notional") > 0, F.floor(F.log2(F.col("notional").cast("double")) * 256)).otherwise(F.lit(-(1 << 40))).cast("long")
    ranked = running(counted, list(KEYS), chunk, ["notional"], {"upto": Running("sum", "n")}, {"total": "n"})
    limits = ranked.where(F.col("upto") >= F.col("total") * F.lit(Decimal(str(percentile)))).groupBy(*KEYS).agg(F.min("notional").alias("threshold"))
    return valued.join(limits, list(KEYS)).where(F.col("notional") > F.col("threshold"))


def alert_large_trade(trades: DataFrame, threshold, processor_version: str) -> DataFrame:
    return as_alerts(
        large_trades(trades, threshold), LARGE_TRADE, "INFO", F.col("event_time"), F.col("trade_id"), F.lit(None),
        {"threshold": F.lit(threshold), "notional": F.col("notional")}, processor_version)


def alert_large_trade_percentile(trades: DataFrame, percentile: float, processor_version: str) -> DataFrame:
    """Alert rows of :func:`large_trades_percentile`."""
    return as_alerts(
        large_trades_percentile(trades, percentile), LARGE_TRADE, "INFO", F.col("event_time"), F.col("trade_id"), F.lit(None),
        {"percentile": F.lit(percentile), "threshold": F.col("threshold"), "notional": F.col("notional")}, processor_version)


def volume_scores(candles: DataFrame, size_ms: int, slots: int = 20, bucket_ms: int | None = None) -> DataFrame:
    """Add ``baseline_mean, baseline_stddev, baseline_windows, z_score`` of each candle's volume.

    The baseline is the candles in the ``slots`` window slots before this one. Slots without
    trades have no candle and do not count as zero volume.
    """
    timed = candles.withColumns({"at_ms": F.unix_millis("window_start"), "v": F.col("volume").cast("double")})
    scored = trailing(timed, KEYS, "at_ms", slots * size_ms, {
        "baseline_mean": F.avg("v"), "baseline_stddev": F.stddev_samp("v"), "baseline_windows": F.count("v"),
    }, include_current=False, bucket_ms=bucket_ms)
    z = F.when(F.col("baseline_stddev") > 0, (F.col("v") - F.col("baseline_mean")) / F.col("baseline_stddev"))
    return scored.withColumn("z_score", z).drop("v", "at_ms")


def alert_volume_spike(candles: DataFrame, size_ms: int, z_limit: float, processor_version: str,
                       slots: int = 20, min_windows: int = 5) -> DataFrame:
    hits = volume_scores(candles, size_ms, slots).where(
        (F.col("z_score") >= z_limit) & (F.col("baseline_windows") >= min_windows))
    start = F.unix_millis("window_start").cast("string")
    return as_alerts(
        hits, VOLUME_SPIKE, "WARN", F.col("window_end"), start, F.concat_ws(":", F.col("window"), start),
        {"z_score": F.col("z_score"), "volume": F.col("volume"), "mean": F.col("baseline_mean")}, processor_version)


def alert_stale_book(gaps: DataFrame, threshold_ms: int, processor_version: str) -> DataFrame:
    """From book silences (:func:`tickweave.operators.rolling.inter_trade_gaps` on book rows)."""
    at = F.timestamp_millis(F.col("gap_from_ms") + threshold_ms)
    return as_alerts(
        gaps.where(F.col("gap_ms") > threshold_ms), STALE_BOOK, "CRITICAL", at, F.col("gap_from_ms").cast("string"),
        F.lit(None), {"threshold_ms": F.lit(threshold_ms), "silent_ms": F.col("gap_ms")}, processor_version)


def depth_drops(metrics: DataFrame, span_ms: int, ratio: float) -> DataFrame:
    """Instants where total depth falls to ``ratio`` of its mean over the preceding span.

    Several updates in one millisecond count as one reading, the last.
    """
    total = (F.col("bid_depth") + F.col("ask_depth")).cast(DECIMAL)
    ticks = metrics.groupBy(*KEYS, F.unix_millis("event_time").alias("at_ms")).agg(
        F.max_by(total, F.col("src_offset")).alias("depth")).withColumn("one", F.lit(1).cast("long"))
    summed = sliding_sums(ticks, KEYS, "at_ms", span_ms, {"total": "depth", "with_own": "one"})
    # The reading itself is not part of what came before it.
    readings = F.col("with_own") - 1
    mean = F.when(readings > 0, (F.col("total") - F.col("depth")).cast("double") / readings)
    scored = summed.withColumns({"mean_depth": mean, "readings": readings}).drop("one", "total", "with_own")
    return scored.where(F.col("depth") <= F.col("mean_depth") * F.lit(ratio))


def alert_liquidity_drop(metrics: DataFrame, span_ms: int, ratio: float, processor_version: str) -> DataFrame:
    return as_alerts(
        depth_drops(metrics, span_ms, ratio), LIQUIDITY_DROP, "WARN", F.timestamp_millis("at_ms"),
        F.col("at_ms").cast("string"), F.lit(None),
        {"depth": F.col("depth"), "mean_depth": F.col("mean_depth")}, processor_version)


def dedupe_alerts(alerts: DataFrame) -> DataFrame:
    """First firing per dedupe key."""
    return first_per_key(alerts, ["dedupe_key"], F.asc("triggered_at"), F.asc("alert_id"))


def dedupe_alerts_stream(alerts: DataFrame, horizon: str) -> DataFrame:
    return alerts.withWatermark("triggered_at", horizon).dropDuplicatesWithinWatermark(["dedupe_key"])


def active_alerts(alerts: DataFrame, as_of: Column, horizon_ms: int) -> DataFrame:
    """Latest firing per dedupe key, if it fired within the horizon before ``as_of``."""
    since = F.unix_millis(as_of) - F.unix_millis("triggered_at")
    recent = alerts.where(since.between(0, horizon_ms))
    return first_per_key(recent, ["dedupe_key"], F.desc("triggered_at"), F.desc("alert_id"))
