"""Sliding-window metrics and gap detection, at most one row per (instrument, ms) per task bucket."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.decimals import DECIMAL
from ..functions.keys import KEYS
from .prefix import Running, running, sliding_sums, trailing

HOUR_MS = 3_600_000


def per_millisecond(trades: DataFrame, *aggs: Column, keys: Sequence[str] = KEYS) -> DataFrame:
    """Collapse rows that share an instrument and a millisecond before any window."""
    return trades.groupBy(*keys, F.unix_millis("event_time").alias("at_ms")).agg(*aggs)


def rolling_volume(trades: DataFrame, span_ms: int) -> DataFrame:
    """Volume and trade count over ``[t - span, t]`` at each instant with trades."""
    ticks = per_millisecond(trades, F.sum("quantity").cast(DECIMAL).alias("qty"), F.count("*").alias("n"))
    out = sliding_sums(ticks, KEYS, "at_ms", span_ms, {"rolling_volume": "qty", "rolling_trades": "n"})
    return out.withColumn("rolling_volume", F.col("rolling_volume").cast(DECIMAL)).drop("qty", "n")


def rolling_volume_stream(trades: DataFrame, span: str, slide: str) -> DataFrame:
    """Hopping-window form for streams (state is one row per open window)."""
    return trades.groupBy(*KEYS, F.window("event_time", span, slide).alias("w")).agg(
        F.sum("quantity").cast(DECIMAL).alias("rolling_volume"), F.count("*").alias("rolling_trades"))


def log_returns(candles: DataFrame, chunk_ms: int = 30 * 24 * HOUR_MS) -> DataFrame:
    """Log return of each candle's close against the previous candle of the instrument.

    A close of zero is a return of minus infinity, the next one of plus infinity; from zero to zero it is no number.
    """
    ticks = candles.select(*KEYS, F.unix_millis("window_start").alias("at_ms"), F.col("close").cast("double").alias("close"))
    linked = running(ticks, KEYS, F.expr(f"at_ms div {chunk_ms}"), ["at_ms"],
                     {"previous_close": Running("last", "close", before=True)})
    close, before = F.col("close"), F.col("previous_close")
    # Division by zero is an error in Spark, and its logarithm of zero is NULL.
    at_zero = F.when(close > 0, float("inf")).when(before > 0, float("-inf")).otherwise(float("nan"))
    return linked.withColumn("log_return", F.when((before == 0) | ((close == 0) & (before > 0)), at_zero)
                             .otherwise(F.log(close / F.when(before != 0, before))))


def rolling_volatility(candles: DataFrame, span_ms: int, bucket_ms: int | None = None) -> DataFrame:
    """Sample standard deviation of candle log returns over ``[t - span, t]``.

    The formula is this package's choice: close-to-close log returns, no annualisation, NULL
    below two returns.
    """
    returns = log_returns(candles)
    return trailing(returns, KEYS, "at_ms", span_ms, {
        "volatility": F.stddev_samp("log_return"), "returns": F.count("log_return")}, bucket_ms=bucket_ms)


def inter_trade_gaps(trades: DataFrame, threshold_ms: int, chunk_ms: int = 24 * HOUR_MS, until: Column | None = None) -> DataFrame:
    """Silences of at least ``threshold_ms`` between consecutive instants of an instrument, and, with ``until``, up to that time."""
    ticks = per_millisecond(trades, F.count("*").alias("n")).withColumn("seen_ms", F.col("at_ms"))
    if until is not None:
        ends = ticks.groupBy(*KEYS).agg(F.max("at_ms").alias("last_ms")).where(F.col("last_ms") < F.unix_millis(until))
        ticks = ticks.unionByName(ends.select(*KEYS, F.unix_millis(until).alias("at_ms")), allowMissingColumns=True)
    linked = running(ticks, KEYS, F.expr(f"at_ms div {chunk_ms}"), ["at_ms"],
                     {"previous_ms": Running("max", "seen_ms", before=True)})
    gap = F.col("at_ms") - F.col("previous_ms")
    return linked.select(*KEYS, F.col("previous_ms").alias("gap_from_ms"), F.col("at_ms").alias("gap_to_ms"),
                         gap.alias("gap_ms")).where(F.col("gap_ms") >= threshold_ms)


def ingest_gaps(envelopes: DataFrame, chunk: int = 65_536) -> DataFrame:
    """Missing ingest sequence numbers inside each connection.

    A sequence starts at zero on a new connection, so connections are never compared and a first number above
    zero is a loss at the head, after sequence -1.
    Redelivered frames collapse first.
    """
    seen = envelopes.groupBy("source_connection_id", "ingest_sequence").agg(F.count("*").alias("n"))
    seen = seen.withColumn("seen", F.col("ingest_sequence"))
    linked = running(seen, ["source_connection_id"], F.expr(f"ingest_sequence div {chunk}"), ["ingest_sequence"],
                     {"previous": Running("max", "seen", before=True)})
    linked = linked.withColumn("previous", F.coalesce("previous", F.lit(-1).cast("long")))
    return linked.select(
        "source_connection_id", F.col("previous").alias("after_sequence"),
        F.col("ingest_sequence").alias("next_sequence"),
        (F.col("ingest_sequence") - F.col("previous") - 1).alias("missing")).where(F.col("missing") > 0)
