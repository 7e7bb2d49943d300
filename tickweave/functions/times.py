"""Event-time parsing, trust limits and window arithmetic (all in UTC)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .decimals import is_blank

# Fixed values.
MAX_FUTURE_SKEW_MS = 60_000
MAX_PAST_SKEW_MS = 24 * 3_600_000
FROM_EXCHANGE = "EXCHANGE"
FROM_INGESTION = "INGESTION_FALLBACK"

# Spark's own parser also takes bare dates and local times, which are not instants.
_INSTANT = r"^\d{4}-\d\d-\d\d[Tt]\d\d:\d\d:\d\d(\.\d{1,9})?([Zz]|[+-]\d\d:\d\d)$"


def parse_exchange_time(text: Column) -> Column:
    """ISO-8601 instant cut (not rounded) to milliseconds; NULL when blank or not an instant."""
    parsed = F.when(~is_blank(text) & text.rlike(_INSTANT), F.upper(text)).try_cast("timestamp")
    return F.date_trunc("MILLISECOND", parsed)


def resolve_event_time(exchange_time: Column, ingestion_time: Column) -> Column:
    """``struct(event_time, source)``: exchange time inside inclusive limits, else ingestion time."""
    lead = F.unix_micros(exchange_time) - F.unix_micros(ingestion_time)
    trusted = lead.between(-MAX_PAST_SKEW_MS * 1000, MAX_FUTURE_SKEW_MS * 1000)
    trusted = F.coalesce(trusted, F.lit(False))
    return F.struct(
        F.when(trusted, exchange_time).otherwise(ingestion_time).alias("event_time"),
        F.when(trusted, FROM_EXCHANGE).otherwise(FROM_INGESTION).alias("source"),
    )


def from_millis(ms: Column) -> Column:
    return F.timestamp_millis(ms)


def window_start(event_time: Column, size_ms: int) -> Column:
    """Start of the epoch-aligned window ``[start, start + size)``."""
    us = F.unix_micros(event_time)
    return F.timestamp_micros(us - F.pmod(us, F.lit(size_ms * 1000)))


def plus_ms(ts: Column, ms: int | Column) -> Column:
    step = F.lit(ms * 1000) if isinstance(ms, int) else ms * 1000
    return F.timestamp_micros(F.unix_micros(ts) + step)


def naive(ts: Column) -> Column:
    """UTC timestamp as a zone-less one, for comparison with engines that have no zones."""
    return ts.cast("timestamp_ntz")
