"""Fixed, versioned schemas; nothing in the package infers one."""

from __future__ import annotations

from pyspark.sql import types as T

# Fixed values.
SCHEMA_VERSION = 1
SIDES = ("BUY", "SELL")
WINDOW_NAMES = {1_000: "S1", 10_000: "S10", 60_000: "M1"}
STAGES = ("INGEST", "NORMALIZE", "BOOK_APPLY", "WINDOW", "ALERT", "SINK")
REASONS = ("SCHEMA_INVALID", "PARSE_ERROR", "CHECKSUM_MISMATCH", "SEQUENCE_GAP",
           "IMPOSSIBLE_STATE", "LATE_BEYOND_GRACE", "UNKNOWN_TYPE")
RAW_TRADES, RAW_BOOK = "raw.kraken.trade", "raw.kraken.book"
NORMALIZED_TRADES, NORMALIZED_BOOK = "normalized.trades", "normalized.book.events"
DERIVED_CANDLES, DERIVED_BOOK_METRICS = "derived.candles", "derived.book.metrics"
ALERTS, BOOK_CURRENT = "alerts", "state.book.current"
INVALID_EVENTS, DEAD_LETTER = "invalid.events", "dead-letter"
BOOK_RESYNC = "control.book.resync"
#: Days each stream is kept; 0 is a latest-per-key table that never expires.
RETENTION_DAYS = {
    RAW_TRADES: 7, RAW_BOOK: 7, NORMALIZED_TRADES: 3, NORMALIZED_BOOK: 3,
    DERIVED_CANDLES: 14, DERIVED_BOOK_METRICS: 3, ALERTS: 30, BOOK_CURRENT: 0,
    INVALID_EVENTS: 14, DEAD_LETTER: 14, BOOK_RESYNC: 1,
}
REPLAY_STATUSES = ("PENDING", "RUNNING", "COMPLETED", "FAILED", "CANCELLED")

_DEC = T.DecimalType(38, 18)
_TS = T.TimestampType()


def _struct(*fields: tuple) -> T.StructType:
    return T.StructType([T.StructField(name, kind, nullable) for name, kind, nullable in fields])


#: Where a record sits in its log. ``record_key`` is the incoming key.
LOG_POSITION = [("record_key", T.StringType(), True), ("src_partition", T.IntegerType(), False),
                ("src_offset", T.LongType(), False)]

RAW_ENVELOPE = _struct(
    ("event_id", T.StringType(), False), ("exchange", T.StringType(), False),
    ("channel", T.StringType(), False), ("instrument", T.StringType(), True),
    ("received_at", _TS, False), ("source_connection_id", T.StringType(), False),
    ("ingest_sequence", T.LongType(), False), ("payload", T.BinaryType(), False),
    ("payload_encoding", T.StringType(), False), ("trace_id", T.StringType(), False),
    ("schema_version", T.IntegerType(), False), *LOG_POSITION,
)

EVENT_HEADER = _struct(
    ("event_id", T.StringType(), False), ("exchange", T.StringType(), False),
    ("instrument", T.StringType(), False), ("event_time", _TS, False),
    ("ingestion_time", _TS, False), ("processing_time", _TS, True),
    ("event_time_source", T.StringType(), False), ("schema_version", T.IntegerType(), False),
    ("trace_id", T.StringType(), False), ("source_event_id", T.StringType(), True),
)

TRADE_EVENT = _struct(
    ("header", EVENT_HEADER, False), ("trade_id", T.StringType(), False), ("price", _DEC, False),
    ("quantity", _DEC, False), ("side", T.StringType(), False), ("dedupe_key", T.StringType(), False),
)

_CANDLE_FIELDS = [
    ("window", T.StringType(), False), ("window_start", _TS, False), ("window_end", _TS, False),
    *[(n, _DEC, False) for n in ("open", "high", "low", "close", "volume", "quote_volume", "vwap",
                                 "buy_volume", "sell_volume")],
    ("trade_count", T.LongType(), False), ("is_final", T.BooleanType(), False),
    ("input_trade_count", T.LongType(), False), ("processor_version", T.StringType(), False),
]

CANDLE = _struct(("header", EVENT_HEADER, False), *_CANDLE_FIELDS)

INVALID_EVENT = _struct(
    ("event_id", T.StringType(), False), ("occurred_at", _TS, False), ("stage", T.StringType(), False),
    ("reason", T.StringType(), False), ("error_class", T.StringType(), True),
    ("original_topic", T.StringType(), False), ("original_key", T.StringType(), True),
    ("original_payload", T.BinaryType(), True), ("instrument", T.StringType(), True),
    ("trace_id", T.StringType(), True), ("processor_version", T.StringType(), False),
    ("schema_version", T.IntegerType(), False),
)

#: Trades as columns, the working form of every operator downstream of normalisation.
TRADES = _struct(
    *[(f.name, f.dataType, f.nullable) for f in EVENT_HEADER],
    ("trade_id", T.StringType(), False), ("price", _DEC, False), ("quantity", _DEC, False),
    ("side", T.StringType(), False), ("dedupe_key", T.StringType(), False),
    ("src_partition", T.IntegerType(), False), ("src_offset", T.LongType(), False),
    ("ordinal", T.IntegerType(), False),
)

_LEVELS = T.ArrayType(_struct(("price", _DEC, False), ("quantity", _DEC, False)), False)

#: One canonical book message; deltas with quantity 0 remove a level.
BOOK_EVENT = _struct(
    ("exchange", T.StringType(), False), ("instrument", T.StringType(), True),
    ("type", T.StringType(), False), ("event_time", _TS, False), ("ingestion_time", _TS, False),
    ("bids", _LEVELS, True), ("asks", _LEVELS, True), ("checksum", T.LongType(), True),
    ("sequence", T.LongType(), True), ("trace_id", T.StringType(), True),
    ("src_partition", T.IntegerType(), False), ("src_offset", T.LongType(), False),
    ("ordinal", T.IntegerType(), False),
)

ALERT = _struct(
    ("alert_id", T.StringType(), False), ("exchange", T.StringType(), False),
    ("instrument", T.StringType(), False), ("type", T.StringType(), False),
    ("severity", T.StringType(), False), ("triggered_at", _TS, False),
    ("window_ref", T.StringType(), True), ("dedupe_key", T.StringType(), False),
    ("details", T.MapType(T.StringType(), T.StringType()), False),
    ("processor_version", T.StringType(), False),
)

STORED_TRADES = _struct(
    ("exchange", T.StringType(), False), ("instrument", T.StringType(), False),
    ("trade_id", T.StringType(), False), ("event_id", T.StringType(), False),
    ("event_time", _TS, False), ("ingestion_time", _TS, False),
    ("event_time_source", T.StringType(), False), ("price", _DEC, False), ("quantity", _DEC, False),
    ("side", T.StringType(), False), ("trace_id", T.StringType(), False), ("written_at", _TS, False),
)

STORED_CANDLES = _struct(
    ("exchange", T.StringType(), False), ("instrument", T.StringType(), False),
    *[f for f in _CANDLE_FIELDS if f[0] != "is_final"], ("written_at", _TS, False),
)

INSTRUMENT = _struct(
    ("id", T.LongType(), False), ("exchange", T.StringType(), False),
    ("canonical_symbol", T.StringType(), False), ("exchange_symbol", T.StringType(), False),
    ("base_asset", T.StringType(), False), ("quote_asset", T.StringType(), False),
    ("tick_size", _DEC, False), ("lot_size", _DEC, False), ("price_precision", T.IntegerType(), False),
    ("quantity_precision", T.IntegerType(), False), ("book_depth", T.IntegerType(), False),
    ("enabled", T.BooleanType(), False), ("created_at", _TS, True), ("updated_at", _TS, True),
)

PROCESSOR_VERSION = _struct(
    ("id", T.LongType(), False), ("processor_version", T.StringType(), False),
    ("schema_version", T.IntegerType(), False), ("git_sha", T.StringType(), True),
    ("deployed_at", _TS, False), ("retired_at", _TS, True), ("notes", T.StringType(), True),
)

REPLAY_JOB = _struct(
    ("id", T.StringType(), False), ("application_id", T.StringType(), False),
    ("source_topic", T.StringType(), False), ("target_topic", T.StringType(), False),
    ("from_offset", T.LongType(), True), ("to_offset", T.LongType(), True),
    ("from_timestamp", _TS, True), ("to_timestamp", _TS, True),
    ("processor_version", T.StringType(), False), ("requested_by", T.StringType(), False),
    ("status", T.StringType(), False), ("started_at", _TS, True), ("finished_at", _TS, True),
    ("created_at", _TS, False),
)
