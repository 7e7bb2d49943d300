"""Exchange frames before normalisation: type, destination and envelope."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import json
from ..functions.ids import uuid3
from ..functions.keys import SEPARATOR, canonical_instrument
from ..schemas import DEAD_LETTER, RAW_BOOK, RAW_TRADES, SCHEMA_VERSION
from .columns import once
from .prefix import Running, running

# Fixed values.
CHANNEL_TYPES = {"trade": "TRADE_DATA", "book": "BOOK_DATA", "heartbeat": "HEARTBEAT", "status": "STATUS"}
ACK, UNKNOWN, MALFORMED = "SUBSCRIBE_ACK", "UNKNOWN", "MALFORMED"
NO_CONNECTION = "pending"


def classify_frames(frames: DataFrame, payload: str = "payload") -> DataFrame:
    """Add ``frame_type, frame_channel, symbol, connection_id``.

    A ``method`` field wins over ``channel`` because replies to our own requests carry both;
    only the first element's symbol is read. Connection ids stay text: they exceed a long.
    """
    root = F.col("__root")
    source = (frames.withColumn("__text", json.payload_text(F.col(payload)))
              .withColumn("__root", json.parse_object(F.col("__text"))).drop("__text"))
    first = F.get(json.elements(root, "data"), F.lit(0))
    opened = once(source, __method=json.as_text(root, "method"), __channel=json.text(root, "channel"),
                  __first=json.pull(first, ["symbol", "connection_id"]), __object=root.isNotNull()).drop("__root")

    kind = F.lit(UNKNOWN)
    for name, label in CHANNEL_TYPES.items():
        kind = F.when(F.col("__channel") == name, label).otherwise(kind)
    typed = opened.withColumn(
        "frame_type",
        F.when(~F.col("__object"), MALFORMED).when(F.col("__method").isNotNull(), ACK)
        .when(F.col("__channel").isNull(), UNKNOWN).otherwise(kind))
    channelled = F.col("frame_type").isin("TRADE_DATA", "BOOK_DATA", UNKNOWN) & F.col("__channel").isNotNull()
    return typed.withColumns({
        "frame_channel": F.when(F.col("frame_type") == ACK, F.col("__method"))
                          .when(F.col("frame_type") != MALFORMED, F.col("__channel")),
        "symbol": F.when(channelled, json.text_of(F.col("__first.symbol"))),
        "connection_id": F.when(F.col("frame_type") == "STATUS", json.any_text_of(F.col("__first.connection_id"))),
    }).drop("__method", "__channel", "__first", "__object")


def symbol_lookup(frames: DataFrame, registry: DataFrame, symbol: str = "symbol") -> DataFrame:
    """Left join of exchange and wire symbol, case-insensitively, to the exchange's own canonical symbol.

    The registry is small configuration; its size is left to Spark's broadcast threshold, so
    a registry that outgrows it turns into a shuffle join instead of an oversized broadcast.
    """
    mapping = (registry.where("enabled")
               .groupBy(F.col("exchange").alias("__exchange"), F.upper("exchange_symbol").alias("__wire"))
               .agg(F.max("canonical_symbol").alias("canonical_symbol")))
    same = (F.upper(F.col(symbol)) == F.col("__wire")) & (F.col("exchange") == F.col("__exchange"))
    return frames.join(mapping, same, "left").drop("__wire", "__exchange")


def unknown_symbols(frames: DataFrame, registry: DataFrame, symbol: str = "symbol") -> DataFrame:
    """Frames whose symbol is not an enabled registry entry of their exchange."""
    known = registry.where("enabled").select(F.col("exchange").alias("__exchange"), F.upper("exchange_symbol").alias("__wire")).distinct()
    return frames.join(known, (F.upper(F.col(symbol)) == F.col("__wire")) & (F.col("exchange") == F.col("__exchange")), "left_anti")


def route_raw(classified: DataFrame, registry: DataFrame) -> DataFrame:
    """Add ``canonical_symbol`` and ``target``: the stream a frame is stored on, NULL if only observed."""
    looked_up = symbol_lookup(classified, registry)
    data = F.when(F.col("frame_type") == "TRADE_DATA", RAW_TRADES).when(F.col("frame_type") == "BOOK_DATA", RAW_BOOK)
    target = (
        F.when(F.col("frame_type").isin(UNKNOWN, MALFORMED), DEAD_LETTER)
        .when(data.isNotNull() & F.col("canonical_symbol").isNull(), DEAD_LETTER)
        .otherwise(data))
    return looked_up.withColumn("target", target).withColumn(
        "canonical_symbol", F.when(F.col("target") != DEAD_LETTER, F.col("canonical_symbol")))


def wrap_envelope(routed: DataFrame, exchange: str = "KRAKEN", partitions: int = 6) -> DataFrame:
    """Stored frames as raw envelopes, payload untouched.

    Needs ``payload, received_at, source_connection_id, ingest_sequence``. Ids come from the
    frame's place in its connection, so wrapping the same frames twice gives the same rows. Log positions count the frames
    of a stream's partition by arrival, then connection and sequence, so that connections share none.
    """
    place = F.concat(F.coalesce("source_connection_id", F.lit(NO_CONNECTION)), F.lit(":"),
                     F.col("ingest_sequence").cast("string"))
    instrument = canonical_instrument(F.col("canonical_symbol"))
    key = F.concat(F.lit(exchange + SEPARATOR), instrument)
    stored = routed.where(F.col("target").isNotNull()).select(
        "target",
        uuid3(F.concat(F.lit("raw:"), place)).alias("event_id"), F.lit(exchange).alias("exchange"),
        F.coalesce("frame_channel", F.lit("unknown")).alias("channel"), instrument.alias("instrument"),
        "received_at", F.coalesce("source_connection_id", F.lit(NO_CONNECTION)).alias("source_connection_id"),
        "ingest_sequence", "payload", F.lit("json").alias("payload_encoding"),
        F.concat(F.lit("trace:"), place).alias("trace_id"), F.lit(SCHEMA_VERSION).alias("schema_version"),
        key.alias("record_key"),
        F.pmod(F.xxhash64(key), F.lit(partitions)).cast("int").alias("src_partition"), F.lit(1).cast("long").alias("__one"))
    hour = F.unix_millis("received_at") - F.pmod(F.unix_millis("received_at"), F.lit(3_600_000))
    numbered = running(stored, ["target", "src_partition"], hour, ["received_at", "source_connection_id", "ingest_sequence"], {"src_offset": Running("sum", "__one")})
    return numbered.withColumn("src_offset", F.col("src_offset") - 1).drop("__one")


def guard_size(frames: DataFrame, max_bytes: int, payload: str = "payload") -> DataFrame:
    """Add ``oversize``, to quarantine a frame before anything parses it."""
    return frames.withColumn("oversize", F.length(payload) > F.lit(max_bytes))
