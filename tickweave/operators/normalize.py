"""Raw frames to canonical trades; every frame leaves as at least one routed row.

The whole step is a narrow projection (parse, explode, one ordered CASE), so it runs at
scan speed and shuffles nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import ids, json
from ..functions.decimals import DECIMAL, is_blank
from ..functions.keys import SEPARATOR, canonical_instrument
from ..functions.times import parse_exchange_time, resolve_event_time
from ..schemas import RAW_TRADES, SCHEMA_VERSION
from .columns import once

TRADE, INVALID, DEAD = "trade", "invalid", "dead"

# Fixed values.
SIDE_WORDS = {"buy": "BUY", "b": "BUY", "sell": "SELL", "s": "SELL"}
TRADE_CHANNEL = "trade"
UNFIT = "price or qty does not fit decimal(38,18)"
_SYMBOL_GUARD = 4  # place of the last symbol guard below


def side_of(word: Column) -> Column:
    lowered = F.lower(word)
    picked = F.lit(None).cast("string")
    for name, side in SIDE_WORDS.items():
        picked = F.when(lowered == name, side).otherwise(picked)
    return picked


def normalize_frames(envelopes: DataFrame, processor_version: str, exchange: str = "KRAKEN",
                     topic: str = RAW_TRADES, max_bytes: int | None = None) -> DataFrame:
    """Raw envelopes to one row per trade or per rejected frame, with a ``route``.

    ``route`` is ``trade``, ``invalid`` or ``dead``. The envelope columns stay, so a dead row
    is the original record. The first failing guard decides ``reason`` and ``detail``.
    With ``max_bytes``, larger frames are quarantined unparsed.
    """
    return derive_outcomes(explode_frames(envelopes, max_bytes), processor_version, exchange, topic)


def explode_frames(envelopes: DataFrame, max_bytes: int | None = None) -> DataFrame:
    """Parse each payload and give every element of ``data`` its own row and ordinal."""
    oversize = F.length("payload") > max_bytes if max_bytes is not None else F.lit(False)
    # Text and root are columns of their own: each is used twice and should be made once.
    parsed = (envelopes.withColumn("oversize", oversize)
              .withColumn("text", F.when(~F.col("oversize"), json.payload_text(F.col("payload"))))
              .withColumn("root", json.parse_object(F.col("text"))).drop("text"))
    framed = parsed.select(
        "*",
        F.col("root").isNotNull().alias("is_object"),
        json.text(F.col("root"), "channel").alias("wire_channel"),
        json.elements(F.col("root"), "data").alias("items"),
    ).drop("root")
    # Only trade frames are opened; outer keeps one row for every other frame.
    opened = F.when(F.col("wire_channel") == TRADE_CHANNEL, F.col("items"))
    exploded = framed.withColumn("has_data", F.coalesce(F.size("items") > 0, F.lit(False))).withColumn(
        "items", opened)
    kept = [F.col(c) for c in exploded.columns if c != "items"]
    return exploded.select(*kept, F.posexplode_outer("items").alias("ordinal", "item")).withColumn(
        "ordinal", F.coalesce("ordinal", F.lit(0)))


_FIELDS = ["symbol", "side", "price", "qty", "timestamp", "trade_id"]


def derive_outcomes(items: DataFrame, processor_version: str, exchange: str, topic: str) -> DataFrame:
    wire = items.withColumn("wire", json.pull(F.col("item"), _FIELDS)).drop("item")
    w, k = F.col("wire"), F.col("kinds")
    kinds = wire.withColumn("kinds", F.struct(*[json.kind(w[name]).alias(name) for name in _FIELDS]))
    texts = once(
        kinds,
        symbol=json.text_of(w["symbol"], k["symbol"]), wire_side=json.text_of(w["side"], k["side"]),
        wire_time=json.text_of(w["timestamp"], k["timestamp"]), wire_id=json.any_text_of(w["trade_id"], k["trade_id"]),
        price_text=json.number(w["price"], k["price"]), qty_text=json.number(w["qty"], k["qty"]),
    ).drop("wire", "kinds")
    values = once(
        texts,
        no_symbol=is_blank(F.col("symbol")), parsed_instrument=canonical_instrument(F.col("symbol")),
        parsed_side=side_of(F.col("wire_side")),
        price_value=F.col("price_text").try_cast(DECIMAL), qty_value=F.col("qty_text").try_cast(DECIMAL),
        # Signs come from the unrounded numbers: a size far below 1e-18 is still positive.
        price_sign=F.signum(F.col("price_text").try_cast("double")),
        qty_sign=F.signum(F.col("qty_text").try_cast("double")),
        exchange_time=parse_exchange_time(F.col("wire_time")))

    unusable = F.concat(F.lit("unusable symbol '"), F.col("symbol"),
                        F.lit("': instrument must not contain '" + SEPARATOR + "': '"), F.col("symbol"), F.lit("'"))
    # Guards in contract order: condition, reason, detail.
    guards = [
        (F.col("oversize"), "SCHEMA_INVALID", "frame exceeds the size limit"),
        (F.col("wire_channel").isNull() | (F.col("wire_channel") != TRADE_CHANNEL), "UNKNOWN_TYPE",
         F.concat(F.lit("channel="), F.coalesce("wire_channel", F.lit("null")))),
        (~F.col("has_data"), "SCHEMA_INVALID", "trade frame has no data array"),
        (F.col("no_symbol"), "SCHEMA_INVALID",
         F.concat(F.lit("trade at index "), F.col("ordinal").cast("string"), F.lit(" has no symbol"))),
        (F.col("parsed_instrument").isNull(), "SCHEMA_INVALID", unusable),
        (F.col("parsed_side").isNull(), "SCHEMA_INVALID",
         F.concat(F.lit("unknown side '"), F.coalesce("wire_side", F.lit("null")), F.lit("'"))),
        (F.col("price_sign").isNull() | F.col("qty_sign").isNull(), "SCHEMA_INVALID",
         "price or qty missing or not numeric"),
        ((F.col("qty_sign") <= 0) | (F.col("price_sign") <= 0), "IMPOSSIBLE_STATE",
         F.concat(F.lit("non-positive price or quantity: "), "price_text", F.lit(" @ "), "qty_text")),
        (F.col("price_value").isNull() | F.col("qty_value").isNull(), "SCHEMA_INVALID", UNFIT),
    ]
    guard = F.lit(len(guards))
    for place, (condition, _, _) in reversed(list(enumerate(guards))):
        guard = F.when(condition, place).otherwise(guard)
    # Text that is no JSON object has no fault to name, unless it was too large to look at.
    dead = ~F.col("is_object") & ~F.col("oversize")
    judged = once(values, guard=F.when(~dead, guard))

    reason, detail = F.lit(None).cast("string"), F.lit(None).cast("string")
    for place, (_, name, words) in enumerate(guards):
        reason = F.when(F.col("guard") == place, F.lit(name)).otherwise(reason)
        detail = F.when(F.col("guard") == place, F.lit(words) if isinstance(words, str) else words).otherwise(detail)
    ok = F.col("guard") == len(guards)
    # The payload names a usable instrument once the guards up to the symbol have passed.
    instrument = F.when(F.col("guard") > _SYMBOL_GUARD, F.col("parsed_instrument"))
    resolved = resolve_event_time(F.col("exchange_time"), F.col("received_at"))
    known = judged.select(
        *[F.col(c) for c in items.columns if c not in
          ("oversize", "is_object", "wire_channel", "has_data", "ordinal", "item")],
        "ordinal", "wire_id",
        F.when(ok, TRADE).when(F.col("guard").isNotNull(), INVALID).otherwise(DEAD).alias("route"),
        reason.alias("reason"), detail.alias("detail"), instrument.alias("payload_instrument"),
        F.when(ok, F.col("price_value")).alias("price"), F.when(ok, F.col("qty_value")).alias("quantity"),
        F.when(ok, F.col("parsed_side")).alias("side"),
        resolved["event_time"].alias("event_time"), resolved["source"].alias("event_time_source"))
    trade_id = ids.trade_id(
        F.col("wire_id"), instrument=F.col("payload_instrument"), event_time=F.col("event_time"),
        price=F.col("price"), quantity=F.col("quantity"), side=F.col("side"), ordinal=F.col("ordinal"))
    key = F.concat(F.lit(exchange + SEPARATOR), F.col("payload_instrument"))
    return known.select(
        *[c for c in known.columns if c != "wire_id"],
        F.when(F.col("route") == TRADE, trade_id).alias("trade_id"),
        F.coalesce(F.when(F.col("route") != DEAD, key), F.col("record_key")).alias("output_key"),
        F.lit(exchange).alias("trade_exchange"), F.lit(topic).alias("original_topic"),
        F.lit(processor_version).alias("processor_version"))


def trades(routed: DataFrame) -> DataFrame:
    """The ``trade`` branch in the columns of :data:`tickweave.schemas.TRADES`."""
    return routed.where(F.col("route") == TRADE).select(
        ids.trade_event_id(F.col("output_key"), F.col("trade_id")).alias("event_id"),
        F.col("trade_exchange").alias("exchange"), F.col("payload_instrument").alias("instrument"),
        "event_time", F.col("received_at").alias("ingestion_time"),
        # Wall-clock time would differ between replays, so trades carry none.
        F.lit(None).cast("timestamp").alias("processing_time"),
        "event_time_source", F.lit(SCHEMA_VERSION).alias("schema_version"), "trace_id",
        F.col("event_id").alias("source_event_id"), "trade_id", "price", "quantity", "side",
        F.concat_ws("|", "payload_instrument", "trade_id").alias("dedupe_key"),
        "src_partition", "src_offset", "ordinal")


def trade_events(flat: DataFrame) -> DataFrame:
    """Flat trades in the nested wire shape of :data:`tickweave.schemas.TRADE_EVENT`."""
    header = F.struct("event_id", "exchange", "instrument", "event_time", "ingestion_time", "processing_time",
                      "event_time_source", "schema_version", "trace_id", "source_event_id")
    return flat.select(header.alias("header"), "trade_id", "price", "quantity", "side", "dedupe_key")


def flatten_trade_events(events: DataFrame) -> DataFrame:
    return events.select("header.*", *[c for c in events.columns if c != "header"])


def invalid_events(routed: DataFrame) -> DataFrame:
    """The ``invalid`` branch as quarantine records, plus the key each is written under."""
    return routed.where(F.col("route") == INVALID).select(
        ids.invalid_event_id(F.col("source_connection_id"), F.col("ingest_sequence"), F.col("reason"),
                             F.col("detail")).alias("event_id"),
        F.col("received_at").alias("occurred_at"), F.lit("NORMALIZE").alias("stage"), "reason",
        F.col("detail").alias("error_class"), "original_topic", F.col("record_key").alias("original_key"),
        F.col("payload").alias("original_payload"), F.col("payload_instrument").alias("instrument"),
        "trace_id", "processor_version", F.lit(SCHEMA_VERSION).alias("schema_version"), "output_key")


def dead_letters(routed: DataFrame, envelope_columns: list[str]) -> DataFrame:
    """The default branch: original envelopes, unchanged."""
    return routed.where(~F.col("route").isin(TRADE, INVALID)).select(*envelope_columns)
