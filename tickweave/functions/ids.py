"""Names and name-based (version 3) UUIDs, so a replay gives every row the same id."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .decimals import is_blank


def uuid3(name: Column) -> Column:
    """RFC 4122 version-3 UUID text of the UTF-8 name, with no namespace prefix."""
    h = F.md5(name.cast("string").cast("binary"))
    # The top two bits of the 17th digit become binary 10.
    variant = F.translate(F.substring(h, 17, 1), "0123456789abcdef", "89ab89ab89ab89ab")
    return F.concat_ws(
        "-",
        F.substring(h, 1, 8),
        F.substring(h, 9, 4),
        F.concat(F.lit("3"), F.substring(h, 14, 3)),
        F.concat(variant, F.substring(h, 18, 3)),
        F.substring(h, 21, 12),
    )


def trade_event_id(instrument_key: Column, trade_id: Column) -> Column:
    return uuid3(F.concat(F.lit("trade:"), instrument_key, F.lit("|"), trade_id))


def candle_event_id(instrument_key: Column, window: Column, window_start: Column, is_final: Column) -> Column:
    return uuid3(F.concat(
        F.lit("candle:"), instrument_key, F.lit(":"), window, F.lit(":"),
        F.unix_millis(window_start).cast("string"), F.lit(":"), is_final.cast("string")))


def invalid_event_id(connection: Column, sequence: Column, reason: Column, detail: Column) -> Column:
    return uuid3(F.concat(
        F.lit("invalid:"), F.coalesce(connection, F.lit("null")), F.lit(":"), sequence.cast("string"),
        F.lit(":"), reason, F.lit(":"), F.coalesce(detail, F.lit(""))))


def composite_trade_id(instrument: Column, event_time: Column, price: Column, quantity: Column,
                       side: Column, ordinal: Column) -> Column:
    """Identity of a trade that carries no id: every part canonical, the ordinal last."""
    return F.concat(
        F.lit("c:"), instrument, F.lit(":"), F.unix_millis(event_time).cast("string"),
        F.lit(":"), price.cast("string"), F.lit(":"), quantity.cast("string"),
        F.lit(":"), side, F.lit(":"), ordinal.cast("string"))


def trade_id(wire_id: Column, **parts: Column) -> Column:
    """The exchange's id as text when present and not blank, else the composite."""
    return F.when(~is_blank(wire_id), wire_id).otherwise(composite_trade_id(**parts))
