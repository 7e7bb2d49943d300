"""``EXCHANGE|INSTRUMENT`` keys and the log position that orders rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .decimals import is_blank, java_trim

# Fixed values.
SEPARATOR = "|"
EXCHANGES = ("KRAKEN",)

KEYS = ("exchange", "instrument")
POSITION = ("src_partition", "src_offset", "ordinal")


def canonical_instrument(symbol: Column) -> Column:
    """Trimmed upper case; NULL for a blank symbol or one that contains the separator."""
    return F.when(~is_blank(symbol) & ~symbol.contains(SEPARATOR), F.upper(java_trim(symbol)))


def instrument_key(exchange: Column, instrument: Column) -> Column:
    return F.concat(exchange, F.lit(SEPARATOR), canonical_instrument(instrument))


def parse_key(key: Column, exchanges: Sequence[str] = EXCHANGES) -> Column:
    """``struct(exchange, instrument, error)``, split at the first separator.

    ``error`` is NULL for a usable key; the two other fields are NULL otherwise.
    """
    at = F.instr(key, SEPARATOR)
    raw_exchange = F.when(at > 0, F.substring(key, F.lit(1), at - 1))
    rest = F.when(at > 0, F.substring(key, at + 1, F.length(key)))
    exchange = F.upper(java_trim(raw_exchange))
    instrument = canonical_instrument(rest)
    error = (
        F.when(is_blank(key), "key must not be blank")
        .when(at == 0, "key has no separator")
        .when(is_blank(raw_exchange), "exchange must not be blank")
        .when(~exchange.isin(*exchanges), F.concat(F.lit("unknown exchange: '"), raw_exchange, F.lit("'")))
        .when(is_blank(rest), "instrument must not be blank")
        .when(instrument.isNull(), "instrument must not contain '|'")
    )
    return F.struct(
        F.when(error.isNull(), exchange).alias("exchange"),
        F.when(error.isNull(), instrument).alias("instrument"),
        error.alias("error"),
    )


def log_order(partition: str = "src_partition", offset: str = "src_offset", ordinal: str = "ordinal") -> Column:
    """One decimal that sorts as ``(partition, offset, ordinal)``.

    A struct in a ``min_by``/``max_by`` buffer forces a sort of the whole input before the
    partial aggregate; a decimal keeps the hash aggregate. Ordinals must stay below 10^6.
    """
    wide = F.col(partition).cast("decimal(10,0)") * F.lit("1" + "0" * 25).cast("decimal(26,0)")
    mid = F.col(offset).cast("decimal(20,0)") * F.lit(1_000_000).cast("decimal(7,0)")
    return (wide + (mid + F.col(ordinal).cast("decimal(10,0)"))).cast("decimal(38,0)")
