"""The whole batch job: raw envelopes to trades, quarantine, candles and stored tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from typing import Protocol

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import KEYS
from ..operators import candles, dedupe, normalize
from ..operators.candles import DEFAULT_WINDOW, WindowSpec
from ..schemas import DEAD_LETTER, DERIVED_CANDLES, INVALID_EVENTS, NORMALIZED_TRADES, RAW_ENVELOPE
from ..session import materialise


class ExchangeAdapter(Protocol):
    """What a further exchange has to bring: its frames as routed rows, and its checksum text."""

    name: str

    def normalize(self, envelopes: DataFrame, processor_version: str) -> DataFrame: ...

    def checksum_text(self, bids: Column, asks: Column) -> Column: ...


@dataclass(frozen=True)
class Outputs:
    """The job's results by stream name, all lazy."""

    routed: DataFrame
    trades: DataFrame
    late: DataFrame
    candles: DataFrame
    streams: dict[str, DataFrame]


def derive(envelopes: DataFrame, processor_version: str, spec: WindowSpec = DEFAULT_WINDOW,
           scope: Sequence[str] = KEYS, processing_time: Column | None = None, deduplicate: bool = True,
           adapter: ExchangeAdapter | None = None, store: str | None = None) -> Outputs:
    """Everything derived from a bounded raw log.

    Two full shuffles, however large the log: by (scope, chunk of the log) for stream time,
    then by dedupe key. Candles shuffle only their partial aggregates. With ``store``, the
    routed rows are written below it first and the candles read them back, so frames are
    parsed once; without, the outputs stay lazy.

    Stream time is taken before deduplication: a copy never moves the clock, because the
    first row already has.
    """
    routed = (adapter.normalize(envelopes, processor_version) if adapter
              else normalize.normalize_frames(envelopes, processor_version))
    if store:
        routed = materialise(routed, "routed", store)
    trades = normalize.trades(routed)
    timed = candles.with_stream_time(trades, scope)
    counted = dedupe.dedupe_trades(timed) if deduplicate else timed
    windowed = candles.assign_window(counted, spec)
    marked = windowed.withColumn("late", candles.is_late(F.col("window_end"), spec.grace_ms, F.col("stream_time")))
    folded = candles.finalise(candles.fold_candles(marked.where(~F.col("late")), scope), spec.grace_ms, scope)
    clock = F.lit(None).cast("timestamp") if processing_time is None else processing_time
    stamped = candles.stamp_candles(folded, processor_version, clock)
    late = candles.late_invalid_events(marked, processor_version)
    return Outputs(routed, trades, late, stamped, {
        NORMALIZED_TRADES: trades,
        INVALID_EVENTS: normalize.invalid_events(routed).drop("output_key").unionByName(late),
        DEAD_LETTER: normalize.dead_letters(routed, RAW_ENVELOPE.names),
        DERIVED_CANDLES: stamped,
    })
