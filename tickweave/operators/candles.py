"""Trades to OHLCV/VWAP candles: windows, lateness, finality and identity.

Log order (``src_partition, src_offset, ordinal``) decides open, close and lateness; event
time decides only the window. Sums, extremes and log-order picks all merge, so Catalyst's
map-side partial aggregate absorbs a hot instrument before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import decimals, ids
from ..functions.keys import KEYS, POSITION, instrument_key, log_order
from ..functions.times import FROM_EXCHANGE, plus_ms, window_start
from ..schemas import SCHEMA_VERSION, WINDOW_NAMES
from .prefix import CHUNK_ROWS, Running, offset_chunk, running

_ORDER, _NOTIONAL = "__order", "__notional"


@dataclass(frozen=True)
class WindowSpec:
    """A tumbling window; ``name`` defaults to the registered one or its length in ms."""

    size_ms: int = 60_000
    grace_ms: int = 30_000
    label: str | None = None

    @property
    def name(self) -> str:
        return self.label or WINDOW_NAMES.get(self.size_ms, f"{self.size_ms}ms")


# Fixed values.
DEFAULT_WINDOW = WindowSpec()
MULTI_WINDOWS = (WindowSpec(1_000, 2_000), WindowSpec(10_000, 5_000), WindowSpec(60_000, 30_000))


def assign_window(trades: DataFrame, spec: WindowSpec = DEFAULT_WINDOW) -> DataFrame:
    """Add ``window``, ``window_start`` and ``window_end``."""
    start = window_start(F.col("event_time"), spec.size_ms)
    return trades.withColumns({
        "window": F.lit(spec.name), "window_start": start, "window_end": plus_ms(start, spec.size_ms)})


def assign_windows(trades: DataFrame, specs: Sequence[WindowSpec]) -> DataFrame:
    """One row per trade and window size, from one scan; ``grace_ms`` comes along."""
    options = F.array(*[
        F.struct(
            F.lit(s.name).alias("window"),
            window_start(F.col("event_time"), s.size_ms).alias("window_start"),
            plus_ms(window_start(F.col("event_time"), s.size_ms), s.size_ms).alias("window_end"),
            F.lit(s.grace_ms).cast("long").alias("grace_ms"),
        ) for s in specs
    ])
    return trades.select("*", F.inline(options))


def with_stream_time(trades: DataFrame, scope: Sequence[str] = KEYS, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Add ``stream_time``: the highest event time seen so far in the scope's log, this row included.

    Also adds ``scope_clock``, the stream time at the log's end. ``scope`` is what shares one clock: ``("src_partition",)`` as in a partitioned log, or the
    instrument when each is read on its own.
    """
    return running(trades, scope, offset_chunk(rows=chunk_rows), POSITION,
                   {"stream_time": Running("max", "event_time")}, {"scope_clock": "event_time"})


def is_late(window_end: Column, grace_ms: int | Column, stream_time: Column) -> Column:
    """Closed at equality: a window takes rows while ``stream_time < window_end + grace``."""
    return plus_ms(window_end, grace_ms) <= stream_time


def mark_late(trades: DataFrame, spec: WindowSpec = DEFAULT_WINDOW, scope: Sequence[str] = KEYS,
              chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Add the window columns, ``stream_time`` and ``late``."""
    timed = with_stream_time(assign_window(trades, spec), scope, chunk_rows)
    return timed.withColumn("late", is_late(F.col("window_end"), spec.grace_ms, F.col("stream_time")))


def foldable(trades: DataFrame) -> DataFrame:
    """Trades with their log order and notional, as :func:`fold_aggregates` needs them."""
    source = trades if "trace_id" in trades.columns else trades.withColumn("trace_id", F.lit(""))
    return source.withColumns({
        _ORDER: log_order(), _NOTIONAL: decimals.exact_mul(F.col("price"), F.col("quantity"))})


def fold_aggregates(copies: bool = False) -> list[Column]:
    """The candle's aggregates over rows from :func:`foldable`.

    A sum that does not fit 38 digits is NULL (storage rejects it) instead of failing the job.
    """
    price, quantity, order = F.col("price"), F.col("quantity"), F.col(_ORDER)
    zero = decimals.zero()
    rows = F.count("*")

    def total(value: Column) -> Column:
        return F.when(rows == 0, zero).otherwise(F.try_sum(value)).cast(decimals.DECIMAL)

    def side_total(side: str) -> Column:
        return total(F.when(F.col("side") == side, quantity).otherwise(zero))

    return [
        F.coalesce(F.min_by(price, order), zero).alias("open"),
        F.coalesce(F.max(price), zero).alias("high"),
        F.coalesce(F.min(price), zero).alias("low"),
        F.coalesce(F.max_by(price, order), zero).alias("close"),
        total(quantity).alias("volume"),
        # A product that overflowed is NULL; it must not drop out of the sum.
        F.when(F.count(_NOTIONAL) == rows, total(F.col(_NOTIONAL))).alias("quote_volume"),
        side_total("BUY").alias("buy_volume"),
        side_total("SELL").alias("sell_volume"),
        rows.alias("trade_count"),
        (F.coalesce(F.sum("copies"), F.lit(0)) if copies else rows).alias("input_trade_count"),
        # A string buffer would force a sort; unused, Catalyst prunes this column away.
        F.coalesce(F.max_by("trace_id", order), F.lit("")).alias("trace_id"),
        F.max("event_time").alias("last_event_time"),
    ]


def fold_candles(trades: DataFrame, extra_keys: Sequence[str] = ()) -> DataFrame:
    """Group windowed trades into candles, VWAP divided once at the end.

    Trades with a ``copies`` column (from deduplication) keep the pre-dedupe count.
    """
    keys = [*KEYS, "window", "window_start", "window_end", *[k for k in extra_keys if k not in KEYS]]
    clock = [F.max("scope_clock").alias("scope_clock")] if "scope_clock" in trades.columns else []
    folded = foldable(trades).groupBy(*keys).agg(*fold_aggregates("copies" in trades.columns), *clock)
    return folded.withColumn("vwap", decimals.safe_div(F.col("quote_volume"), F.col("volume")))


def empty_fold(rows: DataFrame) -> DataFrame:
    """The identity candle: the same aggregates over no rows, all zero, still stampable."""
    folded = foldable(rows.where(F.lit(False))).agg(*fold_aggregates())
    return folded.withColumn("vwap", decimals.safe_div(F.col("quote_volume"), F.col("volume")))


def finalise(candles: DataFrame, grace_ms: int | Column, scope: Sequence[str] = KEYS) -> DataFrame:
    """Add ``is_final``: the scope's stream time has reached ``window_end + grace``.

    Candles folded from rows with stream time already hold their ``scope_clock``. Otherwise
    the clock is the maximum over the scope's candles: the row with the highest event time is
    never late.
    """
    if "scope_clock" in candles.columns:
        timed = candles
    else:
        clock = candles.groupBy(*scope).agg(F.max("last_event_time").alias("scope_clock"))
        timed = candles.join(clock, list(scope))
    return timed.withColumn("is_final", is_late(F.col("window_end"), grace_ms, F.col("scope_clock"))).drop("scope_clock")


def batch_candles(trades: DataFrame, spec: WindowSpec = DEFAULT_WINDOW, scope: Sequence[str] = KEYS,
                  chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Every window of a bounded log as it stands at the log's end, late rows left out.

    Rows with ``is_final`` are exactly what a record-by-record run emits as final.
    """
    on_time = mark_late(trades, spec, scope, chunk_rows).where(~F.col("late"))
    return finalise(fold_candles(on_time, scope), spec.grace_ms, scope)


def multi_window_candles(trades: DataFrame, specs: Sequence[WindowSpec] = MULTI_WINDOWS,
                         scope: Sequence[str] = KEYS, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Candles of several sizes in one table, each with its own grace.

    Stream time is found once and trades are folded once, into the smallest windows and by which sizes still take them; the
    other sizes are merged from these partial candles. Sizes that are no multiple of the smallest fold for themselves.
    """
    smallest = min(specs, key=lambda s: s.size_ms)
    apart = [s for s in specs if s.size_ms % smallest.size_ms]
    nested = [s for s in specs if not s.size_ms % smallest.size_ms]
    timed = with_stream_time(trades, scope, chunk_rows)
    clock = [c for c in ("scope_clock",) if c in timed.columns]

    def end_of(spec: WindowSpec, at: str) -> Column:
        return plus_ms(window_start(F.col(at), spec.size_ms), spec.size_ms)

    takes = F.array_compact(F.array(*[F.when(~is_late(end_of(s, "event_time"), s.grace_ms, F.col("stream_time")), F.lit(i)) for i, s in enumerate(nested)]))
    taken = assign_window(timed, smallest).withColumn("__takes", takes).where(F.size("__takes") > 0).withColumn("__takes", F.array_join("__takes", ","))
    scopes = [k for k in scope if k not in KEYS]
    parts = partial_candles(taken, [*KEYS, *scopes, "window_start", "__takes"], clock)
    options = F.array(*[F.struct(F.lit(str(i)).alias("__size"), F.lit(s.name).alias("window"), F.lit(s.grace_ms).cast("long").alias("grace_ms"),
                                 window_start(F.col("window_start"), s.size_ms).alias("__start"), end_of(s, "window_start").alias("window_end"))
                        for i, s in enumerate(nested)])
    spread = parts.select("*", F.inline(options)).where(F.array_contains(F.split("__takes", ","), F.col("__size"))) \
        .drop("window_start", "__takes", "__size").withColumnRenamed("__start", "window_start")
    keys = [*KEYS, *scopes, "window", "window_start", "window_end", "grace_ms"]
    candles = merge_candles(spread, keys, F.col("first_order"), F.col("last_order"), *[F.max(c).alias(c) for c in clock])
    if apart:
        late = is_late(F.col("window_end"), F.col("grace_ms"), F.col("stream_time"))
        candles = candles.unionByName(fold_candles(assign_windows(timed, apart).where(~late), [*scope, "grace_ms"]).select(*candles.columns))
    return finalise(candles, F.col("grace_ms"), scope)


def partial_candles(windowed: DataFrame, keys: Sequence[str], latest: Sequence[str] = ()) -> DataFrame:
    """Mergeable candles: the fold plus the log positions ``first_order`` and ``last_order``, and the maximum of columns ``latest``."""
    return foldable(windowed).groupBy(*keys).agg(
        *fold_aggregates("copies" in windowed.columns), F.min(_ORDER).alias("first_order"),
        F.max(_ORDER).alias("last_order"), *[F.max(c).alias(c) for c in latest])


def sharded_candles(windowed: DataFrame, shards: int = 16) -> DataFrame:
    """The same candles in two levels: per (window, shard), then merged.

    For instruments so hot that even their partial rows should not meet in one reducer.
    Open and close merge by their log positions.
    """
    keys = [*KEYS, "window", "window_start", "window_end"]
    shard = F.pmod(F.xxhash64(*POSITION), F.lit(shards))
    partial = partial_candles(windowed.withColumn("__shard", shard), [*keys, "__shard"])
    return merge_candles(partial, keys, F.col("first_order"), F.col("last_order"))


def merge_candles(parts: DataFrame, keys: Sequence[str], first: Column, last: Column, *extra: Column) -> DataFrame:
    """Merge partial candles; ``first``/``last`` order the parts that hold open and close."""
    sums = ("volume", "quote_volume", "buy_volume", "sell_volume")
    counts = ("trade_count", "input_trade_count")
    merged = parts.groupBy(*keys).agg(
        F.min_by("open", first).alias("open"), F.max("high").alias("high"),
        F.min("low").alias("low"), F.max_by("close", last).alias("close"),
        *[F.when(F.count(c) == F.count("*"), F.try_sum(c)).cast(decimals.DECIMAL).alias(c) for c in sums],
        *[F.sum(c).alias(c) for c in counts],
        F.max_by("trace_id", last).alias("trace_id"),
        F.max("last_event_time").alias("last_event_time"), *extra,
    )
    return merged.withColumn("vwap", decimals.safe_div(F.col("quote_volume"), F.col("volume")))


def stamp_candles(candles: DataFrame, processor_version: str, processing_time: Column) -> DataFrame:
    """Identity and header of each candle; the clock is an argument so replays agree."""
    key = instrument_key(F.col("exchange"), F.col("instrument"))
    return candles.withColumns({
        "event_id": ids.candle_event_id(key, F.col("window"), F.col("window_start"), F.col("is_final")),
        "event_time": F.col("window_start"),
        "ingestion_time": F.col("window_start"),
        "processing_time": processing_time,
        "event_time_source": F.lit(FROM_EXCHANGE),
        "schema_version": F.lit(SCHEMA_VERSION),
        "source_event_id": F.lit(None).cast("string"),
        "processor_version": F.lit(processor_version),
    })


def candle_events(stamped: DataFrame) -> DataFrame:
    """Stamped candles in the nested wire shape of :data:`tickweave.schemas.CANDLE`."""
    header = F.struct("event_id", "exchange", "instrument", "event_time", "ingestion_time", "processing_time",
                      "event_time_source", "schema_version", "trace_id", "source_event_id")
    return stamped.select(
        header.alias("header"), "window", "window_start", "window_end", "open", "high", "low", "close",
        "volume", "quote_volume", "vwap", "buy_volume", "sell_volume", "trade_count", "is_final",
        "input_trade_count", "processor_version")


def union_provisional_final(provisional: DataFrame, final: DataFrame) -> DataFrame:
    """Both kinds on one stream, told apart by ``is_final`` (and so by id)."""
    return provisional.withColumn("is_final", F.lit(False)).unionByName(final.withColumn("is_final", F.lit(True)))


def late_trades(marked: DataFrame) -> DataFrame:
    return marked.where(F.col("late"))


def late_invalid_events(marked: DataFrame, processor_version: str, sample_percent: int = 100) -> DataFrame:
    """Late rows as quarantine records; a sample is chosen by id, so every run picks the same rows."""
    chosen = late_trades(marked)
    if sample_percent < 100:
        chosen = chosen.where(F.pmod(F.xxhash64("trade_id"), F.lit(100)) < sample_percent)
    key = instrument_key(F.col("exchange"), F.col("instrument"))
    detail = F.concat(F.lit("window closed at "), F.unix_millis("window_end").cast("string"))
    return chosen.select(
        ids.uuid3(F.concat(F.lit("late:"), key, F.lit(":"), F.col("trade_id"), F.lit(":"), F.col("window"),
                           *[p for c in POSITION for p in (F.lit(":"), F.col(c).cast("string"))])).alias("event_id"),
        F.col("ingestion_time").alias("occurred_at"),
        F.lit("WINDOW").alias("stage"), F.lit("LATE_BEYOND_GRACE").alias("reason"),
        detail.alias("error_class"), F.lit("normalized.trades").alias("original_topic"),
        key.alias("original_key"), F.lit(None).cast("binary").alias("original_payload"),
        "instrument", "trace_id", F.lit(processor_version).alias("processor_version"),
        F.lit(SCHEMA_VERSION).alias("schema_version"))


def count_late(marked: DataFrame) -> DataFrame:
    return late_trades(marked).groupBy(*KEYS).agg(F.count("*").alias("late_count"))


def roll_up(candles: DataFrame, size_ms: int, name: str | None = None) -> DataFrame:
    """Coarser candles from stored finer ones."""
    spec = WindowSpec(size_ms, 0, name)
    start = window_start(F.col("window_start"), size_ms)
    order = F.col("__part_start")
    parts = candles.withColumns({
        "__part_start": F.unix_millis("window_start"),
        "trace_id": F.col("trace_id") if "trace_id" in candles.columns else F.lit(""),
        "last_event_time": F.col("window_start"),
    }).withColumns({"window": F.lit(spec.name), "window_start": start, "window_end": plus_ms(start, size_ms)})
    return merge_candles(parts, [*KEYS, "window", "window_start", "window_end"], order, order)
