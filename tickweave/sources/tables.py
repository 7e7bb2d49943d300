"""Stored tables: what a row must satisfy, how it is written, how it is read back."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.decimals import DECIMAL, is_blank
from ..operators.dedupe import first_per_key
from ..schemas import STORED_CANDLES, STORED_TRADES

STORE, SKIP, REJECT = "store", "skip", "reject"

# 1900-01-01 to 2299-12-31, in epoch milliseconds.
TIME_RANGE_MS = (-2_208_988_800_000, 10_413_791_999_000)
TRADE_RETENTION_MONTHS = 6


@dataclass(frozen=True)
class TableSpec:
    """A stored table: columns in order, natural key, day column and row checks.

    Checks are ``(verdict, condition, reason)``; the first condition that holds decides.
    """

    name: str
    columns: tuple[str, ...]
    key: tuple[str, ...]
    day_of: str
    checks: Callable[[], Sequence[tuple[str, Column, str]]]
    retention_months: int | None = None


def _unfit(column: str) -> Column:
    return F.col(column).try_cast(DECIMAL).isNull()


def _out_of_range(column: str) -> Column:
    ms = F.unix_millis(column)
    return F.col(column).isNull() | ~ms.between(*TIME_RANGE_MS)


def _trade_checks():
    key = TRADES_TABLE.key
    return [
        (REJECT, F.coalesce(*[F.col(c).cast("string") for c in key]).isNull(), "null value"),
        (REJECT, _unfit("price"), "price does not fit Decimal(38,18)"),
        (REJECT, _unfit("quantity"), "quantity does not fit Decimal(38,18)"),
        (REJECT, _out_of_range("event_time"), "eventTime is outside the DateTime64(3) range"),
        (REJECT, _out_of_range("ingestion_time"), "ingestionTime is outside the DateTime64(3) range"),
        (REJECT, is_blank(F.col("trade_id")), "tradeId is empty, and it is part of the dedupe key"),
    ]


_CANDLE_DECIMALS = ("open", "high", "low", "close", "volume", "quote_volume", "vwap", "buy_volume", "sell_volume")


def _candle_checks():
    unfit = _unfit(_CANDLE_DECIMALS[0])
    for name in _CANDLE_DECIMALS[1:]:
        unfit = unfit | _unfit(name)
    negative = (F.col("trade_count") < 0) | (F.col("input_trade_count") < 0)
    return [
        (REJECT, F.coalesce(*[F.col(c).cast("string") for c in CANDLES_TABLE.key]).isNull(), "null value"),
        (SKIP, ~F.col("is_final"), "provisional"),
        (REJECT, unfit, "a decimal does not fit Decimal(38,18)"),
        (REJECT, _out_of_range("window_start"), "windowStart is outside the DateTime64(3) range"),
        (REJECT, _out_of_range("window_end"), "windowEnd is outside the DateTime64(3) range"),
        (REJECT, negative, "a trade count is negative and the column is unsigned"),
    ]


TRADES_TABLE = TableSpec(
    "trades", tuple(c for c in STORED_TRADES.names if c != "written_at"),
    ("exchange", "instrument", "event_time", "trade_id"), "event_time", _trade_checks, TRADE_RETENTION_MONTHS)
CANDLES_TABLE = TableSpec(
    "candles", tuple(c for c in STORED_CANDLES.names if c != "written_at"),
    ("exchange", "instrument", "window", "window_start"), "window_start", _candle_checks)


def validate_for_storage(rows: DataFrame, table: TableSpec) -> DataFrame:
    """Add ``verdict`` (store, skip, reject) and ``reason``."""
    judged = F.lit(None)
    for verdict, condition, reason in reversed(list(table.checks())):
        judged = F.when(condition, F.struct(F.lit(verdict).alias("verdict"), F.lit(reason).alias("reason"))
                        ).otherwise(judged)
    return rows.withColumn("__judged", judged).withColumns({
        "verdict": F.coalesce("__judged.verdict", F.lit(STORE)), "reason": F.col("__judged.reason"),
    }).drop("__judged")


def verdicts(table: TableSpec) -> list[tuple[str, str | None]]:
    """Every verdict and reason a row of the table can get."""
    return [(STORE, None), *dict.fromkeys((verdict, reason) for verdict, _, reason in table.checks())]


def storable(rows: DataFrame, table: TableSpec, written_at: Column | None = None, seen: Observation | None = None) -> DataFrame:
    """Rows that may be written, in column order, stamped with their write time and day.

    ``seen`` is given the number of rows of each of :func:`verdicts`, as ``v0``, ``v1`` ..., while they are written.
    """
    judged = validate_for_storage(rows, table)
    if seen is not None:
        judged = judged.observe(seen, *[F.count_if((F.col("verdict") == verdict) & F.col("reason").eqNullSafe(reason)).alias(f"v{k}")
                                        for k, (verdict, reason) in enumerate(verdicts(table))])
    kept = judged.where(F.col("verdict") == STORE)
    stamp = F.current_timestamp() if written_at is None else written_at
    return kept.select(
        *table.columns, F.date_trunc("MILLISECOND", stamp).alias("written_at"),
        F.to_date(table.day_of).alias("day"))


def write_batch(rows: DataFrame, table: TableSpec, root: str, batch_id: int | str,
                written_at: Column | None = None, rebalance: bool = False, seen: Observation | None = None) -> None:
    """Write one batch under its own id, day-partitioned and sorted by the natural key.

    Writing the same batch again replaces it, so a retried batch leaves one copy. Bulk loads
    set ``rebalance``: adaptive execution then merges small and splits oversized days.
    """
    out = storable(rows, table, written_at, seen)
    if rebalance:
        out = out.hint("rebalance", "day")
    (out.sortWithinPartitions("day", *table.key)
        .write.mode("overwrite").partitionBy("day").parquet(f"{root}/{table.name}/batch={batch_id}"))


def read_table(spark: SparkSession, table: TableSpec, root: str) -> DataFrame:
    """Every stored row, redeliveries included; ``day`` and ``batch`` prune files."""
    schema = STORED_TRADES if table.name == "trades" else STORED_CANDLES
    fields = [*schema.fields, T.StructField("batch", T.StringType()), T.StructField("day", T.DateType())]
    return spark.read.schema(T.StructType(fields)).parquet(f"{root}/{table.name}")


def read_final(stored: DataFrame, key: Sequence[str], version: str = "written_at",
               tie_break: Sequence[str] = ()) -> DataFrame:
    """One row per natural key, highest version first.

    Filters on key columns (and on ``day`` when it is among them) pass below the window.
    """
    keys = [*key, "day"] if "day" in stored.columns else list(key)
    return first_per_key(stored, keys, F.desc(version), *[F.desc(t) for t in tie_break])


def compact_days(stored: DataFrame, table: TableSpec, root: str) -> None:
    """Write the final rows of the days in ``stored`` as one sorted set of files a day, replacing those days and no others.

    A day that fails half-way is written again whole; readers of other days are not touched.
    """
    final = read_final(stored, table.key, tie_break=["batch"]).select(*table.columns, "written_at", "day")
    (final.hint("rebalance", "day").sortWithinPartitions("day", *table.key).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(f"{root}/{table.name}.days"))


def read_days(spark: SparkSession, table: TableSpec, root: str) -> DataFrame:
    """Compacted rows; a filter on ``day`` reads the files of those days alone."""
    schema = STORED_TRADES if table.name == "trades" else STORED_CANDLES
    return spark.read.schema(T.StructType([*schema.fields, T.StructField("day", T.DateType())])).parquet(f"{root}/{table.name}.days")


def count_final(stored: DataFrame, key: Sequence[str]) -> DataFrame:
    """Stored rows against distinct keys, without ranking anything."""
    per_key = stored.groupBy(*key).agg(F.count("*").alias("n"))
    return per_key.agg(F.sum("n").alias("stored_rows"), F.count("*").alias("final_rows"))


def expired(column: str, as_of: Column, months: int) -> Column:
    return F.col(column) < as_of - F.make_interval(months=F.lit(months))


def apply_retention(stored: DataFrame, table: TableSpec, as_of: Column) -> DataFrame:
    """Rows inside the retention period; tables without one keep everything."""
    if table.retention_months is None:
        return stored
    kept = stored.where(~expired(table.day_of, as_of, table.retention_months))
    if "day" in stored.columns:
        kept = kept.where(F.col("day") >= F.to_date(as_of - F.make_interval(months=F.lit(table.retention_months))))
    return kept


def retained_by_days(rows: DataFrame, at: str, as_of: Column, days: int) -> DataFrame:
    """Per-stream retention; zero days means a table that never expires."""
    return rows if days == 0 else rows.where(F.col(at) >= as_of - F.make_interval(days=F.lit(days)))


def archive_raw(envelopes: DataFrame, path: str, mode: str = "append") -> None:
    """Long-term raw archive, partitioned for range replay."""
    (envelopes.withColumn("received_date", F.to_date("received_at")).hint("rebalance", "channel", "received_date")
        .sortWithinPartitions("channel", "received_date", "src_partition", "src_offset")
        .write.mode(mode).partitionBy("channel", "received_date").parquet(path))
