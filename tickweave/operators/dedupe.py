"""One row per trade, and one row per natural key in stored tables."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.keys import KEYS, POSITION, log_order
from .prefix import Running, running


def dedupe_trades(trades: DataFrame, keys: Sequence[str] = ("exchange", "dedupe_key")) -> DataFrame:
    """Keep the first row of each key in log order; ``copies`` says how many arrived.

    Copies combine map-side, so a key repeated a billion times reaches the reducer as one
    row per map task. A bounded horizon would not change candles: copies share their event
    time, so one that arrives after window plus grace is late anyway.
    """
    rest = [c for c in trades.columns if c not in keys]
    return (
        trades.withColumn("__order", log_order())
        .groupBy(*keys)
        .agg(F.min_by(F.struct(*rest), F.col("__order")).alias("__first"), F.count("*").alias("copies"))
        .select(*keys, "__first.*", "copies")
        .select(*trades.columns, "copies")
    )


def dedupe_within(trades: DataFrame, horizon_ms: int, keys: Sequence[str] = ("exchange", "dedupe_key"), at: str = "ingestion_time") -> DataFrame:
    """First row of each key, and again the first that comes more than ``horizon_ms`` after the one kept last.

    The form for sources that reuse ids, and the batch twin of :func:`tickweave.streaming.dedupe.dedupe_stream`. Arrival times
    (``at``) must not run back along the log. Almost all keys span no more than the horizon and need only their first row, which
    Spark finds with one row per key and map task. Of the rest, a row after a pause longer than the horizon is always kept, so
    that pauses cut a key into chains; only inside a chain do rows depend on those before.
    """
    order, arrival = log_order(), F.unix_millis(at)
    spans = trades.groupBy(*keys).agg((F.max(arrival) - F.min(arrival)).alias("span"))
    # How many there are is not known beforehand: Spark chooses the join by their size.
    long = spans.where(F.col("span") > horizon_ms).select(*keys)
    simple = first_per_key(trades.join(long, list(keys), "left_anti"), keys, *[F.asc(c) for c in POSITION])
    rest = trades.join(long, list(keys), "left_semi")
    narrow = rest.select(*keys, order.alias("__order"), arrival.alias("__at")).withColumn("__seen", F.col("__at"))
    chunk = F.expr(f"(__at - pmod(__at, {64 * horizon_ms})) div {64 * horizon_ms}")
    linked = running(narrow, list(keys), chunk, ["__at", "__order"], {"__previous": Running("max", "__seen", before=True)})
    starts = linked.withColumn("__start", F.when(F.coalesce(F.col("__at") - F.col("__previous") > horizon_ms, F.lit(True)), F.col("__at")))
    chained = running(starts, list(keys), chunk, ["__at", "__order"], {"__chain": Running("max", "__start")})
    ordered = chained.repartition(*keys, "__chain").sortWithinPartitions(*keys, "__chain", "__at", "__order").select(*keys, "__chain", "__order", "__at")
    width = len(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = held = None
        for batch in batches:
            kept = []
            for *chain, _, arrived in zip(*(c.to_pylist() for c in batch.columns)):
                if chain != now or arrived > held + horizon_ms:
                    now, held = chain, arrived
                    kept.append(True)
                else:
                    kept.append(False)
            yield batch.filter(pa.array(kept, pa.bool_())).select([*range(width), width + 1])

    fields = {f.name: f for f in ordered.schema.fields}
    winners = ordered.mapInArrow(run, T.StructType([fields[c] for c in (*keys, "__order")]))
    chosen = rest.withColumn("__order", order).join(winners, [*keys, "__order"], "left_semi").drop("__order")
    return simple.select(*trades.columns).unionByName(chosen.select(*trades.columns))


def duplicates_count(trades: DataFrame, keys: Sequence[str] = ("exchange", "dedupe_key")) -> DataFrame:
    """Dropped copies per instrument. Two levels, so no task holds a distinct set."""
    per_key = trades.groupBy(*dict.fromkeys([*KEYS, *keys])).agg(F.count("*").alias("n"))
    return per_key.groupBy(*KEYS).agg(F.sum(F.col("n") - 1).alias("duplicates"))


def first_per_key(df: DataFrame, keys: Sequence[str], *order: Column) -> DataFrame:
    """The first row of each key. Spark prunes to one row per key and map task before the
    shuffle (window group limit), and unused columns never leave the scan."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__rank", rank).where(F.col("__rank") == 1).drop("__rank")


def first_n_per_key(df: DataFrame, keys: Sequence[str], n: int, *order: Column) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__rank", rank).where(F.col("__rank") <= n).drop("__rank")


def latest_by_key(df: DataFrame, keys: Sequence[str], *version: str) -> DataFrame:
    """Current-state table: the row with the highest version of each key."""
    return first_per_key(df, keys, *[F.desc(v) for v in version])
