"""Running and trailing window values that never put one whole key into one task.

A plain ``Window.partitionBy(instrument)`` sorts every row of an instrument in a single
task. Here the rows of a key are cut into chunks (by log offset or by time); each chunk
gets what it needs from its neighbours as extra rows, and the window runs per chunk.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Log offsets per chunk: a chunk's sort fits one task, and there are few chunks per key.
CHUNK_ROWS = 65_536

_CARRY, _CHUNK = "__carry", "__chunk"


@dataclass(frozen=True)
class Running:
    """One running value: ``kind`` is max, sum, first or last; ``source`` a column of the input.

    ``before`` leaves the current row out. ``first`` and ``last`` skip NULLs.
    """

    kind: str
    source: str
    before: bool = False


def running(df: DataFrame, scope: Sequence[str], chunk: Column, order: Sequence[str],
            values: dict[str, Running], whole: dict[str, str] | None = None, within: Column | None = None,
            carried: DataFrame | None = None) -> DataFrame:
    """Add running values per ``scope`` in ``order``; ``chunk`` must not decrease along it.

    ``whole`` adds the maximum or sum over the whole scope, by result name and a source that
    has a running maximum or sum; it rides on the same carry-ins, so it costs no further pass.
    ``within`` is one number that orders a chunk's rows as ``order`` does: with it the summaries are hash aggregates.
    ``carried`` holds, per scope, the sources' values from before ``df``, by source name.

    One partial aggregate summarises each chunk, a window over those few summary rows makes
    the carry-in of every chunk, and the carry-ins join the data as rows that sort first.
    The data is shuffled once, by (scope, chunk).
    """
    rows = df.withColumn(_CHUNK, chunk)
    sources = {v.source for v in values.values()}
    summary_order = F.struct(*order) if within is None else within
    summaries = {
        "max": lambda c: F.max(c),
        "sum": lambda c: F.sum(c),
        # min_by/max_by skip rows whose ordering value is NULL, so NULL sources drop out.
        "last": lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), summary_order)),
        "first": lambda c: F.min_by(c, F.when(F.col(c).isNotNull(), summary_order)),
    }
    needed = {(v.kind, v.source) for v in values.values()}
    whole = whole or {}
    if len({s for _, s in needed}) != len(needed) or set(whole.values()) - {s for k, s in needed if k in ("max", "sum")}:
        raise ValueError("use one running kind per source column, max or sum for whole")
    kind_of = {s: k for k, s in needed}

    chunks = rows.groupBy(*scope, _CHUNK).agg(
        *[summaries[kind_of[s]](s).alias(s) for s in sorted(sources)])
    if carried is not None:
        # A null chunk sorts first.
        chunks = chunks.unionByName(carried.select(*scope, F.lit(None).cast(chunks.schema[_CHUNK].dataType).alias(_CHUNK), *sorted(sources)))
    over_chunks = (Window.partitionBy(*scope).orderBy(_CHUNK)
                   .rowsBetween(Window.unboundedPreceding, -1))
    combine = {
        "max": lambda c: F.max(c).over(over_chunks),
        "sum": lambda c: F.sum(c).over(over_chunks),
        "last": lambda c: F.last(c, ignorenulls=True).over(over_chunks),
        "first": lambda c: F.first(c, ignorenulls=True).over(over_chunks),
    }
    all_chunks = Window.partitionBy(*scope)
    carry = chunks.select(
        *scope, _CHUNK, *[combine[kind_of[s]](s).cast(df.schema[s].dataType).alias(s) for s in sorted(sources)],
        *[(F.max(s) if kind_of[s] == "max" else F.sum(s)).over(all_chunks).alias(f"__whole_{name}")
          for name, s in whole.items()],
        F.lit(0).alias(_CARRY))
    if carried is not None:
        carry = carry.where(F.col(_CHUNK).isNotNull())

    window = Window.partitionBy(*scope, _CHUNK).orderBy(_CARRY, *order)
    frame = {
        False: window.rowsBetween(Window.unboundedPreceding, Window.currentRow),
        True: window.rowsBetween(Window.unboundedPreceding, -1),
    }
    pick = {
        "max": lambda c, w: F.max(c).over(w),
        "sum": lambda c, w: F.sum(c).over(w),
        "last": lambda c, w: F.last(c, ignorenulls=True).over(w),
        "first": lambda c, w: F.first(c, ignorenulls=True).over(w),
    }
    return (
        rows.withColumn(_CARRY, F.lit(1))
        .unionByName(carry, allowMissingColumns=True)
        .select("*", *[pick[v.kind](v.source, frame[v.before]).alias(name) for name, v in values.items()],
                *[F.max(f"__whole_{name}").over(frame[False]).alias(name) for name in whole])
        .where(F.col(_CARRY) == 1)
        .drop(_CARRY, _CHUNK, *[f"__whole_{name}" for name in whole])
    )


def offset_chunk(offset: str = "src_offset", rows: int = CHUNK_ROWS, partition: str = "src_partition") -> Column:
    """Chunk of a log position; it follows ``(partition, offset)`` order, as positions do."""
    return F.struct(F.col(partition), F.expr(f"`{offset}` div {rows}").alias("block"))


def sliding_sums(df: DataFrame, scope: Sequence[str], at_ms: str, span_ms: int, sums: dict[str, str], chunk_ms: int = 3_600_000) -> DataFrame:
    """Add sums of columns (result name to source) over ``[at - span, at]``, for rows that are unique per (scope, ms).

    Each row is sent twice: when it enters the span, and with its sign turned when it has left it. One running total of
    both is the sliding sum, so the work is linear however many rows a span holds. Exact for whole numbers and decimals only.
    """
    negated = {c: (-F.col(c)) if df.schema[c].dataType.typeName() != "decimal" else (F.lit(0).cast(df.schema[c].dataType) - F.col(c)).cast(df.schema[c].dataType)
               for c in dict.fromkeys(sums.values())}
    enters = df.withColumn("__enters", F.lit(1))
    leaves = df.select(*scope, (F.col(at_ms) + span_ms + 1).alias(at_ms), *(v.alias(c) for c, v in negated.items()), F.lit(0).alias("__enters"))
    both = enters.unionByName(leaves, allowMissingColumns=True)
    chunk = F.expr(f"(`{at_ms}` - pmod(`{at_ms}`, {chunk_ms})) div {chunk_ms}")
    summed = running(both, scope, chunk, [at_ms, "__enters"], {name: Running("sum", source) for name, source in sums.items()})
    return summed.where(F.col("__enters") == 1).drop("__enters")


def trailing(df: DataFrame, scope: Sequence[str], at_ms: str, span_ms: int, values: dict[str, Column],
             *, include_current: bool = True, bucket_ms: int | None = None) -> DataFrame:
    """Add aggregates over the ``span_ms`` before each row (``rangeBetween`` on ``at_ms``).

    Time is cut into buckets; a row in the last ``span_ms`` of a bucket is also sent to the
    next one as context. Callers aggregate to one row per (scope, ms) first, so a bucket
    holds at most ``bucket_ms + span_ms`` rows whatever the trade rate.
    """
    width = max(bucket_ms or 8 * span_ms, span_ms)
    # Floor division, so that buckets before 1970 also run forward.
    bucket = F.expr(f"(`{at_ms}` - pmod(`{at_ms}`, {width})) div {width}")
    edge = F.expr(f"pmod(`{at_ms}`, {width})") >= F.lit(width - span_ms)
    spread = df.withColumn("__own", bucket).withColumn(
        "__bucket", F.explode(F.when(edge, F.array(F.col("__own"), F.col("__own") + 1))
                              .otherwise(F.array(F.col("__own")))))
    window = (Window.partitionBy(*scope, "__bucket").orderBy(at_ms)
              .rangeBetween(-span_ms, Window.currentRow if include_current else -1))
    return (
        spread.select("*", *[agg.over(window).alias(name) for name, agg in values.items()])
        .where(F.col("__own") == F.col("__bucket"))
        .drop("__own", "__bucket")
    )
