"""Comparing two outputs: A/B diffs, an expected side, replay equality."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import KEYS

CANDLE_KEY = (*KEYS, "window", "window_start")
CANDLE_VALUES = ("open", "high", "low", "close", "volume", "quote_volume", "vwap", "buy_volume", "sell_volume",
                 "trade_count")


def _sides(a: DataFrame, b: DataFrame, key: Sequence[str], values: Sequence[str], how: str) -> DataFrame:
    left = a.select(*key, *[F.col(v).alias(f"a_{v}") for v in values], F.lit(True).alias("__a"))
    right = b.select(*key, *[F.col(v).alias(f"b_{v}") for v in values], F.lit(True).alias("__b"))
    return left.join(right, list(key), how)


def _changed(values: Sequence[str]) -> Column:
    names = F.array(*[F.when(~F.col(f"a_{v}").eqNullSafe(F.col(f"b_{v}")), F.lit(v)) for v in values])
    return F.filter(names, lambda n: n.isNotNull())


def ab_diff(a: DataFrame, b: DataFrame, key: Sequence[str] = CANDLE_KEY,
            values: Sequence[str] = CANDLE_VALUES) -> DataFrame:
    """Full outer comparison; ``status`` is same, changed, only_a or only_b."""
    joined = _sides(a, b, key, values, "full_outer").withColumn("changed", _changed(values))
    status = (F.when(F.col("__b").isNull(), "only_a").when(F.col("__a").isNull(), "only_b")
              .when(F.size("changed") > 0, "changed").otherwise("same"))
    return joined.withColumn("status", status).drop("__a", "__b")


def diff_summary(diff: DataFrame) -> DataFrame:
    return diff.groupBy("status").agg(F.count("*").alias("candles"))


def oracle_compare(produced: DataFrame, expected: DataFrame, key: Sequence[str] = CANDLE_KEY,
                   values: Sequence[str] = CANDLE_VALUES) -> DataFrame:
    """Every produced row with the fields that differ from the expected side.

    ``matched`` is false for a row the expected side lacks; the expected side may hold more.
    """
    joined = _sides(produced, expected, key, values, "left")
    return joined.select(
        *key, F.col("__b").isNotNull().alias("matched"),
        F.when(F.col("__b").isNull(), F.lit(None)).otherwise(_changed(values)).alias("differences"))


def replay_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Whole rows with unequal counts on the two sides; empty when the replays agree.

    One aggregate over both sides replaces two multiset subtractions.
    """
    columns = a.columns
    both = a.select(*columns, F.lit(1).alias("__n")).unionByName(b.select(*columns, F.lit(-1).alias("__n")))
    return both.groupBy(*columns).agg(F.sum("__n").alias("surplus")).where(F.col("surplus") != 0)


def finalised_twice(finals: DataFrame, key: Sequence[str] = CANDLE_KEY) -> DataFrame:
    return finals.groupBy(*key).agg(F.count("*").alias("times")).where(F.col("times") > 1)
