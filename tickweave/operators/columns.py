"""Plan shaping shared by the parsing operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are worked out exactly once per row.

    A filter on a plain projection is pushed below it and repeats its expressions; it
    cannot pass a generator. Used between the heavy parsing steps only.
    """
    row = F.struct(*[value.alias(name) for name, value in columns.items()])
    return df.select("*", F.inline(F.array(row)))
