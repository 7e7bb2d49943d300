"""Exact decimal(38,18) arithmetic on Columns.

Spark rounds a plain (38,18) product or quotient to 6 decimals (or overflows it), so the
product is assembled from pieces whose types are exact, and the quotient relies on
``allowPrecisionLoss=false`` (see :mod:`tickweave.session`).
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

SCALE = 18
PRECISION = 38
DECIMAL = f"decimal({PRECISION},{SCALE})"


def zero() -> Column:
    return F.lit(0).cast(DECIMAL)


def canonical(value: Column) -> Column:
    """Scale 18, HALF_UP; NULL when the value does not fit 38 digits."""
    return value.try_cast(DECIMAL)


def java_trim(text: Column) -> Column:
    """Strip every leading and trailing character up to U+0020 (tabs and controls too)."""
    return F.regexp_replace(text, r"^[\x00-\x20]+|[\x00-\x20]+$", "")


def is_blank(text: Column) -> Column:
    return text.isNull() | text.rlike(r"^\p{javaWhitespace}*$")


def parse_decimal(text: Column) -> Column:
    """Wire text to canonical scale; blank or non-numeric text gives NULL."""
    return F.when(~is_blank(text), java_trim(text).try_cast(DECIMAL))


def exact_mul(left: Column, right: Column) -> Column:
    """``left * right`` rounded HALF_UP to 18 decimals, exact for every (38,18) input pair.

    Prices up to 8 decimals and sizes up to 10 take one multiplication. Other rows split
    each factor at the 9th decimal: the head product has 18 decimals and needs no rounding,
    and the three small products are summed below the 18th decimal before one rounding.
    """
    a8, b10 = left.try_cast("decimal(19,8)"), right.try_cast("decimal(18,10)")
    fast = (a8 == left) & (b10 == right)
    return F.when(fast, (a8 * b10).cast(DECIMAL)).otherwise(_split_mul(left, right))


def _negate(value: Column) -> Column:
    # Spark's unary minus and abs() round to 34 digits; a product with -1 does not.
    return (value * F.lit(-1).cast("decimal(1,0)")).cast(DECIMAL)


def _split_mul(left: Column, right: Column) -> Column:
    x, y = (F.when(v < 0, _negate(v)).otherwise(v.cast(DECIMAL)) for v in (left, right))
    x_head, y_head = (F.floor(v, F.lit(9)).cast("decimal(29,9)") for v in (x, y))
    x_tail, y_tail = ((v - h).cast("decimal(18,18)") for v, h in ((x, x_head), (y, y_head)))

    cross = [x_head * y_tail, y_head * x_tail]                    # decimal(38,27), below 1e11
    cross_head = [F.floor(c, F.lit(18)).cast("decimal(30,18)") for c in cross]
    cross_tail = [(c - h).cast("decimal(28,27)") for c, h in zip(cross, cross_head)]
    below = (cross_tail[0] + cross_tail[1]).cast("decimal(29,27)") + x_tail * y_tail
    total = F.try_add(
        F.try_multiply(x_head, y_head).cast(DECIMAL),
        (cross_head[0] + cross_head[1]).cast(DECIMAL) + below.cast(DECIMAL),
    )
    return F.when((left < 0) != (right < 0), _negate(total)).otherwise(total).cast(DECIMAL)


def safe_div(dividend: Column, divisor: Column) -> Column:
    """Quotient at scale 18 HALF_UP; zero when the divisor is zero or NULL, NULL on overflow."""
    spark = SparkSession.getActiveSession()
    if spark and spark.conf.get("spark.sql.decimalOperations.allowPrecisionLoss", "true") != "false":
        raise RuntimeError("call tickweave.session.configure(spark) first: quotients would lose 12 digits")
    bad = divisor.isNull() | (divisor == F.lit(0))
    return F.when(bad, zero()).otherwise(
        F.try_divide(dividend.cast(DECIMAL), divisor.cast(DECIMAL)).cast(DECIMAL))
