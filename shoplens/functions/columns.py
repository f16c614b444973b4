"""Column expressions shared by the operators (all JVM-side, no UDF)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

# typed literal: a Python datetime literal would pass through the session zone
_EPOCH_NTZ = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"

# Amounts are summed exactly with ten decimals; sums are reported with six.
MONEY = "decimal(28,10)"
REPORTED = "decimal(38,6)"


def is_ntz(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, TimestampNTZType)


def epoch_seconds(df: DataFrame, name: str) -> Column:
    """Whole seconds since 1970-01-01, floored (like ``CAST(ts AS BIGINT)``).

    An NTZ wall clock is read as UTC without going through the session time
    zone, so the result does not move with that setting (a zone with daylight
    saving would otherwise add or drop an hour across the switch).
    """
    c = F.col(name)
    if not is_ntz(df, name):
        return c.cast("long")
    micros = F.timestamp_diff("MICROSECOND", F.expr(_EPOCH_NTZ), c)
    # floor division for negative values too
    return ((micros - F.pmod(micros, F.lit(1_000_000))) / F.lit(1_000_000)).cast("long")


def seconds_between_in_days(df: DataFrame, start: str, end: str) -> Column:
    """(epoch(end) - epoch(start)) / 86400 as a double; null if either is null."""
    return (epoch_seconds(df, end) - epoch_seconds(df, start)) / F.lit(86400)


def as_money(c: Column | str) -> Column:
    """A double amount as an exact decimal, so sums do not depend on row order.

    Null for what is no amount (NaN, infinite, 10^18 or more): such a value is
    neither summed nor counted; ``quality.unusable_amounts`` reports it.
    """
    c = F.col(c) if isinstance(c, str) else c
    return c.try_cast(MONEY)


def reported(total: Column) -> Column:
    """An exact decimal sum as a double, rounded to six places after summing."""
    return total.cast(REPORTED).cast("double")


def money_sum(c: Column | str) -> Column:
    """Exact sum of a double money column, returned as double."""
    return reported(F.sum(as_money(c)))


def money_mean(c: Column | str) -> Column:
    """Mean of a money column: its exact sum over the number of values summed."""
    return safe_divide(money_sum(c), F.count(as_money(c)))


def safe_divide(num: Column, den: Column) -> Column:
    """``num / den``, null where ``den`` is 0 or null (ANSI division would raise)."""
    return F.when(den != 0, num / den)


def percentage(part: Column, whole: Column) -> Column:
    """``part / whole * 100``, 0 where ``whole`` is 0."""
    return F.when(whole > 0, part / whole * F.lit(100)).otherwise(F.lit(0.0))
