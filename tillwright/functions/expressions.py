"""Scalar and aggregate expressions, all built from JVM-side functions."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import rules

# Every character Unicode counts as white space: cleaning removes all of them, not only blanks.
WHITESPACE = "".join(c for c in map(chr, range(0x3001)) if c.isspace())


def strip(text: Column) -> Column:
    return F.trim(text, F.lit(WHITESPACE))


def capitalize(text: Column) -> Column:
    """First letter upper, the rest lower."""
    return F.concat(F.upper(F.substring(text, 1, 1)), F.lower(text.substr(F.lit(2), F.length(text))))


def title_label(text: Column) -> Column:
    """`net_banking` -> `Net Banking`."""
    return F.initcap(F.replace(text, F.lit("_"), F.lit(" ")))


def shorten(text: Column, width: int) -> Column:
    return F.when(F.length(text) > width, F.concat(F.substring(text, 1, width), F.lit("..."))).otherwise(text)


def clip(value: Column, low: int, high: int) -> Column:
    """Bound a value. A null stays null, which least/greatest would turn into a bound."""
    return F.when(value < low, F.lit(low)).when(value > high, F.lit(high)).otherwise(value)


def strict_timestamp(value: Column) -> Column:
    """Parse or fail the job, whatever the session's ANSI setting."""
    parsed = value.try_cast("timestamp")
    message = F.concat(F.lit("not a timestamp: "), value.cast("string"))
    return F.when(value.isNotNull() & parsed.isNull(), F.raise_error(message).cast("timestamp")).otherwise(parsed)


def lenient_timestamp(value: Column) -> Column:
    return value.try_cast("timestamp")


def midnight(as_of: date, days_back: int = 0) -> Column:
    """Start of a day as a literal, so that date filters reach the scan."""
    return F.lit(str(as_of - timedelta(days=days_back))).cast("timestamp")


def instant(as_of: date | datetime) -> Column:
    """A reporting instant; a plain date means its midnight."""
    return F.lit(str(as_of)).cast("timestamp")


def interval_part(part: str, later: Column, earlier: Column) -> Column:
    """One component (DAY, HOUR or SECOND) of a time difference, not its total."""
    return F.extract(F.lit(part), later - earlier)


def seconds_between(later: Column, earlier: Column) -> Column:
    """Elapsed seconds with their fraction."""
    return (F.unix_micros(later) - F.unix_micros(earlier)) / F.lit(1e6)


def _ladder(value: Column, bounds, otherwise: str) -> Column:
    label = None
    for name, bound in bounds:
        label = F.when(value > bound, name) if label is None else label.when(value > bound, name)
    return label.otherwise(otherwise)


def segment(total_spent: Column) -> Column:
    return _ladder(total_spent, rules.SEGMENT_BOUNDS, rules.LOWEST_SEGMENT)


def activity(days_idle: Column) -> Column:
    return _ladder(days_idle, rules.ACTIVITY_BOUNDS, rules.ACTIVE)


# Conditions on a transaction row.

def has_status(status: str) -> Column:
    return F.col("transaction_status") == status


def succeeded() -> Column:
    return has_status(rules.SUCCESS)


# Aggregates over transaction rows.

def amount_where(condition: Column) -> Column:
    """Sum of amounts where the condition holds, 0 when it never does."""
    return F.sum(F.when(condition, F.col("amount")).otherwise(F.lit(0).cast("decimal(15,2)")))


def revenue() -> Column:
    return amount_where(succeeded())


def orders() -> Column:
    return F.count_if(succeeded())


# Ratios of two aggregates. Sums and counts combine across partial results, so every mean is kept as
# such a pair until the last step; the decimal quotient has 14 or more digits, which makes the
# rounding to 2 exact, while avg(decimal) is itself rounded to 6 digits first.

def ratio(total: Column, count: Column) -> Column:
    return F.try_divide(total.cast("decimal(28,6)"), count.cast("decimal(20,0)"))


def mean2(total: Column, count: Column) -> Column:
    """Mean rounded to 2 digits, half up; null for an empty group."""
    return F.round(ratio(total, count), 2)


def mean2_half_even(total: Column, count: Column) -> Column:
    return F.bround(ratio(total, count), 2)


def percent2(part: Column, whole: Column) -> Column:
    """Percentage rounded to 2 digits; null when there is no whole."""
    share = F.try_divide(part.cast("decimal(20,0)") * F.lit(100), whole.cast("decimal(20,0)"))
    return F.round(share, 2).cast("double")


def mean(total: Column, count: Column) -> Column:
    """Unrounded mean as a double; null for an empty group."""
    return F.try_divide(total.cast("double"), count.cast("double"))


def percent(part: Column, whole: Column) -> Column:
    """Unrounded percentage as a double."""
    return F.try_divide(part.cast("double"), whole.cast("double")) * F.lit(100.0)
