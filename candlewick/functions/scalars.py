"""Scalar column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PRICE_TYPE = "decimal(18,5)"


def price(value: Column) -> Column:
    """A double, read to 12 decimals, as decimal(18,5), half to even; NaN and infinities become 0."""
    finite = value.isNotNull() & ~F.isnan(value) & (F.abs(value) != float("inf"))
    return F.when(finite, F.bround(F.when(finite, value).otherwise(0.0).cast("decimal(28,12)"), 5)).otherwise(F.lit(0)).cast(PRICE_TYPE)


def epoch_to_timestamp(seconds: Column) -> Column:
    return F.timestamp_seconds(seconds)


def minute_of_hour(ts: Column) -> Column:
    return F.minute(ts).cast("smallint")


def hour_of_day(ts: Column) -> Column:
    return F.hour(ts).cast("smallint")


def day_of_week(ts: Column) -> Column:
    """1 is Monday, 7 is Sunday."""
    return (F.weekday(ts) + 1).cast("smallint")


def total_volume(bid: Column, ask: Column) -> Column:
    return (bid + ask).cast("double")


def typical_price(high: Column, low: Column, close: Column) -> Column:
    return (high + low + close) / F.lit(3.0)


def true_range(high: Column, low: Column, previous_close: Column) -> Column:
    return F.greatest(high - low, F.abs(high - previous_close), F.abs(low - previous_close))


def finite(value: Column) -> Column:
    """Neither null, NaN nor infinite."""
    return value.isNotNull() & ~F.isnan(value) & (F.abs(value) != float("inf"))


def ratio(a: Column, b: Column) -> Column:
    """a / b, null where b is 0."""
    return F.when(b != 0, a / F.when(b != 0, b))


def feature_name(family: Column, period: Column) -> Column:
    return F.concat_ws("_", family, period.cast("string"))
