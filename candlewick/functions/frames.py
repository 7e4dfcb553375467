"""Row frames over an ordered series. A partial frame never gives a value."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scalars import true_range, typical_price

KEYS = ("instrument", "timeframe")
ORDER = "timestamp"


def feature_keys(df: DataFrame) -> list[str]:
    """What tells features apart in ``df``: the index, and the name if it is there."""
    return [c for c in ("idx", "feature") if c in df.columns]


_partition: ContextVar[tuple[str, ...]] = ContextVar("partition", default=KEYS)


@contextmanager
def partitioned_by(*keys: str) -> Iterator[None]:
    """Frames built inside are partitioned by ``keys`` instead of the series."""
    token = _partition.set(keys)
    try:
        yield
    finally:
        _partition.reset(token)


def base():
    return Window.partitionBy(*_partition.get()).orderBy(ORDER)


def last(p: int):
    """The trailing p rows, this one included."""
    return base().rowsBetween(-(p - 1), 0)


def before(p: int):
    """The p rows before this one."""
    return base().rowsBetween(-p, -1)


def whole():
    return base().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)


def so_far():
    return base().rowsBetween(Window.unboundedPreceding, 0)


def full(p: int, value: Column) -> Column:
    """``value`` once p rows are there."""
    return F.when(F.col("rn") >= p, value)


def full_after(p: int, value: Column) -> Column:
    """``value`` once p rows and one before are there."""
    return F.when(F.col("rn") > p, value)


def with_bars(candles: DataFrame) -> DataFrame:
    """Adds what families share, in one sorted pass: rn and n (if not there), the previous bar,
    change, true range (tr, 0 on the first bar) and typical price (tp)."""
    w = base()
    if "rn" not in candles.columns:
        candles = candles.withColumns({"rn": F.row_number().over(w).cast("long"), "n": F.count("*").over(whole())})
    df = candles.withColumns(
        {
            "prev_high": F.lag("high").over(w),
            "prev_low": F.lag("low").over(w),
            "prev_close": F.lag("close").over(w),
            "tp": typical_price(F.col("high"), F.col("low"), F.col("close")),
        }
    )
    first = F.col("prev_close").isNull()
    df = df.withColumns(
        {
            "change": F.when(~first, F.col("close") - F.col("prev_close")),
            "tr": F.when(first, 0.0).otherwise(true_range(F.col("high"), F.col("low"), F.col("prev_close"))),
            "prev_tp": typical_price(F.col("prev_high"), F.col("prev_low"), F.col("prev_close")),
        }
    )
    return df
