"""Column quality: constant, empty and duplicate features."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.frames import KEYS, feature_keys

MIN_RANGE = 1e-9
EMPTY, CONSTANT = "All Null / Empty", "Zero Variance (Constant Value)"


def feature_ranges(cells: DataFrame) -> DataFrame:
    """Per series and feature: least and greatest value (NaN passed over), values present, and two
    independent 64-bit sums over (row, value) that equal columns share.

    One grouped aggregate with map-side partials, so a feature is one row per task however many bars.
    """
    real = F.when(~F.isnan("value"), F.col("value"))
    exact = F.when(F.col("value") == 0, 0.0).otherwise(F.col("value"))  # -0.0 equals 0.0
    marks = [F.bit_xor(F.xxhash64(F.lit(salt), "rn", exact)).alias(f"mark{salt}") for salt in (1, 2)]
    return cells.groupBy(*KEYS, *feature_keys(cells)).agg(F.min(real).alias("min"), F.max(real).alias("max"), F.count("value").alias("present"), F.count(real).alias("real"), *marks)


def _unequal(cells: DataFrame, pairs: DataFrame) -> DataFrame:
    """(series, idx) of ``pairs`` (series, idx, first_idx) whose values differ in some row; NaN equals
    NaN and null equals null. Only the cells of the pairs take part."""
    rows = cells.select(*KEYS, "rn", "idx", "value")
    mine = rows.join(F.broadcast(pairs), [*KEYS, "idx"])  # at most one row per feature of the schema and series
    theirs = rows.join(F.broadcast(pairs.select(*KEYS, F.col("first_idx").alias("idx")).distinct()), [*KEYS, "idx"]).select(*KEYS, "rn", F.col("idx").alias("first_idx"), F.col("value").alias("first_value"))
    return mine.join(theirs, [*KEYS, "rn", "first_idx"]).where(~F.col("value").eqNullSafe(F.col("first_value"))).select(*KEYS, "idx").distinct()


def screen(cells: DataFrame, name: Callable[[Column], Column] | None = None) -> DataFrame:
    """instrument, timeframe, idx, feature, min, max, kept, reason. ``name`` gives features their names
    where ``cells`` have none.

    A feature with NaN only has no range and is kept. Of equal features that are not dropped already,
    the first in schema order stays. Equal marks find the candidates; values confirm them.
    """
    f = feature_ranges(cells)
    f = f.withColumn("feature", name(F.col("idx"))) if name else f
    reason = F.when(F.col("present") == 0, EMPTY).when((F.col("real") > 0) & (F.abs(F.col("max") - F.col("min")) < MIN_RANGE), CONSTANT)
    f = f.withColumn("reason", reason)
    equal = Window.partitionBy(*KEYS, "present", "mark1", "mark2", F.col("reason").isNull())
    first = F.min(F.struct("idx", "feature")).over(equal)
    f = f.withColumn("first", F.when(F.col("reason").isNull(), first))
    pairs = f.where(F.col("reason").isNull() & (F.col("first.idx") != F.col("idx"))).select(*KEYS, "idx", F.col("first.idx").alias("first_idx"))
    f = f.join(_unequal(cells, pairs).withColumn("unequal", F.lit(True)), [*KEYS, "idx"], "left")
    duplicate = F.col("reason").isNull() & (F.col("first.idx") != F.col("idx")) & F.col("unequal").isNull()
    f = f.withColumn("reason", F.when(duplicate, F.concat(F.lit("Duplicate of "), F.col("first.feature"))).otherwise(F.col("reason")))
    return f.select(*KEYS, "idx", "feature", "min", "max", F.col("reason").isNull().alias("kept"), "reason")
