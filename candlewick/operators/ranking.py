"""Ranking of features by strength and stability of their correlation with the next return."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.frames import KEYS, feature_keys
from ..functions.scalars import finite

BATCH_ROWS = 50_000
MIN_PRODUCT = 1e-9


def batch_correlations(rows: DataFrame, batch_rows: int = BATCH_ROWS) -> DataFrame:
    """instrument, timeframe, batch_id, idx, feature, abs_r from (clean_rn, idx, feature, value, target); without names if the rows have none.

    Explicit pairwise-finite sums in one grouped aggregate; fewer than two pairs or no variance give 0.
    """
    x, y = F.col("value"), F.col("target")
    pairs = rows.where(finite(y)).withColumn("batch_id", F.floor((F.col("clean_rn") - 1) / batch_rows).cast("long"))
    ok = finite(x)
    by = feature_keys(rows)
    g = pairs.groupBy(*KEYS, "batch_id", *by).agg(
        F.count(F.when(ok, 1)).alias("n"), *(F.sum(F.when(ok, v)).alias(a) for v, a in ((x, "sx"), (y, "sy"), (x * x, "sxx"), (y * y, "syy"), (x * y, "sxy")))
    )
    n = F.col("n").cast("double")
    top = n * F.col("sxy") - F.col("sx") * F.col("sy")
    under = (n * F.col("sxx") - F.col("sx") * F.col("sx")) * (n * F.col("syy") - F.col("sy") * F.col("sy"))
    root = F.when(under > 0, F.sqrt(F.when(under > 0, under)))
    r = F.when((F.col("n") >= 2) & (root > MIN_PRODUCT), F.abs(top / F.when(root > MIN_PRODUCT, root))).otherwise(0.0)
    return g.select(*KEYS, "batch_id", *by, r.alias("abs_r"))


def stability(batches: DataFrame, penalty: float = 1.0) -> DataFrame:
    """mean, population std_dev and stability_score = mean - penalty * std_dev, with rank per series.
    Ties go to the greater mean, then to schema order; values are compared to 12 decimals, so that
    equal features tie whatever the order in which their sums were added."""
    g = batches.groupBy(*KEYS, *feature_keys(batches)).agg(F.avg("abs_r").alias("mean"), F.stddev_pop("abs_r").alias("std_dev"))
    g = g.withColumn("stability_score", F.col("mean") - penalty * F.col("std_dev"))
    # one row per feature: a series has no more of them than its schema
    w = Window.partitionBy(*KEYS).orderBy(F.round("stability_score", 12).desc(), F.round("mean", 12).desc(), F.col("idx"))
    return g.withColumn("rank", F.row_number().over(w))


def target_count(features: int) -> int:
    return max(50, math.ceil(0.25 * features))


def top_features(ranking: DataFrame, k: int) -> DataFrame:
    return ranking.where(F.col("rank") <= k)
