"""Sinks: a feature list as text, selected rows as Parquet, ranking reports."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession


def write_feature_list(spark: SparkSession, names: Iterable[str], path: str) -> None:
    """One name per line, in one file of a folder that any Hadoop file system holds; overwritten."""
    rows = [(n,) for n in names]
    spark.createDataFrame(rows, "value string").coalesce(1).write.mode("overwrite").text(path)


def read_feature_list(spark: SparkSession, path: str) -> list[str]:
    return [r.value for r in spark.read.text(path).collect()]


def write_parquet(df: DataFrame, path: str) -> None:
    """One Parquet file; without rows a valid empty one."""
    df.coalesce(1).write.mode("overwrite").parquet(path)


def report(ranking: DataFrame, by: str, k: int) -> str:
    """The k first rows by ``by`` as a fixed-width table with four decimals."""
    from pyspark.sql import functions as F

    rows = ranking.orderBy(F.col(by).desc(), F.col("mean").desc(), F.col("idx")).limit(k).collect()
    lines = [f"{'rank':>4}  {'feature':<28} {'mean':>10} {'std_dev':>10} {'score':>10}"]
    lines += [f"{i:>4}  {r.feature:<28} {r.mean:>10.4f} {r.std_dev:>10.4f} {r.stability_score:>10.4f}" for i, r in enumerate(rows, 1)]
    return "\n".join(lines)
